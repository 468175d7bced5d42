"""The library's input tables derived from the star-schema and document tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.operators.embedding import token_table
from ratingloom.operators.filters import rating_matrix
from ratingloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _rating():
    return (F.pmod(F.round(F.col("l_discount") * 100).cast("int"), F.lit(5)) + 1).cast("double")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("parent_asin"),
        _rating().alias("rating"),
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, item), repeated ones averaged."""
    return rating_matrix(ratings(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("parent_asin"),
        _rating().alias("rating"),
        F.col("l_quantity").cast("int").alias("helpful_vote"),
        (F.col("l_linestatus") == "F").alias("verified_purchase"),
        F.array_repeat(F.lit("img"), F.pmod(F.col("l_linenumber"), F.lit(4))).alias("images"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as they may arrive: ratings as text, some unreadable, some ids missing."""
    text = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(_rating().cast("string"))
    return _sales(spark, sf_dir).select(
        F.when(F.col("l_tax") > 0, F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("l_partkey").cast("string").alias("parent_asin"),
        text.alias("rating"),
        F.col("l_quantity").cast("int").alias("helpful_vote"),
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.array("p_type", "p_brand").alias("description"),
        F.struct(F.col("p_brand").alias("name")).alias("author"),
        F.array("p_type").alias("categories"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("string")).alias("price"),
    )


def item_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"), "embedding", F.col("label").alias("cluster")
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def word_vectors(spark: SparkSession, sf_dir: str, words: DataFrame, spread: int) -> DataFrame:
    """A fixed vector per word, picked from the embeddings by the word's hash.

    ``spread`` times as many slots as vectors, so a part of the words stays unknown.
    """
    embeddings = table(spark, sf_dir, "embeddings")
    slots = embeddings.agg(F.count(F.lit(1)) * F.lit(spread))
    slot = F.pmod(F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long"), slots.scalar())
    return (
        words.select("word")
        .distinct()
        .withColumn("vec_id", slot)
        .join(embeddings.select("vec_id", F.col("embedding").alias("vector")), "vec_id")
        .select("word", "vector")
    )


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(texts(spark, sf_dir), "doc_id")
