"""Descriptive statistics of a ratings or reviews table, one small table per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ratingloom.functions.columns import array_count
from ratingloom.operators.skew import exact_quantiles, quantiles_of_counts, value_counts
from ratingloom.schemas import ITEM, RATING, USER


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of one numeric column.

    The table is read once, for the counts of the distinct values; the rest comes from those.
    """
    counts = value_counts(df, column)
    quartiles = quantiles_of_counts(counts, (0.25, 0.5, 0.75)).select(F.struct("q0", "q1", "q2"))
    v, n = F.col("_v").cast("double"), F.sum("_cnt")
    mean = counts.agg(F.sum(v * F.col("_cnt")) / n)
    return (
        counts.withColumn("_d", v - mean.scalar())
        .agg(
            F.coalesce(n, F.lit(0)).alias("count"),
            (F.sum(v * F.col("_cnt")) / n).alias("mean"),
            F.when(n > 1, F.sqrt(F.sum(F.col("_d") * F.col("_d") * F.col("_cnt")) / (n - 1))).alias("std"),
            F.min("_v").alias("min"),
            F.max("_v").alias("max"),
        )
        .withColumn("_q", quartiles.scalar())
        .select(
            "count",
            "mean",
            "std",
            "min",
            F.col("_q.q0").alias("p25"),
            F.col("_q.q1").alias("p50"),
            F.col("_q.q2").alias("p75"),
            "max",
        )
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, number of nulls, number of rows. One pass over the table."""
    missing = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        test = column.isNull()
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            test = test | F.isnan(column)
        missing.append(F.count_if(test).alias(field.name))
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *missing)
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"`{f.name}`").alias("nulls"),
            F.col("_rows").alias("n_rows"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


def sparsity(ratings: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Rows, distinct users, distinct items and 1 - rows / (users * items)."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct(user).alias("n_users"),
        F.countDistinct(item).alias("n_items"),
    ).withColumn(
        "sparsity",
        1.0 - F.col("n_ratings") / (F.col("n_users").cast("double") * F.col("n_items").cast("double")),
    )


def reviews_per(df: DataFrame, key: str) -> DataFrame:
    """Number of rows per key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_reviews"))


def mean_reviews(df: DataFrame, keys: Sequence[str] = (USER, ITEM)) -> DataFrame:
    """Mean number of rows per value of each key: rows divided by distinct values."""
    counted = df.agg(
        *[F.count(k).alias(f"_n_{k}") for k in keys],
        *[F.countDistinct(k).alias(f"_d_{k}") for k in keys],
    )
    rows = [
        F.struct(F.lit(k).alias("key"), (F.col(f"_n_{k}") / F.col(f"_d_{k}")).alias("mean_reviews"))
        for k in keys
    ]
    return counted.select(F.inline(F.array(*rows)))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have 1, 2, 3 ... rows."""
    return reviews_per(df, key).groupBy("n_reviews").agg(F.count(F.lit(1)).alias("n_keys"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value, empty bins included."""
    x = F.col("_x")
    data = df.select(F.col(column).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    lo, hi = F.min("_x"), F.max("_x")
    span = data.agg(
        F.struct(
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        ).alias("_s")
    )
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    counts = (
        data.withColumn("_s", span.scalar())
        .select(F.least(F.lit(bins - 1), F.floor((x - lo) / (hi - lo) * bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = span.select("_s", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (hi - lo) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("low"),
        (lo + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def with_image_columns(reviews: DataFrame, images: str = "images") -> DataFrame:
    """Add ``num_images`` and ``has_image``."""
    return reviews.withColumn("num_images", array_count(F.col(images))).withColumn(
        "has_image", F.col("num_images") >= 1
    )


def votes_by_image(reviews: DataFrame, votes: str = "helpful_vote") -> DataFrame:
    """Mean helpful votes of reviews with and without images."""
    return with_image_columns(reviews).groupBy("has_image").agg(F.avg(votes).alias("mean_votes"))


def quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One interpolated quantile of a column."""
    return exact_quantiles(df, column, (p,)).withColumnRenamed("q0", "value")


def global_mean(ratings: DataFrame, rating: str = RATING, empty: float | None = None) -> DataFrame:
    """The mean rating as a one-row table; ``empty`` stands in when there is no rating."""
    mean = F.avg(rating)
    return ratings.agg((mean if empty is None else F.coalesce(mean, F.lit(empty))).alias("global_mean"))
