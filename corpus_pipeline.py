"""A training corpus from the documents table: five stages, each written and read again by the next.

Toxic documents go, one document of each group of near-duplicates stays, documents with a
benchmark passage go, personal data is masked, and the rest is encoded. All stages but the last
return the columns of documents. Rows with null or empty text pass through to the encoder, which
gives them no ids; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.llm import decontamination, minmax_dedup, ordinal_toxicity, personal_data, prefix_viterbi
from ratingloom.llm.common import short_batches
from ratingloom.session import durable

SIMILAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the ordinal regression does not reject."""
    short_batches(spark)
    model = ordinal_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(~ordinal_toxicity.is_toxic(docs["text"], model))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, linked from a similarity of 0.8 on."""
    short_batches(spark)
    return minmax_dedup.first_of_each(docs, percent=SIMILAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any window of a benchmark item."""
    short_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.uncontaminated(docs, items)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows where the text changes."""
    short_batches(spark)
    weights = personal_data.fit(docs)
    masked = personal_data.without_personal_data(docs["text"], weights)
    name = "".join(docs.columns) + "_"  # longer than any column's name
    out = docs.withColumn(name, masked)
    same = F.col(name).eqNullSafe(docs["text"])
    values = {"text": F.col(name), "n_chars": F.when(same, F.col("n_chars")).otherwise(F.length(name)).alias("n_chars")}
    return out.select(*[values[c].cast(t).alias(c) if c in values else F.col(c) for c, t in docs.dtypes])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, counts, token ids and the round-trip check of every document."""
    short_batches(spark)
    return prefix_viterbi.encode_texts(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]

# boosted weights, random fields and a tokenizer are no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
