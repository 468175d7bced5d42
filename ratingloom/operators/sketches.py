"""Mergeable sketches of a growing table: distinct keys and quantiles from one small row per part.

Each part of a table is sketched once, when it arrives. A profile of the whole table merges those
rows and never reads the table again. Distinct counts are HyperLogLog sketches with a relative
standard error of about 1.04 / sqrt(2^precision); quantiles are KLL sketches whose rank error is at
most about 2.3 / k^0.9 with 99 percent confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.schemas import ITEM, RATING, USER

PRECISION = 14
QUANTILE_SIZE = 400


def distinct_error(precision: int = PRECISION) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / (2**precision) ** 0.5


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Rank error of a quantile, at 99 percent confidence."""
    return 2.296 / size**0.9021


def sketch_part(
    df: DataFrame,
    part: str,
    keys: Sequence[str] = (USER, ITEM),
    values: Sequence[str] = (RATING,),
    precision: int = PRECISION,
    size: int = QUANTILE_SIZE,
) -> DataFrame:
    """One row: the part's name, its rows, sums and extremes, and a sketch of every key and value.

    Nulls are left out of the sketches, as of every aggregate.
    """
    columns = [F.hll_sketch_agg(F.col(k).cast("string"), precision).alias(f"distinct_{k}") for k in keys]
    for v in values:
        x = F.col(v).cast("double")
        columns += [
            F.kll_sketch_agg_double(x, size).alias(f"quantiles_{v}"),
            F.count(x).alias(f"n_{v}"),
            F.sum(x).alias(f"sum_{v}"),
            F.min(x).alias(f"min_{v}"),
            F.max(x).alias(f"max_{v}"),
        ]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *columns).select(F.lit(part).alias("part"), "*")


def save_sketch(sketch: DataFrame, path: str) -> None:
    """The sketch of one part beside those of the others; written again, it replaces itself."""
    sketch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = (USER, ITEM), values: Sequence[str] = (RATING,)) -> DataFrame:
    """One row for all parts, in the layout of ``sketch_part`` without its name."""
    columns = [F.hll_union_agg(f"distinct_{k}").alias(f"distinct_{k}") for k in keys]
    for v in values:
        columns += [
            F.kll_merge_agg_double(f"quantiles_{v}").alias(f"quantiles_{v}"),
            F.sum(f"n_{v}").alias(f"n_{v}"),
            F.sum(f"sum_{v}").alias(f"sum_{v}"),
            F.min(f"min_{v}").alias(f"min_{v}"),
            F.max(f"max_{v}").alias(f"max_{v}"),
        ]
    return sketches.agg(F.sum("n_rows").alias("n_rows"), *columns)


def load_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def approximate_sparsity(merged: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Rows (exact), and estimates of the distinct users, distinct items and the sparsity."""
    users, items = F.hll_sketch_estimate(f"distinct_{user}"), F.hll_sketch_estimate(f"distinct_{item}")
    return merged.select(F.col("n_rows").alias("n_ratings"), users.alias("n_users"), items.alias("n_items")).withColumn(
        "sparsity", 1.0 - F.col("n_ratings") / (F.col("n_users").cast("double") * F.col("n_items").cast("double"))
    )


def approximate_quantiles(merged: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """``(p, value)``: a value whose rank is within ``rank_error`` of p; null without any value."""
    sketch = F.col(f"quantiles_{value}")
    rows = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))).alias("value")) for p in probabilities]
    empty = [F.struct(F.lit(float(p)).alias("p"), F.lit(None).cast("double").alias("value")) for p in probabilities]
    filled = F.col(f"n_{value}") > 0
    return merged.select(F.inline(F.when(filled, F.array(*rows)).otherwise(F.array(*empty))))


def approximate_describe(merged: DataFrame, value: str) -> DataFrame:
    """count, mean, min and max (exact) and estimated quartiles of a value."""
    return merged.select(
        F.col(f"n_{value}").alias("count"),
        (F.col(f"sum_{value}") / F.col(f"n_{value}")).alias("mean"),
        F.col(f"min_{value}").alias("min"),
        *[
            F.when(F.col(f"n_{value}") > 0, F.kll_sketch_get_quantile_double(f"quantiles_{value}", F.lit(p))).alias(name)
            for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        ],
        F.col(f"max_{value}").alias("max"),
    )
