"""Seeded samples, exact-size splits and folds, stable across partitionings and engines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.schemas import ITEM, USER

PREFIX = 4  # hex digits: 65,536 equal ranges of the hash
COPIES_PER_ROW = 10_000


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """md5 of the keys and the seed, the order used by every draw."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _hash_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _mark_first(df: DataFrame, keys: Sequence[str], seed: int, quota: Callable[[Column], Column]) -> DataFrame:
    """Flag the first ``quota(total)`` rows in hash order as ``_picked``.

    The hash is cut into 65,536 equal ranges. Their counts, a bounded table, tell the one
    range that holds the border. All other rows are decided by comparing their range with
    it; only the border range is ordered, after equal rows in it were counted together.
    """
    columns = df.columns
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn("_b", F.substring("_h", 1, PREFIX))
    ahead = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        hashed.groupBy("_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_b",
            "_n",
            F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
            quota(F.sum("_n").over(Window.partitionBy())).cast("long").alias("_quota"),
        )
    )
    border = ranges.where(F.col("_before") + F.col("_n") > F.col("_quota")).agg(
        F.min_by(F.struct("_b", "_before", "_quota"), F.col("_b")).alias("_cut")
    )
    # without a border range every row is picked; "g" sorts after all hex digits
    everything = F.struct(
        F.lit("g").alias("_b"), F.lit(0).cast("long").alias("_before"), F.lit(0).cast("long").alias("_quota")
    )
    cut = border.select(F.coalesce("_cut", everything)).scalar()
    placed = hashed.withColumn("_cut", cut)
    whole = placed.where(F.col("_b") != F.col("_cut._b")).select(
        *columns, (F.col("_b") < F.col("_cut._b")).alias("_picked")
    )

    in_order = Window.partitionBy("_b").orderBy("_h", *columns).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_cut._quota") - F.col("_cut._before") - F.coalesce(F.sum("_copies").over(in_order), F.lit(0))
    at_border = (
        placed.where(F.col("_b") == F.col("_cut._b"))
        .groupBy("_b", "_h", "_cut", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_copies"), left)))
    )
    split = F.array(
        F.struct(F.lit(True).alias("_picked"), F.col("_take").alias("_times")),
        F.struct(F.lit(False).alias("_picked"), (F.col("_copies") - F.col("_take")).alias("_times")),
    )
    parts = at_border.select(*columns, F.inline(split)).where(F.col("_times") > 0)
    return whole.unionByName(_repeat_rows(parts, "_times").select(*columns, "_picked"))


def _repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times; large counts are cut into chunks spread over tasks."""
    chunked = df.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / COPIES_PER_ROW)))
    ).repartition(F.col("_chunk"), F.xxhash64(*[c for c in df.columns]))
    here = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col(times) - F.col("_chunk") * COPIES_PER_ROW)
    return chunked.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), here))).drop("_again", "_chunk")


def sample_exact(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer), the same for any partitioning."""
    picked = _mark_first(df, keys or df.columns, seed, lambda total: F.least(F.lit(n), total))
    return picked.where("_picked").drop("_picked")


def split_holdout(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, keys: Sequence[str] = (USER, ITEM)
) -> DataFrame:
    """Add ``is_test``: ceil(test_size * rows) rows are test rows."""
    share = float(test_size)
    if not 0.0 < share < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    marked = _mark_first(df, keys, seed, lambda total: F.ceil(F.round(total * F.lit(share), 6)))
    return marked.withColumnRenamed("_picked", "is_test")


def assign_folds(df: DataFrame, folds: int = 3, seed: int = 42, keys: Sequence[str] = (USER, ITEM)) -> DataFrame:
    """Add ``fold`` in 0..folds-1 from the key hash: no shuffle, no sort."""
    return df.withColumn("fold", F.pmod(_hash_number(key_hash(keys, seed), 8), F.lit(folds)).cast("int"))


def training_folds(df: DataFrame, folds: int = 3) -> DataFrame:
    """The training rows of every fold in one table: a row of fold f trains all others."""
    others = F.array_except(F.sequence(F.lit(0), F.lit(folds - 1)), F.array("fold"))
    return df.withColumn("fold", F.explode(others))
