"""Building blocks that keep one hot key from landing in one task.

* ``with_fragments`` / ``fragment_join``: a key with many rows is cut into fragments of a
  bounded size; the other side is copied once per fragment. Exact, and a no-op for cold keys.
* ``running_counts``: cumulative counts over sorted values without a single-partition window
  over the data: only a bounded table of range buckets is ordered in one place.
* ``number_in_order``: dense 0-based positions in sort order, from a durable sorted copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.session import durable, durable_in_order

ROWS_PER_FRAGMENT = 2_000
RANGE_BUCKETS = 256


def with_fragments(
    df: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    rows_per_fragment: int = ROWS_PER_FRAGMENT,
) -> DataFrame:
    """Add ``_frags`` (fragments of the row's key) and ``_frag`` (the row's own one).

    The join side holds only keys over the limit, at most rows / rows_per_fragment of
    them, and carries no hint: adaptive execution broadcasts it when it is small and
    splits it as a skewed join when it is not.
    """
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_fragment)
        .select(*keys, F.ceil(F.col("_n") / rows_per_fragment).cast("int").alias("_frags"))
    )
    frags = F.coalesce(F.col("_frags"), F.lit(1))
    return (
        df.join(hot, list(keys), "left")
        .withColumn("_frags", frags)
        .withColumn("_frag", F.pmod(F.xxhash64(*spread_by), F.col("_frags")).cast("int"))
    )


def fragment_join(
    big: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    rows_per_fragment: int = ROWS_PER_FRAGMENT,
) -> DataFrame:
    """Inner equi-join in which hot keys of ``big`` are spread over several tasks."""
    hot = (
        big.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_fragment)
        .select(*keys, F.ceil(F.col("_n") / rows_per_fragment).cast("int").alias("_frags"))
    )
    frags = F.coalesce(F.col("_frags"), F.lit(1))
    spread = (
        big.join(hot, list(keys), "left")
        .withColumn("_frag", F.pmod(F.xxhash64(*spread_by), frags).cast("int"))
        .drop("_frags")
    )
    copies = (
        other.join(hot, list(keys), "left")
        .withColumn("_frag", F.explode(F.sequence(F.lit(0), frags - 1)))
        .drop("_frags")
    )
    return spread.join(copies, [*keys, "_frag"]).drop("_frag")


def running_counts(
    counts: DataFrame,
    value: str,
    count: str,
    by: Sequence[str] = (),
    buckets: int = RANGE_BUCKETS,
) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to a table of distinct values.

    ``counts`` has one row per (by, value). Values are cut at approximate quantiles into ranges
    that hold about equally many of them, whatever their distances; inside a range a partitioned
    window sums, and the ranges themselves, at most ``buckets`` per group, give the offsets. Where
    the cuts lie does not change the result. Only groups of more than ROWS_PER_FRAGMENT values are cut.
    ``counts`` is read several times: hand over a table that is already computed.
    """
    by = list(by)
    shares = [n / buckets for n in range(1, buckets)]
    cuts = F.percentile_approx(value, shares, 4 * buckets).alias("_cuts")
    if by:
        long = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROWS_PER_FRAGMENT).select(*by)
        placed = counts.join(counts.join(long, by, "left_semi").groupBy(*by).agg(cuts), by, "left")
    else:
        placed = counts.withColumn("_cuts", counts.agg(cuts).scalar())
    below = F.size(F.filter(F.coalesce("_cuts", F.array().cast(counts.select(F.array(value)).schema[0].dataType)), lambda cut: cut < F.col(value)))
    placed = placed.withColumn("_b", below).drop("_cuts")

    ahead = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, "_b")
        .agg(F.sum(count).alias("_c"))
        .select(
            *by,
            "_b",
            F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_off"),
            F.sum("_c").over(Window.partitionBy(*by)).alias("total"),
        )
    )
    inside = Window.partitionBy(*by, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_in", F.coalesce(F.sum(count).over(inside), F.lit(0)))
        .join(offsets, [*by, "_b"])
        .withColumn("before", F.col("_off") + F.col("_in"))
        .drop("_b", "_in", "_off")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    weight: Column | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles ``q0, q1, ...`` of ``value`` (per group if ``by``).

    Equal values are counted first, so the sorted table has one row per distinct value and
    no group is ever held in memory as a whole.
    """
    return quantiles_of_counts(value_counts(df, value, by, weight), probabilities, by)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """(by, ``_v``, ``_cnt``): how often each value occurs, computed once and written down."""
    weight = F.lit(1).cast("long") if weight is None else weight
    return durable(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.sum(weight).alias("_cnt"))
    )


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The quantiles of ``exact_quantiles`` from a table of ``value_counts``."""
    by = list(by)
    placed = running_counts(counts, "_v", "_cnt", by)
    outputs = []
    for n, p in enumerate(probabilities):
        position = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        holds = lambda at: (F.col("before") <= at) & (at < F.col("before") + F.col("_cnt"))
        outputs += [
            F.max(F.when(holds(low), F.col("_v"))).alias(f"_lo{n}"),
            F.max(F.when(holds(high), F.col("_v"))).alias(f"_hi{n}"),
            F.max(position - low).alias(f"_w{n}"),
        ]
    picked = placed.groupBy(*by).agg(*outputs)
    return picked.select(
        *by,
        *[
            (F.col(f"_lo{n}") + (F.col(f"_hi{n}") - F.col(f"_lo{n}")) * F.col(f"_w{n}")).alias(f"q{n}")
            for n in range(len(probabilities))
        ],
    )


def number_in_order(df: DataFrame, column: str, name: str = "pos") -> DataFrame:
    """Distinct values of ``column`` with their 0-based position in ascending order.

    The sorted copy is written to the shared checkpoint folder, which freezes its
    partitions; positions are then the partition's offset plus the row's place in it.
    """
    frozen = durable_in_order(df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column))
    tagged = frozen.select(
        column,
        F.spark_partition_id().alias("_p"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("_i"),
    )
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_p", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_off"))
    )
    return tagged.join(F.broadcast(offsets), "_p").select(column, (F.col("_off") + F.col("_i")).alias(name))
