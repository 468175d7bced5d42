"""Correlation matrices in long form ``(col_x, col_y, corr)``, both triangles and the diagonal.

Every pair of columns is handled in the same job: a row is unpivoted into its pairs,
equal (x, y) values are counted at once, and all later steps work on those counts.
Rows with a null in a pair are left out of that pair only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.skew import running_counts
from ratingloom.session import durable


def _mirror(upper: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both triangles and the diagonal from the upper triangle, ``corr`` null where undefined."""
    both = upper.select(
        F.explode(
            F.array(
                F.struct(F.col("col_x"), F.col("col_y"), F.col("corr")),
                F.struct(F.col("col_y").alias("col_x"), F.col("col_x").alias("col_y"), F.col("corr")),
            )
        ).alias("r")
    ).select("r.*")
    ones = [F.struct(F.lit(c).alias("col_x"), F.lit(c).alias("col_y"), F.lit(1.0).alias("corr")) for c in columns]
    diagonal = upper.sparkSession.range(1).select(F.inline(F.array(*ones)))
    return both.unionByName(diagonal)


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, all in one aggregate."""
    pairs = list(combinations(columns, 2))
    cells = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{n}") for n, (a, b) in enumerate(pairs)]
    rows = [
        F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(f"_{n}").alias("corr"))
        for n, (a, b) in enumerate(pairs)
    ]
    upper = df.agg(*cells).select(F.inline(F.array(*rows)))
    return _mirror(upper, columns)


def _pair_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col_x, col_y, x, y, cnt): how often each pair of values occurs."""
    pairs = [
        F.struct(
            F.lit(a).alias("col_x"),
            F.lit(b).alias("col_y"),
            F.col(a).cast("double").alias("x"),
            F.col(b).cast("double").alias("y"),
        )
        for a, b in combinations(columns, 2)
    ]
    # cells of the whole row are counted first, so a repeated row is unpivoted once
    cells = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.inline(F.array(*pairs)), "_n")
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("col_x", "col_y", "x", "y")
        .agg(F.sum("_n").alias("cnt"))
    )
    # ranks, ties and the cells themselves all start from here
    return durable(cells)


PAIR = ("col_x", "col_y")


def _value_counts(cells: DataFrame, axis: str) -> DataFrame:
    return cells.groupBy(*PAIR, axis).agg(F.sum("cnt").alias("_c"))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of average ranks."""
    cells = _pair_cells(df, columns)
    ranked = cells
    for axis in ("x", "y"):
        ranks = running_counts(_value_counts(cells, axis), axis, "_c", PAIR).select(
            *PAIR,
            axis,
            # distance of the average rank from the mean rank (n + 1) / 2
            (F.col("before") + (F.col("_c") + 1) / 2 - (F.col("total") + 1) / 2).alias(f"d{axis}"),
        )
        ranked = ranked.join(ranks, [*PAIR, axis])
    cnt, dx, dy = F.col("cnt"), F.col("dx"), F.col("dy")
    upper = (
        ranked.groupBy(*PAIR)
        .agg(F.sum(cnt * dx * dy).alias("xy"), F.sum(cnt * dx * dx).alias("xx"), F.sum(cnt * dy * dy).alias("yy"))
        .select(
            *PAIR,
            F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("corr"),
        )
    )
    return _mirror(upper, columns)


def kendall_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kendall tau-b with tie correction.

    Concordant pairs are counted without forming pairs. Write both values as dense ranks in
    binary. Two points with different x differ first at exactly one bit of x, and likewise
    for y; so for every (bit of x, bit of y) the points are grouped by the higher bits, and
    a group with n00, n01, n10, n11 points per bit combination holds n00 * n11 concordant
    and n01 * n10 discordant pairs. Only hash aggregates, (log values)^2 rows per cell.
    """
    cells = _pair_cells(df, columns)
    ranked = cells
    for axis in ("x", "y"):
        ranks = running_counts(
            _value_counts(cells, axis).select(*PAIR, axis, F.lit(1).cast("long").alias("_c")), axis, "_c", PAIR
        ).select(
            *PAIR,
            axis,
            F.col("before").alias(f"r{axis}"),
            F.length(F.bin(F.col("total") - 1)).alias(f"bits{axis}"),
        )
        ranked = ranked.join(ranks, [*PAIR, axis])

    leveled = ranked.withColumn("lx", F.explode(F.sequence(F.lit(0), F.col("bitsx") - 1))).withColumn(
        "ly", F.explode(F.sequence(F.lit(0), F.col("bitsy") - 1))
    )
    bit = lambda rank, level: F.expr(f"shiftright({rank}, {level}) & 1")
    prefix = lambda rank, level: F.expr(f"shiftright({rank}, {level} + 1)")
    exact = lambda c: F.sum(c).cast("decimal(19,0)")
    quadrant = lambda a, b: exact(
        F.when((F.col("bx") == a) & (F.col("by") == b), F.col("cnt")).otherwise(F.lit(0))
    )
    orders = (
        leveled.select(
            *PAIR,
            "lx",
            "ly",
            prefix("rx", "lx").alias("px"),
            prefix("ry", "ly").alias("py"),
            bit("rx", "lx").alias("bx"),
            bit("ry", "ly").alias("by"),
            "cnt",
        )
        .groupBy(*PAIR, "lx", "ly", "px", "py")
        .agg(
            quadrant(0, 0).alias("n00"),
            quadrant(0, 1).alias("n01"),
            quadrant(1, 0).alias("n10"),
            quadrant(1, 1).alias("n11"),
        )
        .groupBy(*PAIR)
        .agg(F.sum(F.col("n00") * F.col("n11") - F.col("n01") * F.col("n10")).alias("balance"))
    )
    joined = orders
    half = lambda c: F.col(c).cast("double") * (F.col(c).cast("double") - 1) / 2
    for axis in ("x", "y"):
        ties = (
            _value_counts(cells, axis)
            .groupBy(*PAIR)
            .agg(F.sum(half("_c")).alias(f"ties_{axis}"), F.sum("_c").alias(f"n_{axis}"))
        )
        joined = joined.join(ties, list(PAIR))
    loose = (half("n_x") - F.col("ties_x")) * (half("n_x") - F.col("ties_y"))
    upper = joined.select(
        *PAIR, F.when(loose > 0, F.col("balance").cast("double") / F.sqrt(loose)).alias("corr")
    )
    return _mirror(upper, columns)
