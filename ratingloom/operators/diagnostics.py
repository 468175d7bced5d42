"""Checks of an embedding table ``(item_id, embedding)``; one small table per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions.vectors import dot, l2_norm
from ratingloom.operators.clustering import principal_axes
from ratingloom.operators.nearest import query_neighbors
from ratingloom.operators.sampling import key_hash, sample_exact
from ratingloom.operators.skew import number_in_order
from ratingloom.operators.wide_components import COLUMN_BLOCK, blocked_components
from ratingloom.session import durable

PAIRS = 20_000
DIGITS = 6


def _doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def sanity(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows, dimensions, NaN and infinite entries."""
    v = F.col(vector_col)
    return embeddings.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max(F.size(v)).alias("dim"),
        F.sum(F.size(F.filter(v, lambda x: F.isnan(x)))).alias("n_nan"),
        F.sum(F.size(F.filter(v, lambda x: F.abs(x) == float("inf")))).alias("n_inf"),
    )


def overview(vectors: DataFrame) -> DataFrame:
    """One row on any embedder's table, dense (``embedding``) or sparse (``indices``, ``values``).

    Rows, dimensions, NaN and infinite entries, share of zeros, vector lengths, and how many rows
    repeat another to six places. Two aggregates, both combined before their shuffle.
    """
    dense = "embedding" in vectors.columns
    values = _doubles(F.col("embedding" if dense else "values"))
    place = F.lit(0) if dense else F.col("indices")
    rows = vectors.select(
        values.alias("v"),
        place.alias("at"),
        (F.size("embedding") if dense else F.coalesce(F.array_max("indices") + 1, F.lit(0))).alias("dim"),
    ).where("v IS NOT NULL")
    rounded = F.transform("v", lambda x: F.round(x, DIGITS) + F.lit(0.0))
    counted = F.col("n")
    norm = l2_norm(F.col("v"))
    grouped = rows.groupBy(rounded.alias("r"), "at").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("dim").alias("dim"),
        F.sum(F.size(F.filter("v", lambda x: F.isnan(x)))).alias("nan"),
        F.sum(F.size(F.filter("v", lambda x: F.abs(x) == float("inf")))).alias("inf"),
        F.sum(F.size(F.filter("v", lambda x: x != 0))).alias("filled"),
        F.sum(norm).alias("s"),
        F.sum(norm * norm).alias("ss"),
        F.min(norm).alias("lo"),
        F.max(norm).alias("hi"),
    )
    total = F.sum(counted)
    mean = F.sum("s") / total
    return grouped.agg(
        total.alias("n_items"),
        F.max("dim").alias("dim"),
        F.sum("nan").alias("n_nan"),
        F.sum("inf").alias("n_inf"),
        (1 - F.sum("filled") / (total * F.max("dim"))).alias("zero_share"),
        mean.alias("norm_mean"),
        F.min("lo").alias("norm_min"),
        F.max("hi").alias("norm_max"),
        F.sum(F.when(counted > 1, counted).otherwise(0)).alias("n_repeated"),
    )


def zero_variance_dims(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """How many dimensions hold one value only."""
    return (
        embeddings.select(F.posexplode(vector_col).alias("pos", "x"))
        .groupBy("pos")
        .agg((F.min("x") == F.max("x")).alias("_constant"))
        .agg(F.count_if("_constant").alias("zero_variance_dims"), F.count(F.lit(1)).alias("dim"))
    )


def near_duplicates(
    embeddings: DataFrame,
    sample: int | None = None,
    seed: int = 42,
    id_col: str = "item_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Groups of vectors equal to six places, over all rows or within a seeded sample.

    One aggregate that is combined before the shuffle; null vectors are no duplicates.
    """
    drawn = embeddings.select(id_col, vector_col).where(F.col(vector_col).isNotNull())
    if sample is not None:
        drawn = sample_exact(drawn, sample, seed, [id_col])
    rounded = F.transform(vector_col, lambda x: F.round(x.cast("double"), DIGITS) + F.lit(0.0))
    return (
        drawn.groupBy(rounded.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_groups"), F.sum("_n").alias("n_sampled"))
    )


def norm_stats(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Mean, population deviation, smallest and largest vector length."""
    return embeddings.select(l2_norm(F.col(vector_col)).alias("_n")).agg(
        F.avg("_n").alias("norm_mean"),
        F.stddev_pop("_n").alias("norm_std"),
        F.min("_n").alias("norm_min"),
        F.max("_n").alias("norm_max"),
    )


def random_pair_cosine(
    embeddings: DataFrame,
    pairs: int = PAIRS,
    seed: int = 42,
    id_col: str = "item_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Cosine of randomly drawn pairs of different items: mean, deviation, 5% and 95% points.

    ``pairs`` draws by position, so the cost beyond one pass over the ids is fixed.
    """
    numbered = number_in_order(embeddings, id_col)
    total = embeddings.agg(F.countDistinct(id_col)).scalar()

    def draw(side: str) -> Column:
        digest = key_hash(["pair", side], seed)
        return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.col("_total"))

    drawn = (
        embeddings.sparkSession.range(pairs)
        .select(F.col("id").alias("pair"), F.lit("a").alias("a"), F.lit("b").alias("b"))
        .withColumn("_total", total)
        .select("pair", draw("a").alias("pa"), draw("b").alias("pb"))
        .where(F.col("pa") != F.col("pb"))
    )
    # the drawn positions become ids before any vector moves; ``drawn`` has at most ``pairs`` rows
    ids = drawn
    for side in ("a", "b"):
        of_side = numbered.select(F.col("pos").alias(f"p{side}"), F.col(id_col).alias(f"_id{side}"))
        ids = of_side.join(F.broadcast(ids), f"p{side}")
    ids = ids.select("_ida", "_idb")
    vectors = embeddings.select(id_col, F.col(vector_col).alias("v"))
    first = vectors.select(F.col(id_col).alias("_ida"), F.col("v").alias("va")).join(F.broadcast(ids), "_ida")
    second = vectors.select(F.col(id_col).alias("_idb"), F.col("v").alias("vb"))
    both = second.join(F.broadcast(first), "_idb")  # at most ``pairs`` vectors
    cos = dot(F.col("va"), F.col("vb")) / (l2_norm(F.col("va")) * l2_norm(F.col("vb")) + F.lit(1e-9))
    return both.select(cos.alias("_c")).agg(
        F.avg("_c").alias("cos_mean"),
        F.stddev_pop("_c").alias("cos_std"),
        F.percentile("_c", F.lit(0.05)).alias("cos_p05"),
        F.percentile("_c", F.lit(0.95)).alias("cos_p95"),
        F.count("_c").alias("n_pairs"),
    )


def explained_variance(
    embeddings: DataFrame, components: int = 50, vector_col: str = "embedding", column_block: int = COLUMN_BLOCK
) -> DataFrame:
    """Share of variance of the first, the first ten and all components; effective dimension."""
    vectors = embeddings.where(F.col(vector_col).isNotNull()).select(
        F.struct(
            F.lit(1).cast("tinyint").alias("type"),
            F.size(vector_col).alias("size"),
            F.lit(None).cast("array<int>").alias("indices"),
            _doubles(F.col(vector_col)).alias("values"),
        ).alias("features")
    )
    shape = embeddings.agg(F.count(vector_col).alias("n"), F.max(F.size(vector_col)).alias("d")).first()
    k = min(components, shape["d"], shape["n"] - 1)
    if shape["d"] > column_block:
        numbered = vectors.withColumn("row", F.monotonically_increasing_id())
        shares = blocked_components(numbered, "row", k, column_block)[1]
    else:
        shares = principal_axes(durable(vectors), k)[1]
    ratios = [float(x) for x in shares]
    total = sum(ratios)
    effective = 1.0 / sum((r / (total + 1e-12)) ** 2 for r in ratios)
    return embeddings.sparkSession.range(1).select(
        F.lit(ratios[0]).alias("evr_pc1"),
        F.lit(sum(ratios[:10])).alias("evr_top10"),
        F.lit(total).alias("evr_total"),
        F.lit(k).alias("components"),
        F.lit(effective).alias("effective_dim"),
    )


def zero_share(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Share of entries that are exactly zero."""
    v = F.col(vector_col)
    return embeddings.agg(
        (F.sum(F.size(F.filter(v, lambda x: x == 0))) / F.sum(F.size(v))).alias("zero_share")
    )


def quick_stats(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Mean, population deviation, range and zero share over all entries."""
    return embeddings.select(F.size(vector_col).alias("dim"), F.explode(vector_col).alias("x")).agg(
        F.max("dim").alias("dim"),
        F.avg(F.col("x").cast("double")).alias("mean"),
        F.stddev_pop(F.col("x").cast("double")).alias("std"),
        F.min(F.col("x").cast("double")).alias("min"),
        F.max(F.col("x").cast("double")).alias("max"),
        (F.count_if(F.col("x") == 0) / F.count("x")).alias("zero_share"),
    )


def retrieval_demo(
    embeddings: DataFrame,
    k: int = 5,
    n_items: int = 3,
    seed: int = 42,
    id_col: str = "item_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Nearest neighbours of a few seeded items."""
    drawn = sample_exact(embeddings.select(id_col, vector_col), n_items, seed, [id_col])
    return query_neighbors(embeddings, drawn, k, "cosine", id_col, vector_col)
