"""Row filters: required columns, nulls, minimum counts, alignment, first row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions.columns import to_number
from ratingloom.schemas import ITEM, RATING, USER


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def clean_ratings(df: DataFrame, user: str = USER, item: str = ITEM, rating: str = RATING) -> DataFrame:
    """All columns, ``rating`` made numeric, rows with a null key or rating dropped."""
    require_columns(df, [user, item, rating])
    return df.withColumn(rating, to_number(F.col(rating))).na.drop(subset=[user, item, rating])


def rating_triples(df: DataFrame, user: str = USER, item: str = ITEM, rating: str = RATING) -> DataFrame:
    """The three columns of the fact table, ids as strings."""
    require_columns(df, [user, item, rating])
    return df.select(
        F.col(user).cast("string").alias(USER),
        F.col(item).cast("string").alias(ITEM),
        F.col(rating).cast("double").alias(RATING),
    )


def min_count_filter(
    df: DataFrame,
    min_user: int = 10,
    min_item: int = 10,
    user: str = USER,
    item: str = ITEM,
    strict: bool = False,
) -> DataFrame:
    """Keep rows whose user and whose item have enough rows in ``df``.

    Both counts come from the input, in a single pass that is not iterated.
    ``strict`` asks for more than the minimum instead of at least the minimum.
    """
    require_columns(df, [user, item])

    def frequent(key: str, least: int) -> DataFrame:
        size = F.count(F.lit(1))
        return (
            df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(size.alias("_n"))
            .filter(F.col("_n") > least if strict else F.col("_n") >= least)
            .select(key)
        )

    return df.join(frequent(user, min_user), user, "left_semi").join(
        frequent(item, min_item), item, "left_semi"
    ).select(*df.columns)


def align_items(reviews: DataFrame, meta: DataFrame, item: str = ITEM) -> tuple[DataFrame, DataFrame]:
    """Reviews and metadata restricted to the items both of them have."""
    require_columns(reviews, [item])
    require_columns(meta, [item])
    in_reviews = reviews.select(item).where(F.col(item).isNotNull()).distinct()
    meta_kept = meta.join(in_reviews, item, "left_semi").select(*meta.columns)
    in_meta = meta.select(item).where(F.col(item).isNotNull()).distinct()
    reviews_kept = reviews.join(in_meta, item, "left_semi").select(*reviews.columns)
    return reviews_kept, meta_kept


def restrict_to_items(ratings: DataFrame, items: DataFrame, item: str = ITEM, items_col: str = "item_id") -> DataFrame:
    """Ratings on the given items only."""
    wanted = items.select(F.col(items_col).alias(item)).distinct()
    return ratings.join(wanted, item, "left_semi").select(*ratings.columns)


def first_per_id(df: DataFrame, id_col: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per id: the first in ``order``.

    A combinable aggregate instead of a window: every map task sends at most one row
    per id, so an id with many copies costs no more than any other.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return (
        df.groupBy(id_col)
        .agg(F.min_by(F.struct(*df.columns), F.struct(*order_cols)).alias("_row"))
        .select("_row.*")
    )


def rating_matrix(
    ratings: DataFrame,
    dup_policy: str = "mean",
    user: str = USER,
    item: str = ITEM,
    rating: str = RATING,
) -> DataFrame:
    """One row per (user, item): repeated ratings are averaged or summed."""
    if dup_policy not in ("mean", "sum"):
        raise ValueError("dup_policy must be 'mean' or 'sum'")
    merge = F.avg if dup_policy == "mean" else F.sum
    return (
        ratings.na.drop(subset=[user, item, rating])
        .groupBy(user, item)
        .agg(merge(F.col(rating).cast("double")).alias(rating))
    )
