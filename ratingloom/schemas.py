"""Column layouts of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

USER, ITEM, RATING = "user_id", "parent_asin", "rating"

RATINGS = T.StructType(
    [
        T.StructField(USER, T.StringType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField(RATING, T.DoubleType()),
    ]
)

# Raw reviews keep ``rating`` as text: bad values become null in the cleaning step, not at read time.
REVIEWS = T.StructType(
    [
        T.StructField(USER, T.StringType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField(RATING, T.StringType()),
        T.StructField("helpful_vote", T.IntegerType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("images", T.ArrayType(T.StringType())),
    ]
)

META = T.StructType(
    [
        T.StructField(ITEM, T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.ArrayType(T.StringType())),
        T.StructField("author", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("price", T.StringType()),
    ]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

NEIGHBORS = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("neighbor", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("sim", T.DoubleType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("pred", T.DoubleType()),
    ]
)
