from pyspark.sql import Row, functions as F, types as T

from ratingloom.functions.columns import array_count, clean_price, clip, concat_text, flatten_text, to_number
from ratingloom.functions.text import ngrams, simple_tokens, word_tokens
from ratingloom.functions.vectors import cosine, l2_norm, l2_normalize


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def test_clean_price(spark):
    given = ["$1,299.99", "from 12.50", "—", None, "1.2.3", ".", "-5", "7"]
    df = spark.createDataFrame([(n, x) for n, x in enumerate(given)], "n int, p string").orderBy("n")
    assert values(df.select("n", clean_price(F.col("p")).alias("v"))) == [1299.99, 12.5, None, None, None, None, 5.0, 7.0]


def test_to_number(spark):
    df = spark.createDataFrame([(0, "4"), (1, "4.5"), (2, "bad"), (3, None), (4, "NaN")], "n int, r string").orderBy("n")
    assert values(df.select("n", to_number(F.col("r")).alias("v"))) == [4.0, 4.5, None, None, None]


def test_flatten_text(spark):
    schema = T.StructType.fromDDL(
        "s string, a array<string>, p struct<name:string,role:string>, q struct<x:string,y:int>, "
        "m map<string,string>, d double, b boolean"
    )
    df = spark.createDataFrame(
        [
            ("t", ["x", None, "y"], Row(name="N", role="r"), Row(x="1", y=2), {"name": "M", "k": "z"}, 1.5, True),
            (None, [], Row(name=None, role="r"), Row(x=None, y=2), {"k": "z"}, float("nan"), None),
            (None, None, None, None, None, None, False),
        ],
        schema,
    )
    flat = df.select(*[flatten_text(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    got = [tuple(r) for r in flat.collect()]
    assert got[0] == ("t", "x y", "N", "1 2", "M", "1.5", "True")
    assert got[1] == ("", "", "r", "2", "z", "", "")
    assert got[2] == ("", "", "", "", "", "", "False")


def test_concat_keeps_inner_spaces_and_trims(spark):
    df = spark.createDataFrame([("a", "", "b\n"), ("", "", "")], "x string, y string, z string")
    assert values(df.select(concat_text(df, ["x", "y", "missing", "z"]).alias("v"))) == ["a  b", ""]


def test_array_count_and_clip(spark):
    df = spark.createDataFrame([(["a"], 0.2), (None, 9.0), ([], None)], "a array<string>, r double")
    assert values(df.select(array_count(F.col("a")).alias("v"))) == [1, 0, 0]
    assert values(df.select(clip(F.col("r"), 1, 5).alias("v"))) == [1.0, 5.0, None]


def test_word_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("The quick-brown X_1 fox a fox",), ("",), (None,)], "t string")
    tokens = word_tokens(F.col("t"), ["the"])
    assert values(df.select(tokens.alias("v"))) == [["quick", "brown", "x_1", "fox", "fox"], [], []]
    assert values(df.select(ngrams(tokens, 1, 2).alias("v")))[0] == [
        "quick", "brown", "x_1", "fox", "fox", "quick brown", "brown x_1", "x_1 fox", "fox fox",
    ]
    assert values(df.select(ngrams(tokens, 3, 3).alias("v")))[0] == ["quick brown x_1", "brown x_1 fox", "x_1 fox fox"]
    assert values(df.select(ngrams(tokens, 1, 2).alias("v")))[1] == []


def test_simple_tokens(spark):
    texts = ["Élan vital, a 12ab _x naïveté", "a b 1", "", "abcdefghijklmno abcdefghijklmnop"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").orderBy("n")
    got = values(df.select("n", simple_tokens(F.col("t")).alias("v")))
    assert got == [["elan", "vital", "ab", "naivete"], ["empty", "text"], ["empty", "text"], ["abcdefghijklmno"]]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [-2.0, 0.0])], "a array<double>, b array<double>")
    assert values(df.select(l2_norm(F.col("a")).alias("v"))) == [5.0, 1.0]
    assert values(df.select(l2_normalize(F.col("a")).alias("v")))[0] == [0.6, 0.8]
    assert values(df.select(l2_normalize(F.col("b")).alias("v")))[0] == [0.0, 0.0]
    assert values(df.select(cosine(F.col("a"), F.col("b")).alias("v"))) == [0.0, -1.0]
