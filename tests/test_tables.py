import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import correlation, filters, profile, sampling, skew


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_column_is_reported_before_any_job(spark):
    with pytest.raises(ValueError, match="rating"):
        filters.clean_ratings(spark.createDataFrame([("u", "i")], "user_id string, parent_asin string"))


def test_clean_ratings_drops_bad_rows(spark):
    df = spark.createDataFrame(
        [("u", "i", "4"), (None, "i", "4"), ("u", None, "4"), ("u", "i", "bad"), ("u", "i", None)],
        "user_id string, parent_asin string, rating string",
    )
    assert rows(filters.clean_ratings(df)) == [("u", "i", 4.0)]


def test_min_counts_inclusive_and_strict(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("b", "z"), (None, "x")], "user_id string, parent_asin string"
    )
    # counts: a 2, b 3; x 3 (a null user still rates x), y 2, z 1
    assert rows(filters.min_count_filter(df, 2, 2)) == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")]
    assert rows(filters.min_count_filter(df, 2, 2, strict=True)) == [("b", "x")]


def test_align_items(spark):
    reviews = spark.createDataFrame([("u", "x"), ("u", "y"), ("u", None)], "user_id string, parent_asin string")
    meta = spark.createDataFrame([("x", "t"), ("z", "t"), (None, "t")], "parent_asin string, title string")
    kept_reviews, kept_meta = filters.align_items(reviews, meta)
    assert rows(kept_reviews) == [("u", "x")] and rows(kept_meta) == [("x", "t")]


def test_first_per_id(spark):
    df = spark.createDataFrame([("a", 3, "c"), ("a", 1, None), ("b", 2, "d")], "id string, n int, t string")
    assert rows(filters.first_per_id(df, "id", ["n"])) == [("a", 1, None), ("b", 2, "d")]


def test_rating_matrix_policies(spark):
    df = spark.createDataFrame([("u", "i", 4.0), ("u", "i", 5.0), ("u", None, 1.0)], "user_id string, parent_asin string, rating double")
    assert rows(filters.rating_matrix(df)) == [("u", "i", 4.5)]
    assert rows(filters.rating_matrix(df, "sum")) == [("u", "i", 9.0)]


@pytest.mark.parametrize("n", [0, 1, 7, 150, 1000])
def test_sample_size_is_exact_and_stable(spark, n):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 3).alias("k"))
    one = rows(sampling.sample_exact(df.repartition(1), n, 5))
    many = rows(sampling.sample_exact(df.repartition(7), n, 5))
    assert one == many and len(one) == min(n, 300)


def test_sample_of_copies(spark):
    """A row repeated very often is counted, not collected; the size stays exact."""
    df = spark.range(30_000).select(F.lit("same").alias("a")).unionByName(spark.range(5).select(F.col("id").cast("string").alias("a")))
    for n in (1, 12_345, 30_004):
        assert sampling.sample_exact(df, n).count() == n


def test_split_is_exact_disjoint_and_complete(spark, ratings):
    total = ratings.count()
    for size, seed in ((0.1, 42), (0.2, 19), (0.3, 27)):
        marked = sampling.split_holdout(ratings, size, seed)
        counts = {r["is_test"]: r["count"] for r in marked.groupBy("is_test").count().collect()}
        assert counts[True] == math.ceil(round(size * total, 6)) and sum(counts.values()) == total
        assert rows(marked.drop("is_test")) == rows(ratings)


def test_folds_cover_everything_once(spark, ratings):
    rated = sampling.assign_folds(ratings, 3)
    assert set(r["fold"] for r in rated.select("fold").distinct().collect()) == {0, 1, 2}
    train = sampling.training_folds(rated, 3)
    assert train.count() == 2 * ratings.count()
    assert train.join(rated, ["fold", "user_id", "parent_asin"]).count() == 0


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    data = [(f"g{n % 3}", float(x)) for n, x in enumerate(np.round(rng.normal(0, 100, 500), 1))]
    data += [("one", 4.0), ("same", 2.0), ("same", 2.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: (r["q0"], r["q1"], r["q2"]) for r in skew.exact_quantiles(df, "x", (0.25, 0.5, 0.99), ["g"]).collect()}
    for g in got:
        want = np.quantile([x for h, x in data if h == g], [0.25, 0.5, 0.99])
        assert np.allclose(got[g], want)
    whole = skew.exact_quantiles(df, "x", (0.5,)).first()["q0"]
    assert np.isclose(whole, np.quantile([x for _, x in data], 0.5))


def test_number_in_order(spark):
    df = spark.createDataFrame([(f"k{n * 37 % 101:03d}",) for n in range(101)] * 2 + [(None,)], "k string").repartition(9)
    got = {r["k"]: r["pos"] for r in skew.number_in_order(df, "k").collect()}
    assert got == {k: n for n, k in enumerate(sorted(got))} and len(got) == 101


def test_fragment_join_equals_plain_join(spark, ratings):
    other = ratings.select("parent_asin", F.col("user_id").alias("v"))
    plain = ratings.join(other, "parent_asin").select("user_id", "parent_asin", "rating", "v")
    cut = skew.fragment_join(ratings, other, ["parent_asin"], ["user_id"], rows_per_fragment=3)
    assert rows(cut.select(*plain.columns)) == rows(plain)


def test_histogram_of_constant_and_gaps(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,)], "x double")
    got = [(r["bin"], r["n"]) for r in profile.histogram(df, "x").orderBy("bin").collect()]
    assert got == [(0, 2)] + [(b, 0) for b in range(1, 9)] + [(9, 1)]
    constant = profile.histogram(df.where("x = 1"), "x").collect()
    assert sum(r["n"] for r in constant) == 2 and len(constant) == 10


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, s string")
    got = {r["column_name"]: (r["dtype"], r["nulls"], r["n_rows"]) for r in profile.null_profile(df).collect()}
    assert got == {"x": ("double", 2, 3), "s": ("string", 2, 3)}


def _kendall(x, y):
    balance = tx = ty = 0
    pairs = list(combinations(range(len(x)), 2))
    for i, j in pairs:
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        balance += a * b
        tx += a == 0
        ty += b == 0
    return balance / math.sqrt((len(pairs) - tx) * (len(pairs) - ty))


def test_rank_correlations_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x, y, z = rng.integers(0, 6, 90), rng.integers(0, 40, 90), rng.normal(0, 1, 90)
    y = y + x
    data = [(int(a), int(b), float(c)) for a, b, c in zip(x, y, z)]
    df = spark.createDataFrame(data, "x int, y int, z double")
    tau = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.kendall_matrix(df, ["x", "y", "z"]).collect()}
    rho = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.spearman_matrix(df, ["x", "y", "z"]).collect()}
    r = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.pearson_matrix(df, ["x", "y", "z"]).collect()}
    assert len(tau) == len(rho) == len(r) == 9

    def ranks(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    for a, b, va, vb in (("x", "y", x, y), ("x", "z", x, z), ("z", "y", z, y)):
        assert tau[a, b] == pytest.approx(_kendall(va, vb))
        assert rho[a, b] == pytest.approx(np.corrcoef(ranks(va), ranks(vb))[0, 1])
        assert r[a, b] == pytest.approx(np.corrcoef(va, vb)[0, 1])
    assert tau["x", "x"] == 1.0


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "x int, y int")
    for matrix in (correlation.kendall_matrix, correlation.spearman_matrix):
        got = {(r["col_x"], r["col_y"]): r["corr"] for r in matrix(df, ["x", "y"]).collect()}
        assert got["x", "y"] is None
