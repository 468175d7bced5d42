"""Odd vectors, wide projections, hand-over tables, and sessions started elsewhere."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import clustering, nearest
from ratingloom.operators.similarity import co_rating_sums
from ratingloom.session import durable, scratch_tables, shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "item_id string, embedding array<double>")


def test_null_vectors_are_nobodys_neighbours(spark):
    df = vectors(spark, [("a", [1.0, 0.0, 0.0]), ("b", None), ("c", [0.0, 1.0, 0.0]), ("d", [1.0, 0.0, 0.1])])
    got = {(r["item"], r["neighbor"]): r["sim"] for r in nearest.item_neighbors(df, 3).collect()}
    assert set(got) == {(x, y) for x in "acd" for y in "acd" if x != y}
    assert got["a", "d"] > 0.99 and got["c", "d"] == 0.0
    labels = df.withColumn("cluster", F.when(F.col("item_id") == "c", 1).otherwise(0))
    assert {r["id"] for r in clustering.silhouette_samples(labels).collect()} == {"a", "c", "d"}


@pytest.mark.parametrize("block_rows", [1, 100])
def test_ragged_vectors_are_an_error(spark, block_rows):
    df = vectors(spark, [("a", [1.0, 0.0, 0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])])
    with pytest.raises(Exception, match="one length"):
        nearest.item_neighbors(df, 2, block_rows=block_rows).collect()


def test_projection_takes_more_columns_than_a_covariance_could(spark):
    rng = np.random.default_rng(4)
    n, d = 120, 9_000
    x = np.zeros((n, d))
    for row in x:
        at = rng.choice(d, 80, replace=False)
        row[at] = rng.normal(size=80)
    x[:, :5] += np.outer(np.linspace(-30, 30, n), [1, 2, 3, 4, 5])
    x[:, 5:8] += np.outer(np.sin(np.arange(n)) * 20, [3, -2, 1])
    rows = [(f"u{u:03d}", f"i{i:05d}", float(x[u, i])) for u in range(n) for i in np.flatnonzero(x[u])]
    cells = spark.createDataFrame(rows, "user_id string, parent_asin string, scaled double").withColumn("base", F.lit(0.0))
    profiles = clustering.user_profiles(cells, cells.select("user_id"))
    assert profiles.first()["features"].size > 4_000
    got = {r["user_id"]: r for r in clustering.project_2d(profiles, "user_id").collect()}
    used = x[:, np.any(x != 0, axis=0)]
    centred = used - used.mean(axis=0)
    _, s, axes = np.linalg.svd(centred, full_matrices=False)
    want = centred @ axes[:2].T
    for c, name in enumerate(("pc1", "pc2")):
        mine = np.array([got[f"u{u:03d}"][name] for u in range(n)])
        assert np.allclose(np.abs(mine), np.abs(want[:, c]), atol=1e-4)
    assert got["u000"]["ratio1"] == pytest.approx((s**2 / (s**2).sum())[0], rel=1e-6)


@pytest.mark.parametrize("support", [2, 3])
def test_pair_sums_are_the_same_rows_however_keys_are_treated(spark, ratings, support):
    plain = sorted(map(tuple, co_rating_sums(ratings, min_support=support).collect()))
    heavy = sorted(map(tuple, co_rating_sums(ratings, min_support=support, heavy_rows=5).collect()))
    assert [r[:3] for r in plain] == [r[:3] for r in heavy] and all(r[2] >= support for r in plain)
    assert np.allclose([r[3:] for r in plain], [r[3:] for r in heavy])


@pytest.mark.parametrize("rows", [3, 2_000])
def test_pairs_with_a_support_are_summed_where_they_are_formed(spark, ratings, rows):
    """Keys and entities cut into fragments or not: the sums of all pairs, and no shuffle by both ids."""
    plain = co_rating_sums(ratings, min_support=1).where("n >= 2")
    listed = co_rating_sums(ratings, min_support=2, rows_per_fragment=rows)
    rounded = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert rounded(listed) == rounded(plain) and listed.columns == plain.columns
    exchanges = [line for line in listed._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(a#" in line]
    assert exchanges and not any("b#" in line.split("), ")[0] for line in exchanges)


@pytest.mark.parametrize("rows", [2, 2_000])
def test_raters_travel_as_bytes(spark, rows):
    """Null ids and ratings, fragments and tasks or not: the sums of the plain pairs, from packed lists."""
    cells = [(f"u{u}", f"i{i}", None if (u + i) % 7 == 3 else (u * 5 + i * 3) % 11 / 3) for u in range(13) for i in range(6) if (u * 7 + i * 5) % 4]
    cells += [(None, "i0", 1.0), (None, "i1", 2.0), ("u0", None, 3.0), ("u1", None, 4.0), ("none", "i0", None), ("none", "i1", None)]
    df = spark.createDataFrame(cells, "user_id string, parent_asin string, rating double")
    rounded = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    plain = rounded(co_rating_sums(df.where("user_id is not null and parent_asin is not null"), rows_per_fragment=rows).where("n >= 2"))
    listed = co_rating_sums(df, rows_per_fragment=rows, min_support=2)
    assert rounded(listed) == plain and len(plain) > 50
    assert "MapInArrow" in listed._jdf.queryExecution().toString()


@pytest.mark.parametrize("cut", [1, 3, 100])
def test_packed_lists_and_whole_groups(cut):
    from ratingloom.operators import packed_lists as lists

    sizes = np.array([3, 0, 1, 2])
    places, values = np.array([0, 5, 70_000, 4, 9, 2**31 - 1]), lists.with_null(pa.array([1.5, None, float("nan"), 4.0, 5.0, 0.1]))
    packed = lists.packed(sizes, places, values)
    of, p, v = lists.unpacked(packed)
    assert of.tolist() == [0, 0, 0, 2, 3, 3] and p.tolist() == places.tolist() and lists.is_null(v).tolist() == [False, True, False, False, False, False]
    assert np.array_equal(v[2:], values[2:], equal_nan=True) and v[0] == 1.5
    table = pa.table({"k": [None, None, "a", "a"], "l": packed})
    batches = table.to_batches(max_chunksize=cut)
    for most in (1, 100):
        parts = list(lists.whole_groups(iter(batches), ["k"], "l", most))
        assert pa.concat_tables([t for t, _ in parts]).equals(table)
        assert [t.column("k").to_pylist() for t, _ in parts if most == 1] == ([[None, None], ["a", "a"]] if most == 1 else [])


def test_scratch_tables_go_with_their_block(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch_tables(spark):
        assert durable(spark.range(10)).count() == 10
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_queries_run_in_a_session_started_elsewhere(tmp_path):
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
print("ROWS", entry.queries()["item_knn_cosine"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 10000" in run.stdout, run.stderr[-2000:]


def test_an_outlier_does_not_fill_one_range(spark):
    from ratingloom.operators.skew import running_counts

    counts = spark.range(20_000).select(F.when(F.col("id") == 0, F.lit(1e12)).otherwise(F.col("id").cast("double")).alias("v"), F.lit(1).alias("c"))
    placed = running_counts(counts, "v", "c")
    rows = {r["v"]: r["before"] for r in placed.collect()}
    assert rows[1.0] == 0 and rows[19_999.0] == 19_998 and rows[1e12] == 19_999
    cuts = counts.agg(F.percentile_approx("v", [n / 256 for n in range(1, 256)], 1_024)).first()[0]
    shares = np.bincount(np.searchsorted(cuts, sorted(rows)))
    assert shares.max() < 0.02 * len(rows)
