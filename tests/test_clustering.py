import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import clustering, diagnostics


@pytest.fixture(scope="module")
def points(spark):
    data = [("a", [0.0, 0.0], 0), ("b", [0.0, 1.0], 0), ("c", [5.0, 5.0], 1), ("d", [5.0, 7.0], 1), ("e", [9.0, 0.0], 2)]
    return spark.createDataFrame(data, "item_id string, embedding array<double>, cluster int")


def brute_silhouette(points):
    rows = [(r["item_id"], np.array(r["embedding"]), r["cluster"]) for r in points.collect()]
    out = {}
    for i, x, c in rows:
        dist = {}
        for j, y, l in rows:
            if i != j:
                dist.setdefault(l, []).append(np.linalg.norm(x - y))
        if c not in dist:
            out[i] = 0.0
            continue
        a, b = np.mean(dist[c]), min(np.mean(v) for l, v in dist.items() if l != c)
        out[i] = (b - a) / max(a, b)
    return out


@pytest.mark.parametrize("block_rows", [1, 2, 100])
def test_silhouette(spark, points, block_rows):
    got = {r["id"]: r["silhouette"] for r in clustering.silhouette_samples(points, block_rows=block_rows).collect()}
    assert got == pytest.approx(brute_silhouette(points)) and got["e"] == 0.0


def test_inertia_and_step(spark, points):
    assert clustering.inertia(points).first()[0] == pytest.approx(0.5 + 2.0)
    start = spark.createDataFrame([(0, [0.0, 0.0]), (1, [6.0, 6.0])], "cluster int, embedding array<double>")
    labels, moved = clustering.kmeans_step(points.drop("cluster"), start)
    assert {r["item_id"]: r["cluster"] for r in labels.collect()} == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 1}
    centers = {r["cluster"]: r["embedding"] for r in clustering.centroid_table(moved).collect()}
    assert centers[0] == [0.0, 0.5] and centers[1] == pytest.approx([19 / 3, 4.0])
    cosines = {(r["cluster_x"], r["cluster_y"]): r["cosine"] for r in clustering.centroid_cosine(clustering.centroid_table(moved)).collect()}
    assert cosines[0, 0] == pytest.approx(1.0) and cosines[0, 1] == cosines[1, 0]


def test_sweep_marks_unusable_k(spark, points):
    sweep = clustering.kmeans_sweep(points.drop("cluster"), (1, 2, 3, 5, 9), "toy", restarts=3)
    rows = {r["k"]: r for r in sweep.collect()}
    assert all(rows[k]["inertia"] is None and rows[k]["silhouette"] is None for k in (1, 5, 9))
    assert rows[3]["inertia"] <= rows[2]["inertia"] and rows[2]["n_points"] == 5
    assert clustering.best_k(sweep).first()["k"] in (2, 3)


def test_restarts_never_raise_inertia(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(n, [float(v) for v in rng.normal(size=3)]) for n in range(80)], "item_id int, embedding array<double>")
    features = clustering.dense_features(df).cache()
    one = clustering.best_kmeans(features, 6, restarts=1).summary.trainingCost
    many = clustering.best_kmeans(features, 6, restarts=4).summary.trainingCost
    assert many <= one


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(11)
    data = [(f"u{u}", f"i{i}", float(np.round(1 + 4 * rng.random(), 3))) for u in range(9) for i in range(6) if (u * i + u) % 4 != 1]
    return spark.createDataFrame(data, "user_id string, parent_asin string, pred double")


def _dense(cells, fallback):
    rows = cells.collect()
    users = [f"u{u}" for u in range(10)]  # u9 has no cell at all
    items = sorted({r["parent_asin"] for r in rows})
    m = np.full((len(users), len(items)), fallback)
    for r in rows:
        m[users.index(r["user_id"]), items.index(r["parent_asin"])] = r["pred"]
    q1, q2, q3 = np.quantile(m, [0.25, 0.5, 0.75], axis=0)
    spread = np.where(q3 - q1 > 1e-12, q3 - q1, 1.0)
    return users, items, (m - q2) / spread, (fallback - q2) / spread


def test_robust_scaling_and_profiles_equal_the_dense_matrix(spark, cells):
    users, items, scaled, base = _dense(cells, 3.0)
    user_df = spark.createDataFrame([(u,) for u in users], "user_id string")
    fallback = spark.range(1).select(F.lit(3.0))
    out = clustering.robust_scale(cells, user_df, fallback)
    for r in out.collect():
        u, i = users.index(r["user_id"]), items.index(r["parent_asin"])
        assert r["scaled"] == pytest.approx(scaled[u, i]) and r["base"] == pytest.approx(base[i])
    profiles = clustering.user_profiles(out, user_df)
    got = {r["user_id"]: r["features"].toArray() for r in profiles.collect()}
    for n, u in enumerate(users):
        assert np.allclose(got[u], scaled[n] - base)
    # principal components do not feel the shift
    placed = {r["user_id"]: (r["pc1"], r["pc2"]) for r in clustering.project_2d(profiles, "user_id").collect()}
    centered = scaled - scaled.mean(axis=0)
    _, _, axes = np.linalg.svd(centered)
    want = centered @ axes[:2].T
    for axis in (0, 1):
        mine = np.array([placed[u][axis] for u in users])
        assert np.allclose(np.abs(mine), np.abs(want[:, axis]), atol=1e-6)


def test_cluster_tables(spark):
    ratings = spark.createDataFrame([("a", 4.0), ("a", 2.0), ("b", 5.0), ("c", 1.0), ("z", 1.0)], "user_id string, rating double")
    members = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 2)], "user_id string, cluster int")
    got = {r["cluster_id"]: tuple(r)[1:] for r in clustering.cluster_profile(ratings, members).collect()}
    assert got[0] == pytest.approx((2, 11 / 3, np.std([4, 2, 5], ddof=1), 1.5, 3))
    assert got[1] == (1, 1.0, None, 1.0, 1) and got[2] == (1, None, None, 0.0, 0)
    counts = {(r["cluster_id"], r["rating"]): r["n"] for r in clustering.cluster_rating_counts(ratings, members).collect()}
    assert counts == {(0, 4.0): 1, (0, 2.0): 1, (0, 5.0): 1, (1, 1.0): 1}


def test_unit_vectors_have_unit_norm(spark, points):
    from ratingloom.operators.embedding import normalize_embeddings

    out = diagnostics.norm_stats(normalize_embeddings(points.where("item_id <> 'a'"))).first()
    assert out["norm_min"] == pytest.approx(1.0) and out["norm_max"] == pytest.approx(1.0)
