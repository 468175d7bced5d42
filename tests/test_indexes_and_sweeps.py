"""Neighbour index, pruned silhouette, blocked components and the factor sweep against plain versions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import clustering, diagnostics, factor_sweep, factorization, nearest, neighbor_index
from ratingloom.operators.sampling import assign_folds
from ratingloom.operators.similarity import rating_similarity, sampled_similarity
from ratingloom.operators.wide_components import tall_qr


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "item_id string, embedding array<double>")


@pytest.fixture(scope="module")
def clustered(spark):
    """Loose groups, many copies of one vector, a zero, a null and a NaN vector."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(9, 12)) * 2
    rows = [(f"i{n:04d}", middles[n % 9] + rng.normal(size=12) * 0.4) for n in range(500)]
    rows += [(f"c{n:03d}", middles[0]) for n in range(90)]
    rows += [("zero", np.zeros(12)), ("null", None), ("nan", np.full(12, np.nan))]
    return vectors_of(spark, rows)


def as_set(df):
    return {(r.item, r.neighbor, r["rank"], r.sim) for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("probes", [1, 4])
def test_exact_index_search_equals_all_pairs(clustered, metric, probes):
    want = as_set(nearest.item_neighbors(clustered, 7, metric))
    got = as_set(neighbor_index.indexed_neighbors(clustered, 7, metric, probes=probes, exact=True, lists=20))
    assert got == want


def test_small_fragments_give_the_same(clustered, monkeypatch):
    want = as_set(nearest.item_neighbors(clustered, 5))
    monkeypatch.setattr(neighbor_index, "FRAGMENT_ROWS", 16)
    got = as_set(neighbor_index.indexed_neighbors(clustered, 5, probes=2, exact=True, lists=5))
    assert got == want


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_the_second_stage_sends_a_query_once_per_shelf(spark, metric, monkeypatch):
    """Vectors without clusters leave nearly every list open: they must not be copied once per list."""
    rng = np.random.default_rng(8)
    items = vectors_of(spark, [(f"i{n:04d}", v) for n, v in enumerate(rng.normal(size=(600, 16)))])
    monkeypatch.setattr(neighbor_index, "SHELF_ROWS", 250)
    monkeypatch.setattr(neighbor_index, "TILE_CELLS", 3_000)
    monkeypatch.setattr(neighbor_index, "SLICE_CELLS", 400)
    sent = []
    search_shelves = neighbor_index._search_shelves
    monkeypatch.setattr(neighbor_index, "_search_shelves", lambda index, asks, shelves, rows: sent.append((asks.count(), len(set(shelves)))) or search_shelves(index, asks, shelves, rows))
    got = as_set(neighbor_index.indexed_neighbors(items, 6, metric, probes=20, exact=True, lists=30))
    assert got == as_set(nearest.item_neighbors(items, 6, metric))
    asks, shelves = sent[0]
    assert 3 <= shelves <= 6 and 600 < asks <= 600 * shelves


def test_chosen_probes_reach_the_recall(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").cast("string").alias("item_id"), "embedding")
    true = {(r.item, r.neighbor) for r in nearest.item_neighbors(items, 20).collect()}
    index = neighbor_index.build_index(items, 20)
    probes = neighbor_index.choose_probes(index, 0.95)
    found = {(r.item, r.neighbor) for r in neighbor_index.search(index, 20, probes).collect()}
    recall = len(found & true) / len(true)
    print(f"recall {recall:.3f} with {probes} of {len(index.centres)} lists")
    assert recall >= 0.9 and len(found) == len(true)
    some = items.where(F.col("item_id").cast("long") % 50 == 0).select(F.col("item_id").alias("_id"))
    part = {(r.item, r.neighbor) for r in neighbor_index.search(index, 20, probes, queries=some).collect()}
    assert part == {(i, n) for i, n in found if int(i) % 50 == 0}


def test_index_of_few_or_no_vectors(spark):
    none = vectors_of(spark, [("a", None)])
    assert neighbor_index.indexed_neighbors(none, 3, probes=1).collect() == []
    one = vectors_of(spark, [("a", [1, 2])])
    assert neighbor_index.indexed_neighbors(one, 3, exact=True).collect() == []
    same = vectors_of(spark, [(f"x{n}", [1, 2]) for n in range(6)])
    assert as_set(neighbor_index.indexed_neighbors(same, 3, exact=True)) == as_set(nearest.item_neighbors(same, 3))
    with pytest.raises(ValueError):
        neighbor_index.build_index(vectors_of(spark, [("a", [1]), ("b", [1, 2])]), 3)
    with pytest.raises(ValueError):
        neighbor_index.search(neighbor_index.build_index(one, 2), 3, 1)


# --- silhouette ------------------------------------------------------------------------


def plain_silhouette(x, label):
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for n in range(len(x)):
        mine = label == label[n]
        if mine.sum() == 1 or len(set(label)) == 1:
            out.append(0.0)
            continue
        a = gap[n][mine].sum() / (mine.sum() - 1)
        b = min(gap[n][label == c].mean() for c in set(label) - {label[n]})
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_silhouette_needs_few_clusters_and_equals_the_plain_one(spark, spread):
    rng = np.random.default_rng(5)
    label = np.array([n % 8 for n in range(300)] + [9] + [3] * 100)
    x = rng.normal(size=(10, 6))[label] * 3 + rng.normal(size=(len(label), 6)) * spread
    rows = [(f"p{n}", [float(v) for v in p], int(c)) for n, (p, c) in enumerate(zip(x, label))]
    points = spark.createDataFrame([*rows, ("none", None, 1)], "item_id string, embedding array<double>, cluster int")
    got = {r.id: r.silhouette for r in clustering.silhouette_samples(points, block_rows=32).collect()}
    want = plain_silhouette(x, label)
    assert set(got) == {f"p{n}" for n in range(len(x))}
    assert max(abs(got[f"p{n}"] - s) for n, s in enumerate(want)) < 1e-7
    rows = clustering._labelled(points, "item_id", "embedding", "cluster")
    assert clustering.undecided_clusters(rows, clustering.cluster_balls(rows), 1_000_000).count() == rows.count()  # one shelf: no vector is copied
    work = clustering.silhouette_work(points).agg(F.sum("distances").alias("d"), F.sum("members").alias("n")).first()
    assert work["n"] == len(x)
    if spread < 1:  # own cluster and hardly more than one other
        assert work["d"] < 0.4 * len(x) ** 2
    assert clustering.silhouette_samples(points.where("cluster = 9")).first().silhouette == 0.0


# --- components ------------------------------------------------------------------------


@pytest.mark.parametrize("block", [16, 64])
def test_blocked_components_equal_the_plain_ones(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 37)) * 2 + rng.normal(size=(120, 37)) + 3
    x[5] = 0
    items = vectors_of(spark, [(f"r{n}", v) for n, v in enumerate(x)])
    centred = x - x.mean(0)
    _, s, right = np.linalg.svd(centred, full_matrices=False)
    want = centred @ right[:2].T
    got = {r.item_id: r for r in clustering.project_2d(clustering.dense_features(items), "item_id", column_block=block).collect()}
    for c, name in enumerate(("pc1", "pc2")):
        place = np.array([got[f"r{n}"][name] for n in range(len(x))])
        sign = np.sign(place @ want[:, c])
        assert np.abs(sign * place - want[:, c]).max() < 1e-5
    shares = s**2 / (s**2).sum()
    assert abs(got["r0"].ratio1 - shares[0]) < 1e-8 and abs(got["r0"].ratio2 - shares[1]) < 1e-8
    facts = diagnostics.explained_variance(items, 10, column_block=block).first()
    assert abs(facts.evr_top10 - shares[:10].sum()) < 1e-7 and abs(facts.evr_pc1 - shares[0]) < 1e-8


def test_sparse_rows_and_rows_without_entries(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(n, Vectors.sparse(40, {(n * 7) % 40: 1.0 + n % 3, (n * 7 + 3) % 40: -2.0})) if n % 5 else (n, Vectors.sparse(40, [], [])) for n in range(60)]
    features = spark.createDataFrame(rows, ["id", "features"])
    x = np.array([v.toArray() for _, v in rows])
    centred = x - x.mean(0)
    s = np.linalg.svd(centred, compute_uv=False)
    got = clustering.project_2d(features, "id", column_block=8).collect()
    assert len(got) == 60
    assert abs(got[0].ratio1 - s[0] ** 2 / (s**2).sum()) < 1e-8
    place = np.array([[r.pc1, r.pc2] for r in got])
    assert abs(place.mean(0)).max() < 1e-8 and abs((place[:, 0] ** 2).sum() - s[0] ** 2) < 1e-5


def test_tall_qr_is_orthonormal_and_drops_what_is_dependent(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(50, 4))
    m[:, 3] = m[:, 0] + m[:, 1]
    parts = [(n, m[n * 10 : n * 10 + 10].tobytes()) for n in range(5)]
    q, width = tall_qr(spark.createDataFrame(parts, "cb int, m binary"), 4)
    assert width == 3
    whole = np.concatenate([np.frombuffer(r["m"]).reshape(-1, 3) for r in sorted(q.collect(), key=lambda r: r["cb"])])
    assert np.abs(whole.T @ whole - np.eye(3)).max() < 1e-12
    assert np.abs(whole @ (whole.T @ m) - m).max() < 1e-10


# --- factor sweep ----------------------------------------------------------------------


def plain_sweep(rows, rank, reg, epochs, folds=3, seed=42):
    """Errors by (fold, epoch) of one setting: rows (user, item, rating, fold)."""
    out = {}
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    draw = lambda u, j: int(hashlib.md5(f"{u}|{j}|{seed}".encode()).hexdigest()[:8], 16) / 4294967296 - 0.5
    for f in range(folds):
        train = [r for r in rows if r[3] != f]
        mean = np.mean([r[2] for r in train])
        bi, bu = {}, {}
        for i in items:
            held = [r[2] - mean for r in train if r[1] == i]
            bi[i] = sum(held) / (len(held) + 10.0)
        for u in users:
            held = [r[2] - mean - bi[r[1]] for r in train if r[0] == u]
            bu[u] = sum(held) / (len(held) + 15.0)
        p = {u: np.array([draw(u, j + 1) for j in range(rank)]) / np.sqrt(rank) for u in users}
        q = {}

        def solve(own, other, x):
            fresh = {}
            for e in {r[own] for r in train}:
                mine = [r for r in train if r[own] == e]
                a = np.array([x[r[other]] for r in mine])
                b = np.array([r[2] - mean - bi[r[1]] - bu[r[0]] for r in mine])
                fresh[e] = np.linalg.solve(a.T @ a + reg * len(mine) * np.eye(rank), a.T @ b)
            return fresh

        for epoch in range(1, epochs + 1):
            q = solve(1, 0, p)
            p = solve(0, 1, q)
            zero = np.zeros(rank)
            errors = [(r[2] - np.clip(mean + bi[r[1]] + bu[r[0]] + p.get(r[0], zero) @ q.get(r[1], zero), 1, 5)) ** 2 for r in rows if r[3] == f]
            out[f, epoch] = np.mean(errors)
    return out


@pytest.mark.parametrize("hot", [1_000, 12])
def test_all_settings_equal_single_fits(spark, ratings, hot):
    scores = {(r.n_factors, r.reg_all, r.fold, r.n_epochs): r for r in factor_sweep.sweep(ratings, (2, 5), (1, 4), (0.05, 0.3), hot_ratings=hot).collect()}
    assert len(scores) == 2 * 2 * 3 * 2
    rows = [tuple(r) for r in assign_folds(ratings, 3, 42).select("user_id", "parent_asin", "rating", "fold").collect()]
    for rank, reg in ((2, 0.05), (5, 0.3)):
        for (fold, epoch), mse in plain_sweep(rows, rank, reg, 4).items():
            if epoch in (1, 4):
                assert scores[rank, reg, fold, epoch].mse == pytest.approx(mse, abs=2e-4)
                assert scores[rank, reg, fold, epoch].n == sum(r[3] == fold for r in rows)


def test_the_sweep_agrees_with_the_library_trainer(spark):
    """On structured ratings the sweep's held-out error is as low as that of Spark's ALS."""
    rows = [(f"u{u}", f"i{i}", 5.0 if (u % 2) == (i % 2) else 1.0) for u in range(40) for i in range(30) if (u * 7 + i * 3) % 4]
    matrix = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double")
    grid = factorization.factor_grid(matrix, (4,), (8,), (0.05,)).first()
    folded = assign_folds(matrix, 3, 42)
    errors = []
    for f in range(3):
        model = factorization.fit_factors(folded.where(F.col("fold") != f).drop("fold"), 4, 8, 0.05)
        e = (F.col("rating") - F.col("pred")) ** 2
        errors.append(factorization.factor_predict(model, folded.where(F.col("fold") == f)).agg(F.sqrt(F.avg(e))).first()[0])
    assert grid.mean_rmse < 0.5 and abs(grid.mean_rmse - np.mean(errors)) < 0.15
    assert grid.train_rmse <= grid.mean_rmse + 1e-6 and grid.rank_rmse == 1


# --- sampled similarity ----------------------------------------------------------------


def test_sampled_similarity_is_unbiased_and_finds_strong_pairs(spark):
    rng = np.random.default_rng(8)
    rows = [(f"u{u:03d}", f"i{i:02d}", float(rng.integers(1, 6))) for u in range(200) for i in range(40) if rng.random() < 0.5]
    matrix = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double")
    exact = {(r.a, r.b): (r.n, r.sim) for r in rating_similarity(matrix, "cosine").collect()}
    runs = [{(r.a, r.b): r for r in sampled_similarity(matrix, "cosine", raters_per_group=40, seed=s).collect()} for s in range(4)]
    total = sum(n for n, _ in exact.values())
    for run in runs:  # about 100 raters an item in three groups
        assert sum(r.seen for r in run.values()) < 0.45 * total
        assert abs(sum(r.n for r in run.values()) / total - 1) < 0.03
        strong = [p for p, (n, _) in exact.items() if n >= 8]
        assert len([p for p in strong if p in run]) >= 0.9 * len(strong) > 0
        # about three of nine common keys are met, with ratings drawn from one to five
        assert np.mean([abs(run[p].sim - exact[p][1]) for p in strong if p in run]) < 0.12
        off = np.array([(run[p].n / exact[p][0] - 1) for p in strong if p in run])
        said = np.array([run[p].error for p in strong if p in run])
        assert 0.5 < np.sqrt((off**2).mean()) / said.mean() < 2.0  # the stated error is about the real one
    whole = {(r.a, r.b): (r.n, r.sim) for r in sampled_similarity(matrix, "cosine").collect()}
    assert whole.keys() == exact.keys() and all(abs(whole[p][1] - exact[p][1]) < 1e-12 for p in exact)


def test_wide_sweeps_are_cut_into_parts(spark, ratings, monkeypatch):
    wide = factor_sweep.Settings(3, (50, 75, 100, 125), (0.01, 0.02, 0.03, 0.04), (1.0, 5.0))
    parts = wide.parts()
    assert max(part.width for part in parts) <= factor_sweep.PART_WIDTH
    assert [one[:4] for part in parts for one in part.slices] == [one[:4] for one in wide.slices]
    run = lambda: {tuple(r)[:4]: tuple(r)[4:] for r in factor_sweep.sweep(ratings, (2, 3), (1,), (0.05, 0.3), hot_ratings=12).collect()}
    whole = run()
    monkeypatch.setattr(factor_sweep, "PART_WIDTH", 5)
    cut = run()
    assert cut.keys() == whole.keys()
    assert all(np.allclose(cut[k], whole[k], atol=1e-5) for k in whole)
