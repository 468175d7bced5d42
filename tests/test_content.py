from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import content, nearest


@pytest.fixture(scope="module")
def vectors(spark):
    """Random vectors with copies, an opposite pair and a zero vector."""
    rng = np.random.default_rng(7)
    data = [(f"i{n:02d}", [float(x) for x in rng.normal(size=4)]) for n in range(12)]
    data += [("copy1", data[0][1]), ("copy2", data[0][1]), ("minus", [-x for x in data[1][1]]), ("zero", [0.0] * 4)]
    return spark.createDataFrame(data, "item_id string, embedding array<double>")


def brute_neighbors(rows, k, metric):
    out = {}
    for a, va in rows.items():
        scored = []
        for b, vb in rows.items():
            if a == b:
                continue
            if metric == "cosine":
                scale = np.linalg.norm(va) * np.linalg.norm(vb)
                sim = float(va @ vb / scale) if scale else 0.0
            else:
                sim = 1 / (1 + float(np.linalg.norm(va - vb)))
            scored.append((-round(sim, 6) + 0.0, b))
        out[a] = [(b, -s) for s, b in sorted(scored)[:k]]
    return out


def listed(df):
    out = defaultdict(list)
    for r in df.orderBy("item", "rank").collect():
        out[r["item"]].append((r["neighbor"], r["sim"]))
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block_rows", [3, 100])
def test_neighbors_against_brute_force(spark, vectors, metric, block_rows):
    rows = {r["item_id"]: np.array(r["embedding"]) for r in vectors.collect()}
    want = brute_neighbors(rows, 5, metric)
    got = listed(nearest.item_neighbors(vectors, 5, metric, block_rows=block_rows))
    assert got.keys() == want.keys()
    for item in want:
        assert [b for b, _ in got[item]] == [b for b, _ in want[item]]
        assert np.allclose([s for _, s in got[item]], [s for _, s in want[item]], atol=2e-6)
    assert all(b != item for item, near in got.items() for b, _ in near)


@pytest.mark.parametrize("piece", [2, 7])
def test_large_blocks_are_compared_in_pieces(spark, monkeypatch, piece):
    """Blocks that grow with the table, in pieces: the same neighbours, ties by id, and fewer copies of a vector."""
    rng = np.random.default_rng(3)
    rows = [(f"i{n:02d}", np.round(rng.normal(size=3), 1).tolist()) for n in range(40)] + [(f"copy{n}", [1.0, 2.0, 0.0]) for n in range(6)] + [("nan", [float("nan")] * 3), ("none", None)]
    df = spark.createDataFrame(rows, "item_id string, embedding array<double>")
    want = listed(nearest.item_neighbors(df, 5, block_rows=100))
    monkeypatch.setattr(nearest, "BLOCK_ROWS", piece)
    for block_rows in (11, 100):
        assert listed(nearest.item_neighbors(df, 5, block_rows=block_rows)) == want
    assert listed(nearest.item_neighbors(df, 5)) == want
    sparse = df.where("item_id not in ('nan', 'none')").selectExpr("item_id doc_id", "array(0, 1, 2) indices", "embedding values")
    whole = listed(nearest.sparse_neighbors(sparse, 5, block_rows=100))
    monkeypatch.setattr(nearest, "SPARSE_BLOCK_ROWS", piece)
    assert listed(nearest.sparse_neighbors(sparse, 5, block_rows=100)) == whole
    # eight blocks a table, until a block holds so many rows or numbers; never fewer than the least
    assert nearest.block_size(800_000, 64 * 800_000, 2_048) == 32_768 and nearest.block_size(800_000, 1_000 * 800_000, 2_048) == 4_000
    assert nearest.block_size(51_282, 64 * 51_282, 2_048) == 6_411 and nearest.block_size(0, 0, 2_048) == 2_048


def test_k_is_limited_by_the_other_items(spark, vectors):
    few = vectors.where("item_id < 'i02' and item_id like 'i%'")
    assert nearest.item_neighbors(few, 10).count() == 2
    with pytest.raises(ValueError):
        nearest.item_neighbors(vectors, 3, "manhattan")


def test_vector_with_nan_has_no_neighbors(spark, vectors):
    odd = vectors.unionByName(spark.createDataFrame([("nan", [float("nan")] * 4)], vectors.schema))
    got = nearest.item_neighbors(odd, 3)
    assert got.where("item = 'nan' or neighbor = 'nan'").count() == 0


def test_sparse_neighbors_equal_dense(spark):
    rng = np.random.default_rng(2)
    dense = []
    for n in range(25):
        v = rng.random(9) * (rng.random(9) < 0.4)
        dense.append((f"d{n:02d}", v / np.linalg.norm(v) if v.any() else v))
    sparse = spark.createDataFrame(
        [(i, [int(x) for x in np.nonzero(v)[0]], [float(v[x]) for x in np.nonzero(v)[0]]) for i, v in dense],
        "doc_id string, indices array<int>, values array<double>",
    )
    full = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in dense], "item_id string, embedding array<double>")
    assert listed(nearest.sparse_neighbors(sparse, 4, block_rows=6)) == listed(nearest.item_neighbors(full, 4))


def test_query_neighbors_agree_with_the_index(spark, vectors):
    some = vectors.where("item_id in ('i03', 'copy1')")
    got, index = listed(nearest.query_neighbors(vectors, some, 4)), listed(nearest.item_neighbors(vectors, 4))
    assert got == {k: index[k] for k in ("i03", "copy1")}


@pytest.fixture(scope="module")
def small(spark):
    near = spark.createDataFrame(
        [("x", "y", 1, 0.5), ("x", "z", 2, -0.25), ("y", "x", 1, 0.5), ("y", "z", 2, 0.0), ("z", "y", 1, 0.0)],
        "item string, neighbor string, rank int, sim double",
    )
    rated = spark.createDataFrame(
        [("a", "y", 4.0), ("a", "z", 2.0), ("b", "x", 5.0), ("c", "q", 1.0)],
        "user_id string, parent_asin string, rating double",
    )
    return near, rated


def test_content_cells(spark, small):
    near, rated = small
    got = {(r["user_id"], r["parent_asin"]): r["pred"] for r in content.content_cells(rated, near).collect()}
    # a on x: (0.5 * 4 - 0.25 * 2) / (0.5 + 0.25); a on y and z only have weights of zero
    assert got == {("a", "x"): pytest.approx(2.0), ("b", "y"): 5.0}
    strict = content.content_cells(rated, near, min_common=2).collect()
    assert [(r["user_id"], r["parent_asin"]) for r in strict] == [("a", "x")]


def test_content_predict_falls_back(spark, small):
    near, rated = small
    target = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "x"), ("nobody", "x")], "user_id string, parent_asin string")
    got = {(r["user_id"], r["parent_asin"]): r["pred"] for r in content.content_predict(rated, target, near).collect()}
    assert got == {("a", "x"): pytest.approx(2.0), ("a", "y"): 3.5, ("c", "x"): 3.5, ("nobody", "x"): 3.5}


def test_cells_and_pairs_agree(spark, vectors, ratings):
    named = ratings.withColumn("parent_asin", F.regexp_replace("parent_asin", "hot", "copy1"))
    near = nearest.item_neighbors(vectors, 4)
    matrix = content.item_rating_matrix(named, vectors)
    cells = content.content_cells(matrix, near)
    pairs = content.content_predict(matrix, cells.select("user_id", "parent_asin"), near, fallback=-9.0)
    joined = cells.join(pairs.withColumnRenamed("pred", "p2"), ["user_id", "parent_asin"])
    assert joined.count() == cells.count() > 0
    assert joined.where(F.abs(F.col("pred") - F.col("p2")) > 1e-9).count() == 0


def test_grid_counts_what_it_skips(spark, vectors, ratings):
    near = nearest.item_neighbors(vectors, 6)
    grid = content.content_grid(ratings, near, vectors, (2, 6), keys=("user_id", "parent_asin")).collect()
    assert [r["k"] for r in grid] == [2, 6]
    for r in grid:
        assert r["n_test_used"] + r["skipped_users"] + r["skipped_items"] == -(-ratings.count() * 2 // 10)
        assert r["skipped_items"] > 0 and r["rmse"] ** 2 == pytest.approx(r["mse"]) and r["mae"] <= r["rmse"]


def test_no_nested_loops_in_prediction_plans(spark, vectors, ratings):
    near = nearest.item_neighbors(vectors, 4)
    for df in (content.content_cells(ratings, near), content.content_predict(ratings, ratings, near)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cells_are_not_shuffled(spark):
    """Ratings travel with the list of items they reach; cells stay where they are formed, also those of a user in several tasks."""
    rows = [(f"u{u}", f"i{i}", float((u * 3 + i) % 5 + 1)) for u in range(5) for i in range(u, 9)]
    rows += [("many", f"i{i}", float(i % 5 + 1)) for i in range(2_100)]
    matrix = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double")
    near = [(f"i{i}", f"i{j}", 1.0 / (i + j + 1)) for i in range(9) for j in range(9) if i != j]
    near += [(f"i{i % 7}", f"i{i}", 0.25) for i in range(9, 2_100)]
    cells = content.content_cells(matrix, spark.createDataFrame(near, "item string, neighbor string, sim double"))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id#" in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "_target" in line.split("hashpartitioning")[-1]]
    sums = {}
    of = {}
    for item, neighbor, sim in near:
        of.setdefault(neighbor, []).append((item, sim))
    for user, rated, rating in rows:
        for item, sim in of[rated]:
            num, den = sums.get((user, item), (0.0, 0.0))
            sums[user, item] = num + sim * rating, den + sim
    got = {(r["user_id"], r["parent_asin"]): r["pred"] for r in cells.collect()}
    assert got == pytest.approx({key: num / den for key, (num, den) in sums.items()})
