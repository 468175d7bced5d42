"""Parts appended once, bucketed tables, recorded encoding, sketches, one-scan quantiles and pruned top lists."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.catalog import QUERIES, views
from ratingloom.operators import cbow, clustering, embedding, factorization, profile, sketches, skew
from ratingloom.sources import tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_part_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, n int, more array<string>, m map<string,int>"
    rows = [(f"k{n}", n, ["a", None], {"x": n}) for n in range(50)] + [("k0", 0, ["a", None], {"x": 0}), (None, None, None, None)]
    part = spark.createDataFrame(rows, schema)
    assert tables.read_appended(spark, path, part.schema).count() == 0
    assert tables.append_once(path, part)
    assert not tables.append_once(path, part.repartition(7))  # the same rows, dealt otherwise
    assert tables.read_appended(spark, path, part.schema).count() == len(rows)
    other = spark.createDataFrame(rows[:-1], schema)  # one row less is another part
    assert tables.append_once(path, other)
    assert tables.append_once(path, part, name="second delivery") and not tables.append_once(path, part, name="second delivery")
    held = tables.read_appended(spark, path, part.schema)
    assert held.count() == 3 * len(rows) - 1 and held.schema == part.schema
    # files of a try that broke off before it was recorded do not count, and the next try replaces them
    lost = spark.createDataFrame([("lost", 1, [], {})], schema)
    digest = tables.part_digest(lost)[0]
    lost.write.parquet(f"{path}/part={digest}")
    assert tables.read_appended(spark, path, part.schema).count() == 3 * len(rows) - 1
    assert tables.append_once(path, lost)
    assert tables.read_appended(spark, path, part.schema).where("k = 'lost'").count() == 1


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    keys = ["user_id", "parent_asin"]
    ratings = spark.createDataFrame([(f"u{n % 9}", f"i{n % 7}", float(n % 5)) for n in range(63)], "user_id string, parent_asin string, rating double")
    known = tables.save_bucketed(ratings, "known_in_buckets", str(tmp_path / "a"), keys, 4)
    guessed = tables.save_bucketed(ratings.withColumnRenamed("rating", "pred"), "guessed_in_buckets", str(tmp_path / "b"), keys, 4)
    both = known.join(guessed.hint("merge"), keys)
    assert both.count() == 63 and both.where("rating = pred").count() == 63
    assert "SortMergeJoin" in plan_of(both) and "Exchange" not in plan_of(both)
    assert "Exchange" not in plan_of(known.groupBy(*keys).count())
    plain = ratings.join(ratings.withColumnRenamed("rating", "pred").hint("merge"), keys)
    assert "Exchange" in plan_of(plain)


def test_recorded_encoding_equals_the_plain_one_and_goes_on(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{n}", None if n == 3 else "word " * (1 + n * 37 % 200)) for n in range(400)], "parent_asin string, text string")
    path, log = str(tmp_path / "e"), tmp_path / "calls"
    log.mkdir()

    class Failing(embedding.HashingEncoder):
        def __init__(self, fails):
            super().__init__()
            self.fails = fails

        def __call__(self, texts):
            if self.fails and any(len(t) > 900 for t in texts):
                raise RuntimeError("executor lost")
            with open(log / "texts", "a") as out:
                out.write(f"{len(texts)}\n")
            return super().__call__(texts)

    def call(fails):
        return embedding.encode_texts_resumable(docs, path, lambda: Failing(fails), chunks=10, chunks_per_job=2)

    want = {r.parent_asin: r.embedding for r in embedding.encode_texts(docs).collect()}
    with pytest.raises(Exception, match="executor lost"):
        call(True)
    (log / "texts").unlink(missing_ok=True)
    assert {r.parent_asin: r.embedding for r in call(False).collect()} == want
    first = sum(map(int, (log / "texts").read_text().split()))
    assert first == 400
    (log / "texts").unlink()
    assert {r.parent_asin: r.embedding for r in call(True).collect()} == want  # nothing is left to encode
    assert not (log / "texts").exists()
    empty = embedding.encode_texts_resumable(docs.limit(0), str(tmp_path / "none"), chunks=2)
    assert empty.collect() == []


def test_batches_hold_texts_of_about_one_length(spark, tmp_path):
    class Padding(embedding.HashingEncoder):
        """Adds the length of the longest text of the batch, so that padding can be seen."""

        def __call__(self, texts):
            return np.hstack([super(type(self), self).__call__(texts), np.full((len(texts), 1), max(map(len, texts)))])

    docs = spark.createDataFrame([(f"d{n}", "x" * (1 + n * 37 % 400)) for n in range(400)], "parent_asin string, text string")
    padded = lambda df: sum(r.embedding[-1] for r in df.collect())
    plain = padded(embedding.encode_texts(docs, lambda: Padding(4), 8, normalize=False))
    sorted_ = padded(embedding.encode_texts_resumable(docs, str(tmp_path / "p"), lambda: Padding(4), 8, normalize=False, chunks=2, chunks_per_job=2))
    assert sorted_ < 0.75 * plain


def test_sketches_of_parts_merge_to_those_of_the_table(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = [(f"u{int(u)}", f"i{int(i)}", float(x)) for u, i, x in zip(rng.zipf(1.3, 20_000) % 5_000, rng.integers(0, 700, 20_000), rng.lognormal(size=20_000))]
    table = spark.createDataFrame([*rows, (None, None, None)], "user_id string, parent_asin string, rating double")
    path = str(tmp_path / "s")
    for n in (0, 1, 2, 1):
        sketches.save_sketch(sketches.sketch_part(table.where(F.pmod(F.xxhash64("user_id", "parent_asin", "rating"), F.lit(3)) == n), f"p{n}"), path)
    held = sketches.load_sketches(spark, path)
    assert held.count() == 3
    merged = sketches.merge_sketches(held)
    facts = sketches.approximate_sparsity(merged).first()
    users, items = len({u for u, _, _ in rows}), len({i for _, i, _ in rows})
    assert facts.n_ratings == len(rows) + 1
    assert abs(facts.n_users / users - 1) < 4 * sketches.distinct_error() and abs(facts.n_items / items - 1) < 4 * sketches.distinct_error()
    x = np.sort([r[2] for r in rows])
    for r in sketches.approximate_quantiles(merged, "rating", (0.01, 0.5, 0.9, 0.99)).collect():
        rank = np.searchsorted(x, r.value) / len(x)
        assert abs(rank - r.p) <= sketches.rank_error() + 1 / len(x)
    told = sketches.approximate_describe(merged, "rating").first()
    assert told["count"] == len(rows) and told["min"] == x[0] and told["max"] == x[-1] and abs(told["mean"] - x.mean()) < 1e-9
    nothing = sketches.merge_sketches(sketches.sketch_part(table.where("rating IS NULL"), "n"))
    assert [r.value for r in sketches.approximate_quantiles(nothing, "rating", (0.5,)).collect()] == [None]
    assert sketches.approximate_describe(nothing, "rating").first()["p50"] is None


def test_describe_reads_the_table_once(spark, monkeypatch):
    ratings = views.ratings(spark, SF)
    plans = []
    real = profile.value_counts
    monkeypatch.setattr(profile, "value_counts", lambda df, *a: plans.append(plan_of(df)) or real(df, *a))
    out = QUERIES["rating_describe"](spark, SF)
    scans = [line for line in plan_of(out).splitlines() if "FileScan" in line]
    assert len(plans) == 1 and plans[0].count("FileScan") == 2  # lines and orders
    assert scans and not any("lineitem" in line or "orders" in line for line in scans)  # the rest comes from the counts
    assert out.first()["count"] == ratings.count()


@pytest.mark.parametrize("limit", [3, 2_000])
def test_quantiles_of_cut_groups_equal_those_of_whole_ones(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_FRAGMENT", limit)
    rng = np.random.default_rng(1)
    rows = [(g, float(x)) for g, n in (("a", 1), ("b", 2), ("c", 300)) for x in rng.integers(0, 90, n)]
    df = spark.createDataFrame([*rows, ("d", None)], "g string, x double")
    got = {r.g: (r.q0, r.q1) for r in skew.exact_quantiles(df, "x", (0.25, 0.9), ["g"]).collect()}
    for g in "abc":
        x = [v for k, v in rows if k == g]
        assert got[g] == pytest.approx(tuple(np.quantile(x, (0.25, 0.9))))


def model_of(spark, users, items):
    return factorization.FactorModel(
        spark.createDataFrame(users, "user_id string, b_u double, p array<double>"),
        spark.createDataFrame(items, "parent_asin string, b_i double, q array<double>"),
        spark.range(1).select(F.lit(3.0).alias("mean")),
        (1.0, 5.0),
    )


@pytest.mark.parametrize("first", [1, 3])
def test_pruned_top_lists_equal_the_plain_ones(spark, first):
    rng = np.random.default_rng(4)
    sizes = rng.lognormal(sigma=1.2, size=600) * 0.1
    q = rng.normal(size=(600, 5)) * sizes[:, None]
    p, bu, bi = rng.normal(size=(25, 5)), rng.normal(size=25) * 0.1, rng.normal(size=600) * 0.1
    q[:40] = q[0]  # equal items: ties go by id
    bi[:40] = bi[0]
    model = model_of(
        spark,
        [(f"u{n:02d}", float(bu[n]), p[n].tolist()) for n in range(25)] + [("none", 0.0, None)],
        [(f"i{n:03d}", float(bi[n]), q[n].tolist()) for n in range(600)] + [("none", 0.0, None)],
    )
    score = np.round(np.clip(3 + bu[:, None] + bi[None] + p @ q.T, 1, 5), 6)
    want = {(f"u{u:02d}", f"i{i:03d}", r + 1) for u in range(25) for r, i in enumerate(np.lexsort((np.arange(600), -score[u]))[:7])}
    got = {(r.user_id, r.parent_asin, r["rank"]) for r in factorization.factor_top_n(model, 7, block_items=30, first=first).collect()}
    assert got == want
    work = factorization.top_n_work(model, 7, block_items=30, first=first).first()
    assert work.n_users == 25 and work.n_blocks >= 20 and work.visits < 0.7 * 25 * work.n_blocks
    none = model_of(spark, [("u", 0.0, [1.0])], [("i", 0.0, None)])
    assert factorization.factor_top_n(none, 3).collect() == []


@pytest.mark.parametrize("merge,dense", [(1, 0), (50_000, 64)])
def test_users_travel_once_to_a_shelf_of_blocks(spark, monkeypatch, merge, dense):
    """Most scores lie at an end of the scale or are equal: lists go by id, from one row per user and shelf."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(factorization, "MERGE_ROWS", merge)
    monkeypatch.setattr(factorization, "DENSE", dense)
    monkeypatch.setattr(factorization, "BLOCK_ROWS", 100)
    q, bi = np.round(rng.normal(size=(400, 3)) * 2)[rng.integers(0, 120, 400)], rng.integers(-1, 2, 400) * 1.5
    p, bu = np.round(rng.normal(size=(30, 3))), np.where(np.arange(30) % 3, 0.0, -9.0)
    model = model_of(spark, [(f"u{n:02d}", float(bu[n]), p[n].tolist()) for n in range(30)], [(f"i{n:03d}", float(bi[n]), q[n].tolist()) for n in range(400)])
    score = np.round(np.clip(3 + bu[:, None] + bi[None] + p @ q.T, 1, 5), 6)
    want = {(f"u{u:02d}", f"i{i:03d}", r + 1) for u in range(30) for r, i in enumerate(np.lexsort((np.arange(400), -score[u]))[:9])}
    assert {(r.user_id, r.parent_asin, r["rank"]) for r in factorization.factor_top_n(model, 9, block_items=8).collect()} == want
    limits = factorization.FactorBlocks(None, np.zeros(50), np.ones(50), np.zeros((50, 3)), np.ones(50))
    users = spark.createDataFrame([(f"u{n}", 3.0, [1.0, 0.0, 0.0], 4.5 if n == 1 else None) for n in range(20)], "_id string, _b double, _f array<double>, _last double")
    open_ = factorization._open_shelves(users, limits, np.arange(50) // 10, 1.0, 5.0)
    assert sorted((r["_id"], r["_shelf"]) for r in open_.collect()) == sorted((f"u{n}", s) for n in range(20) if n != 1 for s in range(5))


@pytest.mark.parametrize("again", [False, True])
def test_visits_of_many_blocks_come_in_bounded_batches(monkeypatch, again):
    monkeypatch.setattr(factorization, "VISITS", 100)
    limits = factorization.FactorBlocks(None, np.zeros(40), np.ones(40), np.zeros((40, 2)), np.ones(40))
    users = {"_id": pa.array([f"u{n}" for n in range(30)]), "_b": pa.array([3.0] * 30), "_f": pa.array([[1.0, 0.0]] * 30)}
    users |= {"_last": pa.array([None] * 30, pa.float64()), "_seen": pa.array([[n % 40] for n in range(30)], pa.list_(pa.int32()))}
    batches = list(factorization._block_visits(iter([pa.RecordBatch.from_pydict(users)]), limits, 2, 1.0, 5.0, again))
    assert max(b.num_rows for b in batches) <= 100
    got = [(i, c) for b in batches for i, c in zip(b.column("_id").to_pylist(), b.column("_block").to_pylist())]
    assert got == [(f"u{n}", c) for n in range(30) for c in (range(40) if again else range(2)) if not again or c != n % 40]


def test_lloyd_equals_the_plain_steps(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3))
    points = spark.createDataFrame([(f"p{n}", v.tolist()) for n, v in enumerate(x)], "item_id string, embedding array<double>")
    placed = clustering.lloyd(points, 4, steps=2)
    got = {r.item_id: r.cluster for r in placed.collect()}
    import hashlib

    order = sorted(range(60), key=lambda n: hashlib.md5(f"p{n}|42".encode()).hexdigest())[:4]
    centres = x[order]
    for _ in range(2):
        label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[label == c].mean(0) for c in range(4)])
    label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert got == {f"p{n}": c for n, c in enumerate(label)}


@pytest.mark.parametrize("parts", [2_000_000, 1_500])
def test_cbow_puts_words_of_one_topic_together(spark, parts):
    rng = np.random.default_rng(9)
    topics = [[f"{t}{n}" for n in range(12)] for t in ("sea", "hill")]
    rows = []
    for n in range(240):
        words = rng.choice([*topics[n % 2], "the", "of"], 25).tolist()
        rows.append((f"d{n}", words))
    rows += [("none", []), ("once", ["rare"]), ("null", None), ("long", ["sea1", "sea2"] * 1_200)]
    tokens = spark.createDataFrame(rows, "parent_asin string, tokens array<string>")
    vectors = {r.word: np.array(r.vector) for r in cbow.train_cbow(tokens, 16, window=3, epochs=10, words_per_part=parts).collect()}
    assert set(vectors) == {*topics[0], *topics[1], "the", "of"} and all(len(v) == 16 for v in vectors.values())
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    same = np.mean([unit[a] @ unit[b] for t in topics for a in t for b in t if a < b])
    other = np.mean([unit[a] @ unit[b] for a in topics[0] for b in topics[1]])
    assert same > other + 0.3
    again = {r.word: r.vector for r in cbow.train_cbow(tokens.repartition(5), 16, window=3, epochs=1, words_per_part=parts).collect()}
    once = {r.word: r.vector for r in cbow.train_cbow(tokens, 16, window=3, epochs=1, words_per_part=parts).collect()}
    assert max(abs(np.array(again[w]) - np.array(once[w])).max() for w in once) < 1e-6  # however the rows are dealt
    assert cbow.train_cbow(tokens.where("parent_asin IN ('none', 'once')"), 4).collect() == []
