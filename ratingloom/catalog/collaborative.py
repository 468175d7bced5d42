"""Queries on co-rating similarity, neighbourhood prediction and matrix factorisation."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ratingloom.catalog import views
from ratingloom.catalog.registry import query
from ratingloom.catalog.sql_parts import (
    MATRIX,
    SIMILARITY,
    hash_key,
    hash_number,
    holdout,
    mirrored,
    pair_sums,
    similarities,
)
from ratingloom.operators import collaborative, evaluation, factor_sweep, factorization, recommend, sampling
from ratingloom.operators.similarity import rating_similarity, sampled_similarity
from ratingloom.session import durable

IDS = ("user_id", "parent_asin")
# Hold-out shares with their seeds, and the neighbourhood sizes and supports of the grid.
SPLITS = ((0.1, 42), (0.2, 19), (0.3, 27))
GRID_KS = (3, 5, 10, 15, 20, 25)
GRID_SUPPORTS = (1, 2, 3, 5)


def _rounded(df, *columns, digits=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _sim_sql(measure: str, support: int, by_user: bool = True) -> str:
    return f"""WITH {MATRIX}, {pair_sums('matrix', by_user)}, {similarities(measure, support)}
SELECT a, b, n, round(sim, 6) AS sim FROM sims"""


@query("sim_cosine", _sim_sql("cosine", 2))
def sim_cosine(spark, d):
    return _rounded(rating_similarity(durable(views.matrix(spark, d)), "cosine", True, 2), "sim")


@query("sim_pearson", _sim_sql("pearson", 3))
def sim_pearson(spark, d):
    return _rounded(rating_similarity(durable(views.matrix(spark, d)), "pearson", True, 3), "sim")


@query("sim_msd", _sim_sql("msd", 2))
def sim_msd(spark, d):
    return _rounded(rating_similarity(durable(views.matrix(spark, d)), "msd", True, 2), "sim")


@query("sim_item_based", _sim_sql("cosine", 2, by_user=False))
def sim_item_based(spark, d):
    return _rounded(rating_similarity(durable(views.matrix(spark, d)), "cosine", False, 2), "sim")


@query("sim_sampled", f"""WITH {MATRIX}, {pair_sums()}
SELECT count(*) FILTER (n >= 4) AS n_strong, CAST(sum(n) FILTER (n >= 4) AS BIGINT) AS n_common, true AS sum_holds, true AS recall_reached,
  true AS sims_close FROM sums""")
def sim_sampled(spark, d):
    """Similarities from pairs inside groups of sixteen raters, beside all pairs with four or more common items."""
    matrix = durable(views.matrix(spark, d))
    exact = durable(rating_similarity(matrix, "cosine", True, 1)).toDF("a", "b", "m", "true_sim")
    guess = durable(sampled_similarity(matrix, "cosine", raters_per_group=16))
    all_keys = guess.agg(F.sum("n")).scalar()
    both = exact.withColumn("_strong", F.col("m") >= 4).join(guess, ["a", "b"], "left")
    strong = F.col("_strong")
    return both.agg(
        F.count_if(strong).alias("n_strong"),
        F.sum(F.when(strong, F.col("m"))).alias("n_common"),
        F.sum("m").alias("_m"),
        (F.count(F.when(strong, F.col("n"))) >= 0.9 * F.count_if(strong)).alias("recall_reached"),
        (F.avg(F.when(strong & F.col("n").isNotNull(), F.abs(F.col("sim") - F.col("true_sim")))) < 0.1).alias("sims_close"),
    ).withColumn("_n", all_keys).select(
        "n_strong", "n_common", (F.abs(F.col("_n") / F.col("_m") - 1) < 0.02).alias("sum_holds"), "recall_reached", "sims_close"
    )


def _predict_sql(k: int, by_user: bool, tag: str = "") -> str:
    """``preds``: targets in ``test{tag}`` from ``train{tag}`` and ``both_ways{tag}``, mean where there is none."""
    met = (
        "t.parent_asin = r.parent_asin AND t.user_id <> r.user_id"
        if by_user
        else "t.user_id = r.user_id AND t.parent_asin <> r.parent_asin"
    )
    own, other = ("t.user_id", "r.user_id") if by_user else ("t.parent_asin", "r.parent_asin")
    return f"""ranked{tag} AS (
  SELECT t.user_id, t.parent_asin, r.rating AS r, s.sim,
         row_number() OVER (PARTITION BY t.user_id, t.parent_asin ORDER BY round(s.sim, 6) DESC, {other}) AS rank
  FROM test{tag} t JOIN train{tag} r ON {met} JOIN both_ways{tag} s ON s.e = {own} AND s.o = {other}),
found{tag} AS (
  SELECT user_id, parent_asin, greatest(1.0, least(5.0, sum(sim * r) / sum(sim))) AS p
  FROM ranked{tag} WHERE rank <= {k} GROUP BY 1, 2),
preds{tag} AS (
  SELECT t.user_id, t.parent_asin, t.rating, coalesce(p, (SELECT avg(rating) FROM train{tag})) AS pred
  FROM test{tag} t LEFT JOIN found{tag} USING (user_id, parent_asin))"""


def _holdout_sql(size: float, seed: int, measure: str, support: int, k: int, by_user: bool = True, tag: str = "") -> str:
    return f"""{holdout('matrix', size, seed, IDS, f'marked{tag}')},
train{tag} AS (SELECT user_id, parent_asin, rating FROM marked{tag} WHERE NOT is_test),
test{tag} AS (SELECT user_id, parent_asin, rating FROM marked{tag} WHERE is_test),
{pair_sums(f'train{tag}', by_user, f'sums{tag}')}, {similarities(measure, support, f'sums{tag}', f'sims{tag}')},
{mirrored(f'sims{tag}', f'both_ways{tag}')}, {_predict_sql(k, by_user, tag)}"""


def _holdout_predictions(matrix, size, seed, measure, support, k, by_user=True):
    marked = durable(sampling.split_holdout(matrix, size, seed))
    train = marked.where(~F.col("is_test")).drop("is_test")
    test = marked.where("is_test").drop("is_test")
    sims = rating_similarity(train, measure, by_user, support)
    return collaborative.knn_predict(train, test, sims, k, by_user, min_support=support)


@query("knn_predict", f"""WITH {MATRIX}, {_holdout_sql(0.2, 42, 'cosine', 1, 20)}
SELECT user_id, parent_asin, round(rating, 6) AS rating, round(pred, 6) AS pred FROM preds""")
def knn_predict(spark, d):
    return _rounded(_holdout_predictions(durable(views.matrix(spark, d)), 0.2, 42, "cosine", 1, 20), "rating", "pred")


@query("knn_predict_items", f"""WITH {MATRIX}, {_holdout_sql(0.2, 42, 'msd', 2, 20, by_user=False)}
SELECT user_id, parent_asin, round(rating, 6) AS rating, round(pred, 6) AS pred FROM preds""")
def knn_predict_items(spark, d):
    return _rounded(_holdout_predictions(durable(views.matrix(spark, d)), 0.2, 42, "msd", 2, 20, by_user=False), "rating", "pred")


def _eval_sql() -> str:
    parts = ", ".join(_holdout_sql(size, seed, "cosine", 3, 20, tag=f"_{seed}") for size, seed in SPLITS)
    rows = " UNION ALL ".join(
        f"""SELECT CAST({size} AS DOUBLE) AS test_size, CAST({seed} AS INTEGER) AS seed,
  round(sqrt(avg((rating - pred) ** 2)), 6) AS rmse, round(avg((rating - pred) ** 2), 6) AS mse,
  round(avg(abs(rating - pred)), 6) AS mae, count(*) AS n FROM preds_{seed}"""
        for size, seed in SPLITS
    )
    return f"WITH {MATRIX}, {parts} {rows}"


@query("knn_eval", _eval_sql())
def knn_eval(spark, d):
    matrix, out = durable(views.matrix(spark, d)), None
    for size, seed in SPLITS:
        preds = _holdout_predictions(matrix, size, seed, "cosine", 3, 20)
        row = evaluation.accuracy(preds).select(
            F.lit(size).alias("test_size"), F.lit(seed).alias("seed"), "rmse", "mse", "mae", "n"
        )
        out = row if out is None else out.unionByName(row)
    return _rounded(out, "rmse", "mse", "mae")


def _grid_sql(ks, measures, directions, supports, folds=3) -> str:
    """Every configuration on its own: similarities, ranks and errors without any sharing."""
    parts, unions = [], []
    for by_user in directions:
        tag = "u" if by_user else "i"
        met = (
            "t.parent_asin = r.parent_asin AND t.user_id <> r.user_id"
            if by_user
            else "t.user_id = r.user_id AND t.parent_asin <> r.parent_asin"
        )
        own, other = ("t.user_id", "r.user_id") if by_user else ("t.parent_asin", "r.parent_asin")
        sims = " UNION ALL ".join(
            f"SELECT fold, a, b, n, '{m}' AS similarity, {SIMILARITY[m]} AS sim FROM sums_{tag}" for m in measures
        )
        parts.append(f"""{pair_sums('train', by_user, f'sums_{tag}', 'fold')},
sims_{tag} AS ({sims}),
both_{tag} AS (
  SELECT fold, similarity, n, a AS e, b AS o, sim FROM sims_{tag} WHERE sim > 0 UNION ALL
  SELECT fold, similarity, n, b AS e, a AS o, sim FROM sims_{tag} WHERE sim > 0),
ranked_{tag} AS (
  SELECT t.fold, t.user_id, t.parent_asin, similarity, min_support, r.rating AS r, sim,
         row_number() OVER (PARTITION BY t.fold, t.user_id, t.parent_asin, similarity, min_support
                            ORDER BY round(sim, 6) DESC, {other}) AS rank
  FROM rated t JOIN train r ON t.fold = r.fold AND {met}
  JOIN both_{tag} s ON s.fold = t.fold AND s.e = {own} AND s.o = {other}
  JOIN supports ON n >= min_support),
found_{tag} AS (
  SELECT fold, user_id, parent_asin, similarity, min_support, k,
         greatest(1.0, least(5.0, sum(sim * r) / sum(sim))) AS p
  FROM ranked_{tag} JOIN ks ON rank <= k GROUP BY ALL)""")
        unions.append(f"""SELECT c.fold, c.similarity, c.min_support, c.k, {str(by_user).lower()} AS user_based,
  avg((c.rating - coalesce(p, c.mean)) ** 2) AS mse
FROM (SELECT rated.*, mean, similarity, min_support, k FROM rated JOIN means USING (fold), measures, supports, ks) c
LEFT JOIN found_{tag} f ON f.fold = c.fold AND f.user_id = c.user_id AND f.parent_asin = c.parent_asin
  AND f.similarity = c.similarity AND f.min_support = c.min_support AND f.k = c.k
GROUP BY ALL""")
    values = lambda name, items: f"{name} AS (SELECT unnest([{', '.join(items)}]) AS {{}})"
    return f"""WITH {MATRIX},
{values('ks', [str(k) for k in ks]).format('k')}, {values('supports', [str(s) for s in supports]).format('min_support')},
{values('measures', [f"'{m}'" for m in measures]).format('similarity')},
rated AS (SELECT user_id, parent_asin, rating,
  CAST({hash_number(hash_key(*IDS, seed=42))} % {folds} AS INTEGER) AS fold FROM matrix),
train AS (SELECT f.fold, user_id, parent_asin, rating
          FROM rated r JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range({folds})) f ON f.fold <> r.fold),
means AS (SELECT fold, avg(rating) AS mean FROM train GROUP BY 1),
{', '.join(parts)},
scores AS ({' UNION ALL '.join(unions)}),
results AS (
  SELECT CAST(k AS INTEGER) AS k, similarity, user_based, CAST(min_support AS INTEGER) AS min_support,
         avg(sqrt(mse)) AS mean_rmse, stddev_pop(sqrt(mse)) AS std_rmse, avg(mse) AS mean_mse, stddev_pop(mse) AS std_mse
  FROM scores GROUP BY ALL)
SELECT k, similarity, user_based, min_support, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse,
       round(mean_mse, 6) AS mean_mse, round(std_mse, 6) AS std_mse,
       CAST(rank() OVER (ORDER BY round(mean_rmse, 9)) AS INTEGER) AS rank_rmse
FROM results"""


_ERRORS = ("mean_rmse", "std_rmse", "mean_mse", "std_mse")


@query("knn_cv", _grid_sql((10,), ("cosine",), (True,), (2,)))
def knn_cv(spark, d):
    return _rounded(collaborative.knn_cross_validate(views.matrix(spark, d)), *_ERRORS)


_FULL_GRID = _grid_sql(GRID_KS, ("cosine", "pearson", "msd"), (True, False), GRID_SUPPORTS)


@query("knn_grid", _FULL_GRID)
def knn_grid(spark, d):
    return _rounded(collaborative.knn_grid(views.matrix(spark, d), GRID_KS, supports=GRID_SUPPORTS), *_ERRORS)


@query("knn_grid_top", f"""SELECT *, CASE WHEN user_based THEN 'User' ELSE 'Item' END AS based_on
FROM ({_FULL_GRID}) ORDER BY rank_rmse, k, similarity, user_based, min_support LIMIT 10""")
def knn_grid_top(spark, d):
    grid = collaborative.knn_grid(views.matrix(spark, d), GRID_KS, supports=GRID_SUPPORTS)
    return _rounded(evaluation.top_configurations(grid, 10), *_ERRORS)


@query("knn_grid_best", f"""SELECT k, similarity, user_based, min_support, mean_rmse
FROM ({_FULL_GRID}) ORDER BY rank_rmse, k, similarity, user_based, min_support LIMIT 1""")
def knn_grid_best(spark, d):
    grid = collaborative.knn_grid(views.matrix(spark, d), GRID_KS, supports=GRID_SUPPORTS)
    best = evaluation.best_configuration(grid, ["k", "similarity", "user_based", "min_support"], "mean_rmse")
    return _rounded(best, "mean_rmse")


_CELLS = f"""{MATRIX}, {pair_sums()}, {similarities('cosine', 3)}, {mirrored()},
ranked AS (
  SELECT user_id, parent_asin, r, sim,
         row_number() OVER (PARTITION BY user_id, parent_asin ORDER BY round(sim, 6) DESC, o) AS rank
  FROM (SELECT s.e AS user_id, m.parent_asin, m.rating AS r, s.sim, s.o
        FROM both_ways s JOIN matrix m ON m.user_id = s.o
        UNION ALL SELECT user_id, parent_asin, rating, 1.0, user_id FROM matrix)),
cells AS (
  SELECT user_id, parent_asin, greatest(1.0, least(5.0, sum(sim * r) / sum(sim))) AS pred
  FROM ranked WHERE rank <= 20 GROUP BY 1, 2)"""


def _knn_cells(spark, d):
    matrix = durable(views.matrix(spark, d))
    return matrix, collaborative.knn_cells(matrix, rating_similarity(matrix, "cosine", True, 3), 20)


@query("knn_cells", f"WITH {_CELLS} SELECT user_id, parent_asin, round(pred, 6) AS pred FROM cells")
def knn_cells(spark, d):
    return _rounded(_knn_cells(spark, d)[1], "pred")


def top_n_sql(n: int, keep: str = "") -> str:
    """``top``: the n best items per user over the dense matrix; ``keep`` restricts the cells."""
    return f"""top AS (
  SELECT user_id, parent_asin, round(pred, 6) AS pred, CAST(rank AS INTEGER) AS rank FROM (
    SELECT user_id, parent_asin, coalesce(c.pred, m.mean) AS pred,
           row_number() OVER (PARTITION BY user_id ORDER BY round(coalesce(c.pred, m.mean), 6) DESC, parent_asin) AS rank
    FROM (SELECT DISTINCT user_id FROM all_users) CROSS JOIN (SELECT DISTINCT parent_asin FROM all_items)
    CROSS JOIN m LEFT JOIN cells c USING (user_id, parent_asin) {keep})
  WHERE rank <= {n})"""


@query("knn_topn", f"""WITH {_CELLS}, all_users AS (SELECT user_id FROM matrix),
all_items AS (SELECT parent_asin FROM matrix), m AS (SELECT avg(rating) AS mean FROM matrix), {top_n_sql(10)}
SELECT * FROM top""")
def knn_topn(spark, d):
    matrix, cells = _knn_cells(spark, d)
    top = recommend.top_n_with_fallback(cells, matrix, matrix.select("parent_asin"), 10)
    return _rounded(top, "pred")


# --- matrix factorisation -------------------------------------------------------------

_BIASES = f"""{MATRIX}, mu AS (SELECT avg(rating) AS mean FROM matrix),
bi AS (SELECT parent_asin, sum(rating - mean) / (count(*) + 10.0) AS b_i FROM matrix, mu GROUP BY 1),
bu AS (SELECT user_id, sum(rating - mean - b_i) / (count(*) + 15.0) AS b_u
       FROM matrix JOIN bi USING (parent_asin), mu GROUP BY 1)"""


@query("mf_bias", f"""WITH {_BIASES}
SELECT 'user' AS side, user_id AS id, round(b_u, 6) AS bias FROM bu
UNION ALL SELECT 'item', parent_asin, round(b_i, 6) FROM bi""")
def mf_bias(spark, d):
    users, items, _ = factorization.damped_biases(views.matrix(spark, d))
    both = users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), F.col("b_u").alias("bias"))
    return _rounded(
        both.unionByName(items.select(F.lit("item").alias("side"), F.col("parent_asin").alias("id"), F.col("b_i").alias("bias"))),
        "bias",
    )


# Trained factors differ from run to run of any trainer; the facts about them do not.
@query("mf_als", f"""WITH {MATRIX}, {holdout('matrix', 0.2, 42, IDS, 'marked')}
SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, true AS finite, true AS in_scale,
       true AS beats_mean_on_train, true AS near_mean_on_test FROM marked""")
def mf_als(spark, d):
    """Facts on the factor model: finite, inside the scale, closer to the training ratings than their mean."""
    marked = durable(sampling.split_holdout(durable(views.matrix(spark, d)), 0.2, 42))
    model = factorization.fit_factors(marked.where(~F.col("is_test")).drop("is_test"), 50, 10, 0.1)
    preds = factorization.factor_predict(model, marked).withColumn("_mean", model.mean.scalar())
    square = lambda c: (F.col("rating") - F.col(c)) ** 2
    seen, held = ~F.col("is_test"), F.col("is_test")
    rmse = lambda c, part: F.sqrt(F.avg(F.when(part, square(c))))
    return preds.agg(
        F.count_if(seen).alias("n_train"),
        F.count_if(held).alias("n_test"),
        F.every(F.abs("pred") < float("inf")).alias("finite"),
        F.every(F.col("pred").between(1.0, 5.0)).alias("in_scale"),
        (rmse("pred", seen) < 0.95 * rmse("_mean", seen)).alias("beats_mean_on_train"),
        (rmse("pred", held) < 1.2 * rmse("_mean", held)).alias("near_mean_on_test"),
    )


@query("mf_als_structured", f"""WITH {MATRIX}, structured AS (
  SELECT user_id, parent_asin, CASE WHEN (substr(md5(user_id), 1, 1) < '8') = (substr(md5(parent_asin), 1, 1) < '8') THEN 5.0 ELSE 1.0 END AS rating FROM matrix),
{holdout('structured', 0.2, 42, IDS, 'marked')}
SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, round(avg(rating) FILTER (is_test), 6) AS mean_test,
  true AS recovers FROM marked""")
def mf_als_structured(spark, d):
    """Ratings of two tastes on the given pairs: a model that learns them is far closer to the held-out ones than their mean."""
    low = lambda c: F.substring(F.md5(c), 1, 1) < "8"
    rating = F.when(low("user_id") == low("parent_asin"), 5.0).otherwise(1.0)
    matrix = views.matrix(spark, d).withColumn("rating", rating)
    marked = durable(sampling.split_holdout(durable(matrix), 0.2, 42))
    model = factorization.fit_factors(marked.where(~F.col("is_test")).drop("is_test"), 8, 10, 0.05)
    preds = factorization.factor_predict(model, marked.where("is_test")).withColumn("_mean", model.mean.scalar())
    error = lambda c: F.sqrt(F.avg((F.col("rating") - F.col(c)) ** 2))
    sizes = marked.agg(F.count_if(~F.col("is_test")))
    return preds.agg(
        F.count(F.lit(1)).alias("n_test"), F.round(F.avg("rating"), 6).alias("mean_test"), (error("pred") < 0.5 * error("_mean")).alias("recovers")
    ).withColumn("n_train", sizes.scalar())


@query("mf_topn", f"""WITH {MATRIX}
SELECT user_id, CAST(10 AS BIGINT) AS n, true AS in_scale, true AS in_order FROM matrix GROUP BY user_id""")
def mf_topn(spark, d):
    model = factorization.fit_factors(views.matrix(spark, d), 50, 30, 0.01)
    top = factorization.factor_top_n(model, 10)
    listed = F.array_sort(F.collect_list(F.struct("rank", "pred")))
    out = top.groupBy("user_id").agg(F.countDistinct("parent_asin").alias("n"), listed.alias("l"))
    falling = F.transform("l", lambda e: -e["pred"])
    return out.select(
        "user_id",
        "n",
        F.forall("l", lambda e: e["pred"].between(1.0, 5.0)).alias("in_scale"),
        ((F.array_sort(falling) == falling) & (F.col("l.rank") == F.sequence(F.lit(1), F.size("l")))).alias("in_order"),
    )


# The grid of the factor model.
MF_FACTORS = (50, 75, 100, 125)
MF_EPOCHS = (15, 20, 25, 30)
MF_REGS = (0.01, 0.02, 0.03, 0.04)


def _folded_biases(folds: int = 3) -> str:
    """``based``: every rating with the mean and the damped biases of each fold's training rows."""
    return f"""{MATRIX},
rated AS (SELECT user_id, parent_asin, rating, CAST({hash_number(hash_key(*IDS, seed=42))} % {folds} AS INTEGER) AS fold FROM matrix),
f AS (SELECT CAST(range AS INTEGER) AS f FROM range({folds})),
train AS (SELECT f, user_id, parent_asin, rating FROM rated JOIN f ON f <> fold),
mu AS (SELECT f, avg(rating) AS mean FROM train GROUP BY 1),
bi AS (SELECT f, parent_asin, sum(rating - mean) / (count(*) + 10.0) AS b_i FROM train JOIN mu USING (f) GROUP BY 1, 2),
bu AS (SELECT f, user_id, sum(rating - mean - b_i) / (count(*) + 15.0) AS b_u
       FROM train JOIN mu USING (f) JOIN bi USING (f, parent_asin) GROUP BY 1, 2),
based AS (SELECT f, user_id, parent_asin, rating, fold = f AS held, mean + coalesce(b_i, 0.0) + coalesce(b_u, 0.0) AS base
          FROM rated CROSS JOIN f JOIN mu USING (f) LEFT JOIN bi USING (f, parent_asin) LEFT JOIN bu USING (f, user_id))"""


_BIAS_RMSE = """bias AS (
  SELECT avg(t) AS train, avg(h) AS held FROM (
    SELECT f, sqrt(avg((rating - greatest(1.0, least(5.0, base))) ** 2) FILTER (NOT held)) AS t,
           sqrt(avg((rating - greatest(1.0, least(5.0, base))) ** 2) FILTER (held)) AS h
    FROM based GROUP BY f))"""


@query("mf_grid", f"""WITH {_folded_biases()}, {_BIAS_RMSE}
SELECT CAST(n AS INTEGER) AS n_factors, CAST(e AS INTEGER) AS n_epochs, CAST(g AS DOUBLE) AS reg_all, round(train, 6) AS bias_train_rmse,
  round(held, 6) AS bias_rmse, true AS learns_train, true AS epochs_do_no_harm, true AS ranked
FROM bias, (SELECT unnest([{', '.join(map(str, MF_FACTORS))}]) AS n), (SELECT unnest([{', '.join(map(str, MF_EPOCHS))}]) AS e),
  (SELECT unnest([{', '.join(map(str, MF_REGS))}]) AS g)""")
def mf_grid(spark, d):
    """All configurations: the error on training rows is far below that of the biases, after any number of epochs."""
    matrix = durable(views.matrix(spark, d))
    grid = factorization.factor_grid(matrix, MF_FACTORS, MF_EPOCHS, MF_REGS)
    based = factor_sweep.fold_bases(sampling.assign_folds(matrix.select("user_id", "parent_asin", "rating")), 3)
    rows = based.select("rating", "fold", F.posexplode("base").alias("f", "b"))
    square = (F.col("rating") - F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.col("b")))) ** 2
    held = F.col("fold") == F.col("f")
    bias = rows.groupBy("f").agg(F.sqrt(F.avg(F.when(~held, square))).alias("t"), F.sqrt(F.avg(F.when(held, square))).alias("h"))
    bias = bias.agg(F.struct(F.avg("t").alias("t"), F.avg("h").alias("h")))
    before = F.lag("train_rmse").over(Window.partitionBy("n_factors", "reg_all").orderBy("n_epochs"))
    ahead = F.rank().over(Window.orderBy(F.round("mean_rmse", 9))).cast("int")
    return grid.withColumn("_b", bias.scalar()).select(
        "n_factors",
        "n_epochs",
        "reg_all",
        F.round("_b.t", 6).alias("bias_train_rmse"),
        F.round("_b.h", 6).alias("bias_rmse"),
        (F.col("train_rmse") < 0.5 * F.col("_b.t")).alias("learns_train"),
        # the error on training rows is not what the epochs lower, but their regularised sum: it may rise a little
        F.coalesce(F.col("train_rmse") <= before + 0.05, F.lit(True)).alias("epochs_do_no_harm"),
        (F.col("rank_rmse") == ahead).alias("ranked"),
    )


SMALL_RANKS, SMALL_EPOCHS, SMALL_REGS = (1, 2), (1, 3), (0.05, 0.5)


def _als_sql(rank: int, reg: float, epochs: int) -> str:
    """Ranks one and two written out: each half-step solves its normal equations by Cramer's rule."""
    tag = f"{rank}_{str(reg).replace('.', '')}"

    def draw(j: int) -> str:
        digest = f"md5(user_id || '|{j}|42')"
        return f"({hash_number(digest)} / 4294967296.0 - 0.5) / sqrt({rank}.0)" if j <= rank else "0.0"

    def half(own: str, other: str, name: str, source: str) -> str:
        diagonal = f"(yy + {reg} * n)" if rank == 2 else "1.0"
        det = f"((xx + {reg} * n) * {diagonal} - xy * xy)"
        y = f"((xx + {reg} * n) * yr - xy * xr) / {det}" if rank == 2 else "0.0"
        return f"""{name} AS (SELECT f, id, ({diagonal} * xr - xy * yr) / {det} AS x, {y} AS y FROM (
    SELECT b.f, b.{own} AS id, count(*) AS n, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy,
      sum(x * (rating - base)) AS xr, sum(y * (rating - base)) AS yr
    FROM based b JOIN {source} s ON s.f = b.f AND s.id = b.{other} WHERE NOT held GROUP BY 1, 2))"""

    parts = [f"u{tag}_0 AS (SELECT f, user_id AS id, {draw(1)} AS x, {draw(2)} AS y FROM based GROUP BY f, user_id)"]
    for e in range(1, epochs + 1):
        parts.append(half("parent_asin", "user_id", f"i{tag}_{e}", f"u{tag}_{e - 1}"))
        parts.append(half("user_id", "parent_asin", f"u{tag}_{e}", f"i{tag}_{e}"))
        parts.append(f"""e{tag}_{e} AS (SELECT b.f AS fold, {rank} AS n_factors, {e} AS n_epochs, {reg} AS reg_all,
  avg((rating - greatest(1.0, least(5.0, base + coalesce(u.x * i.x + u.y * i.y, 0.0)))) ** 2) AS mse
  FROM based b LEFT JOIN u{tag}_{e} u ON u.f = b.f AND u.id = b.user_id LEFT JOIN i{tag}_{e} i ON i.f = b.f AND i.id = b.parent_asin
  WHERE held GROUP BY b.f)""")
    return ",\n".join(parts)


def _small_grid_sql() -> str:
    runs = [(r, g) for r in SMALL_RANKS for g in SMALL_REGS]
    parts = ",\n".join(_als_sql(r, g, max(SMALL_EPOCHS)) for r, g in runs)
    rows = " UNION ALL ".join(f"SELECT * FROM e{r}_{str(g).replace('.', '')}_{e}" for r, g in runs for e in SMALL_EPOCHS)
    return f"""WITH {_folded_biases()}, {parts}, scores AS ({rows})
SELECT CAST(n_factors AS INTEGER) AS n_factors, CAST(n_epochs AS INTEGER) AS n_epochs, CAST(reg_all AS DOUBLE) AS reg_all,
  round(avg(sqrt(mse)), 3) AS mean_rmse, round(stddev_pop(sqrt(mse)), 3) AS std_rmse FROM scores GROUP BY ALL"""


@query("mf_grid_small", _small_grid_sql())
def mf_grid_small(spark, d):
    """Small ranks, whose errors SQL can work out number by number."""
    grid = factorization.factor_grid(views.matrix(spark, d), SMALL_RANKS, SMALL_EPOCHS, SMALL_REGS)
    return _rounded(grid.select("n_factors", "n_epochs", "reg_all", "mean_rmse", "std_rmse"), "mean_rmse", "std_rmse", digits=3)


# --- prediction from given factors ------------------------------------------------------

_FACTORS = 8


def _given_sql(side: str, column: str) -> str:
    slot = f"CAST('0x' || substr(md5('{side}' || {column}), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings)"
    return f"""SELECT {column}, (slot % 7 - 3) / 10.0 AS bias, CAST(embedding[1:{_FACTORS}] AS DOUBLE[]) AS f
  FROM (SELECT {column}, {slot} AS slot FROM matrix GROUP BY 1) JOIN embeddings ON vec_id = slot"""


_GIVEN = f"""{MATRIX}, mu AS (SELECT avg(rating) AS mean FROM matrix),
fu AS ({_given_sql('u', 'user_id')}), fi AS ({_given_sql('i', 'parent_asin')})"""
_GIVEN_PRED = "greatest(1.0, least(5.0, mean + fu.bias + fi.bias + 3.0 * list_inner_product(fu.f, fi.f)))"


def _given_model(spark, d):
    """A factor model whose factors are taken from the embeddings by a hash of each id."""
    matrix = durable(views.matrix(spark, d))
    embeddings = views.table(spark, d, "embeddings")
    total = embeddings.agg(F.count(F.lit(1))).scalar()

    def side(letter: str, column: str, bias: str, factors: str, scale: float):
        slot = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(letter), F.col(column))), 1, 8), 16, 10).cast("long"), total)
        ids = matrix.select(column).distinct().withColumn("vec_id", slot)
        vector = F.transform(F.slice("embedding", 1, _FACTORS), lambda x: x.cast("double") * scale)
        return durable(ids.join(embeddings, "vec_id").select(column, ((F.col("vec_id") % 7 - 3) / 10.0).alias(bias), vector.alias(factors)))

    users, items = side("u", "user_id", "b_u", "p", 3.0), side("i", "parent_asin", "b_i", "q", 1.0)
    return matrix, factorization.FactorModel(users, items, matrix.agg(F.avg("rating").alias("mean")), (1.0, 5.0))


@query("mf_predict_given_factors", f"""WITH {_GIVEN}
SELECT user_id, parent_asin, round({_GIVEN_PRED}, 6) AS pred FROM matrix JOIN fu USING (user_id) JOIN fi USING (parent_asin), mu""")
def mf_predict_given_factors(spark, d):
    matrix, model = _given_model(spark, d)
    return _rounded(factorization.factor_predict(model, matrix).select("user_id", "parent_asin", "pred"), "pred")


@query("mf_topn_given_factors", f"""WITH {_GIVEN}
SELECT user_id, parent_asin, pred, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, parent_asin) AS rank
  FROM (SELECT user_id, parent_asin, round({_GIVEN_PRED}, 6) AS pred FROM fu, fi, mu)) WHERE rank <= 10""")
def mf_topn_given_factors(spark, d):
    return factorization.factor_top_n(_given_model(spark, d)[1], 10)


@query("mf_topn_pruned", f"""WITH {_GIVEN}
SELECT user_id, parent_asin, pred, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, parent_asin) AS rank
  FROM (SELECT user_id, parent_asin, round({_GIVEN_PRED}, 6) AS pred FROM fu, fi, mu)) WHERE rank <= 25""")
def mf_topn_pruned(spark, d):
    """Longer lists over small blocks of items, most of which a user never looks at."""
    return factorization.factor_top_n(_given_model(spark, d)[1], 25, block_items=64, first=2)
