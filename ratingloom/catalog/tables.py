"""Queries on cleaning, filtering, sampling and profiling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ratingloom.catalog import views
from ratingloom.catalog.registry import query
from ratingloom.catalog.sql_parts import MATRIX, META, RATINGS, REVIEWS, hash_key, hash_number, holdout
from ratingloom.functions.columns import clean_price, clip
from ratingloom.operators import correlation, filters, profile, sampling, sketches
from ratingloom.operators.features import documents, text_table
from ratingloom.session import durable, shared_folder
from ratingloom.sources.tables import merge_parts

KEYS = ("user_id", "parent_asin", "rating")
CORRELATED = ("rating", "helpful_vote", "verified_purchase", "has_image", "num_images")


@query("price_clean", f"""WITH {META}
SELECT parent_asin, TRY_CAST(nullif(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price FROM meta""")
def price_clean(spark, d):
    return views.meta(spark, d).select("parent_asin", clean_price(F.col("price")).alias("price"))


@query("text_flatten", f"WITH {META} SELECT parent_asin, title, description, author, categories FROM meta")
def text_flatten(spark, d):
    return text_table(views.meta(spark, d))


@query("text_concat", f"""WITH {META}
SELECT parent_asin, trim(concat_ws(' ', title, description, author, categories)) AS text FROM meta""")
def text_concat(spark, d):
    return documents(text_table(views.meta(spark, d)))


@query("coerce_numeric", """
SELECT user_id, parent_asin, rating, helpful_vote FROM (
  SELECT CASE WHEN l_tax > 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id, CAST(l_partkey AS VARCHAR) AS parent_asin,
         CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(round(l_discount * 100) AS INTEGER) % 5 + 1 AS DOUBLE) END AS rating,
         CAST(trunc(l_quantity) AS INTEGER) AS helpful_vote
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
WHERE user_id IS NOT NULL AND rating IS NOT NULL""")
def coerce_numeric(spark, d):
    return filters.clean_ratings(views.raw_reviews(spark, d))


@query("rating_triples", f"WITH {RATINGS} SELECT user_id, parent_asin, rating FROM ratings")
def rating_triples(spark, d):
    return filters.rating_triples(views.reviews(spark, d))


@query("merge_parts", f"""WITH {REVIEWS}
SELECT user_id, parent_asin, rating, helpful_vote FROM reviews
UNION ALL SELECT user_id, parent_asin, rating, NULL FROM reviews WHERE verified_purchase""")
def merge(spark, d):
    reviews = views.reviews(spark, d)
    first = reviews.select("user_id", "parent_asin", "rating", "helpful_vote")
    second = reviews.where("verified_purchase").select("user_id", "parent_asin", "rating")
    return merge_parts([first, second])


@query("dedupe_first", """
SELECT CAST(l_partkey AS VARCHAR) AS parent_asin, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey
                               ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity) AS n FROM lineitem)
WHERE n = 1""")
def dedupe_first(spark, d):
    lines = views.table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("parent_asin"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    return filters.first_per_id(lines, "parent_asin", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])


@query("image_counts", f"WITH {REVIEWS} SELECT user_id, parent_asin, num_images, has_image FROM reviews")
def image_counts(spark, d):
    return profile.with_image_columns(views.reviews(spark, d)).select(
        "user_id", "parent_asin", "num_images", "has_image"
    )


@query("clip_rating", f"""WITH {REVIEWS}
SELECT user_id, parent_asin, greatest(1.0, least(5.0, CAST(helpful_vote AS DOUBLE) / 8)) AS clipped FROM reviews""")
def clip_rating(spark, d):
    return views.reviews(spark, d).select(
        "user_id", "parent_asin", clip(F.col("helpful_vote").cast("double") / 8, 1, 5).alias("clipped")
    )


@query("min_count_incl", f"""WITH {RATINGS}
SELECT user_id, parent_asin, rating FROM ratings
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) >= 30)
  AND parent_asin IN (SELECT parent_asin FROM ratings GROUP BY 1 HAVING count(*) >= 30)""")
def min_count_incl(spark, d):
    return filters.min_count_filter(durable(views.ratings(spark, d)), 30, 30)


@query("min_count_strict", f"""WITH {RATINGS}
SELECT user_id, parent_asin, rating FROM ratings
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) > 20)
  AND parent_asin IN (SELECT parent_asin FROM ratings GROUP BY 1 HAVING count(*) > 20)""")
def min_count_strict(spark, d):
    return filters.min_count_filter(durable(views.ratings(spark, d)), 20, 20, strict=True)


@query("filter_and_sample", f"""WITH {RATINGS}, kept AS (
  SELECT * FROM ratings
  WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) > 20)
    AND parent_asin IN (SELECT parent_asin FROM ratings GROUP BY 1 HAVING count(*) > 20))
SELECT user_id, parent_asin, rating FROM (
  SELECT *, row_number() OVER (ORDER BY {hash_key(*KEYS, seed=42)}, user_id, parent_asin, rating) AS n FROM kept)
WHERE n <= 20000""")
def filter_and_sample(spark, d):
    kept = filters.min_count_filter(durable(views.ratings(spark, d)), 20, 20, strict=True)
    return sampling.sample_exact(durable(kept), 20_000, 42, KEYS)


@query("align_meta", f"""WITH {RATINGS}, {META}, kept AS (
  SELECT * FROM ratings
  WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) >= 35)
    AND parent_asin IN (SELECT parent_asin FROM ratings GROUP BY 1 HAVING count(*) >= 35))
SELECT parent_asin, title, count(*) AS n_reviews FROM kept JOIN meta USING (parent_asin) GROUP BY ALL""")
def align_meta(spark, d):
    kept = filters.min_count_filter(durable(views.ratings(spark, d)), 35, 35)
    reviews, meta = filters.align_items(kept, views.meta(spark, d))
    return (
        reviews.groupBy("parent_asin")
        .agg(F.count(F.lit(1)).alias("n_reviews"))
        .join(meta.select("parent_asin", "title"), "parent_asin")
    )


@query("sample_exact", f"""WITH {RATINGS}
SELECT user_id, parent_asin, rating FROM (
  SELECT *, row_number() OVER (ORDER BY {hash_key(*KEYS, seed=7)}, user_id, parent_asin, rating) AS n FROM ratings)
WHERE n <= 10000""")
def sample_exact(spark, d):
    return sampling.sample_exact(views.ratings(spark, d), 10_000, 7, KEYS)


@query("split_holdout", f"""WITH {MATRIX}, {holdout('matrix', 0.2, 19, ('user_id', 'parent_asin'))}
SELECT user_id, parent_asin, is_test FROM marked""")
def split_holdout(spark, d):
    return sampling.split_holdout(durable(views.matrix(spark, d)), 0.2, 19).select("user_id", "parent_asin", "is_test")


@query("kfold_assign", f"""WITH {MATRIX}
SELECT user_id, parent_asin, CAST({hash_number(hash_key('user_id', 'parent_asin', seed=42))} % 3 AS INTEGER) AS fold
FROM matrix""")
def kfold_assign(spark, d):
    return sampling.assign_folds(views.matrix(spark, d)).select("user_id", "parent_asin", "fold")


_RAW_COLUMNS = (("user_id", "string"), ("parent_asin", "string"), ("rating", "string"), ("helpful_vote", "int"))


@query("null_profile", """WITH raw AS (
  SELECT CASE WHEN l_tax > 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id, CAST(l_partkey AS VARCHAR) AS parent_asin,
         'x' AS rating, CAST(trunc(l_quantity) AS INTEGER) AS helpful_vote
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) - count({c}) AS nulls, count(*) AS n_rows FROM raw"
    for c, t in _RAW_COLUMNS
))
def null_profile(spark, d):
    return profile.null_profile(views.raw_reviews(spark, d))


@query("rating_describe", f"""WITH {RATINGS}
SELECT count(*) AS "count", round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS std, min(rating) AS "min",
       quantile_cont(rating, 0.25) AS p25, quantile_cont(rating, 0.5) AS p50, quantile_cont(rating, 0.75) AS p75,
       max(rating) AS "max" FROM ratings""")
def rating_describe(spark, d):
    out = profile.describe_column(views.ratings(spark, d), "rating")
    return out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query("sparsity", f"""WITH {RATINGS}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT parent_asin) AS n_items,
       round(1.0 - count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT parent_asin)), 8) AS sparsity
FROM ratings""")
def sparsity(spark, d):
    return profile.sparsity(views.ratings(spark, d)).withColumn("sparsity", F.round("sparsity", 8))


@query("reviews_per_user", f"WITH {RATINGS} SELECT user_id, count(*) AS n_reviews FROM ratings GROUP BY 1")
def reviews_per_user(spark, d):
    return profile.reviews_per(views.ratings(spark, d), "user_id")


@query("reviews_per_item", f"WITH {RATINGS} SELECT parent_asin, count(*) AS n_reviews FROM ratings GROUP BY 1")
def reviews_per_item(spark, d):
    return profile.reviews_per(views.ratings(spark, d), "parent_asin")


@query("mean_reviews", f"""WITH {RATINGS}
SELECT 'user_id' AS "key", round(count(*) / count(DISTINCT user_id), 6) AS mean_reviews FROM ratings
UNION ALL SELECT 'parent_asin', round(count(*) / count(DISTINCT parent_asin), 6) FROM ratings""")
def mean_reviews(spark, d):
    return profile.mean_reviews(views.ratings(spark, d)).withColumn("mean_reviews", F.round("mean_reviews", 6))


@query("count_of_counts", f"""WITH {RATINGS}
SELECT n_reviews, count(*) AS n_keys FROM (SELECT count(*) AS n_reviews FROM ratings GROUP BY user_id) GROUP BY 1""")
def count_of_counts(spark, d):
    return profile.count_of_counts(views.ratings(spark, d), "user_id")


@query("count_of_counts_items", f"""WITH {RATINGS}
SELECT n_reviews, count(*) AS n_keys FROM (SELECT count(*) AS n_reviews FROM ratings GROUP BY parent_asin) GROUP BY 1""")
def count_of_counts_items(spark, d):
    return profile.count_of_counts(views.ratings(spark, d), "parent_asin")


@query("rating_histogram", f"""WITH {RATINGS}, s AS (SELECT min(rating) AS lo, max(rating) AS hi FROM ratings),
c AS (SELECT CAST(least(9, floor((rating - lo) / (hi - lo) * 10)) AS INTEGER) AS bin, count(*) AS n
      FROM ratings, s GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * (hi - lo) / 10, 6) AS low, round(lo + (b + 1) * (hi - lo) / 10, 6) AS high,
       coalesce(n, 0) AS n
FROM range(10) t(b) CROSS JOIN s LEFT JOIN c ON c.bin = b""")
def rating_histogram(spark, d):
    out = profile.histogram(views.ratings(spark, d), "rating")
    return out.withColumn("low", F.round("low", 6)).withColumn("high", F.round("high", 6))


@query("votes_by_image", f"""WITH {REVIEWS}
SELECT has_image, round(avg(helpful_vote), 6) AS mean_votes FROM reviews GROUP BY 1""")
def votes_by_image(spark, d):
    return profile.votes_by_image(views.reviews(spark, d)).withColumn("mean_votes", F.round("mean_votes", 6))


@query("votes_p99", f"WITH {REVIEWS} SELECT round(quantile_cont(helpful_vote, 0.99), 6) AS value FROM reviews")
def votes_p99(spark, d):
    return profile.quantile(views.reviews(spark, d), "helpful_vote", 0.99).withColumn("value", F.round("value", 6))


@query("global_mean", f"WITH {RATINGS} SELECT round(avg(rating), 8) AS global_mean FROM ratings")
def global_mean(spark, d):
    return profile.global_mean(views.ratings(spark, d)).withColumn("global_mean", F.round("global_mean", 8))


def _sketches(spark, d):
    """Sketches of five parts of the reviews, one of them written twice, and the reviews."""
    reviews, path = durable(views.reviews(spark, d).drop("images")), f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("user_id", "parent_asin"), F.lit(5))
    for n in (0, 1, 2, 3, 4, 2):
        held = sketches.sketch_part(reviews.where(part == n), f"part{n}", values=("rating", "helpful_vote"))
        sketches.save_sketch(held, path)
    return reviews, sketches.merge_sketches(sketches.load_sketches(spark, path), values=("rating", "helpful_vote"))


@query("sketch_sparsity", f"""WITH {RATINGS}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT parent_asin) AS n_items,
       true AS users_close, true AS items_close FROM ratings""")
def sketch_sparsity(spark, d):
    """The exact counts, and whether the merged sketches of the parts come as close as promised."""
    reviews, merged = _sketches(spark, d)
    guess = sketches.approximate_sparsity(merged).select(F.col("n_ratings"), F.col("n_users").alias("u"), F.col("n_items").alias("i"))
    bound = 4 * sketches.distinct_error()
    close = lambda a, b: F.abs(F.col(a) / F.col(b) - 1) <= bound
    exact = profile.sparsity(reviews).select(F.struct("n_users", "n_items"))
    return guess.withColumn("e", exact.scalar()).select(
        "n_ratings", F.col("e.n_users").alias("n_users"), F.col("e.n_items").alias("n_items"),
        close("u", "e.n_users").alias("users_close"), close("i", "e.n_items").alias("items_close"),
    )


_SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("sketch_quantiles", f"""WITH {REVIEWS}
SELECT CAST(p AS DOUBLE) AS p, count(*) AS n, round(quantile_cont(helpful_vote, 0.5), 6) AS median, true AS within
FROM reviews, (SELECT unnest([{', '.join(map(str, _SHARES))}]) AS p) GROUP BY p""")
def sketch_quantiles(spark, d):
    """Whether the ranks of the estimated quantiles are within the promised error; the exact median beside them."""
    reviews, merged = _sketches(spark, d)
    guess = sketches.approximate_quantiles(merged, "helpful_vote", _SHARES)
    counts = durable(reviews.groupBy("helpful_vote").agg(F.count(F.lit(1)).alias("c")))
    total = counts.agg(F.sum("c"))
    # the five estimates travel as one array
    asked = counts.withColumn("g", guess.agg(F.collect_list(F.struct("p", "value"))).scalar()).select("helpful_vote", "c", F.inline("g"))
    ranks = asked.groupBy("p").agg(
        F.sum(F.when(F.col("helpful_vote") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("helpful_vote") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"),
    )
    slack = sketches.rank_error() * F.col("n")
    return (
        ranks.withColumn("n", total.scalar())
        .withColumn("median", profile.quantile(reviews, "helpful_vote", 0.5).scalar())
        .select("p", "n", F.round("median", 6).alias("median"), ((F.col("below") - slack <= F.col("p") * F.col("n")) & (F.col("p") * F.col("n") <= F.col("upto") + slack)).alias("within"))
    )


_NUMERIC = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CORRELATED)


def _matrix_sql(pair_sql) -> str:
    """All ordered pairs of columns; ``pair_sql`` gives the value of one pair."""
    rows = [
        f"SELECT '{a}' AS col_x, '{b}' AS col_y, {'1.0' if a == b else f'round(({pair_sql(a, b)}), 6)'}::DOUBLE AS corr"
        for a in CORRELATED
        for b in CORRELATED
    ]
    return f"WITH {REVIEWS}, t AS (SELECT {_NUMERIC} FROM reviews)" + "{extra}\n" + "\nUNION ALL ".join(rows)


def _numeric_reviews(spark, d):
    reviews = profile.with_image_columns(views.reviews(spark, d))
    return reviews.select(*[F.col(c).cast("int").alias(c) for c in CORRELATED])


def _rounded(table):
    return table.withColumn("corr", F.round("corr", 6))


@query("corr_pearson", _matrix_sql(lambda a, b: f"SELECT corr({a}, {b}) FROM t").format(extra=""))
def corr_pearson(spark, d):
    return _rounded(correlation.pearson_matrix(_numeric_reviews(spark, d), CORRELATED))


_RANKS = ", r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in CORRELATED
) + " FROM t)"


@query("corr_spearman", _matrix_sql(lambda a, b: f"SELECT corr({a}, {b}) FROM r").format(extra=_RANKS))
def corr_spearman(spark, d):
    return _rounded(correlation.spearman_matrix(_numeric_reviews(spark, d), CORRELATED))


def _kendall_sql(a: str, b: str) -> str:
    cells = f"(SELECT {a} AS x, {b} AS y, CAST(count(*) AS DOUBLE) AS c FROM t GROUP BY 1, 2)"
    ties = lambda c: f"(SELECT sum(c * (c - 1) / 2) FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM t GROUP BY {c}))"
    total = "(SELECT CAST(count(*) AS DOUBLE) * (count(*) - 1) / 2 FROM t)"
    return f"""SELECT sum(p.c * q.c * sign(p.x - q.x) * sign(p.y - q.y)) / 2
  / sqrt(({total} - {ties(a)}) * ({total} - {ties(b)})) FROM {cells} p, {cells} q"""


@query("corr_kendall", _matrix_sql(_kendall_sql).format(extra=""))
def corr_kendall(spark, d):
    return _rounded(correlation.kendall_matrix(_numeric_reviews(spark, d), CORRELATED))
