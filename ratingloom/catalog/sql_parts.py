"""Common table expressions shared by the checking SQL."""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS parent_asin,
         CAST(CAST(round(l_discount * 100) AS INTEGER) % 5 + 1 AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MATRIX = (
    RATINGS
    + """,
matrix AS (
  SELECT user_id, parent_asin, avg(rating) AS rating FROM ratings GROUP BY user_id, parent_asin)"""
)

REVIEWS = """reviews AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS parent_asin,
         CAST(CAST(round(l_discount * 100) AS INTEGER) % 5 + 1 AS DOUBLE) AS rating,
         CAST(trunc(l_quantity) AS INTEGER) AS helpful_vote, l_linestatus = 'F' AS verified_purchase,
         CAST(l_linenumber % 4 AS INTEGER) AS num_images, l_linenumber % 4 >= 1 AS has_image
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

META = """meta AS (
  SELECT CAST(p_partkey AS VARCHAR) AS parent_asin, p_name AS title, p_type || ' ' || p_brand AS description,
         p_brand AS author, p_type AS categories, '$' || CAST(p_retailprice AS VARCHAR) AS price
  FROM part)"""

EMB = """emb AS (
  SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(embedding AS DOUBLE[]) AS v, label AS cluster FROM embeddings)"""


def hash_key(*columns: str, seed: int) -> str:
    return f"md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)}, '{seed}'))"


def hash_number(digest: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr({digest}, 1, {digits}) AS BIGINT)"


def neighbors(k: int, metric: str = "cosine", keep: str = "true") -> str:
    """``nn``: the k nearest other items of every item for which ``keep`` holds."""
    if metric == "cosine":
        sim = (
            "list_inner_product(a.v, b.v)"
            " / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v)))"
        )
    else:
        sim = "1.0 / (1.0 + list_distance(a.v, b.v))"
    return f"""{EMB},
nn AS (
  SELECT item, neighbor, CAST(rank AS INTEGER) AS rank, sim FROM (
    SELECT item, neighbor, sim, row_number() OVER (PARTITION BY item ORDER BY sim DESC, neighbor) AS rank
    FROM (SELECT a.item_id AS item, b.item_id AS neighbor, round({sim}, 6) AS sim
          FROM (SELECT * FROM emb WHERE {keep}) a JOIN (SELECT * FROM emb WHERE {keep}) b ON a.item_id <> b.item_id))
  WHERE rank <= {k})"""


SIMILARITY = {
    "cosine": "CASE WHEN sqrt(sxx * syy) > 0 THEN sxy / sqrt(sxx * syy) ELSE 0.0 END",
    "pearson": """CASE WHEN sqrt(greatest(n * sxx - sx * sx, 0.0) * greatest(n * syy - sy * sy, 0.0)) > 1e-6
            AND abs(n * sxy - sx * sy) > 1e-6
       THEN (n * sxy - sx * sy) / sqrt(greatest(n * sxx - sx * sx, 0.0) * greatest(n * syy - sy * sy, 0.0))
       ELSE 0.0 END""",
    "msd": "1.0 / ((sxx - 2 * sxy + syy) / n + 1.0)",
}


def pair_sums(source: str = "matrix", by_user: bool = True, name: str = "sums", within: str = "") -> str:
    """``sums``: per pair of users (or items) the sums over their common ratings."""
    entity, shared = ("user_id", "parent_asin") if by_user else ("parent_asin", "user_id")
    extra = f"x.{within}, " if within else ""
    same = f" AND x.{within} = y.{within}" if within else ""
    group = f"x.{within}, " if within else ""
    return f"""{name} AS (
  SELECT {extra}x.{entity} AS a, y.{entity} AS b, count(*) AS n, sum(x.rating) AS sx, sum(y.rating) AS sy,
         sum(x.rating * y.rating) AS sxy, sum(x.rating * x.rating) AS sxx, sum(y.rating * y.rating) AS syy
  FROM {source} x JOIN {source} y ON x.{shared} = y.{shared} AND x.{entity} < y.{entity}{same}
  GROUP BY {group}x.{entity}, y.{entity})"""


def similarities(measure: str, min_support: int, sums: str = "sums", name: str = "sims") -> str:
    return f"""{name} AS (
  SELECT a, b, n, {SIMILARITY[measure]} AS sim FROM {sums} WHERE n >= {min_support})"""


def mirrored(sims: str = "sims", name: str = "both_ways") -> str:
    return f"""{name} AS (
  SELECT a AS e, b AS o, sim FROM {sims} WHERE sim > 0 UNION ALL
  SELECT b AS e, a AS o, sim FROM {sims} WHERE sim > 0)"""


def holdout(source: str, test_size: float, seed: int, keys: tuple[str, ...], name: str = "marked") -> str:
    """``marked``: the rows of a table with ``is_test`` for the first ceil(share * rows) in hash order."""
    digest = hash_key(*keys, seed=seed)
    return f"""{name} AS (
  SELECT user_id, parent_asin, rating,
         row_number() OVER (ORDER BY {digest}, user_id, parent_asin, rating)
           <= ceil(round(count(*) OVER () * {test_size}, 6)) AS is_test
  FROM {source})"""
