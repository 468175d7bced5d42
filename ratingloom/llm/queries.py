"""The queries of this subpackage and, where SQL can say it, the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm import (
    blob_ledger,
    compression_bands,
    decontamination,
    dom_extraction,
    filter_audit,
    interval_repeats,
    minmax_dedup,
    ordinal_toxicity,
    personal_data,
    prefix_viterbi,
    tier_packing,
    warc_chain,
    word_runs,
)
from ratingloom.llm.common import documents, pages
from ratingloom.session import shared_folder

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_compression_bands")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.compression_bands(documents(spark, sf_dir))


@query("op2_semi_markov_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return personal_data.find_personal_data(docs, personal_data.fit(docs))


def _secrets_sql(kind: str, place: int, pattern: str, measured: int, least: int) -> str:
    """All matches of one kind: the text before each and the match itself give the places; ``measured`` is the group whose length counts."""
    all_of = lambda group: f"regexp_extract_all(t, '(?s)(.*?)({pattern})', {group})"
    return f"SELECT doc_id, '{kind}' AS kind, {place} AS place, {least} AS least, {all_of(1)} AS b, {all_of(2)} AS m, {all_of(measured)} AS v FROM d"


_ASSIGN = """(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  {_secrets_sql('assign', 0, _ASSIGN, 3, 6)}
  UNION ALL {_secrets_sql('access', 1, 'AKIA[A-Z0-9]+', 2, 20)}
  UNION ALL {_secrets_sql('hex', 2, '[0-9a-f]+', 2, 24)}
), each AS (
  SELECT doc_id, kind, place, least, unnest(b) AS b, unnest(m) AS m, unnest(v) AS v, generate_subscripts(m, 1) AS n FROM found
), spans AS (
  SELECT doc_id, kind, place, length(v) >= least AS counts, length(m) AS size,
    sum(length(b) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY n) AS e FROM each
), told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(e - size AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - size, place) AS spans
  FROM spans WHERE counts GROUP BY doc_id
)
SELECT doc_id, sha256(t) AS blob, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""


@query("op3_blob_ledger", SECRETS_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.scan_secrets(documents(spark, sf_dir), f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")


CONTAMINATION_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size)
), hits AS (
  SELECT DISTINCT p.doc_id, p.i, p.size, k.item_id FROM places p JOIN windows k USING (win, size)
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op5_aho_corasick_decontamination", CONTAMINATION_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_contamination(documents(spark, sf_dir), items).drop("hit_spans")


@query("op8_prefix_viterbi")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_viterbi.encode_texts(documents(spark, sf_dir))


@query("op9_ordinal_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = ordinal_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal_toxicity.score_toxicity(docs, model)


NEAR_DUPLICATES_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), classes AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY sig, n) AS first
  FROM (SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(1) ORDER BY s)) AS sig FROM shingles GROUP BY doc_id)
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  WHERE x.doc_id IN (SELECT first FROM classes) AND y.doc_id IN (SELECT first FROM classes)
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
  UNION SELECT first, doc_id FROM classes WHERE first <> doc_id
), ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, e.b FROM reach r JOIN ends e ON e.a = r.seen
), roots AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents JOIN roots ON node = doc_id LEFT JOIN sizes USING (doc_id)
"""


@query("op6_minmax_dedup", NEAR_DUPLICATES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(documents(spark, sf_dir)).drop("class_id")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS last FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to,
  true AS verified
FROM b
"""


@query("op4_warc_boundary_chain", WARC_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chain.round_trip(pages(spark, sf_dir), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")


@query("op10_dom_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pages(spark, sf_dir)
    return dom_extraction.extract(table, dom_extraction.fit(table))


@query("op7_interval_repeats")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval_repeats.remove_repeats(documents(spark, sf_dir)).drop("removed")


AUDIT_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t
), said AS (SELECT doc_id, max(quality) AS q, max(toxic) AS x FROM labels GROUP BY doc_id
), flags AS (
  SELECT d.part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN d.doc_id > first THEN 'E' ELSE '' END AS fails,
    coalesce(q = 1, false) AS good, coalesce(x = 1, false) AS bad
  FROM d JOIN firsts USING (t) LEFT JOIN said ON said.doc_id = d.doc_id
), masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE bad) AS x FROM flags GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), grown AS (
  SELECT '' AS filter_order UNION ALL SELECT filter_order || letter FROM grown, letters WHERE NOT contains(filter_order, letter)
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM grown, unnest(range(1, 6)) AS s(step) WHERE length(filter_order) = 5
), placed AS (
  SELECT part, filter_order, step, f, fails, n, g, x, contains(fails, f) AS own, regexp_matches(fails, '[' || earlier || '-]') AS gone
  FROM masks, steps
), counted AS (
  SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (WHERE NOT own AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE own AND NOT gone), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (WHERE own AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE fails = f), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(g) FILTER (WHERE own AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(x) FILTER (WHERE own AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op12_tier_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing.pack_documents(documents(spark, sf_dir))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digests(word_runs.find_runs(documents(spark, sf_dir), prepare=word_runs.planted))
