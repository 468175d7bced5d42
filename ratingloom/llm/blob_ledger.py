"""Secret scans over an incremental blob ledger.

Every version of every file is a blob named by the SHA-256 of its text. The ledger holds which
(blob, rule, rule version) triples were scanned and what was found. A scan reads only blobs with
a triple the ledger lacks, each of them once however many paths hold it, and appends to the
ledger; findings are then joined back to all paths.

The ledger is two Parquet folders. Findings are written before the triples they belong to, so a
job that dies in between leaves triples that are scanned again and findings that are the same
again; readers drop such repeats.

Null texts count as empty; rows with equal key and text share their findings and each get a row;
null keys are a key like any other. Columns other than key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.llm.common import slices

# fixed values: the base patterns, in the order in which kinds are listed
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX_MIN, ACCESS_MIN, ASSIGN_MIN = 24, 20, 6
HEX = re.compile(rb"h{24,}")
HEX_TABLE = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))

Find = Callable[[bytes], list[tuple[int, int]]]


def find_assign(text: bytes) -> list[tuple[int, int]]:
    if b"=" not in text and b":" not in text:
        return []
    return [m.span() for m in ASSIGN.finditer(text.lower()) if m.end(2) - m.start(2) >= ASSIGN_MIN]


def find_access(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]


def find_hex(text: bytes) -> list[tuple[int, int]]:
    marks = text.translate(HEX_TABLE)
    return [m.span() for m in HEX.finditer(marks)] if b"h" * HEX_MIN in marks else []


@dataclass(frozen=True)
class Rule:
    """A named pattern; raise ``version`` when it changes and every blob is scanned for it anew."""

    name: str
    version: int
    find: Find


RULES = (Rule("assign", 1, find_assign), Rule("access", 1, find_access), Rule("hex", 1, find_hex))
SCANNED = "blob string, rule string, version int"
FINDINGS = "blob string, rule string, version int, start long, end long"


def one_byte_each(text: str) -> bytes:
    """One byte per code point: the patterns are ASCII, so any other character may become a question mark."""
    return text.encode("ascii", "replace")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def scan_new_blobs(files: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> None:
    """Scans what the ledger lacks and appends it; ``ledger`` is a folder that all executors reach."""
    spark = files.sparkSession
    versions = files.select(
        F.coalesce(files[key].cast("string"), F.lit("")).alias("path"), F.coalesce(files[text], F.lit("")).alias("content")
    ).withColumn("blob", F.sha2("content", 256))
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    done = _read(spark, f"{ledger}/scanned", SCANNED).distinct()
    # one path stands for each blob, so that only one copy of its text is read further
    unseen = (
        versions.groupBy("blob").agg(F.min("path").alias("path"))
        .select("blob", "path", F.explode(wanted).alias("r")).select("blob", "path", "r.*")
        .join(done, ["blob", "rule", "version"], "left_anti")
        .groupBy("blob", "path").agg(F.collect_list("rule").alias("rules"))
    )
    texts = versions.join(unseen, ["blob", "path"]).select("blob", "content", "rules")
    by_name = {r.name: r for r in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            out: list[tuple] = []
            for blob, content, names in zip(*(piece.column(n).to_pylist() for n in range(3))):
                flat = one_byte_each(content)
                for name in names:
                    rule = by_name[name]
                    # a row without place says that the triple was scanned
                    out.append((blob, name, rule.version, None, None))
                    out += [(blob, name, rule.version, s, e) for s, e in rule.find(flat)]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["blob", "rule", "version", "start", "end"])

    from ratingloom.session import durable

    scan = durable(texts.mapInArrow(run, FINDINGS))  # one scan, written to both folders
    scan.filter("start is not null").write.mode("append").parquet(f"{ledger}/findings")
    scan.filter("start is null").select("blob", "rule", "version").write.mode("append").parquet(f"{ledger}/scanned")


def findings_by_path(files: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``files``: key, blob, one count per rule, digest and list of the spans."""
    spark = files.sparkSession
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.name), F.lit(n))])
    now = spark.createDataFrame([(r.name, r.version) for r in rules], "rule string, version int")
    found = _read(spark, f"{ledger}/findings", FINDINGS).distinct().join(F.broadcast(now), ["rule", "version"])
    per_blob = found.groupBy("blob").agg(
        *[F.count(F.when(F.col("rule") == r.name, 1)).alias(f"n_{r.name}") for r in rules],
        F.array_sort(F.collect_list(F.struct("start", order[F.col("rule")].alias("place"), "rule", "end"))).alias("all"),
    )
    spans = F.array_join(F.transform("all", lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")
    per_blob = per_blob.select("blob", *[f"n_{r.name}" for r in rules], spans.alias("spans"))
    paths = files.select(files[key].alias(key), F.sha2(F.coalesce(files[text], F.lit("")), 256).alias("blob"))
    joined = paths.join(per_blob, "blob", "left")
    spans = F.coalesce("spans", F.lit(""))
    return joined.select(
        key,
        "blob",
        *[F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in rules],
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def scan_secrets(files: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Brings the ledger up to date with ``files`` and returns the findings of all their paths."""
    scan_new_blobs(files, ledger, rules, key, text)
    return findings_by_path(files, ledger, rules, key, text)
