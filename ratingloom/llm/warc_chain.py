"""WARC archives: writing, and reading back by boundary-chain verification.

Writing. Pages with equal payloads of at least ``min_bytes`` bytes become one response record, for
the largest page_id, and revisit records that refer to it. Spark's text writer puts the record
terminator behind each row, so the archives are ordinary WARC files, written with Spark's commit.

Reading. Files are split at the record magic ``WARC/1.0`` wherever it stands, in payloads too, so
a task reads only its stretch of a file and no file is ever one row. A task emits, for each
candidate, the offset of the successor its header promises, already shortened to where the chain
leaves the stretch. Pointer jumping from offset 0 of each file (the steps double, so the rounds
grow with the logarithm of the stretches of a file) finds where the true chain enters each
stretch, and an interval test on the tree of candidates keeps the records on it. A magic inside a
payload is never reached. Only lengths, offsets and digests are shuffled, no payload.

Null html counts as empty. Rows that repeat a page_id with equal payload are both responses; a
null page_id is written as an empty name and read back as null. Line ends in urls are escaped.
Extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratingloom.llm.common import slices
from ratingloom.session import durable

# fixed values of the format
MAGIC = "WARC/1.0\r\n"
HEADER_END = b"\r\n\r\n"
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 0
NESTED = 8  # payloads hashed at a time in one stretch
REGION = 1 << 20  # bytes by which pieces and records meet when records are read again
DATE = "1970-01-01T00:00:00Z"


def base32_of_hex(hexed: Column) -> Column:
    """Base 32 of a SHA-1 in hexadecimal: five hexadecimal digits make four characters."""
    letters = []
    for n in range(8):
        bits = F.conv(F.substring(hexed, 5 * n + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Writes one record per row of ``pages`` (page_id, url, html)."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("id"), pages["url"].alias("url"), F.coalesce(pages["html"], F.lit("")).alias("html")
    ).withColumn("digest", F.sha1("html"))
    large = rows.filter(F.octet_length("html") >= min_bytes).select("id", "digest")
    last = durable(large.groupBy("digest").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    # only the repeated pages: with few of them this table is broadcast and no html is shuffled
    repeats = durable(large.join(last, "digest").filter("not id <=> response").distinct())
    told = rows.join(repeats, rows["digest"].eqNullSafe(repeats["digest"]) & rows["id"].eqNullSafe(repeats["id"]), "left").select(
        rows["id"], "url", "html", rows["digest"], "response"
    )
    revisit = F.col("response").isNotNull()
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("digest")))),
        line("X-Payload-Length", F.octet_length("html").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("response"))))).otherwise(""),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    told.select(F.concat(head, block).alias("value")).write.option("lineSep", RECORD_END).text(path)


def _header(raw: bytes) -> dict[str, str]:
    fields = {}
    for line in raw.split(b"\r\n"):
        key, _, value = line.partition(b":")
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


class _Payload:
    """Length and digest of a record's payload: what follows the inner header of a block of ``length`` bytes."""

    def __init__(self, place: int, length: int):
        self.place, self.left = place, length
        self.head: bytes | None = b""  # until the inner header has ended
        self.size, self.digest = 0, hashlib.sha1()

    def add(self, piece: bytes) -> None:
        piece = piece[: max(0, self.left)]
        self.left -= len(piece)
        if self.head is not None:
            self.head += piece
            end = self.head.find(HEADER_END)
            if end < 0:
                return
            piece, self.head = self.head[end + len(HEADER_END) :], None
        self.size += len(piece)
        self.digest.update(piece)

    def result(self) -> list:
        return [self.size, base64.b32encode(self.digest.digest()).decode()]


class _Stretch:
    """The candidates of one stretch of a file, in order of their offsets.

    Payloads that go on after a magic are hashed as their bytes come, at most NESTED of them at a time:
    of candidates nested deeper most are bytes of a payload and no records. The few that are records
    are read again later, like those that reach into the next stretch.
    """

    def __init__(self, file: str, block: int):
        self.file, self.block = file, block
        self.size = 0  # bytes of the pieces so far, from the first piece of the stretch
        self.found: list[list] = []
        self.open: list[_Payload] = []
        self.first = block == 0  # what stands before the first magic of a file is no candidate

    def add(self, piece: bytes) -> None:
        for payload in self.open:
            payload.add(MAGIC.encode())
            payload.add(piece)
        start, self.size = self.size - len(MAGIC), self.size + len(piece) + len(MAGIC)
        if self.first:
            self.first = False
        else:
            self._candidate(start, piece)
        if any(payload.left <= 0 for payload in self.open):
            for payload in self.open:
                if payload.left <= 0:
                    self.found[payload.place][7:9] = payload.result()
            self.open = [payload for payload in self.open if payload.left > 0]

    def _candidate(self, start: int, piece: bytes) -> None:
        end = piece.find(HEADER_END)
        if end < 0:
            return  # no whole header before the next magic: not a record
        fields = _header(piece[:end])
        length = fields.get("content-length", "")
        if not (length.isascii() and length.isdigit() and len(length) < 16):
            return
        length, body = int(length), end + len(HEADER_END)
        after = start + len(MAGIC) + body + length + len(RECORD_END)
        known = fields.get("x-payload-length", "")
        self.found.append([
            start, after, _page(fields.get("warc-record-id")), fields.get("warc-type"), _page(fields.get("warc-refers-to")),
            fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(known) if known.isascii() and known.isdigit() and len(known) < 16 else None,
            None, None, start + len(MAGIC) + body, length,
        ])
        if len(self.open) < NESTED or len(piece) - body >= length:
            payload = _Payload(len(self.found) - 1, length)
            payload.add(piece[body:])
            self.open.append(payload)

    def rows(self) -> Iterator[tuple]:
        """(file, block, size, ..., exit, first, last): a row without start holds the size alone."""
        yield (self.file, self.block, self.size, *([None] * 14))
        at = {c[0]: n for n, c in enumerate(self.found)}
        children: list[list[int]] = [[] for _ in self.found]
        exits = [c[1] for c in self.found]
        roots = []
        for n in range(len(self.found) - 1, -1, -1):  # successors lie behind, so their exits are known
            to = at.get(self.found[n][1])
            if to is None:
                roots.append(n)
            else:
                exits[n] = exits[to]
                children[to].append(n)
        first, last, clock = [0] * len(exits), [0] * len(exits), 0
        for root in roots:  # intervals of a depth-first walk: a candidate is on the chain of all those inside its interval
            todo = [(root, False)]
            while todo:
                n, done = todo.pop()
                if done:
                    last[n] = clock
                    continue
                first[n], clock = clock, clock + 1
                todo.append((n, True))
                todo += [(c, False) for c in children[n]]
        for n, c in enumerate(self.found):
            yield (self.file, self.block, None, *c, exits[n], first[n], last[n])


CANDIDATES = (
    "file string, block long, size long, start long, after long, page_id long, type string, refers long, digest string, told_bytes long, "
    "payload_bytes long, payload_digest string, body long, length long, exit long, first long, last long"
)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in CANDIDATES.split(","))])
    stretch = None

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for piece in slices(batches):
        for value, file, block in zip(*(piece.column(n).to_pylist() for n in range(3))):
            if stretch is None or (file, block) != (stretch.file, stretch.block):
                if stretch is not None:
                    yield batch(list(stretch.rows()))
                stretch = _Stretch(file, block)
            stretch.add(value)
    if stretch is not None:
        yield batch(list(stretch.rows()))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per true record: page_id, payload_bytes, payload_digest, record_type, refers_to, verified."""
    pieces = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    seen = durable(pieces.mapInArrow(_candidates, CANDIDATES))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = seen.filter("start is null").select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    found = seen.filter("start is not null").join(bases, ["file", "block"])
    for c in ("start", "after", "exit", "body"):
        found = found.withColumn(c, F.col(c) + F.col("base"))
    found = durable(found.drop("base", "size"))

    # pointer jumping over the points where chains enter a stretch
    entries = found.select("file", F.col("exit").alias("start")).distinct()
    jumps = durable(
        found.join(entries.withColumn("target", F.lit(True)), ["file", "start"], "left")
        .filter("target or start = 0")
        .select("file", "start", F.col("exit").alias("to"))
    )
    reached = jumps.filter("start = 0").select("file", "start")
    count = 0
    while True:
        ahead = reached.join(jumps, ["file", "start"]).select("file", F.col("to").alias("start"))
        reached = durable(reached.union(ahead).distinct())
        now = reached.count()
        if now == count:
            break
        count = now
        second = jumps.select("file", F.col("start").alias("to"), F.col("to").alias("farther"))
        jumps = durable(jumps.join(second, ["file", "to"]).select("file", "start", F.col("farther").alias("to")))

    entry = found.join(reached, ["file", "start"]).select("file", "block", F.col("first").alias("at"))
    records = found.join(entry, ["file", "block"]).filter("first <= at and at < last")
    whole = records.filter("payload_digest is not null").select("page_id", "type", "refers", "digest", "told_bytes", "payload_bytes", "payload_digest")
    torn = durable(records.filter("payload_digest is null").select("file", "body", "length", "page_id", "type", "refers", "digest", "told_bytes"))
    if not torn.isEmpty():
        whole = whole.union(_torn_records(pieces, durable(bases), torn))
    revisit = F.col("type") == "revisit"
    return whole.select(
        "page_id",
        F.when(revisit, F.col("told_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("refers")).alias("refers_to"),
        (revisit | (F.col("digest") == F.col("payload_digest"))).alias("verified"),
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, offset in the stretch, value) of every piece, the magic before it included."""
    stretch, size = None, 0
    for piece in slices(batches):
        offsets, values = [], piece.column(0).to_pylist()
        for value, file, block in zip(values, piece.column(1).to_pylist(), piece.column(2).to_pylist()):
            if (file, block) != stretch:
                stretch, size = (file, block), 0
            offsets.append(size)
            size += len(value) + len(MAGIC)
        ends = pa.array([v + MAGIC.encode() for v in values], pa.binary())  # the magic that ended the piece
        yield pa.RecordBatch.from_arrays([piece.column(1), piece.column(2), pa.array(offsets, pa.int64()), ends], names=["file", "block", "at", "value"])


def _torn_records(pieces: DataFrame, bases: DataFrame, torn: DataFrame) -> DataFrame:
    """Records whose payload no stretch hashed: their bytes come from the pieces that overlap them.

    Pieces and records meet by regions of the file. The parts of a record are sorted by offset and
    hashed as they come, so neither a file nor a record is ever one row.
    """
    told = ["page_id", "type", "refers", "digest", "told_bytes"]
    regions = lambda first, last: F.explode(F.sequence(F.floor(first / REGION), F.floor(last / REGION)))
    records = torn.withColumn("region", regions(F.col("body"), F.col("body") + F.col("length")))
    laid = pieces.mapInArrow(_placed, "file string, block long, at long, value binary").join(F.broadcast(bases), ["file", "block"])
    laid = laid.select("file", (F.col("at") + F.col("base")).alias("at"), "value")
    laid = laid.withColumn("region", regions(F.col("at"), F.col("at") + F.octet_length("value")))
    begin = F.greatest("at", "body")
    end = F.least(F.col("at") + F.octet_length("value"), F.col("body") + F.col("length"))
    part = F.substring("value", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int"))
    parts = (
        laid.join(records, ["file", "region"])
        .where(end > begin)
        .where(F.col("region") == F.floor(begin / REGION))  # each overlap once
        .select("file", "body", "length", begin.alias("at"), part.alias("part"), *told)
        .repartition("file", "body")
        .sortWithinPartitions("file", "body", "at")
    )
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [*told, "payload_bytes", "payload_digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, payload, kept = None, None, ()
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([*kept, *payload.result()], kinds)], names=names)
        for piece in slices(batches, 16):
            columns = [piece.column(n).to_pylist() for n in range(10)]
            for file, body, length, _, data, *rest in zip(*columns):
                if (file, body) != record:
                    if record is not None:
                        yield batch()
                    record, payload, kept = (file, body), _Payload(0, length), rest
                payload.add(data)
        if record is not None:
            yield batch()

    return parts.mapInArrow(run, "page_id long, type string, refers long, digest string, told_bytes long, payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the pages to ``path`` and reads their records back."""
    write_archives(pages, path, min_bytes)
    return read_archives(pages.sparkSession, path)
