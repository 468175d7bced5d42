"""Packing: tokenised documents cut into sequences of several context sizes with hardly any padding.

A document is routed to the smallest tier its tokens fit into (``TIERS``); what exceeds the
largest window fills whole windows first. Tiers are packed from long to short. A window opens with
the longest piece of its tier, its gap is filled with the longest pieces of shorter tiers that fit,
and what then remains is cut from the shortest piece that is longer. So every window is exactly
full and needs no padding. The sequences of a round are dealt to step groups of about
``STEP_TOKENS`` tokens, longest first to the lightest group, so that the groups hold equal numbers
of tokens and similar sums of squared lengths.

Each task packs the rows of its own partition in rounds of about ``ROUND_TOKENS`` tokens; nothing is
shuffled but the last window of each task, which the end of the partition left unfilled. Those are
packed again, ``TASKS_PER_REST`` tasks together, and what remains is cut into sequences of powers of two.
Packed rows are written once to the shared folder, so a lost executor repeats single tasks.

Null and empty texts hold the end token alone, so that every row has at least one piece. Rows with a
null or repeated doc_id are packed like all others; extra columns are not read; an empty table gives
an empty result. Texts are tokenised piece by piece, so a very long one costs its pieces and ids and
no more. Equal texts and ties in length are taken in the order of the rows.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ratingloom.llm.common import slices
from ratingloom.session import durable

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
TIERS = (128, 256, 512, 1_024, 2_048)
END_ID = 1
ROUND_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
TASKS_PER_REST = 64
CACHE_PIECES = 500_000
REST_SEQUENCES = 1 << 62  # sequence and group numbers of the packed rests lie above

PIECE = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, step_group long"
)


# How the tokenizer file cuts lower-cased text, for the letters of PLAIN.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\s0-9a-z\u00df-\u00f6\u00f8-\u00ff]+", re.A)
PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*", re.A)
MARK = "<|"  # special tokens of the file begin so


class Words:
    """Texts to ids, piece by piece: the tokenizer of file ``path`` never joins anything across its pieces.

    Texts of ASCII and Latin-1 letters are cut here, and the ids of recent pieces remembered; other
    words go to the tokenizer as they are. White space separates pieces, so that words can be taken one
    by one. Equal to encoding the whole text.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        pieces, known = PIECES.findall(text.lower()), self.known
        distinct = set(pieces)
        if len(known) + len(distinct) > CACHE_PIECES:
            known.clear()
        for piece in distinct:
            if piece not in known:
                if piece.isascii() and piece.isalpha():
                    known[piece] = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
                else:
                    known[piece] = self._encoded(piece)
        return b"".join(map(known.__getitem__, pieces))

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        if MARK not in text and PLAIN.fullmatch(text):
            ids = self._plain(text)
        else:
            # bytes.split() splits at ASCII white space only
            words = [w.decode() for w in text.encode().split()]
            ids = b"".join(self._plain(w) if MARK not in w and PLAIN.fullmatch(w) else self._encoded(w) for w in words)
        return np.frombuffer(ids + self.end, "<u4")


class Pool:
    """Pieces by length; finds the longest one up to a length and the shortest one above it."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.lengths = 0  # bit n: there are pieces of length n

    def add(self, piece: tuple) -> None:
        n = len(piece[2])
        self.by_length.setdefault(n, []).append(piece)
        self.lengths |= 1 << n

    def take(self, length: int) -> tuple:
        held = self.by_length[length]
        piece = held.pop()
        if not held:
            self.lengths &= ~(1 << length)
        return piece

    def longest(self, most: int) -> int:
        """The largest length up to ``most`` that occurs, 0 if none."""
        return max(0, (self.lengths & ((2 << most) - 1)).bit_length() - 1)

    def shortest(self, above: int) -> int:
        """The smallest length over ``above`` that occurs, 0 if none."""
        rest = self.lengths >> (above + 1)
        return (rest & -rest).bit_length() + above if rest else 0


def pack(pieces: Iterable[tuple], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[tuple]], list[tuple]]:
    """(full windows as lists of pieces, pieces of the last unfilled window).

    A piece is (document, start, ids); a document is whatever the caller needs to know of it.
    """
    window = tiers[-1]
    pool, full = Pool(), []
    for doc, start, ids in reversed(list(pieces)):
        whole = len(ids) // window * window
        full += [[(doc, start + n, ids[n : n + window])] for n in range(0, whole, window)]
        if whole < len(ids):
            pool.add((doc, start + whole, ids[whole:]))
    for tier in reversed(tiers):
        below = 0 if tier == tiers[0] else tier // 2
        while (length := pool.longest(tier)) > below:
            row, gap = [pool.take(length)], tier - length
            while gap:
                if fits := pool.longest(gap):
                    row.append(pool.take(fits))
                    gap -= fits
                elif longer := pool.shortest(gap):
                    doc, start, ids = pool.take(longer)
                    row.append((doc, start, ids[:gap]))
                    pool.add((doc, start + gap, ids[gap:]))
                    gap = 0
                else:  # nothing is left anywhere
                    return full, row
            full.append(row)
    return full, []


def powers_of_two(pieces: list[tuple]) -> list[list[tuple]]:
    """The pieces in sequences whose lengths are the powers of two of their sum, longest first."""
    total = sum(len(ids) for _, _, ids in pieces)
    rows, queue = [], list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        row, gap = [], 1 << bit
        while gap:
            doc, start, ids = queue.pop()
            row.append((doc, start, ids[:gap]))
            if len(ids) > gap:
                queue.append((doc, start + gap, ids[gap:]))
            gap -= min(gap, len(ids))
        rows.append(row)
    return rows


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for every sequence: longest first to the group with the fewest tokens, then squares."""
    groups = max(1, round(sum(sizes) / step_tokens))
    heap = [(0, 0, g) for g in range(groups)]
    out = [0] * len(sizes)
    for n in sorted(range(len(sizes)), key=lambda n: (-sizes[n], n)):
        tokens, squares, g = heap[0]
        out[n] = g
        heapq.heapreplace(heap, (tokens + sizes[n], squares + sizes[n] ** 2, g))
    return out


class Numbered:
    """Rows of packed sequences, numbered from ``first`` on."""

    def __init__(self, first: int):
        self.sequence = self.group = first

    def rows(self, sequences: list[list[tuple]], step_tokens: int) -> Iterator[tuple]:
        """(document, start, ids, sequence_id, offset, sequence_tokens, step_group) of every piece."""
        sizes = [sum(len(ids) for _, _, ids in row) for row in sequences]
        groups = step_groups(sizes, step_tokens)
        for row, size, group in zip(sequences, sizes, groups):
            offset = 0
            for doc, start, ids in row:
                yield doc, start, ids, self.sequence, offset, size, self.group + group
                offset += len(ids)
            self.sequence += 1
        self.group += max(groups, default=-1) + 1


def _batch(rows: list[tuple], schema: pa.Schema, with_ids: bool) -> pa.RecordBatch:
    """Rows of ``Numbered.rows``, or (document, start, ids) of pieces that are not placed yet."""
    made = []
    for (key, total), start, ids, *place in rows:
        data = ids.astype("<u4").tobytes()
        crc = zlib.crc32(data) if place else None
        made.append((key, start, len(ids), crc, total, *(place or [None] * 4), data if with_ids or not place else None))
    columns = list(zip(*made)) if made else [()] * 10
    arrays = [pa.array(columns[n], schema.field(n).type) for n in range(10)]
    if len(schema) > 10:  # the task that left the piece over
        arrays.append(pa.array([None if r[3:] else True for r in rows], pa.bool_()))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    text: str = "text",
    key: str = "doc_id",
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    round_tokens: int = ROUND_TOKENS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``key``, its place in the document and in its sequence, and the sequence's step group.

    ``sequence_tokens`` is the length of the sequence, always a power of two where the tiers are.
    ``ids`` (little-endian 32-bit numbers) comes as well if ``with_ids`` is set.
    """
    key_type = docs.schema[key].dataType.simpleString()
    packed = StructType.fromDDL(f"`{key}` {key_type}, {PIECE}, ids binary")
    placed = StructType.fromDDL(f"`{key}` {key_type}, {PIECE}, ids binary, rest boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(placed)
        encode = Words(tokenizer, end_id)
        numbered = Numbered(TaskContext.get().partitionId() << 32)
        held: list[tuple] = []
        tokens = 0

        def packed_round() -> pa.RecordBatch:
            sequences, rest = pack(held, tiers)
            held[:] = rest
            return _batch(list(numbered.rows(sequences, step_tokens)), schema, with_ids)

        for piece in slices(batches):
            keys, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            for k, text_of in zip(keys, texts):
                ids = encode(text_of)
                held.append(((k, len(ids)), 0, ids))
                tokens += len(ids)
                if tokens >= round_tokens:
                    yield packed_round()
                    tokens = sum(len(ids) for _, _, ids in held)
        yield packed_round()
        yield _batch(held, schema, with_ids)

    def pack_rests(group: tuple, table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(packed)
        ordered = table.sort_by([("task", "ascending"), ("place", "ascending")])
        columns = [ordered.column(c).to_pylist() for c in (key, "doc_tokens", "start", "ids")]
        pieces = [((k, total), start, np.frombuffer(data, "<u4")) for k, total, start, data in zip(*columns)]
        sequences, rest = pack(pieces, tiers)
        numbered = Numbered(REST_SEQUENCES + (group[0].as_py() << 32))
        rows = list(numbered.rows(sequences + powers_of_two(rest), step_tokens))
        return pa.Table.from_batches([_batch(rows, schema, with_ids)])

    rows = docs.select(F.col(key), F.col(text)).mapInArrow(run, placed)
    written = durable(rows.select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")))
    rests = written.filter("rest").select(
        key, "doc_tokens", "start", "ids", "task", "place", F.floor(F.col("task") / TASKS_PER_REST).cast("long").alias("rest_group")
    )
    out = (
        written.filter("rest IS NULL")
        .select(*[f.name for f in packed])
        .unionByName(rests.groupBy("rest_group").applyInArrow(pack_rests, packed))
    )
    return out if with_ids else out.drop("ids")
