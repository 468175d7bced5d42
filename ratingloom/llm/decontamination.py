"""Benchmark decontamination with one Aho-Corasick automaton.

Item and document texts are normalised alike: A-Z to lower case, every other ASCII character that
is not a letter or digit to a space. That keeps the length in bytes, so places in the normalised
text are places in the original one. All windows of ten words of all items form one automaton,
through which the words of each document, joined by single spaces, pass once.

The automaton is built once per task from the items, whose total size is checked against
``max_bytes``; a larger set of items is scanned in blocks of that size, one pass over the texts for
each, so that a task holds one automaton and the driver the items of one part; the hits of a text
are united by an aggregate. Null and empty texts have no words and no hits; items without words
have no window; items with equal windows are all reported, an item without id as one more item
that the digest leaves out. Extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.llm.common import map_rows, sha256_hex
from ratingloom.session import durable

WINDOW = 10
MAX_BYTES = 400_000  # of item texts in one automaton: an item byte takes about 430 bytes there (173 MB for 400 kB, measured)
TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans array<struct<start: long, end: long>>"
NO_ITEMS = sha256_hex([])


def flattened(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE)


def as_line(words: list[bytes]) -> str:
    """Words between single spaces, one character per byte, so that a match is a run of whole words."""
    return " " + b" ".join(words).decode("latin-1") + " "


def windows_of(items: Iterable[tuple[object, str | None]], width: int = WINDOW) -> dict[str, list[str | None]]:
    """Window -> ids of the items that hold it."""
    out: dict[str, set[str | None]] = {}
    for item, text in items:
        words = flattened(text).split()
        for n in range(max(1, len(words) - width + 1) if words else 0):
            out.setdefault(as_line(words[n : n + width]), set()).add(None if item is None else str(item))
    return {w: sorted(ids, key=_null_first) for w, ids in out.items()}


def _null_first(item: str | None) -> tuple[bool, str]:
    return item is not None, item or ""


def automaton_of(windows: dict[str, list[str | None]]) -> ahocorasick.Automaton | None:
    automaton = ahocorasick.Automaton()
    for window, ids in windows.items():
        automaton.add_word(window, (len(window), tuple(ids)))
    if not windows:
        return None
    automaton.make_automaton()
    return automaton


def hits_of(words: list[bytes], automaton: ahocorasick.Automaton | None) -> tuple[list[int], list[int], list[str | None]]:
    """(first words, words after, items) of what the automaton finds, runs that overlap or touch as one."""
    matches = [(end - size + 1, end, ids) for end, (size, ids) in automaton.iter(as_line(words))] if automaton and words else []
    if not matches:
        return [], [], []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    spaces = np.concatenate(([0], np.cumsum(lengths + 1)))  # place of the space before each word, and the last one
    first = np.searchsorted(spaces, [m[0] for m in matches])
    after = np.searchsorted(spaces, [m[1] for m in matches])
    starts, ends = _united(first, after, len(words))
    return starts.tolist(), ends.tolist(), sorted({i for m in matches for i in m[2]}, key=_null_first)


def _united(first: np.ndarray, after: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    cover = np.zeros(size + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, after, -1)
    hit = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def result_of(flat: bytes, words: list[bytes], first: list[int], after: list[int], items: Iterable[str | None]) -> tuple:
    """All columns of SCHEMA for one flattened text, from its hits in words."""
    if not len(first):
        return len(words), 0, 0, NO_ITEMS, False, []
    starts_of, ends_of = _united(np.array(first), np.array(after), len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(flat, np.uint8)
    inside = raw != 0x20
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
    spans = [(int(points[starts[a]]), int(points[starts[b - 1] + lengths[b - 1]])) for a, b in zip(starts_of, ends_of)]
    found = set(items)
    named = sorted(i for i in found if i is not None)
    return len(words), int((ends_of - starts_of).sum()), len(found), sha256_hex(named), True, spans


def scan_text(text: str | None, automata: list[ahocorasick.Automaton]) -> tuple:
    """All columns of SCHEMA for one text."""
    flat = flattened(text)
    words = flat.split()
    hits = [hits_of(words, a) for a in automata]
    return result_of(flat, words, *(sum((h[n] for h in hits), []) for n in range(3)))


def pieces(item: str | None, text: str, max_bytes: int, width: int = WINDOW) -> Iterator[tuple[str | None, str]]:
    """The item in texts of about ``max_bytes`` that have the windows of the whole one."""
    words = flattened(text).split()
    windows = len(words) - width + 1
    size = sum(map(len, words)) + len(words)
    if size <= max_bytes or windows <= 1:
        yield item, text
        return
    step = max(1, windows * max_bytes // size)
    for n in range(0, windows, step):
        part = words[n : min(n + step, windows) + width - 1]
        yield item, b" ".join(part).decode("utf-8", "surrogatepass")


def item_blocks(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", max_bytes: int = MAX_BYTES, width: int = WINDOW
) -> Iterator[list[tuple]]:
    """The items in lists of at most ``max_bytes``, each fetched when it is asked for; one list at least."""
    sized = benchmark.select(
        benchmark[item].cast("string").alias("i"), benchmark[text].alias("t"), F.coalesce(F.octet_length(benchmark[text]), F.lit(0)).alias("b")
    ).filter("b > 0")
    total = sized.agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    n = -(-total // max_bytes) or 1
    none = True
    for part in range(n):
        rows = sized.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == part).select("i", "t").collect()
        block, held = [], 0
        for r in sorted(((r.i, r.t) for r in rows), key=lambda r: (*_null_first(r[0]), r[1])):
            for i, t in pieces(*r, max_bytes, width):
                size = len(t.encode("utf-8", "surrogatepass"))
                if block and held + size > max_bytes:
                    yield block
                    block, held, none = [], 0, False
                block.append((i, t))
                held += size
        if block:
            yield block
            none = False
    if none:
        yield []


def scanner(spark: SparkSession, block: list[tuple], width: int = WINDOW):
    """A factory for the automaton of one block; the items travel as a broadcast of bounded size."""
    shared = spark.sparkContext.broadcast(pickle.dumps(block))
    return lambda: automaton_of(windows_of(pickle.loads(shared.value), width))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = WINDOW, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Columns ``keep``, the counts, the digest of the items found and the hit spans in code points; one block needs no shuffle."""
    blocks = item_blocks(benchmark, max_bytes=max_bytes, width=width)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        make = scanner(docs.sparkSession, block, width)

        def one():
            automata = [make()]
            return lambda value: scan_text(value, automata)

        return map_rows(docs, [text], one, SCHEMA, keep)
    # rows are told apart by a number that is written with them, as doc_id may be null or repeated
    rows = durable(docs.select(*[docs[c].alias(f"_keep{n}") for n, c in enumerate(keep)], docs[text].alias("_text"), F.monotonically_increasing_id().alias("_row")))
    found = None
    while block is not None:
        hits = map_rows(rows, ["_text"], _block_hits(scanner(docs.sparkSession, block, width)), "first array<long>, after array<long>, items array<string>", ("_row",))
        hits = durable(hits.filter("size(first) > 0"))
        found = hits if found is None else found.union(hits)
        block, following = following, next(blocks, None)
    joined = lambda c: F.flatten(F.collect_list(c)).alias(c)
    united = found.groupBy("_row").agg(joined("first"), joined("after"), joined("items"))
    whole = rows.join(united.withColumnRenamed("_row", "_hit_row"), F.col("_row") == F.col("_hit_row"), "left")
    names = [f"_keep{n}" for n in range(len(keep))]
    out = map_rows(whole, ["_text", "first", "after", "items"], lambda: _united_result, SCHEMA, names)
    return out.toDF(*keep, *out.columns[len(keep) :])


def _block_hits(make):
    def run():
        automaton = make()
        return lambda text: hits_of(flattened(text).split(), automaton)

    return run


def _united_result(text: str | None, first: list[int] | None, after: list[int] | None, items: list[str | None] | None) -> tuple:
    flat = flattened(text)
    return result_of(flat, flat.split(), first or [], after or [], items or [])


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows whose text holds no window of an item, all columns as they were; only the text goes to Python."""
    blocks = item_blocks(benchmark, max_bytes=max_bytes, width=width)
    block = next(blocks)
    while block is not None:
        docs = docs.filter(~_is_hit(docs[text], scanner(docs.sparkSession, block, width)))
        block = next(blocks, None)
        if block is not None:  # else the automata of all blocks would live at once
            docs = durable(docs)
    return docs


def _is_hit(text: Column, make) -> Column:
    @F.pandas_udf("boolean")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = make()
        for texts in batches:
            yield pd.Series([bool(hits_of(flattened(t).split(), automaton)[0]) for t in texts], dtype=bool)

    return verdict(text)
