"""Periodic run detection: all maximal repetitions of words in every document.

A run is a stretch of words with smallest period q and length >= max(shortest, 2 q) that no
neighbouring word extends. Candidates come from internal pattern matching. Texts are cut into dyadic
blocks of 1, 2, 4, ... words. The suffixes that begin with a block are an interval of the suffix
array, and a wavelet matrix over the array answers range successor queries: the next place, at or
after a given one, where the block occurs. A run with a period from 2m-1 to 4m-2 holds a whole block
of m words among its first q and the same block q words later, so that each block only asks for its
occurrences in the neighbouring window of 2m places. Occurrences up to half a block apart form an
arithmetic progression, which is stepped over at once; the part of it in the same periodic stretch as
the block has its run at a smaller period. Each distance is a candidate period; the longest common
extensions of the two places to both sides give the run or dismiss it.

Many documents are handled together, one text after the other with a separator of its own behind
each, so that the array operations are long. Memory follows the longer of ``BATCH_WORDS`` and the
longest single document, by about 4 log2(n) bytes a word. Nothing is shuffled; every row is
handled by itself, so repeated rows, null ids and extra columns need no care. Null and empty texts
have no words and no runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ratingloom.llm.common import slices

SHORTEST = 12
BATCH_WORDS = 1 << 17
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def doubled_ranks(symbols: np.ndarray, longest: int) -> list[np.ndarray]:
    """ranks[k][i]: how many places begin with a smaller string of 2^k symbols than place i.

    Ends when all places differ or 2^k reaches ``longest``.
    """
    n = len(symbols)
    first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])[:-1]
    ranks = [first[symbols].astype(np.int32)]
    width = 1
    while width < longest:
        last = ranks[-1]
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = last[width:].astype(np.int64) + 1
        pairs = last.astype(np.int64) * (n + 1) + ahead
        order = np.argsort(pairs)
        held = pairs[order]
        fresh = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(fresh, np.diff(np.append(fresh, n)))
        ranks.append(rank)
        width *= 2
        if len(fresh) == n:
            break
    return ranks


class Bits:
    """A bit array with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class Wavelet:
    """A wavelet matrix over a permutation, asked for many ranges at a time."""

    def __init__(self, values: np.ndarray):
        self.depth = max(1, int(len(values) - 1).bit_length())
        self.levels: list[tuple[int, Bits, int]] = []
        now = values.astype(np.int64)
        for bit in reversed(range(self.depth)):
            ones = (now >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(now) - ones.sum())))
            now = np.concatenate([now[~ones], now[ones]])

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are below ``than``."""
        count = np.zeros(len(low), np.int64)
        for bit, ones, zeros in self.levels:
            a, b = ones.ones(low), ones.ones(high)
            right = (than >> bit & 1).astype(bool)
            count += np.where(right, (high - b) - (low - a), 0)
            low, high = np.where(right, zeros + a, low - a), np.where(right, zeros + b, high - b)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest value of [low, high), from 0; n must be inside."""
        value = np.zeros(len(low), np.int64)
        for bit, ones, zeros in self.levels:
            a, b = ones.ones(low), ones.ones(high)
            left = (high - b) - (low - a)
            right = n >= left
            n = np.where(right, n - left, n)
            value |= right.astype(np.int64) << bit
            low, high = np.where(right, zeros + a, low - a), np.where(right, zeros + b, high - b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, none: int) -> np.ndarray:
        """The smallest value of [low, high) that is >= ``least``, or ``none``."""
        n = self.smaller(low, high, least)
        out = np.full(len(low), none, np.int64)
        some = n < high - low
        out[some] = self.nth(low[some], high[some], n[some])
        return out


def extension(ranks: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols agree from x and y on; x < y, and a separator ends every text."""
    x, y = x.copy(), y.copy()
    start = x.copy()
    for k in reversed(range(len(ranks))):
        same = (ranks[k][x] == ranks[k][y]).astype(np.int64) << k
        x += same
        y += same
    return x - start


def backward_extension(ranks: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols agree from x and y backwards; a separator stands before every text."""
    x, y = x.copy(), y.copy()
    start = x.copy()
    for k in reversed(range(len(ranks))):
        a, b = x - (1 << k) + 1, y - (1 << k) + 1
        same = ((a >= 0) & (ranks[k][np.maximum(a, 0)] == ranks[k][np.maximum(b, 0)])).astype(np.int64) << k
        x -= same
        y -= same
    return start - x


def _stepped(t: np.ndarray, d: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, t + j d) for every j from first to last of every row."""
    sizes = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(t)), sizes)
    j = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[row]
    return row, t[row] + j * d[row]


def candidate_pairs(
    ranks: list[np.ndarray], wavelet: Wavelet, spread: np.ndarray, ends: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of 2^k symbols and their occurrences in the neighbouring window, without same-stretch ones.

    ``ends`` holds the end of the text of every place, ``spread`` the number of suffixes with the
    block at every place.
    """
    m, rank = 1 << k, ranks[k]
    at = np.arange(0, len(rank), m)
    at = at[(at + m <= ends[at]) & (spread[at] > 1)]
    low = rank[at].astype(np.int64)
    high = low + spread[at]
    least, most = at + 2 * m - 1, np.minimum(at + 4 * m - 2, ends[at] - m)
    none = len(rank) + 4 * m
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def only(mask: np.ndarray) -> None:
        nonlocal at, low, high, least, most
        at, low, high, least, most = at[mask], low[mask], high[mask], least[mask], most[mask]

    only(least <= most)
    while len(at):
        t = wavelet.successor(low, high, least, none)
        inside = t <= most
        only(inside)
        t = t[inside]
        if not len(at):
            break
        after = wavelet.successor(low, high, t + 1, none)
        step = after - t
        row = (step <= m // 2) & (after < none)
        found.append((at[~row], t[~row]))
        least = t + 1
        if row.any():
            i, u, d, top = at[row], t[row], step[row], most[row]
            last = (extension(ranks, u, u + d) - m) // d + 1  # occurrences after u in its stretch
            # the block's own stretch, if it goes on beyond the block
            own = i + d + extension(ranks, i, i + d) - m
            first = np.maximum(0, (own - u) // d + 1)
            n, places = _stepped(u, d, first, np.minimum(last, (top - u) // d))
            found.append((i[n], places))
            least[row] = u + last * d + 1
        only(least <= most)
    if not found:
        return at, at
    return np.concatenate([i for i, _ in found]), np.concatenate([t for _, t in found])


def runs_of(symbols: np.ndarray, ends: np.ndarray, longest: int, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, end, period) of all runs, sorted.

    ``symbols`` begins with a separator and has one behind each text; no two separators are equal.
    ``longest`` is the length of the longest text, ``ends`` the place of the next separator.
    """
    ranks = doubled_ranks(symbols, longest + 1)
    suffixes = np.empty(len(symbols), np.int64)
    suffixes[ranks[-1]] = np.arange(len(symbols))
    wavelet = Wavelet(suffixes)
    out = [np.empty((0, 3), np.int64)]
    for k, rank in enumerate(ranks):
        m = 1 << k
        if 4 * m - 2 > longest and m > 1:  # two periods of 2m - 1 words no longer fit
            break
        spread = np.bincount(rank, minlength=len(rank))[rank]
        i, t = candidate_pairs(ranks, wavelet, spread, ends, k)
        start = i - backward_extension(ranks, i - 1, t - 1)
        end = t + extension(ranks, i, t)
        period = t - i
        good = end - start >= np.maximum(shortest, 2 * period)
        out.append(np.unique(np.stack([start[good], end[good], period[good]], 1), axis=0))
    rows = np.concatenate(out)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # a multiple of the period spans the same words
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1)) if len(rows) else np.zeros(0, bool)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of_texts(texts: list[list[bytes]], shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray]:
    """(rows (start, end, period) over the joined texts, where each text begins there)."""
    known: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
    symbols = np.empty(begins[-1], np.int64)
    for words, begin in zip(texts, begins.tolist()):
        symbols[begin : begin + len(words)] = [known.setdefault(w, len(known)) for w in words]
    separators = np.concatenate([[0], begins[1:] - 1])
    symbols[separators] = len(known) + np.arange(len(separators))
    ends = separators[np.searchsorted(separators, np.arange(len(symbols)))]
    return runs_of(symbols, ends, int(sizes.max(initial=0)), shortest), begins[:-1]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the query of this operator plants into some documents.

    With h the CRC-32 of the decimal id, texts with h divisible by ten repeat the p words from
    place a on, up to their end. A row without id stays as it is.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def find_runs(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shortest: int = SHORTEST,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``key``, number of words, all runs by start and period, and the text without repetitions.

    Words are separated by ASCII white space and numbered from 0. ``collapsed`` joins by one space
    the words that no run holds after its first period. ``prepare`` may change a row's words first.
    """
    out = StructType([docs.select(key).schema[0], *StructType.fromDDL(SCHEMA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)

        def finished(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            rows, begins = runs_of_texts(texts, shortest)
            owner = np.searchsorted(begins, rows[:, 0], side="right") - 1
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
            dropped = np.zeros(int(begins[-1]) + len(texts[-1]) + 2, np.int64)
            np.add.at(dropped, rows[:, 0] + rows[:, 2], 1)
            np.add.at(dropped, rows[:, 1], -1)
            kept = np.cumsum(dropped) == 0
            runs, collapsed = [], []
            for n, words in enumerate(texts):
                begin = int(begins[n])
                own = rows[cuts[n] : cuts[n + 1]]
                runs.append([{"start": s - begin, "length": e - s, "period": p} for s, e, p in own.tolist()])
                if len(own):
                    words = [w for w, k in zip(words, kept[begin : begin + len(words)].tolist()) if k]
                collapsed.append(b" ".join(words).decode())
            arrays = [keys, [len(t) for t in texts], runs, collapsed]
            return pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema)

        keys: list = []
        texts: list[list[bytes]] = []
        held = 0
        for piece in slices(batches):
            for k, body in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                # bytes.split() splits at ASCII white space only
                words = (body or "").encode().split()
                keys.append(k)
                texts.append(prepare(k, words) if prepare else words)
                held += len(words) + 1
                if held >= BATCH_WORDS:
                    yield finished(keys, texts)
                    keys, texts, held = [], [], 0
        if keys:
            yield finished(keys, texts)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, out)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The longest run (smallest start, then period), its exponent, and digests of all runs and of the text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    start, length, period = best["start"], -best["shorter"], best["period"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
