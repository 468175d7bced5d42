"""Suffix-array dedup: maximal repeats from the common-prefix interval tree.

A full suffix array of the corpus would be one unbounded sort of all its suffixes. A repeated
string of SIZE bytes needs only one of its suffixes to be found, so the array is kept for sampled
suffixes: those that start at an anchor, the K bytes whose hash is smallest among all K-byte
strings of some SIZE-byte window. What is smallest depends on the window's bytes alone, so two
equal windows have their anchor at the same place and meet under its hash.

Per anchor hash the suffixes that follow it are sorted, the lengths of the common prefixes of
neighbours are scanned with a stack, and each interval of the scan is a set of suffixes that share
exactly so many bytes. Inside an interval the bytes before the anchor decide: where they differ
the repeat ends, so each interval splits into maximal repeats with all their occurrences. Each group
of SIZE bytes or more keeps its earliest occurrence, and the others are removed.

Occurrences with equal bytes all around the anchor need no comparison: the earliest of them
stands for all, and the others go as a whole. That is done per slice of rows before the shuffle
and again after it, so a passage in a third of all documents sends few rows to any task. Anchors
with more distinct surroundings than GROUP are not held by one task; they go by the hashes of
all their windows, aggregated by Spark, with the same result.

Null and short texts (under SIZE bytes) keep all their bytes. Documents are ordered by doc_id, a
null id before all; rows that share a doc_id are compared by start alone: a place is removed for
what starts earlier in any of them, never for the same start in another. A row is named by doc_id
and a digest of its text, so rows equal in both count as one and keep the same, and different
texts under one doc_id (or under none) have spans of their own. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import slices
from ratingloom.operators.skew import fragment_join
from ratingloom.session import durable

SIZE = 100
K = 24
CHUNK = 1 << 20
GROUP = 30_000
NO_ID = -(2**63)
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
SCHEMA = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_margin = 4 * SIZE
_up, _down = (_powers(b, CHUNK + 2 * _margin + 1) for b in (_P, _INVERSE))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` values, by doubling."""
    size, out = 1, x
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[: len(x) - width + 1], out[width - size :][: len(x) - width + 1]) if size < width else out


def anchors(raw: np.ndarray, size: int = SIZE, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes of the K bytes there, hashes of the bytes around) of the anchors of a text."""
    if len(raw) < size:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    width, left = size - k + 1, size - k
    out = []
    for start in range(0, len(raw), CHUNK):
        lo, hi = max(0, start - _margin), min(len(raw), start + CHUNK + _margin)
        part = raw[lo:hi].astype(np.uint64) + np.uint64(1)
        if len(part) < size:
            continue
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _up[: len(part)], out=sums[1:])
        grams = _mixed((sums[k:] - sums[:-k]) * _down[: len(part) - k + 1])
        least = _sliding(grams, width, np.minimum)
        # a gram is an anchor if it is the least of a window: of the least values of its windows the greatest is its own
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        places = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)
        places = places[(places + lo >= start) & (places + lo < start + CHUNK)]
        begin, end = np.maximum(places - left, 0), np.minimum(places + size, len(part))
        around = _mixed((sums[end] - sums[begin]) * _down[begin] + (places - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + (end - places).astype(np.uint64))
        out.append((places + lo, grams[places], around))
    return tuple(np.concatenate(x) for x in zip(*out))


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# place and the bytes that follow it (SIZE at most) travel as one number
ANCHORS = "anchor long, around long, doc long, spot long, row long"
SPOT = 128


def _named(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, text, row): ``row`` is a digest of the text, which tells rows of one doc_id apart."""
    return docs.select(F.coalesce(docs[key].cast("long"), F.lit(NO_ID)).alias("doc"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("row"))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, row) to anchors. Of those that agree all around, only what may be the earliest goes on;
    for the others a row without anchor says that the text around ``place`` is repeated."""
    with np.errstate(over="ignore"):
        for piece in slices(batches):
            parts = []
            for doc, text, row in zip(*(piece.column(n).to_pylist() for n in range(3))):
                raw = np.frombuffer(_encoded(text), np.uint8)
                places, grams, around = anchors(raw)
                if len(places):
                    names = (np.full(len(places), x, np.int64) for x in (doc, row))
                    parts.append((grams, around, next(names), places * SPOT + np.minimum(len(raw) - places, SIZE), next(names)))
            if not parts:
                continue
            columns = [np.concatenate(x) for x in zip(*parts)]
            order = np.lexsort(columns[::-1])
            columns = [x[order] for x in columns]
            once = _changes(*columns)  # repeated rows count once
            grams, around, docs, spots, rows = columns if once.all() else [x[once] for x in columns]
            # the same place in another row of the same doc_id is no earlier one
            first = _run_starts(_changes(grams, around))
            later = (docs != docs[first]) | (spots != spots[first])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams.view(np.int64), mask=later), pa.array(around.view(np.int64), mask=later),
                    pa.array(docs), pa.array(spots), pa.array(rows),
                ],
                names=["anchor", "around", "doc", "spot", "row"],
            )


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the row before it; the first one always does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for x in columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _run_starts(new: np.ndarray) -> np.ndarray:
    """For each row the place of the last row marked in ``new``."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


REPEATED = "anchor long, around long, doc long, spot long, row long, covered boolean"


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (anchor, around, doc, spot, row). The first of each surrounding is kept if its anchor has
    another surrounding, and so are other rows with the very doc and spot of the first; what comes later is
    covered. Two rows are held from batch to batch: the last one and the first of its surrounding."""
    last = opening = None  # the last row and the first of its surrounding
    waiting = None  # the first surrounding of the anchor, not passed on yet
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(5)]
        held = 0 if last is None else 2
        if held:  # the held rows lead; they are not passed on again
            columns = [np.concatenate([[f, x], c]) for f, x, c in zip(opening, last, columns)]
        a, h, d, p, _ = columns
        new_anchor, new = _changes(a), _changes(a, h)
        first = _run_starts(new)
        fresh = _changes(*columns)
        fresh[:held] = False
        same_place = (d == d[first]) & (p == p[first])
        second = new & ~new_anchor
        group = np.cumsum(new_anchor) - 1  # 0: the anchor of the held rows, if any
        has_second = np.zeros(group[-1] + 1, bool)
        has_second[group[second]] = True
        covered = fresh & ~same_place
        keep = fresh & same_place & (~new_anchor | has_second[group])
        rows = [tuple(c[keep] for c in columns) + (np.zeros(int(keep.sum()), bool),)]
        rows.append(tuple(c[covered] for c in columns) + (np.ones(int(covered.sum()), bool),))
        if waiting is not None and has_second[0]:
            rows.append(tuple(np.array([x]) for x in (*waiting, False)))
        if group[-1] or not held:
            at = np.flatnonzero(new_anchor)[-1]
            waiting = None if has_second[group[-1]] else tuple(c[at] for c in columns)
        elif has_second[0]:
            waiting = None
        opening, last = tuple(c[first[-1]] for c in columns), tuple(c[-1] for c in columns)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], names=["anchor", "around", "doc", "spot", "row", "covered"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: what the shuffles carry."""
    compress = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
    for piece in slices(batches):
        packed = [None if t is None else compress(_encoded(t)) for t in piece.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(packed, pa.binary()), piece.column(2)], names=["doc", "packed", "row"])


PACKED = "doc long, packed binary, row long"


def _unpacked(packed: bytes | None) -> bytes:
    return b"" if packed is None else zstandard.ZstdDecompressor().decompress(packed, max_output_size=zstandard.frame_content_size(packed) or 1)


CONTEXTS = "anchor long, doc long, place long, left binary, right binary, row long"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(packed text, doc, row, places, anchors) to the bytes before and from each place."""
    left = SIZE - K
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    for piece in slices(batches, 128):
        out = []
        for packed, doc, row, places, names in zip(*(piece.column(n).to_pylist() for n in range(5))):
            raw = _unpacked(packed)
            out += [(a, doc, p, raw[max(0, p - left) : p], raw[p : p + SIZE], row) for p, a in zip(places, names)]
        columns = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "doc", "place", "left", "right", "row"])


def _common(x: int, y: int, size: int) -> int:
    """Leading bytes that two numbers of ``size`` bytes share."""
    return size - (((x ^ y).bit_length() + 7) >> 3)


def intervals(prefixes: list[int]) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of all intervals of a sorted suffix list, by one scan with a stack.

    ``prefixes[i]`` is the common prefix of suffixes i - 1 and i; the first is not looked at.
    """
    out, stack = [], [(0, 0)]
    for i in range(1, len(prefixes) + 1):
        here = prefixes[i] if i < len(prefixes) else 0
        first = i - 1
        while stack[-1][0] > here:
            depth, first = stack.pop()
            out.append((depth, first, i - 1))
        if stack[-1][0] < here:
            stack.append((here, first))
    return out


def _sorted_suffixes(occurrences: list[tuple], size: int, left: int) -> list[tuple]:
    """(bytes from the anchor, their number, reversed bytes before it, their number, doc, place, ...), sorted."""
    return sorted(
        (int.from_bytes(r.ljust(size, b"\0"), "big"), len(r), int.from_bytes(b[::-1].ljust(left, b"\0"), "big"), len(b), d, p, *more)
        for d, p, b, r, *more in occurrences
    )


def maximal_repeats(occurrences: list[tuple], size: int = SIZE, k: int = K) -> list[tuple[int, int, list[tuple]]]:
    """(bytes before the anchor, bytes from it, members) of the maximal repeats of ``size`` bytes or more.

    All occurrences (doc, place, bytes before, bytes from the anchor, ...) share an anchor; a member is
    (doc, place, ...). A group is listed if it cannot be extended to either side without losing a member.
    """
    left = size - k
    rows = _sorted_suffixes(occurrences, size, left)
    prefixes = _prefixes(rows, size)
    out = []
    for depth, first, last in intervals(prefixes):
        order = sorted(range(first, last + 1), key=lambda n: rows[n][2:4])
        shared = _shared([rows[n] for n in order], left)
        # the bytes before the anchor differ inside a group: intervals of the reversed bytes, and all members where no byte is common
        groups = intervals(shared)
        if 0 in shared[1:]:
            groups.append((0, 0, len(order) - 1))
        for back, a, b in groups:
            members = order[a : b + 1]
            # those inside one smaller interval share more to the right and are listed there
            if back + depth >= size and min(prefixes[min(members) + 1 : max(members) + 1]) == depth:
                out.append((back, depth, sorted(tuple(rows[n][4:]) for n in members)))
    return out


def _shared(rows: list[tuple], left: int) -> list[int]:
    """The common bytes before the anchor of neighbours sorted by them."""
    return [0] + [min(_common(x[2], y[2], left), x[3], y[3]) for x, y in zip(rows, rows[1:])]


def _prefixes(rows: list[tuple], size: int) -> list[int]:
    return [0] + [min(_common(x[0], y[0], size), x[1], y[1]) for x, y in zip(rows, rows[1:])]


def deepest_later(shared: list[int], order: list) -> list[int]:
    """For each member the common bytes of the smallest group in which another member comes first, -1 if none.

    One scan over the groups of ``intervals``: a group hands on its earliest members alone, and those that
    meet an earlier one in the group around theirs are settled there. ``order`` tells who is earlier;
    equal ones are not earlier than each other.
    """
    best = [-1] * len(order)
    stack: list[tuple[int, list[int]]] = []  # open groups with their earliest members so far

    def meet(one: list[int], other: list[int], depth: int) -> list[int]:
        if order[one[0]] == order[other[0]]:
            return one + other
        early, late = (one, other) if order[one[0]] < order[other[0]] else (other, one)
        for n in late:
            best[n] = depth
        return early

    for i in range(1, len(order) + 1):
        here = shared[i] if i < len(order) else -1
        now = [i - 1]
        while stack and stack[-1][0] > here:
            depth, early = stack.pop()
            now = meet(early, now, depth)
        if here < 0:
            break
        if stack and stack[-1][0] == here:
            stack[-1] = (here, meet(stack[-1][1], now, here))
        else:
            stack.append((here, now))
    return best


def removals(occurrences: list[tuple], size: int = SIZE, k: int = K) -> list[tuple]:
    """(doc, start, end) of what each occurrence shares with an earlier one, if ``size`` bytes or more.

    Every group of ``maximal_repeats`` keeps its earliest members and removes the others. Groups lie in
    one another, so that a member is removed by the widest one that does not begin with it; others
    remove parts of that. What an occurrence has beyond doc, place and bytes is handed on.
    """
    left = size - k
    rows = _sorted_suffixes(occurrences, size, left)
    out = []
    for depth, first, last in intervals(_prefixes(rows, size)):
        need = size - depth
        if need > left:
            continue
        members = sorted(rows[first : last + 1], key=lambda r: r[2:4])
        for r, back in zip(members, deepest_later(_shared(members, left), [(r[4], r[5]) for r in members])):
            if back >= need:
                out.append((r[4], r[5] - back, r[5] + depth, *r[6:]))
    return out


def _group_removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor; the occurrences of one anchor are held at a time."""
    name, held, out = None, [], []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc", "start", "end", "row"])

    for piece in slices(batches, 4_096):
        for anchor, doc, place, before, after, row in zip(*(piece.column(n).to_pylist() for n in range(6))):
            if anchor != name:
                if len(held) > 1:
                    out += removals(held)
                name, held = anchor, []
            held.append((doc, place, before, after, row))
        if out:
            yield batch(out)
            out = []
    if len(held) > 1:
        out += removals(held)
    if out:
        yield batch(out)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts to the digests of all their windows that hold the anchor."""
    for piece in slices(batches, 64):
        out = []
        for _, doc, place, before, after, row in zip(*(piece.column(n).to_pylist() for n in range(6))):
            around = before + after
            for n in range(len(around) - SIZE + 1):
                out.append((hashlib.blake2b(around[n : n + SIZE], digest_size=16).digest(), doc, place - len(before) + n, row))
        columns = list(zip(*out)) if out else [()] * 4
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["window", "doc", "start", "row"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, touching ones joined."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, 256):
        rows = []
        for packed, starts, ends in zip(*(piece.column(n).to_pylist() for n in range(3))):
            raw = _unpacked(packed)
            spans = merged(list(zip(starts or (), ends or ())))
            digest, at = hashlib.sha256(), 0
            for s, e in spans:
                digest.update(raw[at:s])
                at = e
            digest.update(raw[at:])
            rows.append((len(raw), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), [x for s in spans for x in s]))
        a, b, c, d, e = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [piece.column(3), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string()), pa.array(e, pa.list_(pa.int64()))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def _with_contexts(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """The occurrences (anchor, doc, row, place) with the bytes around them; each row's text is read once."""
    wanted = open_.groupBy("doc", "row").agg(F.collect_list("place").alias("places"), F.collect_list("anchor").alias("anchors"))
    packed = rows.mapInArrow(_packed, PACKED).dropDuplicates(["doc", "row"])
    return packed.join(wanted, ["doc", "row"]).select("packed", "doc", "row", "places", "anchors").mapInArrow(_contexts, CONTEXTS)


def removed_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """(doc, row, starts, ends): what of each text is repeated from earlier places; lists of spans that may overlap."""
    rows = _named(docs, text, key)
    found = rows.mapInArrow(_anchor_rows, ANCHORS)  # scanned once for each use: cheaper than to write all anchors
    place, after = F.floor(F.col("spot") / SPOT), F.col("spot") % SPOT
    around = lambda t: t.select(
        "doc", F.greatest(place - (SIZE - K), F.lit(0)).alias("start"), (place + after).alias("end"), "row"
    ).filter(F.col("end") - F.col("start") >= SIZE)
    local = around(found.filter("anchor is null"))
    sorted_rows = (
        found.filter("anchor is not null").repartition("anchor").sortWithinPartitions("anchor", "around", "doc", "spot", "row")
    )
    repeated = durable(sorted_rows.mapInArrow(_repeated_anchors, REPEATED).drop("around"))
    whole = around(repeated.filter("covered"))

    open_ = repeated.filter("not covered").select("anchor", "doc", place.alias("place"), "row")
    hot = durable(open_.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select("anchor"))
    contexts = _with_contexts(rows, open_)
    if hot.isEmpty():
        cold, spread = contexts, None
    else:
        contexts = durable(contexts)
        cold, spread = contexts.join(hot, "anchor", "left_anti"), contexts.join(hot, "anchor", "left_semi")
    compared = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_group_removals, "doc long, start long, end long, row long")
    spans = local.union(whole).union(compared)
    if spread is not None:
        windows = durable(spread.select(*contexts.columns).mapInArrow(_window_rows, "window binary, doc long, start long, row long"))
        first = durable(windows.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("window", "first"))
        later = windows.join(first, "window").filter(F.struct("doc", "start") > F.col("first"))
        spans = spans.union(later.select("doc", "start", (F.col("start") + SIZE).alias("end"), "row"))
    return spans.groupBy("doc", "row").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (starts and ends in turn) of every row."""
    spans = removed_spans(docs, text, key, group)
    packed = _named(docs, text, key).mapInArrow(_packed, PACKED)
    joined = packed.join(spans, ["doc", "row"], "left")
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return joined.select("packed", "starts", "ends", doc_id).mapInArrow(
        _results, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"
    )


OCCURRENCES = "anchor long, around long, doc long, spot long, row long"


def _every_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, row) to all anchors with their surroundings."""
    with np.errstate(over="ignore"):
        for piece in slices(batches):
            for doc, text, row in zip(*(piece.column(n).to_pylist() for n in range(3))):
                raw = np.frombuffer(_encoded(text), np.uint8)
                places, grams, around = anchors(raw)
                spots = places * SPOT + np.minimum(len(raw) - places, SIZE)
                names = [pa.array(np.full(len(places), x, np.int64)) for x in (doc, row)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array(around.view(np.int64)), names[0], pa.array(spots), names[1]],
                    names=["anchor", "around", "doc", "spot", "row"],
                )


def _split_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a context that holds the anchor: ``part`` is the window and how far before the anchor it begins."""
    for piece in slices(batches, 64):
        take, parts, backs = [], [], []
        for n, (before, after) in enumerate(zip(piece.column("left").to_pylist(), piece.column("right").to_pylist())):
            text = before + after
            for start in range(len(text) - SIZE + 1):
                back = len(before) - start
                take.append(n)
                backs.append(back)
                parts.append(hashlib.blake2b(text[start : start + SIZE] + bytes([back]), digest_size=16).hexdigest())
        rows = piece.take(pa.array(take, pa.int64()))
        columns = [rows.column(c) for c in ("anchor", "around", "left", "right", "copies")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.string()), pa.array(backs, pa.int32())], names=["anchor", "around", "left", "right", "copies", "part", "back"])


GROUPS = "group_id string, anchor long, around long, before int, after int"


def _listed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, part) to the members of their groups, one surrounding a row.

    In a part of a split anchor all share a window; a group is listed in the part of its first window.
    """
    name, held, copied = None, [], []

    def listed() -> list[tuple]:
        anchor, part, wanted = name
        groups = maximal_repeats(held) if len(held) > 1 else []
        seen = {(back, depth, m[0]) for back, depth, members in groups for m in members}
        # copies of one surrounding are a group of their own unless it is the whole of another one
        groups += [(len(b), len(r), [(around,)]) for around, _, b, r in copied if len(b) + len(r) >= SIZE and (len(b), len(r), around) not in seen]
        out = []
        for n, (back, depth, members) in enumerate(groups):
            if wanted < 0 or back == wanted:
                out += [(f"{anchor & (1 << 64) - 1:016x}-{part}-{n}", anchor, m[0], back, depth) for m in members]
        return out

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["group_id", "anchor", "around", "before", "after"])

    for piece in slices(batches, 4_096):
        out = []
        for anchor, around, before, after, copies, part, back in zip(*(piece.column(n).to_pylist() for n in range(7))):
            if (anchor, part, back) != name:
                out += listed() if name else []
                name, held, copied = (anchor, part, back), [], []
            held.append((around, 0, before, after))
            if copies:
                copied.append(held[-1])
        if out:
            yield batch(out)
    if name and (out := listed()):
        yield batch(out)


def maximal_repeat_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """(group_id, doc_id, start, n_bytes): all occurrences of every maximal repeat around each anchor, one row each.

    A repeat reaches at most SIZE - K bytes before its anchor and SIZE bytes from it on; a longer passage
    is several groups, one per anchor in it. Occurrences with equal surroundings stand behind one of them
    while groups are found and are joined back at the end, exact copies of whole texts included. An
    anchor of more than ``group`` surroundings is split by the windows that hold it.
    """
    rows = _named(docs, text, key)
    every = durable(rows.mapInArrow(_every_anchor, OCCURRENCES))
    spot = F.struct("doc", "spot", "row")
    kinds = every.groupBy("anchor", "around").agg(F.min(spot).alias("rep"), (F.min(F.struct("doc", "spot")) < F.max(F.struct("doc", "spot"))).alias("copies"))
    kinds = durable(kinds.select("anchor", "around", "copies", "rep.*"))
    repeated = durable(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.bool_or("copies").alias("any")).filter("n > 1 or any").select("anchor", "n"))
    known = kinds.join(repeated, "anchor").withColumn("place", F.floor(F.col("spot") / SPOT))
    contexts = _with_contexts(rows, known.select("anchor", "doc", "place", "row")).withColumnRenamed("place", "at")
    told = known.select("anchor", "doc", "row", F.col("place").alias("at"), "around", "copies", "n")
    contexts = durable(contexts.join(told, ["anchor", "doc", "row", "at"]).select("anchor", "around", "left", "right", "copies", "n"))
    whole = contexts.filter(F.col("n") <= group).drop("n").withColumn("part", F.lit("")).withColumn("back", F.lit(-1))
    split = contexts.filter(F.col("n") > group).drop("n").mapInArrow(_split_contexts, "anchor long, around long, left binary, right binary, copies boolean, part string, back int")
    by_part = whole.union(split).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "back")
    found = durable(by_part.mapInArrow(_listed_groups, GROUPS))
    all_of = fragment_join(every.join(repeated, "anchor", "left_semi"), found, ["anchor", "around"], ["doc", "spot", "row"])
    place = F.floor(F.col("spot") / SPOT)
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return all_of.select("group_id", doc_id, (place - F.col("before")).alias("start"), (F.col("before") + F.col("after")).cast("long").alias("n_bytes"), "row").distinct()
