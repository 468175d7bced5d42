"""Near-duplicates by min-max hashing of word shingles.

One hash evaluation per shingle and permutation gives two signature values, the minimum and the
maximum; both agree between two sets with the probability of their Jaccard similarity, so half
the evaluations are enough. Bands of either kind make candidate links. Documents with equal sets
are one class from the start and only its first member takes part.

Candidate links are never listed as pairs: each bucket ties its members to its smallest, and the
connected groups of that sparse graph are the only places where links can be. Inside a group,
sets of similar size are compared exactly, block against block in separate tasks, and a task
passes on at most one link per document. The components of those exact links are the answer.

With 44 bands of 7 values a pair at 0.85 is missed with a probability of 4e-8; all others less.

Null texts and texts without words have no set and are linked with nothing. Rows that share a
doc_id are one document with the text of the largest set digest, the only one that is compared; a
null doc_id has no component.
Extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.llm.common import member_bitmap, slices
from ratingloom.llm.components import components
from ratingloom.session import durable

WIDTH = 5
SIMILAR_PERCENT = 85
ROWS = 7
BANDS = 44  # half of them on minima, half on maxima
PERMUTATIONS = ROWS * BANDS // 2
BLOCK_DOCUMENTS = 1_024
BLOCK_SHINGLES = 200_000
LIGHT = 64  # shingles of at most this many sets are counted pair by pair, others by matrix products

_random = np.random.default_rng(20240607)
_FACTORS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _random.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, _BASE, np.uint64), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    global _POWERS
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    while lengths.max() >= len(_POWERS):
        _POWERS = np.cumprod(np.full(2 * len(_POWERS), _BASE, np.uint64), dtype=np.uint64)
    # each word is a polynomial of its bytes; the spaces between words count as nothing
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))), axis=0) if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(raw), np.int64)
        place[starts[0] :] = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    terms = np.where(_SPACE[raw], np.uint64(0), (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, len(_POWERS) - 1)])
    words = _mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for n in range(size):
        out = out * _BASE + words[n : n + len(out)]
    return np.unique(_mixed(out))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band; two sets that agree on all values of a band share its key."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(hashes), 1_024):
        values = hashes[start : start + 1_024, None] * _FACTORS[None, :]
        np.minimum(low, values.min(0), out=low)
        np.maximum(high, values.max(0), out=high)
    rows = np.concatenate([low, high]).reshape(BANDS, ROWS)
    keys = (rows * _BAND_FACTORS[None, :]).sum(1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _BASE
    return _mixed(keys)


def _digest(packed: bytes) -> str:
    return hashlib.blake2b(packed, digest_size=16).hexdigest()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for piece in slices(batches):
            sizes, digests, keys, offsets = [], [], [], [0]
            for text in piece.column(1).to_pylist():
                hashes = shingle_hashes(text)
                sizes.append(len(hashes))
                digests.append(_digest(hashes.tobytes()))
                if len(hashes):
                    keys.append(band_keys(hashes).view(np.int64))
                offsets.append(offsets[-1] + (BANDS if len(hashes) else 0))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), bands], names=["doc_id", "n", "digest", "bands"])


def similar_within(sets: list[np.ndarray], percent: int = SIMILAR_PERCENT) -> list[tuple[int, int]]:
    """Links (smallest member, member) that join exactly what the similar pairs of ``sets`` join."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), lengths)
    order = np.argsort(np.concatenate(sets), kind="stable")
    values, owner = np.concatenate(sets)[order], owner[order]
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    counts = np.diff(edges)
    run = np.repeat(np.arange(len(counts)), counts)
    common = np.zeros((n, n), np.float32)
    shared = counts[run] > 1
    light = shared & (counts[run] <= LIGHT)
    lo, lr = owner[light], run[light]
    for step in range(1, min(LIGHT, len(lo))):
        same = lr[step:] == lr[:-step]
        if not same.any():
            break
        pairs = lo[:-step][same] * n + lo[step:][same]
        common += np.bincount(pairs, minlength=n * n).reshape(n, n)
    heavy = np.flatnonzero(counts > LIGHT)
    for start in range(0, len(heavy), 2_048):
        columns = heavy[start : start + 2_048]
        matrix = np.zeros((n, len(columns)), np.float32)
        for k, c in enumerate(columns):
            matrix[owner[edges[c] : edges[c + 1]], k] = 1
        common += np.triu(matrix @ matrix.T, 1)
    common = common + common.T
    union = lengths[:, None] + lengths[None, :] - common
    linked = 100 * common >= percent * union
    np.fill_diagonal(linked, False)
    seen, links = np.zeros(n, bool), []
    for root in np.flatnonzero(linked.any(1)):
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            reached = linked[front].any(0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
            links += [(int(root), int(m)) for m in front]
    return links


def _sets_of(among: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, slot, text) to the sets, and their digests, of the documents that may be wanted."""
        with np.errstate(over="ignore"):
            for piece in slices(batches):
                piece = piece.filter(pa.array(among(piece.column(1).to_numpy(zero_copy_only=False))))
                sets = [shingle_hashes(t).tobytes() for t in piece.column(2).to_pylist()]
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(digests, pa.string()), pa.array(sets, pa.binary())], names=["doc_id", "digest", "set"])

    return run


def _links_of_cells(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell; one cell is held at a time."""
        cell, ids, sets = None, [], []

        def finish():
            pairs = similar_within(sets, percent) if len(sets) > 1 else []
            return [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in pairs]

        out: list[tuple] = []
        for piece in slices(batches, 1_024):
            columns = [piece.column(n).to_pylist() for n in range(6)]
            for g, c, x, y, doc, packed in zip(*columns):
                if (g, c, x, y) != cell:
                    out += finish()
                    cell, ids, sets = (g, c, x, y), [], []
                elif doc == ids[-1]:
                    continue  # a repeated row
                ids.append(doc)
                sets.append(np.frombuffer(packed, np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(z, pa.int64()) for z in zip(*out)], names=["a", "b"])
                out = []
        out += finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.int64()) for z in zip(*out)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = SIMILAR_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of its component), kept, class_id."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    signed = rows.mapInArrow(_signatures, "doc_id long, n long, digest string, bands array<long>")
    one = signed.groupBy("doc_id").agg(F.max_by(F.struct("n", "digest", "bands"), "digest").alias("s")).select("doc_id", "s.*")
    signed = durable(one)
    with_set = signed.filter("n > 0 and doc_id is not null")
    classes = durable(with_set.groupBy("digest").agg(F.min("doc_id").alias("class_id")))
    firsts = durable(with_set.join(classes, "digest").filter("doc_id = class_id").select("doc_id", "n", "digest", "bands"))

    keyed = firsts.select(F.explode("bands").alias("band"), "doc_id")
    buckets = durable(keyed.groupBy("band").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("band", "first"))
    candidates = keyed.join(buckets, "band").filter("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    groups = components(candidates)

    # sets of sizes further apart than the wanted similarity cannot be linked: only neighbouring size classes meet
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("int")
    members = durable(groups.join(firsts.select("doc_id", "n", "digest"), groups["node"] == firsts["doc_id"]).select(F.col("root").alias("grp"), size_class.alias("cls"), "doc_id", "digest", "n"))
    weight = members.groupBy("grp", "cls").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("c"))
    blocks = durable(weight.groupBy("grp").agg(F.max(F.greatest(F.ceil(F.col("w") / BLOCK_SHINGLES), F.ceil(F.col("c") / BLOCK_DOCUMENTS))).cast("int").alias("blocks")))
    placed = durable(
        members.join(blocks, "grp").select("grp", "cls", "blocks", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"), "doc_id", "digest")
    )
    # few documents are in a group: the texts of the others stay where they are
    slot, among = member_bitmap(placed, "doc_id")
    wanted = rows.filter("doc_id is not null").select("doc_id", slot(F.col("doc_id")).alias("slot"), "text")
    # rows that share a doc_id may hold other texts: only the one that was signed takes part
    sets = wanted.mapInArrow(_sets_of(among), "doc_id long, digest string, set binary").join(placed, ["doc_id", "digest"])
    # a cell (cls, x, y) compares block x of a class with block y of the same and of the next class
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cell = lambda c, x, y: F.struct(c.alias("cls"), x.alias("x"), y.alias("y"))
    own, block = F.col("cls"), F.col("block")
    cells = F.concat(
        F.transform(every, lambda y: cell(own, block, y)),
        F.transform(F.filter(every, lambda x: x != block), lambda x: cell(own, x, block)),
        F.transform(every, lambda x: cell(own - 1, x, block)),
    )
    compared = (
        sets.select("grp", F.explode(cells).alias("c"), "doc_id", "set")
        .select("grp", "c.*", "doc_id", "set")
        .repartition("grp", "cls", "x", "y")
        .sortWithinPartitions("grp", "cls", "x", "y", "doc_id")
    )
    found = components(compared.mapInArrow(_links_of_cells(percent), "a long, b long"))

    classed = signed.join(classes, "digest", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("class_id")).alias("class_id"))
    joined = classed.join(found, classed["class_id"] == found["node"], "left")
    component = F.coalesce("root", "class_id", "doc_id")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def first_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns as they were.

    One row per component stays. Of rows that share a doc_id the one with the largest text is judged; one
    row of each other text of that id stays unjudged, so that no text is lost to its id. Rows with a
    null doc_id, which have no component, all stay.
    """
    mark = "".join(docs.columns) + "_"  # longer than any column's name
    repeated = durable(docs.filter(docs[key].isNotNull()).groupBy(docs[key].alias(mark)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(mark))
    single = docs.filter(docs[key].isNotNull()).join(repeated, docs[key] == repeated[mark], "left_anti")
    if repeated.isEmpty():
        judged, rest = single, docs.filter(docs[key].isNull())
    else:
        several = docs.join(repeated, docs[key] == repeated[mark], "left_semi")
        nth = F.dense_rank().over(Window.partitionBy(key).orderBy(F.col(text).desc_nulls_last()))
        copy = F.row_number().over(Window.partitionBy(key, text).orderBy(F.lit(0)))
        texts = several.withColumn(mark, nth).withColumn(mark + "_", copy).filter(F.col(mark + "_") == 1).drop(mark + "_")
        texts = durable(texts)
        judged = single.union(texts.filter(F.col(mark) == 1).drop(mark))
        rest = texts.filter(F.col(mark) > 1).drop(mark).union(docs.filter(docs[key].isNull()))
    kept = near_duplicates(judged, text, key, percent).filter("kept").select(F.col("doc_id").alias(mark))
    return judged.join(kept, judged[key] == kept[mark], "left_semi").union(rest)
