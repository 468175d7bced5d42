"""Filter interaction audit: what each quality filter removes under every order of the filters.

Row filters are conditions on one text. The duplicate filter looks at the whole table, and most
texts of a corpus are unique, so a counting Bloom prepass comes first. Every task counts the slots
of the text hashes it reads, the counts are merged by slot, and a text is cleared as unique if one
of its slots was counted once only. Only texts that may repeat are shuffled, whole, for the smallest
doc_id of each; copies are combined before the shuffle, so a hot text costs a row per task.

The flags of a document form a bit mask. Documents are counted by (part, mask, labels), and every
figure of every order is a sum of those counts: kept after a step are the masks without any bit of
the filters so far. So 600 rows a part come from at most 32 counts a part, and no document is
looked at again.

The sketch has ``SLOTS_PER_TEXT`` slots a text and at most ``MAX_SLOTS`` (one bit of each, 32 MB,
is broadcast). Beyond that size slots are shared by more texts, so more unique ones take the exact
way; the result is the same.

Null texts count as empty, null parts as the empty string. A row without doc_id has no smaller id
than itself, and it is no smaller id to others: its text never fails the duplicate filter. Rows that
share doc_id and text are not smaller than each other. Labels that repeat a doc_id count if any row
says 1; labels without document are not read. Extra columns are not read, and an empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.session import durable

SLOTS_PER_TEXT = 16
MAX_SLOTS = 1 << 28
HASHES = 4
CHUNK_SLOTS = 1 << 16  # slots merged by one group
FLUSH_TEXTS = 1 << 17  # texts a task counts before it hands its counts on

WORD = "[^\\x20\\x09-\\x0D]+"


def row_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters A to D on a text that is not null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * distinct.cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """HASHES slots of every 64-bit hash, one row each, by double hashing."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(n) * step) & np.uint64(slots - 1) for n in range(HASHES)])


def crowded_slots(hashes: DataFrame, slots: int) -> np.ndarray:
    """A bit for every slot that two or more rows of the hash column use (a text counts once per slot).

    Tasks emit sparse counts of the slots they saw, chunk by chunk, and each chunk is merged by one
    group. What reaches the driver is one bit a slot, whatever the number of rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(parts: list[np.ndarray]) -> pa.RecordBatch:
            # a slot that two hashes of the same text hit is one use of it
            drawn = np.sort(_slots(np.concatenate(parts), slots), axis=0)
            fresh = np.vstack([np.ones((1, drawn.shape[1]), bool), drawn[1:] != drawn[:-1]])
            used, n = np.unique(drawn[fresh], return_counts=True)
            chunk = used // np.uint64(CHUNK_SLOTS)
            cuts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            ends = np.append(cuts[1:], len(used))
            local = (used % np.uint64(CHUNK_SLOTS)).astype("<u2")
            many = n > 1
            return pa.record_batch(
                {
                    "chunk": pa.array(chunk[cuts].astype(np.int32)),
                    "once": pa.array([local[a:b][~many[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    "more": pa.array([local[a:b][many[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                }
            )

        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= FLUSH_TEXTS:
                yield counts(held)
                held, n = [], 0
        if n:
            yield counts(held)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        counted = np.zeros(CHUNK_SLOTS, np.uint8)
        for once, more in zip(table.column("once").to_pylist(), table.column("more").to_pylist()):
            for data, n in ((once, 1), (more, 2)):
                at = np.frombuffer(data, "<u2")  # distinct within one row
                counted[at] = np.minimum(counted[at] + n, 2)
        bits = np.packbits(counted > 1, bitorder="little").tobytes()
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})

    merged = hashes.mapInArrow(count, "chunk int, once binary, more binary").groupBy("chunk").applyInArrow(merge, "chunk int, bits binary")
    table = np.zeros(slots // 8, np.uint8)
    width = CHUNK_SLOTS // 8
    for row in merged.toLocalIterator():
        table[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return table


def may_repeat(hashes: DataFrame, slots_per_text: int = SLOTS_PER_TEXT, max_slots: int = MAX_SLOTS):
    """A column function of a 64-bit hash: whether its text may occur more than once. Never false for one that does."""
    total, slots = hashes.count(), CHUNK_SLOTS
    while slots < min(max_slots, slots_per_text * total):
        slots *= 2
    held = hashes.sparkSession.sparkContext.broadcast(crowded_slots(hashes, slots))

    @F.pandas_udf("boolean")
    def crowded(values: pd.Series) -> pd.Series:
        at = _slots(values.to_numpy(), slots)
        bits = held.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        return pd.Series(bits.all(axis=0))

    return crowded


def failure_masks(
    docs: DataFrame,
    conditions: dict[str, Column],
    text: str = "text",
    key: str = "doc_id",
    part: str = "source",
    slots_per_text: int = SLOTS_PER_TEXT,
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """(doc_id, part, mask) of every row: bit n for the n-th condition, the last bit for a repeated text.

    ``conditions`` are Columns over a column named ``_text`` (see ``row_conditions``).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("_text"))
    hashes = [F.xxhash64("_text").alias("h"), F.xxhash64(F.lit(1), "_text").alias("g")]
    bits = sum((F.when(c, 1 << n).otherwise(0) for n, c in enumerate(conditions.values())), F.lit(0))
    flagged = durable(given.select("doc_id", "part", bits.cast("int").alias("mask"), *hashes))
    crowded = may_repeat(flagged.select("h"), slots_per_text, max_slots)

    # whole texts that may repeat; one row per distinct text leaves each task
    firsts = (
        given.filter("doc_id IS NOT NULL")
        .select("doc_id", "_text", hashes[0])
        .filter(crowded("h"))
        .groupBy("_text")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", *hashes)
        .withColumn("first", F.lit(True))
    )
    repeats = flagged.filter(F.col("doc_id").isNotNull() & crowded("h")).groupBy("doc_id", "part", "mask", "h", "g").count()
    late = (
        repeats.join(firsts, ["doc_id", "h", "g"], "left")
        .withColumn("mask", F.col("mask") + F.when(F.col("first").isNull(), 1 << len(conditions)).otherwise(0))
        .select("doc_id", "part", "mask", "count")
    )
    unique = flagged.filter(F.col("doc_id").isNull() | ~crowded("h")).groupBy("doc_id", "part", "mask").count()
    return unique.unionByName(late)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by (part, mask): all, those labelled good and those labelled toxic."""
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    known = masks.filter("doc_id IS NOT NULL").join(said, "doc_id", "left")
    rows = known.select("part", "mask", "count", "q", "t").unionByName(
        masks.filter("doc_id IS NULL").select("part", "mask", "count", F.lit(None).alias("q"), F.lit(None).alias("t"))
    )
    return rows.groupBy("part", "mask").agg(
        F.sum("count").alias("n"),
        F.sum(F.when(F.col("q") == 1, F.col("count")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("t") == 1, F.col("count")).otherwise(0)).alias("toxic"),
    )


def interactions(counts: DataFrame, letters: Sequence[str]) -> DataFrame:
    """Every part, order and step with its figures, from the counts of the masks."""
    masks = 1 << len(letters)
    sums = [F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)).alias(f"{c}{m}") for c in ("n", "good", "toxic") for m in range(masks)]
    one = counts.groupBy("part").agg(*sums)
    array = lambda c: F.array(*[F.col(f"{c}{m}") for m in range(masks)])
    # passing[s]: documents that no filter of the set s removes
    passing = lambda c: F.transform(
        F.sequence(F.lit(0), F.lit(masks - 1)),
        lambda s: F.aggregate(
            F.filter(F.sequence(F.lit(0), F.lit(masks - 1)), lambda m: m.bitwiseAND(s) == 0),
            F.lit(0).cast("long"),
            lambda a, m: a + F.get(F.col(c), m),
        ),
    )
    held = one.select("part", *[array(c).alias(c) for c in ("n", "good", "toxic")])
    held = held.select("part", "n", *[passing(c).alias(f"pass_{c}") for c in ("n", "good", "toxic")])
    orders = list(permutations(range(len(letters))))
    shares = len(orders)
    # a document that b filters fail goes to each of them in the same number of orders
    value = [
        sum(
            (F.get("n", F.lit(m)) * (shares // m.bit_count()) for m in range(masks) if m >> f & 1),
            F.lit(0).cast("long"),
        )
        for f in range(len(letters))
    ]
    steps = ", ".join(
        f"named_struct('filter_order', '{''.join(letters[f] for f in order)}', 'step', {step}, 'f', {order[step - 1]}, "
        f"'alone', {1 << order[step - 1]}, 'before', {sum(1 << f for f in order[: step - 1])}, 'after', {sum(1 << f for f in order[:step])})"
        for order in orders
        for step in range(1, len(letters) + 1)
    )
    rows = held.select("*", F.array(*value).alias("shapley")).select("*", F.explode(F.expr(f"array({steps})")).alias("s"))
    get = lambda c, at: F.get(F.col(c), at)
    removed = get("pass_n", F.col("s.before")) - get("pass_n", F.col("s.after"))
    alone = F.col("s.alone")
    return rows.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        get("pass_n", F.col("s.after")).alias("kept"),
        removed.alias("removed"),
        (get("pass_n", F.lit(0)) - get("pass_n", alone) - removed).alias("redundant"),
        get("n", alone).alias("unique_fails"),
        (get("pass_good", F.col("s.before")) - get("pass_good", F.col("s.after"))).alias("good_lost"),
        (get("pass_toxic", F.col("s.before")) - get("pass_toxic", F.col("s.after"))).alias("toxic_lost"),
        get("shapley", F.col("s.f")).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    conditions: dict[str, Column] | None = None,
    duplicates: str = "E",
    slots_per_text: int = SLOTS_PER_TEXT,
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """One row per part, order of the filters and step; ``duplicates`` names the repeated-text filter."""
    conditions = row_conditions(F.col("_text")) if conditions is None else conditions
    masks = failure_masks(docs, conditions, slots_per_text=slots_per_text, max_slots=max_slots)
    return interactions(mask_counts(masks, labels), [*conditions, duplicates])
