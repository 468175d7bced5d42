"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

ROWS_PER_SLICE = 512
ROWS_PER_BATCH = 1_024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def sha256_hex(parts: Sequence[str]) -> str:
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into short pieces, so that the Python objects of few rows live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(
    df: DataFrame,
    columns: Sequence[str],
    make: Callable[[], Callable[..., tuple]],
    schema: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One output row per row: columns ``keep`` unchanged, then what ``make()(*columns)`` returns.

    ``make`` runs once per task, so that automata and models are built once. Only the named
    columns reach Python, whatever else the table holds. Null comes in as None.
    """
    columns, keep = list(columns), list(keep)
    fields = StructType.fromDDL(schema)
    kept = df.select(*[df[c] for c in keep]).schema.fields if keep else []
    out = StructType([*kept, *fields])
    n_out = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        work = make()
        for piece in slices(batches):
            names = piece.schema.names
            values = [piece.column(names.index(f"_in{n}")).to_pylist() for n in range(len(columns))]
            results = [work(*row) for row in zip(*values)]
            made = list(zip(*results)) if results else [()] * n_out
            arrays = [piece.column(names.index(c)).cast(arrow.field(c).type) for c in keep]
            arrays += [pa.array(made[n], arrow.field(len(keep) + n).type) for n in range(n_out)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    given = df.select(*[df[c] for c in keep], *[df[c].alias(f"_in{n}") for n, c in enumerate(columns)])
    return given.mapInArrow(run, out)


FILTER_BITS = 1 << 26


def member_bitmap(members: DataFrame, column: str) -> tuple[Callable[[Column], Column], Callable[[np.ndarray], np.ndarray]]:
    """(slot, among): ``slot`` of an id, and whether slots may be those of ids of ``members``.

    A bitmap of at most FILTER_BITS hashed ids, built by an aggregate and broadcast. ``among`` is
    never false for a member. It keeps rows that cannot join out of a shuffle and is no substitute
    for the join: more ids than bits only let more rows through.
    """
    spark = members.sparkSession
    count = members.count()
    bits = 1 << 16
    while bits < min(FILTER_BITS, 32 * count):
        bits *= 2
    slot = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(bits))
    words = (
        members.select(slot(F.col(column)).alias("s"))
        .groupBy(F.shiftright("s", 5).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(s % 32))")).alias("b"))
        .toPandas()
    )
    table = np.zeros(bits // 32, np.uint32)
    table[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    held = spark.sparkContext.broadcast(table)
    return slot, lambda s: (held.value[s >> 5] >> (s & 31).astype(np.uint32) & 1).astype(bool)


def short_batches(spark: SparkSession) -> None:
    """Hands rows to Python in batches of ROWS_PER_BATCH at most: long texts make long batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > ROWS_PER_BATCH:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 17) -> DataFrame:
    """About ``rows`` rows, and never more than twice as many, chosen by a hash of ``key``.

    For fitting models only. The row count gives the share of hash values that pass, so nothing
    is sorted or shuffled whatever the size of the table.
    """
    total = df.count()
    share = min(1.0, rows / total) if total else 1.0
    place = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1_000_000_007))
    return df.filter(place <= int(share * 1_000_000_007)).limit(2 * rows)


def collected(df: DataFrame) -> list[Row]:
    """The rows of a bounded sample in an order that does not depend on the partitions."""
    return sorted(df.collect(), key=repr)
