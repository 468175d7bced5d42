"""Rows that ask for a block, and the members of the block, side by side in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Tile = Callable[[int, pa.Table, pa.Table], pa.Table]


SIDES = 8  # a side is at least cut into so many pieces before they grow to their full size


def slices(batches: Iterator[pa.RecordBatch], columns: int, cells: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces over which a matrix of so many columns stays within ``cells``."""
    rows = max(1, cells // max(1, columns))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def piece_rows(rows: int, least: int, most: int) -> int:
    """Rows of a piece: few enough to keep tasks busy with a small table, bounded for a large one."""
    return min(most, max(least, -(-rows // SIDES)))


def block_join(
    asks: DataFrame, members: DataFrame, block: str, ask_id: str, member_id: str, tile: Tile, schema: str, side_rows: int
) -> DataFrame:
    """``tile(block, asking rows, members)`` for every pair of pieces of a block that is asked for.

    A block with many members or many asking rows is cut into pieces of about ``side_rows`` by a hash
    of the ids, so no task holds more than two pieces however often a block is asked for. Both
    tables are read twice: hand over computed ones. There is one broadcast row per block; blocks are few.
    """
    pieces = lambda rows: F.ceil(F.count(F.lit(1)) / F.lit(side_rows)).cast("int").alias(rows)
    cuts = F.broadcast(members.groupBy(block).agg(pieces("_parts")).join(asks.groupBy(block).agg(pieces("_groups")), block))
    place = lambda row_id, n: F.pmod(F.xxhash64(row_id), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def side(df: DataFrame, name: str, other: DataFrame, other_name: str) -> DataFrame:
        other_type = other.select(F.struct(*other.columns)).schema[0].dataType
        row, nothing = F.struct(*df.columns).alias(name), F.lit(None).cast(other_type).alias(other_name)
        both = {name: row, other_name: nothing}
        of = df.join(cuts, block)
        if name == "_ask":
            of = of.withColumn("_group", place(ask_id, "_groups")).withColumn("_part", every("_parts"))
        else:
            of = of.withColumn("_part", place(member_id, "_parts")).withColumn("_group", every("_groups"))
        return of.select(F.col(block).alias("_block"), "_part", "_group", both["_ask"], both["_own"])

    out = StructType.fromDDL(schema)

    def run(table: pa.Table) -> pa.Table:
        asking, own = table.column("_ask"), table.column("_own")
        if len(table) in (asking.null_count, own.null_count):  # a piece that the hash left without one side
            return to_arrow_schema(out).empty_table()
        rows_of = lambda column: pa.Table.from_struct_array(column.drop_null().combine_chunks())
        return tile(table.column("_block")[0].as_py(), rows_of(asking), rows_of(own))

    return (
        side(asks, "_ask", members, "_own")
        .unionByName(side(members, "_own", asks, "_ask"))
        .groupBy("_block", "_part", "_group")
        .applyInArrow(run, schema)
    )
