"""Exact nearest neighbours between vectors, tile by tile.

Vectors are dealt into blocks by a hash of their id. Each unordered pair of blocks is one
tile, handled by one task with a matrix product, and only the k best rows per item leave
the tile. No pair of items is ever written as a row, no tile exceeds two blocks, and equal
vectors (copies) spread over blocks like any others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.functions.vectors import cosine, squared_distance
from ratingloom.operators.block_join import piece_rows
from ratingloom.session import durable

BLOCK_ROWS = 2_048
SPARSE_BLOCK_ROWS = 512
TILE_ROWS = 32_768  # of a block, at most
BLOCK_NUMBERS = 4_000_000  # in the vectors of a block, about, at most
SIM_DIGITS = 6
METRICS = ("cosine", "euclidean")


def into_tiles(df: DataFrame, id_col: str, block_rows: int, rows: int | None = None) -> DataFrame:
    """Copy each row to the tiles of its block: ``_x <= _y`` name the tile, ``_side`` the block."""
    rows = df.count() if rows is None else rows
    blocks = max(1, -(-rows // block_rows))
    block = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int")
    return (
        df.withColumn("_side", block)
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("_x", F.least("_side", "_with"))
        .withColumn("_y", F.greatest("_side", "_with"))
        .drop("_with")
    )


def best_per_row(sims: np.ndarray, k: int, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and column positions of the k largest per row; earlier columns win ties."""
    if own:
        np.fill_diagonal(sims, -np.inf)
    k = min(k, sims.shape[1] - int(own))
    if k <= 0 or sims.shape[0] == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    floor = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
    row, col = np.nonzero(sims >= floor[:, None])
    order = np.lexsort((col, -sims[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = (place < k) & np.isfinite(sims[row, col])
    return row[keep], col[keep]


def dense_rows(table: pa.Table, column: str) -> np.ndarray:
    """The vectors of a column as a matrix; they must not be null and must agree in length."""
    values = table.column(column).combine_chunks()
    if not len(values):
        return np.empty((0, 0))
    sizes = np.diff(values.offsets.to_numpy())
    if values.null_count or sizes.min() != sizes.max():
        raise ValueError(f"vectors of {sizes.min()} to {sizes.max()} entries, {values.null_count} null: all need one length")
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _dense_similarity(a: pa.Table, b: pa.Table, metric: str) -> np.ndarray:
    left, right = dense_rows(a, "_vec"), dense_rows(b, "_vec")
    if len(left) and len(right) and left.shape[1] != right.shape[1]:
        raise ValueError(f"vectors of {left.shape[1]} and {right.shape[1]} entries: all need one length")
    if metric == "cosine":
        for m in (left, right):
            length = np.linalg.norm(m, axis=1, keepdims=True)
            np.divide(m, length, out=m, where=length > 0)
        return left @ right.T
    gap = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2.0 * (left @ right.T)
    return 1.0 / (1.0 + np.sqrt(np.maximum(gap, 0.0)))


def _sparse_similarity(a: pa.Table, b: pa.Table, _metric: str) -> np.ndarray:
    """Dot products of (index, weight) lists: rows of ``a`` against a term-major block of ``b``."""
    terms_b, inverse = np.unique(b.column("_idx").combine_chunks().flatten().to_numpy(), return_inverse=True)
    lists_b = b.column("_idx").combine_chunks()
    doc_b = np.repeat(np.arange(len(b)), np.diff(lists_b.offsets.to_numpy()))
    block = np.zeros((len(terms_b), len(b)))
    block[inverse, doc_b] = b.column("_val").combine_chunks().flatten().to_numpy()
    lists_a = a.column("_idx").combine_chunks()
    cuts = lists_a.offsets.to_numpy() - lists_a.offsets.to_numpy()[0]
    idx = lists_a.flatten().to_numpy()
    val = a.column("_val").combine_chunks().flatten().to_numpy()
    out = np.zeros((len(a), len(b)))
    if not len(terms_b):
        return out
    at = np.minimum(np.searchsorted(terms_b, idx), len(terms_b) - 1)
    shared = terms_b[at] == idx
    for row in range(len(a)):
        part = slice(cuts[row], cuts[row + 1])
        hit = shared[part]
        out[row] = val[part][hit] @ block[at[part][hit]]
    return out


def _best_of(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, column, value) found in several pieces the k largest per row; earlier columns win ties."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, col, value = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((col, -value, row))
    row, col, value = row[order], col[order], value[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], col[kept], value[kept]


def _tile_neighbors(
    similarity: Callable[[pa.Table, pa.Table, str], np.ndarray], metric: str, k: int, piece: int
) -> Callable[[pa.Table], pa.Table]:
    """The k best on each side of a tile; ``piece`` x ``piece`` similarities are held at a time."""

    def run(tile: pa.Table) -> pa.Table:
        x, y = tile.column("_x")[0].as_py(), tile.column("_y")[0].as_py()
        tile = tile.sort_by("_id")
        side = tile.column("_side").to_numpy()
        a = tile.filter(pa.array(side == x))
        b = a if x == y else tile.filter(pa.array(side == y))
        of_a: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        of_b = of_a if x == y else []
        for i in range(0, len(a), piece):
            for j in range(i if x == y else 0, len(b), piece):
                sims = np.round(similarity(a.slice(i, piece), b.slice(j, piece), metric), SIM_DIGITS) + 0.0
                sims[np.isnan(sims)] = -np.inf  # a vector with NaN is nobody's neighbour
                own = x == y and i == j
                row, col = best_per_row(sims, k, own)
                of_a.append((row + i, col + j, sims[row, col]))
                if not own:
                    turned = np.ascontiguousarray(sims.T)
                    row, col = best_per_row(turned, k, False)
                    of_b.append((row + j, col + i, turned[row, col]))
            for found in (of_a, of_b):
                found[:] = [_best_of(found, k)]
        parts = []
        for rows, cols, found in [(a, b, of_a)] if x == y else [(a, b, of_a), (b, a, of_b)]:
            row, col, value = _best_of(found, k)
            parts.append(
                pa.table(
                    {
                        "item": rows.column("_id").take(pa.array(row)).cast(pa.string()),
                        "neighbor": cols.column("_id").take(pa.array(col)).cast(pa.string()),
                        "sim": pa.array(value, pa.float64()),
                    }
                )
            )
        return pa.concat_tables(parts).combine_chunks()

    return run


def block_size(rows: int, numbers: int, least: int) -> int:
    """Rows of a block for ``rows`` vectors of ``numbers`` numbers in all.

    A vector is copied once per block and has k rows per block in the merge, so blocks grow with the
    table until one holds BLOCK_NUMBERS numbers or TILE_ROWS rows.
    """
    most = min(TILE_ROWS, BLOCK_NUMBERS * rows // max(1, numbers))
    return piece_rows(rows, least, max(least, most))


def _merge(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("sim").desc(), F.col("neighbor").asc())
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item", "neighbor", "rank", "sim")
    )


def item_neighbors(
    embeddings: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "item_id",
    vector_col: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """``(item, neighbor, rank, sim)``: the k nearest other items of every item.

    sim is the cosine, or 1 / (1 + distance) for the euclidean metric, to six digits; ties
    go to the smaller id. The item itself is left out by id, not by position, and k is
    limited by the number of other items. An item whose vector is null is nobody's neighbour
    and has none; vectors of different lengths are an error. Blocks have ``block_rows`` vectors, by
    default as many as ``block_size`` says.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    vectors = embeddings.select(F.col(id_col).cast("string").alias("_id"), F.col(vector_col).alias("_vec"))
    vectors = vectors.where("_vec IS NOT NULL")
    rows, numbers = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_vec")), F.lit(0))).first()
    tiles = into_tiles(vectors, "_id", block_rows or block_size(rows, numbers, BLOCK_ROWS), rows)
    partial = tiles.groupBy("_x", "_y").applyInArrow(
        _tile_neighbors(_dense_similarity, metric, k, BLOCK_ROWS), "item string, neighbor string, sim double"
    )
    return _merge(partial, k)


def sparse_neighbors(
    weights: DataFrame,
    k: int,
    id_col: str = "doc_id",
    index_col: str = "indices",
    value_col: str = "values",
    block_rows: int | None = None,
) -> DataFrame:
    """Cosine neighbours of unit-length sparse rows ``(id, indices, values)``.

    A frequent term costs a row of a block matrix, not a list of document pairs.
    """
    rows = weights.select(
        F.col(id_col).cast("string").alias("_id"),
        F.col(index_col).cast("array<bigint>").alias("_idx"),
        F.col(value_col).cast("array<double>").alias("_val"),
    )
    rows = durable(rows)
    n, numbers = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_idx")), F.lit(0))).first()
    tiles = into_tiles(rows, "_id", block_rows or block_size(n, numbers, SPARSE_BLOCK_ROWS), n)
    partial = tiles.groupBy("_x", "_y").applyInArrow(
        _tile_neighbors(_sparse_similarity, "cosine", k, SPARSE_BLOCK_ROWS), "item string, neighbor string, sim double"
    )
    return _merge(partial, k)


def vector_neighbors(vectors: DataFrame, k: int, id_col: str = "item_id") -> DataFrame:
    """Cosine neighbours of any embedder's rows: an array ``embedding``, or sparse ``indices`` and ``values``."""
    if "embedding" in vectors.columns:
        return item_neighbors(vectors, k, "cosine", id_col)
    return sparse_neighbors(vectors, k, id_col)


def query_neighbors(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    id_col: str = "item_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Nearest items of a handful of query items, e.g. a retrieval demo.

    The query rows travel as one small array; each item row meets each query in place.
    """
    wanted = queries.agg(
        F.collect_list(F.struct(F.col(id_col).cast("string").alias("item"), F.col(vector_col).alias("vec")))
    )
    similarity = (
        (lambda a, b: cosine(a, b))
        if metric == "cosine"
        else (lambda a, b: 1.0 / (1.0 + F.sqrt(squared_distance(a, b))))
    )
    scored = (
        embeddings.withColumn("_q", F.explode(wanted.scalar()))
        .where(F.col("_q.item") != F.col(id_col).cast("string"))
        .select(
            F.col("_q.item").alias("item"),
            F.col(id_col).cast("string").alias("neighbor"),
            F.round(similarity(F.col("_q.vec"), F.col(vector_col)), SIM_DIGITS).alias("sim"),
        )
    )
    return _merge(scored, k)
