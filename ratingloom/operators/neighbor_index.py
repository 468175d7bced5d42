"""Nearest neighbours through an inverted file: lists of vectors around centres, searched by multi-probe.

Centres come from k-means on a bounded sample; every vector goes to the list of its nearest centre.
A query visits the lists of its ``probes`` nearest centres. The number of probes is chosen so that a
sample of queries reaches the wanted recall against all rows. An exact search adds a second stage:
with r the distance of the last neighbour found so far, a list of radius R around a centre at
distance c can only hold a better one if c - R <= r, and exactly those lists are visited as well.

Equal vectors are one entry of the index. Of the ids that share a vector only the k + 1 smallest can
be in anybody's k nearest, so a vector with very many copies costs no more than others, and what is
found for it goes to every copy by a join. Long lists and the queries that visit them are cut into
fragments; one task holds one fragment of each.

An exact search visits FIRST_LISTS lists at most before the second stage, whatever the probes: they
only have to give the distance r. In the second stage neighbouring lists lie on shelves of about
SHELF_ROWS members. A query goes once to each shelf with a list that may hold a better neighbour and
brings back only members that reach the r it came with, so vectors moved grow with items x shelves,
not items x lists, and rows found hardly exceed the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.operators.block_join import block_join, piece_rows, slices
from ratingloom.operators.nearest import METRICS, SIM_DIGITS, best_per_row
from ratingloom.operators.skew import fragment_join
from ratingloom.session import durable

LISTS = 65_536  # at most; the centres travel as one array
ROWS_PER_CENTRE = 64  # sample rows k-means sees for every centre
FRAGMENT_ROWS = 2_048
FIRST_LISTS = 4  # lists an exact search visits to find its first bound
SHELF_ROWS = 32_768
TILE_CELLS = 4_000_000  # numbers in one matrix of a task
SLICE_CELLS = 250_000  # of one that decides which rows are sent on
SAMPLE_QUERIES = 512
KMEANS_STEPS = 8
MARGIN = 2 * 10.0**-SIM_DIGITS  # similarities are compared by their digits


@dataclass
class NeighborIndex:
    """``members`` (_list, _id, _vec), at most ``copies`` ids per vector; ``rows`` (_id, _key) of every indexed row.

    ``vectors`` (_key, _vec) holds each distinct vector once. ``centres``, ``radii`` and ``sizes``
    describe the lists, at most LISTS of them.
    """

    members: DataFrame
    rows: DataFrame
    vectors: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    metric: str
    copies: int


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) if len(values) else np.zeros((0, 0))


def _gaps(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2.0 * (vectors @ centres.T)
    return np.sqrt(np.maximum(squares, 0.0))


def build_index(
    embeddings: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "item_id",
    vector_col: str = "embedding",
    lists: int | None = None,
    seed: int = 42,
) -> NeighborIndex:
    """An index for up to ``k`` neighbours, of every row with a vector without null or NaN.

    ``lists`` defaults to the square root of the number of distinct vectors. k-means sees
    ROWS_PER_CENTRE rows for each of them, chosen by a hash.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark = embeddings.sparkSession
    vec = F.transform(vector_col, lambda x: x.cast("double"))
    usable = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x))
    rows = embeddings.select(F.col(id_col).cast("string").alias("_id"), vec.alias("_vec")).where(F.col("_vec").isNotNull() & usable)
    key = F.struct(F.xxhash64("_vec").alias("a"), F.xxhash64(F.lit(seed), "_vec").alias("b"))
    rows = durable(rows.withColumn("_key", key))
    shape = rows.agg(F.min(F.size("_vec")).alias("least"), F.max(F.size("_vec")).alias("most")).first()
    if shape["least"] != shape["most"]:
        raise ValueError(f"vectors of {shape['least']} to {shape['most']} entries: all need one length")
    # the limit is taken in every task before the shuffle, so a hot vector sends k + 1 rows each
    smallest = Window.partitionBy("_key").orderBy("_id")
    kept = durable(rows.withColumn("_copy", F.row_number().over(smallest)).where(F.col("_copy") <= k + 1))
    vectors = kept.where("_copy = 1").select("_key", "_vec")
    n = vectors.count()
    dim = max(1, shape["most"] or 0)
    lists = max(1, min(LISTS, lists or int(np.ceil(np.sqrt(n))), n))
    centres = _fit_centres(vectors, n, lists, metric, seed) if lists > 1 else np.zeros((1, dim))
    held = spark.sparkContext.broadcast(centres)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(held.value), TILE_CELLS):
            points = _matrix(batch.column("_vec"))
            gaps = _gaps(_unit(points) if metric == "cosine" else points, held.value)
            nearest = gaps.argmin(1)
            columns = [pa.array(nearest.astype(np.int32)), pa.array(gaps[np.arange(len(gaps)), nearest]), batch.column("_id"), batch.column("_vec")]
            yield pa.RecordBatch.from_arrays(columns, names=["_list", "_gap", "_id", "_vec"])

    members = durable(kept.select("_id", "_vec").mapInArrow(place, "_list int, _gap double, _id string, _vec array<double>"))
    radii, sizes = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in members.groupBy("_list").agg(F.max("_gap").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radii[r["_list"]], sizes[r["_list"]] = r["r"], r["n"]
    return NeighborIndex(members.drop("_gap"), rows.select("_id", "_key"), vectors, centres, radii, sizes, metric, k + 1)


def _fit_centres(vectors: DataFrame, n: int, lists: int, metric: str, seed: int) -> np.ndarray:
    wanted = lists * ROWS_PER_CENTRE
    place = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(1_000_000_007))
    sample = vectors.where(place <= int(min(1.0, wanted / n) * 1_000_000_007)).limit(2 * wanted)
    points = F.col("_vec")
    if metric == "cosine":
        length = F.sqrt(F.aggregate(points, F.lit(0.0), lambda s, x: s + x * x))
        points = F.transform(points, lambda x: F.when(length > 0, x / length).otherwise(x))
    features = durable(sample.select(array_to_vector(points).alias("features")))
    model = KMeans(k=lists, seed=seed, maxIter=KMEANS_STEPS, initMode="random").fit(features)
    return np.array(model.clusterCenters())


def _visited(index: NeighborIndex, queries: DataFrame, probes: int) -> DataFrame:
    """``queries`` (_key, _vec) with ``_lists``: the non-empty lists of the nearest centres, nearest first."""
    full = np.flatnonzero(index.sizes)
    held = index.members.sparkSession.sparkContext.broadcast((index.centres[full], full.astype(np.int32)))
    metric, probes = index.metric, min(probes, len(full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, names = held.value
        for batch in slices(batches, len(names), TILE_CELLS):
            points = _matrix(batch.column("_vec"))
            gaps = _gaps(_unit(points) if metric == "cosine" else points, centres)
            near = np.argpartition(gaps, probes - 1, axis=1)[:, :probes] if probes < gaps.shape[1] else np.tile(np.arange(gaps.shape[1]), (len(gaps), 1))
            near = np.take_along_axis(near, np.take_along_axis(gaps, near, 1).argsort(1, kind="stable"), 1)
            found = pa.ListArray.from_arrays(np.arange(len(near) + 1, dtype=np.int32) * probes, pa.array(names[near].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_vec"), found], names=["_key", "_vec", "_lists"])

    return queries.select("_key", "_vec").mapInArrow(run, "_key struct<a:long,b:long>, _vec array<double>, _lists array<int>")


def _similarity(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return _unit(left) @ _unit(right).T
    return 1.0 / (1.0 + _gaps(left, right))


def _search_lists(index: NeighborIndex, visits: DataFrame) -> DataFrame:
    """(_key, neighbor, sim, _list): the ``copies`` best members of every list a query visits.

    ``visits`` (_key, _vec, _list).
    """
    metric, best = index.metric, index.copies

    def tile(name: int, ask: pa.Table, own: pa.Table) -> pa.Table:
        own = own.sort_by("_id")
        sims = np.round(_similarity(_matrix(ask.column("_vec")), _matrix(own.column("_vec")), metric), SIM_DIGITS) + 0.0
        row, col = best_per_row(sims, best, own=False)
        return pa.table(
            {
                "_key": ask.column("_key").combine_chunks().take(pa.array(row)),
                "neighbor": own.column("_id").combine_chunks().take(pa.array(col)),
                "sim": pa.array(sims[row, col]),
                "_list": pa.array(np.full(len(row), name), pa.int32()),
            }
        )

    schema = "_key struct<a:long,b:long>, neighbor string, sim double, _list int"
    return block_join(visits, index.members, "_list", "_key", "_id", tile, schema, FRAGMENT_ROWS)


def _best(partial: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("_key").orderBy(F.col("sim").desc(), F.col("neighbor").asc())
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def choose_probes(index: NeighborIndex, recall: float, sample: int = SAMPLE_QUERIES, seed: int = 7) -> int:
    """The smallest number of probes with which a sample of queries finds ``recall`` of its true neighbours.

    The sample, at most twice ``sample`` distinct vectors, is compared with all members, so the cost
    is linear in the items.
    """
    n = index.vectors.count()
    full = int((index.sizes > 0).sum())
    if full <= 1:
        return 1
    place = F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(1_000_000_007))
    chosen = index.vectors.where(place <= int(min(1.0, sample / n) * 1_000_000_007)).limit(2 * sample)
    seen = durable(_visited(index, chosen, full))
    found = _best(_search_lists(index, seen.select("_key", "_vec", F.explode("_lists").alias("_list"))), index.copies)
    at = found.join(seen.select("_key", "_lists"), "_key").select(F.array_position("_lists", F.col("_list")).cast("int").alias("at"))
    counts = {r["at"]: r["count"] for r in at.groupBy("at").count().collect()}  # at most LISTS rows
    total, held = sum(counts.values()), 0
    for probes in range(1, full + 1):
        held += counts.get(probes, 0)
        if held >= recall * total:
            return probes
    return full


def search(index: NeighborIndex, k: int, probes: int, exact: bool = False, queries: DataFrame | None = None) -> DataFrame:
    """``(item, neighbor, rank, sim)``: k neighbours of every indexed row, or of the rows of ``queries`` (_id).

    Ordered and rounded as ``nearest.item_neighbors``. With ``exact`` the result equals it.
    """
    if k >= index.copies:
        raise ValueError(f"the index holds {index.copies - 1} neighbours, not {k}")
    asked = index.rows if queries is None else index.rows.join(queries.select("_id").distinct(), "_id", "left_semi")
    if not index.sizes.any():
        return asked.select(F.col("_id").alias("item"), F.lit("").alias("neighbor"), F.lit(1).alias("rank"), F.lit(0.0).alias("sim")).limit(0)
    probes = min(probes, FIRST_LISTS) if exact else probes
    vectors = index.vectors if queries is None else index.vectors.join(asked.select("_key").distinct(), "_key", "left_semi")
    seen = durable(_visited(index, vectors, probes))
    partial = _search_lists(index, seen.select("_key", "_vec", F.explode("_lists").alias("_list")))
    partial = partial.drop("_list")
    if exact:
        partial = durable(partial)
        last = _best(partial, index.copies).where(F.col("rank") == index.copies).select("_key", F.col("sim").alias("_last"))
        rows = piece_rows(int(index.sizes.sum()), FRAGMENT_ROWS, SHELF_ROWS)
        shelves = _shelves(index.centres, index.sizes, rows)
        more = durable(_undecided(index, seen.join(last, "_key", "left"), shelves))
        partial = partial.unionByName(_search_shelves(index, more, shelves, rows))
    found = _best(partial, index.copies).groupBy("_key").agg(F.collect_list(F.struct("rank", "neighbor", "sim")).alias("_found"))
    # every copy of a vector gets its list, without itself
    per_row = fragment_join(asked, found, ["_key"], ["_id"])
    others = F.filter(F.array_sort("_found"), lambda e: e["neighbor"] != F.col("_id"))
    return per_row.select(F.col("_id").alias("item"), F.posexplode(F.slice(others, 1, k)).alias("pos", "e")).select(
        "item", F.col("e.neighbor").alias("neighbor"), (F.col("pos") + 1).alias("rank"), F.col("e.sim").alias("sim")
    )


def _shelves(centres: np.ndarray, sizes: np.ndarray, rows: int) -> np.ndarray:
    """A shelf number for every list: lists are halved along the axis on which they differ most until ``rows`` members are left."""
    shelves, number, todo = np.zeros(len(sizes), np.int32), 0, [np.arange(len(sizes))]
    while todo:
        part = todo.pop()
        if len(part) == 1 or sizes[part].sum() <= rows:
            shelves[part], number = number, number + 1
            continue
        part = part[np.argsort(centres[part, centres[part].var(0).argmax()], kind="stable")]
        half = int(np.searchsorted(np.cumsum(sizes[part]), sizes[part].sum() / 2))
        half = min(max(half, 1), len(part) - 1)
        todo += [part[:half], part[half:]]
    return shelves


def _undecided(index: NeighborIndex, queries: DataFrame, shelves: np.ndarray) -> DataFrame:
    """``queries`` (_key, _vec, _lists, _last) by ``_shelf``: those with a list not visited yet that may hold a better neighbour."""
    full = np.flatnonzero(index.sizes)
    order = full[np.argsort(shelves[full], kind="stable")]  # the lists of a shelf beside one another
    numbers, begins = np.unique(shelves[order], return_index=True)
    place = np.full(len(shelves), -1)
    place[order] = np.arange(len(order))
    held = index.members.sparkSession.sparkContext.broadcast((index.centres[order], index.radii[order], place, numbers.astype(np.int32), begins))
    metric = index.metric

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, place, numbers, begins = held.value
        for batch in slices(batches, len(centres), SLICE_CELLS):
            points = _matrix(batch.column("_vec"))
            gaps = _gaps(_unit(points) if metric == "cosine" else points, centres)
            last = batch.column("_last").to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
            with np.errstate(divide="ignore", invalid="ignore"):
                least = last - MARGIN
                reach = np.sqrt(np.maximum(2.0 - 2.0 * least, 0.0)) if metric == "cosine" else np.where(least > 0, 1.0 / least - 1.0, np.inf)
            reach = np.where(np.isnan(last), np.inf, reach)
            dust = 1e-6 * (1.0 + np.linalg.norm(points, axis=1, keepdims=True))  # rounding of the distances
            open_ = gaps - radii[None, :] <= reach[:, None] + dust
            lists = batch.column("_lists")
            open_[np.repeat(np.arange(len(gaps)), lists.value_lengths().to_numpy()), place[lists.flatten().to_numpy()]] = False
            row, col = np.nonzero(np.logical_or.reduceat(open_, begins, axis=1))
            columns = [batch.column(c).take(pa.array(row)) for c in ("_key", "_vec", "_lists", "_last")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers[col])], names=["_key", "_vec", "_lists", "_last", "_shelf"])

    schema = "_key struct<a:long,b:long>, _vec array<double>, _lists array<int>, _last double, _shelf int"
    return queries.select("_key", "_vec", "_lists", "_last").mapInArrow(run, schema)


def _search_shelves(index: NeighborIndex, asks: DataFrame, shelves: np.ndarray, side_rows: int) -> DataFrame:
    """(_key, neighbor, sim): per shelf a query asks, at most ``copies`` best members outside its ``_lists`` that reach ``_last``."""
    metric, best, spark = index.metric, index.copies, index.members.sparkSession
    names = spark.createDataFrame([(n, int(shelf)) for n, shelf in enumerate(shelves)], "_list int, _shelf int")
    members = index.members.join(F.broadcast(names), "_list")  # at most LISTS short rows

    def tile(_shelf: int, ask: pa.Table, own: pa.Table) -> pa.Table:
        own = own.sort_by("_id")
        vectors, ids = _matrix(own.column("_vec")), own.column("_id").combine_chunks()
        of = own.column("_list").to_numpy()
        here = {name: np.flatnonzero(of == name) for name in np.unique(of)}
        rows, cols, values = [], [], []
        step = max(1, TILE_CELLS // len(own))
        for start in range(0, len(ask), step):
            part = ask.slice(start, step)
            sims = _similarity(_matrix(part.column("_vec")), vectors, metric)
            for row, lists in enumerate(part.column("_lists").to_pylist()):
                for name in lists:
                    if name in here:
                        sims[row, here[name]] = -np.inf
            last = part.column("_last").to_numpy().astype(np.float64)
            floor = np.where(np.isnan(last), -np.inf, last - MARGIN)
            many = np.flatnonzero((sims >= floor[:, None]).sum(1) > best)
            if len(many):
                place = sims.shape[1] - best
                floor[many] = np.maximum(floor[many], np.partition(sims[many], place, axis=1)[:, place] - MARGIN)
            row, col = np.nonzero(sims >= floor[:, None])
            value = np.round(sims[row, col], SIM_DIGITS) + 0.0
            order = np.lexsort((col, -value, row))
            row, col, value = row[order], col[order], value[order]
            keep = (np.arange(len(row)) - np.searchsorted(row, row) < best) & np.isfinite(value)
            rows.append(row[keep] + start)
            cols.append(col[keep])
            values.append(value[keep])
        row, col = np.concatenate(rows), np.concatenate(cols)
        return pa.table(
            {
                "_key": ask.column("_key").combine_chunks().take(pa.array(row)),
                "neighbor": ids.take(pa.array(col)),
                "sim": pa.array(np.concatenate(values)),
            }
        )

    schema = "_key struct<a:long,b:long>, neighbor string, sim double"
    return block_join(asks, members.select("_shelf", "_list", "_id", "_vec"), "_shelf", "_key", "_id", tile, schema, side_rows)


def indexed_neighbors(
    embeddings: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "item_id",
    vector_col: str = "embedding",
    recall: float = 0.95,
    probes: int | None = None,
    exact: bool = False,
    lists: int | None = None,
) -> DataFrame:
    """``(item, neighbor, rank, sim)`` of every item through an index.

    ``recall`` chooses the probes unless ``probes`` names them. ``exact`` makes the result equal to
    ``nearest.item_neighbors``; the probes then only decide how much the second stage has left to do.
    """
    index = build_index(embeddings, k, metric, id_col, vector_col, lists)
    return search(index, k, probes or choose_probes(index, recall), exact)
