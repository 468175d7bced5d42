"""User profiles, robust scaling, k-means, cluster quality and cluster profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, ByteType, DataType, DoubleType, IntegerType, StructField, StructType

from ratingloom.functions.vectors import cosine, squared_distance
from ratingloom.operators.block_join import block_join, piece_rows, slices
from ratingloom.operators.nearest import BLOCK_ROWS, dense_rows
from ratingloom.operators.sampling import key_hash, sample_exact
from ratingloom.operators.skew import exact_quantiles, number_in_order
from ratingloom.operators.wide_components import COLUMN_BLOCK, blocked_components
from ratingloom.schemas import ITEM, RATING, USER
from ratingloom.session import durable


CLUSTER_ROWS = 32_768  # of a piece of clusters, at most
DISTANCES = 4_000_000  # in one matrix of a task
SLICE_CELLS = 250_000  # of a matrix that decides which rows are sent on


# --- profiles and scaling -------------------------------------------------------------


def robust_scale(cells: DataFrame, users: DataFrame, fallback: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """Every stored cell scaled by its item's median and interquartile range.

    ``cells`` are the stored predictions; each of the remaining users holds ``fallback`` (a
    one-row table) on that item. Those cells enter the quantiles as one weighted value, so
    the result equals scaling the dense matrix. Columns: ``scaled`` for the stored cell and
    ``base``, the scaled fallback, which is what the cells left out would hold. A zero
    range divides by 1.
    """
    cells = durable(cells.select(user, item, "pred"))
    n_users = users.agg(F.countDistinct(user)).scalar()
    stored = cells.groupBy(item).agg(F.count(F.lit(1)).alias("_have"))
    filler = (
        stored.withColumn("_weight", n_users - F.col("_have"))
        .withColumn("pred", fallback.scalar())
        .where(F.col("_weight") > 0)
        .select(item, "pred", "_weight")
    )
    values = cells.select(item, "pred", F.lit(1).cast("long").alias("_weight")).unionByName(filler)
    quartiles = exact_quantiles(values, "pred", (0.25, 0.5, 0.75), [item], F.col("_weight"))
    spread = F.col("q2") - F.col("q0")
    centers = quartiles.select(
        item, F.col("q1").alias("_mid"), F.when(spread > 1e-12, spread).otherwise(F.lit(1.0)).alias("_range")
    )
    return (
        cells.join(centers, item)
        .withColumn("_fallback", fallback.scalar())
        .select(
            user,
            item,
            ((F.col("pred") - F.col("_mid")) / F.col("_range")).alias("scaled"),
            ((F.col("_fallback") - F.col("_mid")) / F.col("_range")).alias("base"),
        )
    )


# A vector column is stored as this struct; type 0 is sparse, 1 dense.
STORED_VECTOR = (
    StructType()
    .add("type", ByteType())
    .add("size", IntegerType())
    .add("indices", ArrayType(IntegerType()))
    .add("values", ArrayType(DoubleType()))
)


def _retyped(df: DataFrame, column: str, kind: DataType) -> DataFrame:
    """``df`` written and read back with another type of the same layout for ``column``."""
    return durable(df, StructType([StructField(f.name, kind if f.name == column else f.dataType) for f in df.schema]))


def user_profiles(scaled: DataFrame, users: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    """``(user, features)``: each user's scaled row, relative to the row of a user without cells.

    Subtracting the same base row from every profile moves all of them alike. Distances,
    and with them k-means, silhouette and principal components, stay what they are on the
    dense matrix, while a profile keeps only as many entries as the user has cells.
    """
    scaled = durable(scaled)
    positions = number_in_order(scaled, item)
    size = scaled.agg(F.countDistinct(item)).first()[0]
    entries = (
        scaled.join(positions, item)
        .select(user, F.struct(F.col("pos").cast("int").alias("i"), (F.col("scaled") - F.col("base")).alias("x")).alias("e"))
        .groupBy(user)
        .agg(F.array_sort(F.collect_list("e")).alias("e"))
    )
    empty = F.array().cast("array<struct<i:int,x:double>>")
    full = (
        users.select(user).distinct().join(entries, user, "left").select(user, F.coalesce("e", empty).alias("e"))
    )
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.col("e.i").alias("indices"),
        F.col("e.x").alias("values"),
    )
    return _retyped(full.select(user, stored.alias("features")), "features", VectorUDT())


def dense_features(embeddings: DataFrame, id_col: str = "item_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, features)`` from an array column."""
    return embeddings.select(
        id_col, array_to_vector(F.transform(vector_col, lambda x: x.cast("double"))).alias("features")
    )


# --- k-means --------------------------------------------------------------------------


def best_kmeans(features: DataFrame, k: int, seed: int = 42, restarts: int = 10, max_iter: int = 50) -> KMeansModel:
    """The k-means model with the lowest inertia among ``restarts`` seeded starts."""
    best = None
    for start in range(restarts):
        model = KMeans(k=k, seed=seed + start, maxIter=max_iter, initMode="k-means||").fit(features)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


def assign_clusters(model: KMeansModel, features: DataFrame, id_col: str) -> DataFrame:
    return model.transform(features).select(id_col, "features", F.col("prediction").alias("cluster"))


def kmeans_step(
    points: DataFrame,
    centroids: DataFrame,
    id_col: str = "item_id",
    vector_col: str = "embedding",
    cluster_col: str = "cluster",
) -> tuple[DataFrame, DataFrame]:
    """One Lloyd iteration: ``(id, cluster)`` and ``(cluster, pos, value)`` of the new centroids.

    ``centroids`` (cluster, embedding) is a handful of rows and travels as one array value;
    ties go to the smaller cluster number.
    """
    held = centroids.agg(
        F.array_sort(F.collect_list(F.struct(F.col(cluster_col).alias("c"), F.col(vector_col).alias("v"))))
    )
    nearest = F.array_min(
        F.transform(
            "_cents",
            lambda c: F.struct(
                F.round(squared_distance(F.col(vector_col), c["v"]), 12).alias("d"), c["c"].alias("c")
            ),
        )
    )["c"]
    assigned = points.withColumn("_cents", held.scalar()).select(
        id_col, nearest.alias(cluster_col), vector_col
    )
    moved = mean_by_cluster(assigned, cluster_col, vector_col)
    return assigned.select(id_col, cluster_col), moved


def mean_by_cluster(points: DataFrame, cluster_col: str = "cluster", vector_col: str = "embedding") -> DataFrame:
    """``(cluster, pos, value)``: the mean of every dimension per cluster."""
    return (
        points.select(cluster_col, F.posexplode(vector_col).alias("pos", "x"))
        .groupBy(cluster_col, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("value"))
    )


def centroid_table(means: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """``(cluster, embedding)`` from the long form: one row per cluster."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return means.groupBy(cluster_col).agg(F.transform(ordered, lambda e: e["value"]).alias("embedding"))


# --- cluster quality ------------------------------------------------------------------


def inertia(points: DataFrame, cluster_col: str = "cluster", vector_col: str = "embedding") -> DataFrame:
    """Sum of squared distances to the cluster means, in one pass over the entries."""
    per_dim = (
        points.select(cluster_col, F.posexplode(vector_col).alias("pos", "x"))
        .groupBy(cluster_col, "pos")
        .agg((F.var_pop(F.col("x").cast("double")) * F.count("x")).alias("_ss"))
    )
    return per_dim.agg(F.sum("_ss").alias("inertia"))


@dataclass
class ClusterBalls:
    """Label, size, mean and mean squared distance from the mean of every cluster, in label order.

    They travel as one array: clusters x dimensions numbers, however many points there are.
    """

    labels: np.ndarray
    sizes: np.ndarray
    means: np.ndarray
    spreads: np.ndarray


def _labelled(points: DataFrame, id_col: str, vector_col: str, cluster_col: str) -> DataFrame:
    vec = F.transform(vector_col, lambda x: x.cast("double"))
    return points.select(F.col(id_col).cast("string").alias("_id"), vec.alias("_vec"), F.col(cluster_col).cast("int").alias("_label")).where(
        "_vec IS NOT NULL"
    )


def cluster_balls(rows: DataFrame) -> ClusterBalls:
    """The balls of rows (_vec, _label)."""
    means = centroid_table(mean_by_cluster(rows, "_label", "_vec"), "_label")
    squares = F.aggregate("_vec", F.lit(0.0), lambda s, x: s + x * x)
    sizes = rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n"), F.avg(squares).alias("sq"))
    held = sorted(means.join(sizes, "_label").collect(), key=lambda r: r["_label"])
    centres = np.array([r["embedding"] for r in held]).reshape(len(held), -1)
    raw = np.array([r["sq"] for r in held])
    # the last term covers the rounding of the difference
    spreads = np.maximum(raw - (centres**2).sum(1), 0.0) + 1e-9 * raw
    return ClusterBalls(np.array([r["_label"] for r in held], np.int64), np.array([r["n"] for r in held], np.int64), centres, spreads)


def cluster_shelves(balls: ClusterBalls, rows: int) -> np.ndarray:
    """A number for every cluster: small ones share one up to ``rows`` members, a larger one has its own."""
    shelves, number, held = np.zeros(len(balls.sizes), np.int32), 0, 0
    for n, size in enumerate(balls.sizes):
        if held and held + size > rows:
            number, held = number + 1, 0
        shelves[n], held = number, held + size
    return shelves


def undecided_clusters(rows: DataFrame, balls: ClusterBalls, block_rows: int) -> DataFrame:
    """(_id, _vec, _label, _shelf, _needs): the clusters whose mean distance from a point must be computed.

    The mean distance to the members of a cluster lies between the distance c to their mean and
    sqrt(c^2 + their mean squared distance from it). A point needs its own cluster and every other
    one whose lower bound does not exceed the smallest upper bound of the others. It has one row per
    shelf (``cluster_shelves``) with such clusters, which ``_needs`` lists.
    """
    held = rows.sparkSession.sparkContext.broadcast((balls, cluster_shelves(balls, block_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls, shelves = held.value
        for batch in slices(batches, len(balls.labels), SLICE_CELLS):
            x = dense_rows(pa.Table.from_batches([batch]), "_vec")
            own = np.searchsorted(balls.labels, batch.column("_label").to_numpy())
            squares = (x**2).sum(1)[:, None] + (balls.means**2).sum(1)[None, :] - 2.0 * (x @ balls.means.T)
            dust = 1e-9 * (1.0 + (x**2).sum(1))[:, None]
            low, high = np.sqrt(np.maximum(squares - dust, 0.0)), np.sqrt(np.maximum(squares, 0.0) + dust + balls.spreads)
            high[np.arange(len(x)), own] = np.inf
            need = low <= high.min(1)[:, None]
            need[np.arange(len(x)), own] = True
            row, col = np.nonzero(need)  # by row, then by label, and with it by shelf
            first = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(shelves[col], prepend=-1))
            needs = pa.ListArray.from_arrays(np.append(first, len(row)).astype(np.int32), pa.array(balls.labels[col].astype(np.int32)))
            columns = [batch.column(c).take(pa.array(row[first])) for c in ("_id", "_vec", "_label")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shelves[col[first]]), needs], names=["_id", "_vec", "_label", "_shelf", "_needs"])

    return rows.select("_id", "_vec", "_label").mapInArrow(run, "_id string, _vec array<double>, _label int, _shelf int, _needs array<int>")


SUMS = "id string, own int, other int, total double, n bigint"


def _distance_sums(_shelf: int, ask: pa.Table, own: pa.Table) -> pa.Table:
    """The summed distance of every asking point of a tile to the members of each cluster it needs."""
    needs = ask.column("_needs").combine_chunks()
    row, wanted = np.repeat(np.arange(len(ask)), needs.value_lengths().to_numpy()), needs.flatten().to_numpy()
    of, left = own.column("_label").to_numpy(), dense_rows(ask, "_vec")
    parts = []
    for label in np.unique(of):
        members = own.take(pa.array(np.flatnonzero(of == label)))
        right, ids = dense_rows(members, "_vec"), members.column("_id").combine_chunks()
        asking, step = row[wanted == label], max(1, DISTANCES // len(members))
        for start in range(0, len(asking), step):
            part = asking[start : start + step]
            x, named = left[part], ask.column("_id").take(pa.array(part))
            gap = (x**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2.0 * (x @ right.T)
            dist = np.sqrt(np.maximum(gap, 0.0))
            at = pc.index_in(named, value_set=ids).to_numpy()
            itself = np.flatnonzero(~np.isnan(at))
            dist[itself, at[itself].astype(np.int64)] = 0.0
            parts.append(
                pa.table(
                    {
                        "id": named,
                        "own": ask.column("_label").take(pa.array(part)),
                        "other": pa.array(np.full(len(part), label), pa.int32()),
                        "total": pa.array(dist.sum(1)),
                        "n": pa.array(np.full(len(part), len(members), np.int64)),
                    }
                )
            )
    if not parts:
        return to_arrow_schema(StructType.fromDDL(SUMS)).empty_table()
    return pa.concat_tables(parts)


def silhouette_samples(
    points: DataFrame,
    id_col: str = "item_id",
    vector_col: str = "embedding",
    cluster_col: str = "cluster",
    block_rows: int | None = None,
) -> DataFrame:
    """``(id, cluster, silhouette)`` with exact Euclidean distances; 0 in a cluster of one.

    Points without vector are left out. Every point meets its own cluster and the other clusters that
    bounds leave undecided, most often one (``silhouette_work`` counts them). A tile is a piece of some
    clusters and a piece of the points that need any of them; it emits one row per point and cluster,
    never one per pair of points. Pieces have ``block_rows`` rows, by default up to CLUSTER_ROWS, and a
    vector is copied once per piece, however many clusters its point needs there.
    """
    rows = durable(_labelled(points, id_col, vector_col, cluster_col))
    balls = cluster_balls(rows)
    block_rows = block_rows or piece_rows(int(balls.sizes.sum()), BLOCK_ROWS, CLUSTER_ROWS)
    asking = durable(undecided_clusters(rows, balls, block_rows))
    names = [(int(label), int(shelf)) for label, shelf in zip(balls.labels, cluster_shelves(balls, block_rows))]
    shelves = rows.sparkSession.createDataFrame(names, "_label int, _shelf int")
    members = rows.join(F.broadcast(shelves), "_label").select("_shelf", "_label", "_id", "_vec")  # one short row per cluster
    sums = (
        block_join(asking, members, "_shelf", "_id", "_id", _distance_sums, SUMS, block_rows)
        .groupBy("id", "own", "other")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    same = F.col("own") == F.col("other")
    scored = sums.groupBy("id", F.col("own").alias("cluster")).agg(
        F.max(F.when(same, F.col("n"))).alias("_size"),
        F.max(F.when(same, F.col("total"))).alias("_inside"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("_b"),
    )
    a = F.col("_inside") / (F.col("_size") - 1)
    value = F.when(F.greatest(a, F.col("_b")) > 0, (F.col("_b") - a) / F.greatest(a, F.col("_b")))  # equal points: 0
    return scored.select(
        "id", "cluster", F.when(F.col("_size") > 1, F.coalesce(value, F.lit(0.0))).otherwise(F.lit(0.0)).alias("silhouette")
    )


def silhouette_work(
    points: DataFrame, id_col: str = "item_id", vector_col: str = "embedding", cluster_col: str = "cluster"
) -> DataFrame:
    """``(cluster, members, needed_by, distances)``: points that need a cluster, and distances computed for them."""
    rows = durable(_labelled(points, id_col, vector_col, cluster_col))
    asking = undecided_clusters(rows, cluster_balls(rows), CLUSTER_ROWS)
    needed = asking.select(F.explode("_needs").alias("cluster")).groupBy("cluster").agg(F.count(F.lit(1)).alias("needed_by"))
    members = rows.groupBy(F.col("_label").alias("cluster")).agg(F.count(F.lit(1)).alias("members"))
    return members.join(needed, "cluster").select("cluster", "members", "needed_by", (F.col("members") * F.col("needed_by")).alias("distances"))


def mean_silhouette(points: DataFrame, **columns) -> DataFrame:
    return silhouette_samples(points, **columns).agg(F.avg("silhouette").alias("silhouette"))


def lloyd(
    points: DataFrame, k: int, steps: int = 2, seed: int = 42, id_col: str = "item_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(id, embedding, cluster)`` after some Lloyd steps from a fixed start: the k points first in the order of a hash.

    For results that another engine can recompute; ``best_kmeans`` fits better. A cluster that loses
    all its points is gone.
    """
    first = points.orderBy(key_hash([id_col], seed), id_col).limit(k)
    order = Window.orderBy(key_hash([id_col], seed), id_col)  # k rows
    centres = durable(first.select((F.row_number().over(order) - 1).cast("int").alias("cluster"), F.transform(vector_col, lambda x: x.cast("double")).alias("embedding")))
    for _ in range(steps):
        moved = kmeans_step(points, centres, id_col, vector_col)[1]
        centres = durable(centroid_table(moved))
    return points.join(kmeans_step(points, centres, id_col, vector_col)[0], id_col)


def kmeans_sweep(
    embeddings: DataFrame,
    k_list: Sequence[int],
    name: str,
    seed: int = 42,
    max_points: int | None = None,
    restarts: int = 1,
    id_col: str = "item_id",
    vector_col: str = "embedding",
    max_iter: int = 50,
    fixed_steps: int | None = None,
) -> DataFrame:
    """``(embedding, k, inertia, silhouette, n_points)``, one row per k; null for an unusable k.

    All points take part; with ``max_points`` a seeded draw of that many does, which depends on
    ids only, so that several embeddings of the same items share it. With ``fixed_steps`` the clusters
    are those of ``lloyd`` after so many steps.
    """
    points = embeddings.select(F.col(id_col).cast("string").alias("_id"), F.col(vector_col).alias("embedding"))
    if max_points is not None:
        points = sample_exact(points, max_points, seed, ["_id"])
    features = points.select("_id", "embedding", array_to_vector(
        F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    features = durable(features)
    n_points = features.count()
    rows = []
    for k in k_list:
        if k <= 1 or k >= n_points:
            row = embeddings.sparkSession.range(1).select(
                F.lit(None).cast("double").alias("inertia"), F.lit(None).cast("double").alias("silhouette")
            )
        elif fixed_steps is not None:
            labeled = durable(lloyd(features.select("_id", "embedding"), k, fixed_steps, seed, "_id"))
            row = mean_silhouette(labeled, id_col="_id").withColumn("inertia", inertia(labeled).scalar())
        else:
            model = best_kmeans(features, k, seed, restarts, max_iter)
            labeled = model.transform(features).select("_id", "embedding", F.col("prediction").alias("cluster"))
            row = mean_silhouette(labeled, id_col="_id").select(
                F.lit(float(model.summary.trainingCost)).alias("inertia"), "silhouette"
            )
        rows.append(
            row.select(
                F.lit(name).alias("embedding"), F.lit(k).alias("k"), "inertia", "silhouette",
                F.lit(n_points).cast("long").alias("n_points"),
            )
        )
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def best_k(sweep: DataFrame) -> DataFrame:
    """The k with the highest silhouette; the smallest on a tie."""
    return sweep.where(F.col("silhouette").isNotNull()).agg(
        F.min_by("k", F.struct(-F.round("silhouette", 9), F.col("k"))).alias("k")
    )


EXTRA_AXES = 16
AXIS_STEPS = 200
AXIS_TOLERANCE = 1e-11


def _flat_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, positions and values of the entries of a batch of stored vectors."""
    rows, positions, values = [], [], []
    for n, v in enumerate(batch.column("features").to_pylist()):
        x = np.asarray(v["values"], np.float64)
        rows.append(np.full(len(x), n))
        positions.append(np.arange(len(x)) if v["type"] == 1 else np.asarray(v["indices"], np.int64))
        values.append(x)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(positions), np.concatenate(values)


def _placed(flat: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, axes: np.ndarray) -> np.ndarray:
    """The rows of a batch on the axes."""
    row, position, x = flat
    return np.stack([np.bincount(row, x * axes[position, c], n) for c in range(axes.shape[1])], 1)


def principal_axes(vectors: DataFrame, k: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(axes, shares of variance, column means) of the first k components; ``vectors`` as STORED_VECTOR.

    Block power iteration: each step sends every row through the axes and back, task by task, and
    only the summed columns reach the driver. The mean is taken off as a rank-one correction, so
    sparse rows stay sparse. The driver holds columns x (k + EXTRA_AXES) numbers, never a
    covariance matrix. For at most ``wide_components.COLUMN_BLOCK`` columns; callers take
    ``blocked_components`` beyond, where the axes are a table.
    """
    spark = vectors.sparkSession
    size = F.coalesce("features.size", F.size("features.values"))  # dense vectors store no size
    entries = vectors.select(size.alias("d"), F.transform("features.values", lambda x: x * x).alias("sq"))
    shape = entries.agg(
        F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), F.sum(F.aggregate("sq", F.lit(0.0), lambda s, x: s + x)).alias("sq")
    ).first()
    n, d = shape["n"], shape["d"]
    width = min(d, k + EXTRA_AXES)
    axes = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]

    def through(axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """X'X axes and the column sums of X axes, both from one pass."""
        held = spark.sparkContext.broadcast(axes)
        columns = [f"c{c}" for c in range(axes.shape[1])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, sums = np.zeros_like(held.value), np.zeros(held.value.shape[1])
            for batch in batches:
                flat = _flat_rows(batch)
                y = _placed(flat, batch.num_rows, held.value)
                sums += y.sum(0)
                row, position, x = flat
                for c in range(y.shape[1]):
                    total[:, c] += np.bincount(position, x * y[row, c], len(total))
            used = np.flatnonzero(np.any(total != 0, axis=1))
            place = np.append(used, -1)  # -1: the sums
            block = np.vstack([total[used], sums])
            yield pa.RecordBatch.from_arrays([pa.array(place), *(pa.array(block[:, c]) for c in range(block.shape[1]))], names=["pos", *columns])

        parts = vectors.mapInArrow(run, "pos long, " + ", ".join(f"{c} double" for c in columns))
        got = parts.groupBy("pos").agg(*[F.sum(c).alias(c) for c in columns]).toPandas().set_index("pos")
        held.unpersist()
        out = np.zeros_like(axes)
        inside = got.index[got.index >= 0]
        out[inside] = got.loc[inside, columns].to_numpy()
        return out, got.loc[-1, columns].to_numpy()

    means = np.zeros(d)
    mean_rows = vectors.select(F.posexplode("features.values").alias("p", "x"), "features.type", "features.indices").select(
        F.when(F.col("type") == 1, F.col("p")).otherwise(F.col("indices")[F.col("p")]).alias("pos"), "x"
    )
    for r in mean_rows.groupBy("pos").agg(F.sum("x").alias("s")).toLocalIterator():
        means[r["pos"]] = r["s"] / n
    total = shape["sq"] - n * float(means @ means)
    before = np.zeros(k)
    for _ in range(AXIS_STEPS):
        product, sums = through(axes)
        product -= np.outer(means, sums)
        values, turn = np.linalg.eigh(axes.T @ product)
        order = np.argsort(values)[::-1]
        values, ritz = np.maximum(values[order], 0.0), axes @ turn[:, order]
        if np.all(np.abs(values[:k] - before) <= AXIS_TOLERANCE * max(total, 1e-300)):
            break
        before = values[:k]
        axes = np.linalg.qr(product @ turn[:, order])[0]
    first = ritz[:, :k]
    # the sign is free: the entry of largest size is made positive
    first = first * np.sign(first[np.abs(first).argmax(0), np.arange(k)] + 0.0)
    return first, values[:k] / total if total > 0 else np.zeros(k), means


def columns_of(vectors: DataFrame) -> int:
    """Columns of stored vectors; dense ones store no size."""
    return vectors.agg(F.max(F.coalesce("features.size", F.size("features.values")))).first()[0] or 0


def project_2d(features: DataFrame, id_col: str, column_block: int = COLUMN_BLOCK) -> DataFrame:
    """``(id, pc1, pc2, ratio1, ratio2)``: centred coordinates on the first two components, for any number of columns.

    Axes of at most ``column_block`` columns travel as one array; wider ones are a table of blocks.
    """
    vectors = _retyped(features.select(id_col, "features"), "features", STORED_VECTOR)
    if columns_of(vectors) > column_block:
        placed, ratios = blocked_components(vectors, id_col, 2, column_block)
        return placed.select(
            id_col, F.col("y")[0].alias("pc1"), F.col("y")[1].alias("pc2"), F.lit(float(ratios[0])).alias("ratio1"), F.lit(float(ratios[1])).alias("ratio2")
        )
    axes, ratios, means = principal_axes(vectors, 2)
    middle = means @ axes
    held = features.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _placed(_flat_rows(batch), batch.num_rows, held.value) - middle
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(y[:, 0]), pa.array(y[:, 1])], names=[id_col, "pc1", "pc2"])

    id_type = features.schema[id_col].dataType.simpleString()
    return vectors.mapInArrow(run, f"`{id_col}` {id_type}, pc1 double, pc2 double").select(
        id_col, "pc1", "pc2", F.lit(float(ratios[0])).alias("ratio1"), F.lit(float(ratios[1])).alias("ratio2")
    )


# --- cluster profiles -----------------------------------------------------------------


def cluster_profile(
    ratings: DataFrame, members: DataFrame, user: str = USER, rating: str = RATING, cluster: str = "cluster"
) -> DataFrame:
    """Users, mean and sample deviation of ratings, ratings per user and in total, per cluster.

    Ratings are summed per user before they meet the clusters.
    """
    r = F.col(rating)
    per_user = ratings.groupBy(user).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(r).alias("_n"), F.sum(r).alias("_s"), F.sum(r * r).alias("_ss")
    )
    n, s = F.sum("_n"), F.sum("_s")
    return (
        members.select(user, cluster)
        .join(per_user, user, "left")
        .groupBy(F.col(cluster).alias("cluster_id"))
        .agg(
            F.count(F.lit(1)).alias("n_users"),
            (s / n).alias("avg_rating"),
            F.when(n > 1, F.sqrt(F.greatest(F.sum("_ss") - s * s / n, F.lit(0.0)) / (n - 1))).alias("std_rating"),
            (F.coalesce(F.sum("_rows"), F.lit(0)) / F.count(F.lit(1))).alias("avg_reviews_per_user"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_reviews"),
        )
    )


def cluster_rating_counts(
    ratings: DataFrame, members: DataFrame, user: str = USER, rating: str = RATING, cluster: str = "cluster"
) -> DataFrame:
    """How often each rating occurs in each cluster."""
    per_user = ratings.groupBy(user, rating).agg(F.count(F.lit(1)).alias("_n"))
    return (
        members.select(user, cluster)
        .join(per_user, user)
        .groupBy(F.col(cluster).alias("cluster_id"), rating)
        .agg(F.sum("_n").alias("n"))
    )


def centroid_cosine(centroids: DataFrame, cluster_col: str = "cluster", vector_col: str = "embedding") -> DataFrame:
    """Cosine between every two centroids; the centroids travel as one small array."""
    held = centroids.agg(
        F.collect_list(F.struct(F.col(cluster_col).alias("c"), F.col(vector_col).alias("v")))
    )
    return centroids.withColumn("_o", F.explode(held.scalar())).select(
        F.col(cluster_col).alias("cluster_x"),
        F.col("_o.c").alias("cluster_y"),
        cosine(F.col(vector_col), F.col("_o.v")).alias("cosine"),
    )
