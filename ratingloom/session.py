"""Session settings and the durable hand-over between stages."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_scratch: list[tempfile.TemporaryDirectory] = []


def local_session(cores: str = "*", app: str = "ratingloom", shuffle_partitions: int = 32) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for handed-over tables, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a scratch folder of its own, removed at exit. A
    cluster without the setting is an error: executors could not read a driver-local path.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _scratch.append(tempfile.TemporaryDirectory(prefix="ratingloom-", ignore_cleanup_errors=True))
        folder = _scratch[-1].name
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


_scopes: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that ``durable`` writes inside the block when the block ends.

    For a flow whose results are saved or collected inside the block; a frame that reads such a
    table must not be used after it. Without a scope the tables stay until the folder is cleared.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def durable(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """``df`` computed once, written to the shared folder as Parquet and read back.

    For results that several later branches use: each of them reads only the columns it
    needs, and a lost executor costs a re-read instead of the whole history. ``schema`` reads
    the files with other types of the same layout, such as a vector type for its struct.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends the package to the executors once per session, for sessions started outside its folder.

    Functions that run in Python workers are pickled by name, so workers must be able to import them.
    """
    context = spark.sparkContext
    if getattr(context, "_ratingloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.TemporaryDirectory(prefix="ratingloom-ship-", ignore_cleanup_errors=True)
    _scratch.append(folder)  # the driver serves the file as long as the session lives
    archive = Path(folder.name) / "ratingloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"ratingloom/{source.relative_to(root)}")
    context.addPyFile(str(archive))
    context._ratingloom_shipped = True


def durable_in_order(df: DataFrame) -> DataFrame:
    """As ``durable``, but keeping partitions and the row order inside them as they are."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan's rows dealt over the shuffle partitions by ``key``.

    Only for a local session on one file, whose rows one task would read: the reader cannot split
    a single row group. On a cluster the scan keeps the partitions it has and nothing is shuffled.
    Rows and results are the same either way.
    """
    return df.repartition(F.col(key)) if df.sparkSession.sparkContext.master.startswith("local[") else df
