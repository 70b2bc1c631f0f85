"""Intermediate tables in the folder all executors share.

A table written here cuts the lineage: what is built on it survives the loss of
executors without a second pass over the raw data, and it is read back with
column pruning and file statistics.
"""

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or else its warehouse; a temporary folder in local mode only."""
    context = spark.sparkContext
    local = context.master.startswith("local")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and local:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
        folder = context.getCheckpointDir()
    folder = (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    if not local:
        _require_shared(spark, folder)
    return folder


_shared: set[tuple[str, str]] = set()


def _require_shared(spark: SparkSession, folder: str) -> None:
    """A path of a local file system may be a mount of all nodes or a folder of each machine; its name does not tell.

    Once per application and folder tasks write a file each, and the driver must find them all: of
    a folder of each machine it would read back its own part, without an error.
    """
    context = spark.sparkContext
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/tillroll-shared-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getUri().getScheme() != "file" or (context.applicationId, folder) in _shared:
        return
    tasks = 4 * context.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path.toString())
        found = sum(file.getPath().getName().startswith("part-") for file in files.listStatus(path))
    finally:
        _drop(files, path)
    if found != tasks:
        raise RuntimeError(
            f"the driver finds {found} of {tasks} files of tasks in {folder}: name a folder all nodes share in spark.checkpoint.dir"
        )
    _shared.add((context.applicationId, folder))


_scopes = threading.local()


@contextlib.contextmanager
def released() -> Iterator[None]:
    """Intermediate tables made inside go when the block ends, not only with the driver; for work that repeats."""
    outer, _scopes.made = getattr(_scopes, "made", None), []
    try:
        yield
    finally:
        for files, folder in _scopes.made:
            _drop(files, folder)
        _scopes.made = outer


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, in a folder of its own that goes when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tillroll-{label}-{uuid.uuid4().hex}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if getattr(_scopes, "made", None) is not None:
        _scopes.made.append((files, folder))
    else:
        atexit.register(_drop, files, folder)
    return f"{folder.toString()}/data"


def _drop(files: JavaObject, folder: JavaObject) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        files.delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once, keep the rows in the shared folder and read them back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, label: str, buckets: int, column: str) -> DataFrame:
    """As ``materialize``, in hash buckets of a column: grouping, joining or a window by it reads the files as they lie.

    Buckets are known to tables only. The table's name goes at once; the frame
    reads the files, which stay as long as those of ``materialize``.
    """
    spark = df.sparkSession
    name = f"tillroll_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", scratch_path(spark, label)).format("parquet").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
