"""Session helpers: shared scratch folder, lineage cuts, size checks before a broadcast."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from py4j.java_gateway import JavaClass
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, in rows, that the library itself marks for broadcast.  Rows here are dictionary entries, centres or
# block totals (well under 1 KB each), so the bound is a few tens of MB.
BROADCAST_ROWS = 100_000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application (what ``--py-files`` does on a cluster)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="driftline-ship-"), "driftline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir: required a folder that all executors share, but it is not set")
        base = tempfile.mkdtemp(prefix="driftline-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


# Paths handed out inside the open `scratch` blocks, the innermost last.
_open: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables that are stored inside the block are removed when it ends.

    What the block computes has to be written, to a path from outside of it, before it ends.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.pop()
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_folder(spark: SparkSession, path: str) -> str:
    """Make a folder on the file system that ``path`` belongs to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return path


@contextlib.contextmanager
def plain_checkpoint_files(spark: SparkSession):
    """Streams that start in the block write their logs through Hadoop's FileSystem instead of its FileContext.

    Both rename a finished file into place.  On a local disk without Hadoop's native library the second calls a program
    for each file, which costs more than the rest of a short trigger.  A manager that the session names itself stays.
    """
    key = "spark.sql.streaming.checkpointFileManagerClass"
    found = spark._jvm.org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager
    if spark.conf.get(key, None) is not None or not isinstance(found, JavaClass):
        yield
        return
    spark.conf.set(key, found._fqn)
    try:
        yield
    finally:
        spark.conf.unset(key)


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and return a scan of it.

    Cuts the lineage, survives lost executors and, with ``partition_by``, lets later reads prune whole folders.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small state table."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` holds no more than ``rows`` rows; reads no further than one row past the bound."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a size check; a larger table is left to a shuffle join with AQE skew handling."""
    return F.broadcast(df) if at_most(df, rows) else df


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Run a block with ``n`` shuffle partitions (the learners' parallelism parameter)."""
    if not n:
        yield
        return
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
