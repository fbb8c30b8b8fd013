"""Sinks: append tables, named tables, callbacks, and the learning-curve CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from driftline.session import fresh_folder, plain_checkpoint_files
from driftline.sources.rows import file_system


def insert_into(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def export_stream(stream: DataFrame, name: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a named catalog table."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).toTable(name)


def callback(
    stream: DataFrame, receive: Callable[[int, DataFrame], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``receive(batch_id, rows)``; one call at a time."""
    writer = stream.writeStream.foreachBatch(lambda rows, batch_id: receive(batch_id, rows))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def insert_by_batch(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream of many short micro-batches to one folder of files, each row with its ``batch_id``, exactly once.

    A task writes its rows itself, under a name made of micro-batch and task, so that a trigger needs one job and no
    folders; a replay of the micro-batch overwrites its own files.  This takes a source that cuts the same offsets into the
    same tasks, as :func:`driftline.sources.rows.stream_rows` does, no shuffle behind it, and a folder that pyarrow knows.
    """
    schema = StructType([*stream.schema.fields, StructField("batch_id", IntegerType())])

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [f for f in frames if len(f)]
        if rows:
            context = TaskContext.get()
            batch_id, part = int(context.getLocalProperty("streaming.sql.batchId")), context.partitionId()
            table = pa.Table.from_batches(rows)
            table = table.append_column("batch_id", pa.array(np.full(len(table), batch_id, dtype=np.int32)))
            files, folder = file_system(path)
            name = f"{folder}/part-{batch_id:09}-{part:06}.parquet"
            temporary = f"{folder}/_{uuid.uuid4().hex}"
            pq.write_table(table, temporary, filesystem=files)
            files.move(temporary, name)
        yield from ()

    spark = stream.sparkSession
    fresh_folder(spark, path)
    writer = stream.mapInArrow(write, schema).writeStream.format("noop").option("checkpointLocation", checkpoint)
    with plain_checkpoint_files(spark):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Rows of one micro-batch; a replay of the batch overwrites its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_curve_csv(measurements: DataFrame, path: str, batch_id: int, completed: bool = False) -> None:
    """Lines of one micro-batch under ``path``/curve_csv; the header line, once per run, is in ``path``/curve_header.

    ``completed`` is true in the lines of the write that ends a run, which also leaves an empty ``curve_completed`` table.
    """
    spark = measurements.sparkSession
    rows = measurements.withColumn("completed", F.lit(completed))
    ordered = rows.orderBy(*[c for c in ("point", "ordinal") if c in rows.columns])
    ordered.write.mode("overwrite").csv(f"{path}/curve_csv/batch_id={batch_id}")
    header = spark.range(1).select(F.lit(",".join(rows.columns)).alias("value"))
    header.write.mode("ignore").text(f"{path}/curve_header")
    if completed:
        header.limit(0).write.mode("overwrite").text(f"{path}/curve_completed")


def read_curve_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines that :func:`write_curve_csv` has written under ``path``; ``schema`` is that of the measurements."""
    return spark.read.schema(f"{schema}, completed boolean, batch_id int").csv(f"{path}/curve_csv")


def write_curve_file(spark: SparkSession, path: str) -> str:
    """One file ``path``/curve.csv of all that :func:`write_curve_csv` has written there: the header line, the lines of all
    micro-batches in order, and ``# COMPLETED`` once the run has ended.  Returns its path.

    The lines are copied as bytes into a new file that then takes the place of the old one, so a reader never sees half
    a line and a repeated micro-batch stands there once.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    files = at("curve_csv").getFileSystem(conf)

    def parts(folder) -> list:
        listed = [f.getPath() for f in files.listStatus(folder)] if files.exists(folder) else []
        return sorted((p for p in listed if p.getName().startswith("part-")), key=lambda p: p.getName())

    batches = files.listStatus(at("curve_csv")) if files.exists(at("curve_csv")) else []
    folders = [f.getPath() for f in batches if f.isDirectory()]
    folders.sort(key=lambda p: int(p.getName().split("=")[1]))
    temporary = at("curve.csv.tmp")
    out = files.create(temporary, True)
    try:
        for part in [*parts(at("curve_header")), *(p for folder in folders for p in parts(folder))]:
            lines = files.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(lines, out, conf, False)
            finally:
                lines.close()
        if files.exists(at("curve_completed")):
            out.write(bytearray(b"# COMPLETED\n"))
    finally:
        out.close()
    files.delete(at("curve.csv"), False)
    files.rename(temporary, at("curve.csv"))
    return f"{path}/curve.csv"
