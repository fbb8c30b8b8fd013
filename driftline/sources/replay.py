"""Sources: replay of delimited files, typed streams, named tables.  Schemas are always explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def replay_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated lines without header, one row per line; a malformed line fails the job."""
    return spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").csv(path)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same as an unbounded stream; ``files_per_trigger`` throttles it."""
    reader = spark.readStream.schema(schema).option("header", False).option("mode", "FAILFAST")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def import_stream(spark: SparkSession, name: str) -> DataFrame:
    """Stream of a named catalog table."""
    return spark.readStream.table(name)
