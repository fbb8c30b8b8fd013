"""Dictionaries as keyed state: first appearance and row count of every value live in Spark's state store.

One key per (attribute, value), so state and work spread over the tasks; a value that makes up a third of the rows sends
one row per Arrow batch.  Spark versions and restores the state with the query's checkpoint.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

from driftline.operators.encode import number_entries
from driftline.sources.sinks import write_batch

ENTRIES = "attr string, value string, first_seq bigint, n_rows bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FirstSeen(StatefulProcessor):
    """Keeps the smallest arrival key and the number of rows of a value, and returns them when they change."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "first_seq bigint, n_rows bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, n = self.seen.get() if self.seen.exists() else (None, 0)
        for part in rows:
            least = int(part["first_seq"].min())
            first = least if first is None else min(first, least)
            n += int(part["n_rows"].sum())
        self.seen.update((first, n))
        yield pd.DataFrame({"attr": [key[0]], "value": [key[1]], "first_seq": [first], "n_rows": [n]})

    def close(self) -> None:
        pass


def value_parts(stream: DataFrame, columns: Sequence[str], order_by: str) -> DataFrame:
    """(attr, value, first_seq, n_rows) of every Arrow batch: what a task sends instead of its rows.  Nulls are no values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq = batch.column("__seq").to_numpy()
            for c in columns:
                held = batch.column(c).dictionary_encode()
                code = held.indices.fill_null(-1).to_numpy()
                known = code >= 0
                if not known.any():
                    continue
                size = len(held.dictionary)
                first = np.full(size, np.iinfo(np.int64).max)
                np.minimum.at(first, code[known], seq[known])
                count = np.bincount(code[known], minlength=size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * size), held.dictionary.cast(pa.string()), pa.array(first), pa.array(count)], ["attr", "value", "first_seq", "n_rows"]
                )

    rows = stream.select(*[F.col(c).cast("string").alias(c) for c in columns], F.col(order_by).cast("bigint").alias("__seq"))
    return rows.mapInArrow(run, ENTRIES)


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def dictionary_state(
    stream: DataFrame, columns: Sequence[str], order_by: str, path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Grow the dictionaries of ``columns`` with the stream; ``order_by`` is an integer key of arrival.

    Every micro-batch writes the entries that it changed under ``path``/changes; a replay replaces them.
    """
    state = value_parts(stream, columns, order_by).groupBy("attr", "value").transformWithStateInPandas(
        statefulProcessor=FirstSeen(), outputStructType=StructType.fromDDL(ENTRIES), outputMode="Update", timeMode="None"
    )
    with rocksdb(stream.sparkSession):
        writer = state.writeStream.outputMode("update").foreachBatch(lambda rows, b: write_batch(rows, f"{path}/changes", b))
        return writer.option("checkpointLocation", f"{path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def dictionary_entries(spark: SparkSession, path: str) -> DataFrame:
    """The dictionaries as of the last micro-batch: each value's newest entry, numbered by first appearance."""
    changes = spark.read.schema(f"{ENTRIES}, batch_id int").parquet(f"{path}/changes")
    newest = changes.groupBy("attr", "value").agg(F.max_by(F.struct("first_seq", "n_rows"), "batch_id").alias("e"))
    return number_entries(newest.select("attr", "value", "e.first_seq", "e.n_rows"))
