"""Statistics that merge across micro-batches: one small table per batch, the total is their sum."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.operators.encode import extend_dictionary, number_entries, value_counts
from driftline.operators.kmeans_stream import update
from driftline.operators.order import with_seq
from driftline.session import cut_lineage
from driftline.sources.sinks import callback, write_batch
from driftline.streaming.store import ModelStore

DICTIONARY_SCHEMA = "attr string, value string, first_seq bigint, n_rows bigint, idx int"


def accumulate(
    stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame], path: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write ``aggregate(micro-batch)`` per batch under ``path``/parts."""
    return callback(
        stream, lambda b, rows: write_batch(aggregate(rows), f"{path}/parts", b), f"{path}/checkpoint", trigger
    )


def parts(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/parts")


def total(spark, path: str, keys: Sequence[str], **merge: str) -> DataFrame:
    """Sum of all parts; ``merge`` maps a column to 'sum', 'min' or 'max'."""
    how = {"sum": F.sum, "min": F.min, "max": F.max}
    return parts(spark, path).groupBy(*keys).agg(*[how[fn](c).alias(c) for c, fn in merge.items()])


def dictionary_stream(
    stream: DataFrame, columns: Sequence[str], order_by: str | Sequence[str], path: str, trigger: dict | None = None
) -> StreamingQuery:
    """First-seen dictionaries that grow with the stream; version b holds all values up to batch b."""
    store = ModelStore(stream.sparkSession, f"{path}/dictionary")

    def step(batch_id: int, rows: DataFrame) -> None:
        prior = store.latest_before(batch_id)
        seen = prior[1]["seen"] if prior else 0
        rows = rows.persist()
        numbered = with_seq(rows, order_by).withColumn("seq", F.col("seq") + F.lit(seen))
        counts = value_counts(numbered, columns)
        if prior is None:
            new = number_entries(cut_lineage(counts))
        else:
            new = extend_dictionary(store.read("entries", prior[0], DICTIONARY_SCHEMA), counts)
        store.write("entries", batch_id, new.select("attr", "value", "first_seq", "n_rows", "idx"))
        store.commit(batch_id, {"seen": seen + rows.count()})
        rows.unpersist()

    return callback(stream, step, f"{path}/checkpoint", trigger)


def latest_dictionary(spark, path: str) -> DataFrame:
    store = ModelStore(spark, f"{path}/dictionary")
    return store.read("entries", store.latest_before()[0], DICTIONARY_SCHEMA)


def kmeans_stream(
    stream: DataFrame,
    centers: Sequence[Sequence[float]],
    path: str,
    alpha: float = 1.0,
    features: str = "features",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Streaming k-means: decayed centre update per micro-batch from the given start centres."""
    spark = stream.sparkSession
    store = ModelStore(spark, f"{path}/centers")
    schema = "idx int, n double, center array<double>"

    def step(batch_id: int, rows: DataFrame) -> None:
        prior = store.latest_before(batch_id)
        at, counts = [list(c) for c in centers], [0.0] * len(centers)
        if prior:
            for r in store.read("state", prior[0], schema).collect():
                at[r["idx"]], counts[r["idx"]] = r["center"], r["n"]
        store.write("state", batch_id, update(rows, at, counts, alpha, features))
        store.commit(batch_id, {})

    return callback(stream, step, f"{path}/checkpoint", trigger)


def latest_centers(spark, path: str) -> DataFrame:
    store = ModelStore(spark, f"{path}/centers")
    return store.read("state", store.latest_before()[0], "idx int, n double, center array<double>")
