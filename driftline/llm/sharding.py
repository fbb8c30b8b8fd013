"""Sharding by a two-pass external shuffle.

Pass one scatters whole records into memory-sized buckets by a seeded hash.  Pass two shuffles each bucket in memory
(Fisher-Yates) and writes it.  Positions in the order of buckets are then dealt to the shards in turn, so that shard
counts differ by one at most and every shard is a uniform sample in random order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.order import running
from driftline.session import broadcast_if_small, stored

# Text bytes of a bucket: a task holds a few of them (records, order, result).
BUCKET_BYTES = 32_000_000
SEED = 20_240
ADDED = ("shard", "slot")


def shuffle_bucket(table: pa.Table, seed: int) -> pa.Table:
    """The rows in a random order that follows from the seed and the rows alone: sorted by key, then Fisher-Yates."""
    rng = np.random.default_rng((seed, int(table.column("__bucket")[0].as_py())))
    # Equal sort keys belong to equal rows, which are interchangeable.
    base = np.argsort(table.column("__key").to_numpy(), kind="stable")
    order = np.arange(table.num_rows)
    for i, j in zip(range(len(order) - 1, 0, -1), rng.integers(0, np.arange(len(order), 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return table.take(pa.array(base[order]))


def external_shuffle(docs: DataFrame, text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """The rows, stored in ``__bucket`` order with their ``__place`` inside the bucket.

    The bucket hash takes all columns and, so that a row that repeats without end is spread too, the number of the
    input partition: ``docs`` should be a table, whose partitions hold the same rows in every attempt.
    """
    total = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    buckets = max(1, -(-int((total[0] or 0) + 100 * total[1]) // bucket_bytes))
    columns = [F.col(c) for c in docs.columns]
    keyed = docs.withColumn("__key", F.xxhash64(F.lit(seed), *columns)).withColumn(
        "__bucket", F.pmod(F.xxhash64(F.lit(seed), "__key", F.spark_partition_id()), F.lit(buckets)).cast("int")
    )
    schema = T.StructType([*docs.schema.fields, T.StructField("__bucket", T.IntegerType()), T.StructField("__place", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        mixed = shuffle_bucket(table, seed).drop_columns(["__key"])
        return mixed.append_column("__place", pa.array(np.arange(mixed.num_rows)))

    return stored(keyed.groupBy("__bucket").applyInArrow(run, schema), "buckets")


def shard(docs: DataFrame, shards: int = 16, text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Every row with its ``shard`` (0 to shards - 1) and its ``slot`` in the shard, gapless from 0.

    Null texts have no bytes; repeated rows are separate records; an empty table gives an empty one.  Columns of
    ``docs`` named like results are replaced.
    """
    if shards < 1:
        raise ValueError(f"shards: required 1 or more but found {shards}")
    docs = docs.drop(*ADDED)
    placed = external_shuffle(docs, text, bucket_bytes, seed)
    counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = running(counts, {"before": ("sum", "n")}, position="__bucket", span=4096, exclusive=("before",))
    offsets = before.select("__bucket", F.coalesce("before", F.lit(0)).alias("before"))
    position = F.col("before") + F.col("__place")
    return placed.join(broadcast_if_small(offsets), "__bucket").select(
        *docs.columns, F.pmod(position, F.lit(shards)).cast("int").alias("shard"), F.floor(position / F.lit(shards)).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the result of :func:`shard` as one folder per shard, rows in order of their slots."""
    files = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    files.write.partitionBy("shard").parquet(path)
