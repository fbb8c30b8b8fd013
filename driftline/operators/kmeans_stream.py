"""Streaming k-means: decayed centre updates, learn types, and the row output with error and centres."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import center_format, double_rows, doubles
from driftline.operators.cluster import cf_vectors, nearest, nearest_center, weighted_kmeans
from driftline.operators.observer import matrix
from driftline.operators.order import sliding_batches

# Learn types: each batch on its own, overlapping batches, or one model with decay.
INDEPENDENT, SLIDING, INCREMENTAL = 0, 1, 2


def batch_shift(learn_type: int, window_shift: int, batch_size: int) -> int:
    """Positions between the starts of two batches."""
    if learn_type not in (INDEPENDENT, SLIDING, INCREMENTAL):
        raise ValueError(f"learn_type: required 0, 1 or 2 but found {learn_type}")
    if learn_type != SLIDING:
        return batch_size
    if not 1 <= window_shift <= batch_size:
        raise ValueError(f"window_shift: required 1 to {batch_size}, so that every row is in a batch, but found {window_shift}")
    return window_shift


def learn_batches(df: DataFrame, learn_type: int, window_shift: int, batch_size: int, seq: str = "seq") -> DataFrame:
    """Rows with the batches they train, by learn type."""
    return sliding_batches(df, batch_size, batch_shift(learn_type, window_shift, batch_size), seq)


def first_batch_of(seq: Column, size: int, shift: int) -> Column:
    """Number of the first batch that covers a row; the batch in which the row is new."""
    return F.greatest(F.lit(0), F.ceil((seq - size) / F.lit(shift))).cast("bigint")


def batch_kmeans(
    df: DataFrame,
    k: int,
    learn_type: int = INDEPENDENT,
    window_shift: int = 0,
    batch_size: int = 1000,
    iterations: int = 10,
    features: str = "features",
    seq: str = "seq",
    seed: int = 1,
    batches: tuple[int, int] | None = None,
    centers: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """k-means on every independent or sliding batch: (batch, n, centers).

    A batch never holds more than ``batch_size`` rows, so one task per batch is bounded and all batches run in parallel.
    ``batches`` (first, last) leaves out the batches outside that range.  Every batch starts from ``centers``, if given.
    """
    start = None if centers is None else np.asarray(centers, dtype=np.float64)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        x = np.stack(pdf["features"].to_numpy()).astype(np.float64)
        labels = weighted_kmeans(x, np.ones(len(x)), k, seed, iterations, start)
        centers = sorted(x[labels == c].mean(axis=0).tolist() for c in np.unique(labels))
        return pd.DataFrame({"batch": [pdf["batch"].iloc[0]], "n": [len(x)], "centers": [centers]})

    rows = learn_batches(df, learn_type, window_shift, batch_size, seq)
    if batches is not None:
        rows = rows.filter(F.col("batch").between(*batches))
    rows = rows.select("batch", F.col(seq).alias("seq"), F.col(features).cast("array<double>").alias("features"))
    return rows.groupBy("batch").applyInPandas(fit, "batch bigint, n bigint, centers array<array<double>>")


def batch_output(
    df: DataFrame,
    fits: DataFrame,
    k: int,
    size: int,
    shift: int,
    features: str = "features",
    seq: str = "seq",
    error: str = "stderr",
) -> DataFrame:
    """Every row once, with the centres of the batch it is new in and its distance to the nearest of them.

    Rows join their batch on a key that holds at most ``size`` rows, so no key can be hot.
    """
    keyed = df.withColumn("__batch", first_batch_of(F.col(seq), size, shift))
    return joined_output(keyed, fits.withColumnRenamed("batch", "__batch"), k, "__batch", features, error)


def joined_output(
    df: DataFrame, fits: DataFrame, k: int, batch: str, features: str = "features", error: str = "stderr"
) -> DataFrame:
    """Rows with the ``centers`` of their ``batch`` as texts, formatted once a batch, and their distance to the nearest."""
    texts = {f"center{i}": center_format(F.get("centers", F.lit(i))).alias(f"__center{i}") for i in range(k)}
    joined = df.join(fits.select(batch, F.col("centers").alias("__centers"), *texts.values()), batch)
    nearest_sq = f"array_min(transform(__centers, c -> aggregate(zip_with(c, {features}, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v)))"
    kept = [c for c in df.columns if c not in (batch, error, *texts)]
    return joined.select(*kept, F.sqrt(F.expr(nearest_sq)).alias(error), *[F.col(f"__{t}").alias(t) for t in texts])


def batch_totals(
    df: DataFrame, size: int, shift: int, sums: Sequence[str], seq: str = "seq", keys: Sequence[str] = ()
) -> DataFrame:
    """Count and sums per sliding batch.

    Rows are added up once per pane of gcd(size, shift) positions; only panes are repeated for overlapping batches.
    """
    pane = math.gcd(size, shift)
    panes = df.groupBy(*keys, (F.floor((F.col(seq) - 1) / F.lit(pane))).alias("__pane")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums]
    )
    spread = sliding_batches(
        panes.withColumn("__pos", F.col("__pane") + 1), size // pane, shift // pane, "__pos"
    )
    return spread.groupBy(*keys, "batch").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])


def update(
    df: DataFrame,
    centers: Sequence[Sequence[float]],
    counts: Sequence[float],
    alpha: float = 1.0,
    features: str = "features",
) -> DataFrame:
    """Centres after one micro-batch: n' = α·n + m and c' = (α·n·c + Σx) / n'; one row per centre.

    A centre without new rows stays where it is and only its count decays.
    """
    spark = df.sparkSession
    old = spark.range(len(centers)).select(
        F.col("id").cast("int").alias("idx"),
        F.get(double_rows(centers), F.col("id").cast("int")).alias("old"),
        (F.get(doubles(counts), F.col("id").cast("int")) * alpha).alias("decayed"),
    )
    sums = cf_vectors(nearest_center(df, centers, features), "idx", features).select(
        F.col("key").alias("idx"), F.col("n").alias("m"), "ls"
    )
    n = F.col("decayed") + F.coalesce(F.col("m"), F.lit(0.0))
    moved = F.zip_with("old", "ls", lambda c, s: (c * F.col("decayed") + s) / n)
    center = F.when(F.col("ls").isNull() | (n <= 0), F.col("old")).otherwise(moved)
    return F.broadcast(old).join(sums, "idx", "left").select("idx", n.alias("n"), center.alias("center"))


STATE_SCHEMA = "batch bigint, counts array<double>, centers array<array<double>>"


def chained_updates(
    df: DataFrame,
    centers: Sequence[Sequence[float]],
    counts: Sequence[float],
    alpha: float,
    starts: Sequence[int],
    first: int = 0,
    features: str = "features",
    seq: str = "seq",
) -> DataFrame:
    """What :func:`update` makes of consecutive batches, one row for each: (batch, counts, centers).

    Which centre is nearest depends on the batch before, so one task takes the rows in order; it holds an Arrow batch of
    them.  ``starts`` are the first sequence numbers of the batches, which are numbered from ``first`` on.
    """
    begin = np.asarray(starts, dtype=np.int64)
    at, weight = np.asarray(centers, dtype=np.float64), np.asarray(counts, dtype=np.float64)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, n = at.copy(), weight.copy()
        k, dims = centers.shape
        open_batch, m, sums = None, np.zeros(k), np.zeros((k, dims))
        done: list[tuple] = []

        def close() -> None:
            nonlocal n, m, sums
            decayed = n * alpha
            n = decayed + m
            hit = (m > 0) & (n > 0)
            centers[hit] = (centers[hit] * decayed[hit, None] + sums[hit]) / n[hit, None]
            done.append((open_batch, n.tolist(), centers.tolist()))
            m, sums = np.zeros(k), np.zeros((k, dims))

        def states() -> pa.RecordBatch:
            numbers, *lists = zip(*done)
            done.clear()
            types = (pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64())))
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), *[pa.array(v, t) for v, t in zip(lists, types)]], ["batch", "counts", "centers"]
            )

        for frame in frames:
            x = matrix(frame.column("features"), dims)
            batch = np.searchsorted(begin, frame.column("seq").to_numpy(), side="right") - 1
            for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(batch)) + 1) if len(x) else []:
                if open_batch not in (None, first + int(batch[part[0]])):
                    close()
                open_batch = first + int(batch[part[0]])
                rows = x[part[0] : part[-1] + 1]
                own = nearest(rows, centers)[0]
                m += np.bincount(own, minlength=k)
                for d in range(dims):
                    sums[:, d] += np.bincount(own, weights=rows[:, d], minlength=k)
            if done:
                yield states()
        if open_batch is not None:
            close()
            yield states()

    rows = df.select(F.col(seq).cast("bigint").alias("seq"), F.col(features).cast("array<double>").alias("features"))
    return rows.coalesce(1).sortWithinPartitions("seq").mapInArrow(run, STATE_SCHEMA)


def output(
    df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features", error: str = "stderr"
) -> DataFrame:
    """All input columns, the distance to the nearest centre, and the formatted centres."""
    scored = nearest_center(df, centers, features, "__idx", "__d2").withColumn(error, F.sqrt("__d2"))
    # The texts are the same for every row, so they are formatted once and not per row.
    texts = df.sparkSession.range(1).select(*[center_format(doubles(c)) for c in centers]).first()
    return scored.withColumns({f"center{i}": F.lit(t) for i, t in enumerate(texts)}).drop("__idx", "__d2")
