"""Streaming linear regression: mergeable normal equations, and mini-batch gradient steps."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.bounds import z_value
from driftline.functions.vectors import dot, doubles
from driftline.operators.kmeans_stream import INCREMENTAL, INDEPENDENT, batch_shift, first_batch_of
from driftline.operators.order import running, sliding_batches
from driftline.session import cut_lineage


# Up to this many attributes the moments are one wide aggregate; beyond it each task adds up ZᵀZ of its Arrow batches.
WIDE_ATTRS = 8


def _partial_moments(keys: list[str], size: int):
    iu, ju = np.triu_indices(size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in frames:
            if not len(pdf):
                continue
            z = np.column_stack([np.ones(len(pdf)), np.stack(pdf["features"].to_numpy()), pdf["target"].to_numpy()])
            groups = pdf.groupby(keys).indices.items() if keys else [((), slice(None))]
            for key, rows in groups:
                part = z[rows]
                sums[key] = sums.get(key, 0.0) + part.T @ part
        for key, m in sums.items():
            values = key if isinstance(key, tuple) else (key,)
            yield pd.DataFrame({**dict(zip(keys, values)), "i": iu, "j": ju, "v": m[iu, ju]})

    return run


def normal_stats(
    df: DataFrame, attrs: int, features: str = "features", target: str = "target", keys: Sequence[str] = ()
) -> DataFrame:
    """Upper triangle of the moment matrix of z = [1, x.., y]: rows (keys, i, j, v = Σ z_i z_j).

    Both forms combine before the shuffle; the result has (attrs + 2)(attrs + 3)/2 rows per key and adds up across
    micro-batches.
    """
    keys = list(keys)
    if attrs > WIDE_ATTRS:
        rows = df.select(*keys, F.col(features).alias("features"), F.col(target).cast("double").alias("target"))
        fields = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]
        partial = rows.mapInPandas(_partial_moments(keys, attrs + 2), ", ".join([*fields, "i int, j int, v double"]))
        return partial.groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))
    z = [F.lit(1.0), *[F.get(F.col(features), F.lit(i)) for i in range(attrs)], F.col(target).cast("double")]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    wide = df.groupBy(*keys).agg(*[F.sum(z[i] * z[j]).alias(f"m{i}_{j}") for i, j in pairs])
    cells = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"m{i}_{j}").alias("v")) for i, j in pairs]
    )
    return wide.select(*keys, F.inline(cells)).filter(F.col("v").isNotNull())


def solve_normal(cells: Iterable[tuple[int, int, float]], attrs: int) -> list[float] | None:
    """Intercept and slopes from moment cells; a singular system gets its least-squares solution."""
    m = np.zeros((attrs + 2, attrs + 2))
    for i, j, v in cells:
        m[i, j] = m[j, i] = v
    if m[0, 0] <= 0:
        return None
    a, b = m[: attrs + 1, : attrs + 1], m[: attrs + 1, attrs + 1]
    scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
    w, *_ = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-12)
    return [float(v) for v in w / scale]


def fit(df: DataFrame, attrs: int, features: str = "features", target: str = "target") -> list[float] | None:
    """Least-squares weights [intercept, slopes..] over all rows; only the moment matrix reaches the driver."""
    return solve_normal([(r["i"], r["j"], r["v"]) for r in normal_stats(df, attrs, features, target).collect()], attrs)


def batch_fits(
    df: DataFrame,
    attrs: int,
    learn_type: int = INDEPENDENT,
    window_shift: int = 0,
    batch_size: int = 1000,
    features: str = "features",
    target: str = "target",
    seq: str = "seq",
    batches: tuple[int, int] | None = None,
) -> DataFrame:
    """Least-squares weights after every batch: (batch, n, weights), for independent, sliding or cumulative batches.

    Moments add up once per pane of gcd(batch_size, window_shift) positions, with map-side combine; only panes are
    repeated for overlapping batches.  Cumulative fits are running sums of those moments, so no step waits for a driver
    loop.  Only (attrs + 2)(attrs + 3)/2 cells per batch meet in one task.  ``batches`` (first, last) leaves out the
    batches outside that range.
    """
    shift = batch_shift(learn_type, window_shift, batch_size)
    pane = math.gcd(batch_size, shift)
    paned = df.withColumn("__pane", F.floor((F.col(seq) - 1) / F.lit(pane)))
    panes = normal_stats(paned, attrs, features, target, keys=["__pane"]).withColumn("__pos", F.col("__pane") + 1)
    spread = sliding_batches(panes, batch_size // pane, shift // pane, "__pos")
    if batches is not None:
        spread = spread.filter(F.col("batch").between(*batches))
    cells = spread.groupBy("batch", "i", "j").agg(F.sum("v").alias("v"))
    if learn_type == INCREMENTAL:
        cells = running(cut_lineage(cells), {"total": ("sum", "v")}, "batch", ["i", "j"], span=10_000)
        cells = cells.select("batch", "i", "j", F.col("total").alias("v"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        weights = solve_normal(zip(pdf["i"], pdf["j"], pdf["v"]), attrs)
        n = pdf.loc[(pdf["i"] == 0) & (pdf["j"] == 0), "v"].iloc[0]
        return pd.DataFrame({"batch": [pdf["batch"].iloc[0]], "n": [int(n)], "weights": [weights]})

    return cells.groupBy("batch").applyInPandas(solve, "batch bigint, n bigint, weights array<double>")


def predict(df: DataFrame, weights: Sequence[float], features: str = "features", out: str = "pred") -> DataFrame:
    return df.withColumn(out, F.lit(float(weights[0])) + dot(doubles(weights[1:]), F.col(features)))


def batch_predict(
    df: DataFrame, fits: DataFrame, size: int, shift: int, features: str = "features", target: str = "target", seq: str = "seq"
) -> DataFrame:
    """Rows with ``prediction`` by the weights of the batch they are new in, and ``stderr`` = |target − prediction|.

    A batch is the key of the join and holds at most ``size`` rows, so no key can be hot.
    """
    keyed = df.withColumn("__batch", first_batch_of(F.col(seq), size, shift))
    joined = keyed.join(fits.select(F.col("batch").alias("__batch"), "weights"), "__batch", "left")
    slopes = F.slice("weights", 2, F.size(F.col(features)))
    scored = joined.withColumn("prediction", F.get("weights", F.lit(0)) + dot(slopes, F.col(features)))
    return scored.withColumn("stderr", F.abs(F.col(target) - F.col("prediction"))).drop("__batch", "weights")


def sgd_gradient(
    df: DataFrame, weights: Sequence[float], features: str = "features", target: str = "target"
) -> DataFrame:
    """Mean gradient of the squared error: rows (i, g); i = 0 is the intercept."""
    x = F.concat(F.array(F.lit(1.0)), F.col(features))
    err = predict(df, weights, features, "__p").select((F.col("__p") - F.col(target)).alias("e"), x.alias("x"))
    return err.select("e", F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg(F.col("e") * F.col("v")).alias("g"))


def sgd_step(
    df: DataFrame,
    weights: Sequence[float],
    rate: float,
    features: str = "features",
    target: str = "target",
) -> DataFrame:
    """Weights after one gradient step over ``df`` (one micro-batch): rows (i, w)."""
    grads = sgd_gradient(df, weights, features, target)
    return grads.select("i", (F.get(doubles(weights), F.col("i")) - rate * F.col("g")).alias("w"))


def confidence_interval(df: DataFrame, value: str, ci: float, keys: Sequence[str] = ()) -> DataFrame:
    """mean ± z·s/√n per key, with the sample standard deviation and a two-sided normal quantile."""
    z = z_value(ci)
    stats = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    half = z * F.col("sd") / F.sqrt(F.col("n").cast("double"))
    return stats.select(*keys, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))
