"""Micro-cluster clustering: cluster features (CF), nearest centre, k-means steps and the macro step.

A CF is (n, ls[], ss[], st, stt): weight, per-dimension sum and sum of squares, sum and sum of squares of the arrival
time.  CFs add up, so local clusters per task merge into global ones with ordinary aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import center_format, doubles

CF_SCHEMA = "n double, ls array<double>, ss array<double>, st double, stt double"


# ---------------------------------------------------------------- nearest centre


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre; ties go to the lowest index."""
    rough = (centers**2).sum(axis=1)[None, :] - 2.0 * (x @ centers.T)
    best = rough.argmin(axis=1)
    scale = 1e-9 * (1.0 + np.abs(rough).max(axis=1) + (x**2).sum(axis=1))
    close = np.flatnonzero((rough <= (rough[np.arange(len(x)), best] + scale)[:, None]).sum(axis=1) > 1)
    if len(close):
        best[close] = _distances(x[close], centers).argmin(axis=1)
    return best, ((x - centers[best]) ** 2).sum(axis=1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def _nearest_udf(centers: np.ndarray):
    @F.pandas_udf("struct<idx int, d2 double>")
    def assign(features: pd.Series) -> pd.DataFrame:
        best, d2 = nearest(_matrix(features), centers)
        return pd.DataFrame({"idx": best.astype(np.int32), "d2": d2})

    return assign


def nearest_center(
    df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features", idx: str = "idx", d2: str = "d2"
) -> DataFrame:
    """Nearest centre per row.  The centres are a model of bounded size and travel with the tasks.

    One matrix product per Arrow batch: measured faster than generated expressions from 4 x 8 coordinates upwards.
    """
    hit = _nearest_udf(np.asarray(centers, dtype=np.float64))(F.col(features))
    return df.withColumn("__hit", hit).withColumns({idx: F.col("__hit.idx"), d2: F.col("__hit.d2")}).drop("__hit")


# ---------------------------------------------------------------- cluster features


def _collect_dims(per_dim: DataFrame, key: str) -> DataFrame:
    """CF vectors from one row per (key, dimension)."""
    vectors = F.array_sort(F.collect_list(F.struct("dim", "ls", "ss")))
    return (
        per_dim.groupBy(key)
        .agg(F.max("n").alias("n"), vectors.alias("v"), F.max("st").alias("st"), F.max("stt").alias("stt"))
        .select(
            key, "n", F.transform("v", lambda s: s["ls"]).alias("ls"), F.transform("v", lambda s: s["ss"]).alias("ss"),
            "st", "stt",
        )
    )


def cf_vectors(df: DataFrame, key: str, features: str = "features", seq: str | None = None) -> DataFrame:
    """CF per key over all rows.

    Rows are exploded by dimension right under a partial aggregation, so the shuffle carries keys x dimensions rows
    per task and a hot key costs no more than any other.
    """
    time = F.col(seq).cast("double") if seq else F.lit(0.0)
    exploded = df.select(
        F.col(key).alias("key"), time.alias("t"), F.posexplode(F.col(features).cast("array<double>")).alias("dim", "x")
    )
    per_dim = exploded.groupBy("key", "dim").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("x").alias("ls"),
        F.sum(F.col("x") * F.col("x")).alias("ss"),
        F.sum("t").alias("st"),
        F.sum(F.col("t") * F.col("t")).alias("stt"),
    )
    return _collect_dims(per_dim, "key")


def merge_cf(partials: DataFrame, key: str = "key") -> DataFrame:
    """Sum of CFs per key."""
    per_dim = (
        partials.select(key, "n", "st", "stt", F.posexplode(F.arrays_zip("ls", "ss")).alias("dim", "v"))
        .groupBy(key, "dim")
        .agg(
            F.sum("n").alias("n"), F.sum("v.ls").alias("ls"), F.sum("v.ss").alias("ss"), F.sum("st").alias("st"),
            F.sum("stt").alias("stt"),
        )
    )
    return _collect_dims(per_dim, key)


def centers_of(cfs: DataFrame) -> DataFrame:
    return cfs.withColumn("center", F.transform("ls", lambda v: v / F.col("n")))


def radius(n: Column, ls: Column, ss: Column) -> Column:
    """Root of the summed per-dimension variances."""
    variance = F.zip_with(ss, ls, lambda s, l: s / n - (l / n) * (l / n))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(variance, F.lit(0.0), lambda a, v: a + v)))


def class_means(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Mean vector per class (one row per class)."""
    return centers_of(cf_vectors(df, label, features)).select(F.col("key").alias("label"), "n", "center")


def lloyd_step(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """One k-means step over all rows: ``idx``, ``n`` and the new ``center`` of every non-empty cluster."""
    assigned = nearest_center(df, centers, features)
    cfs = cf_vectors(assigned, "idx", features)
    return centers_of(cfs).select(F.col("key").alias("idx"), "n", "center")


def cluster_ssq(
    df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features", sample: float = 1.0, seed: int = 1
) -> DataFrame:
    """Rows and sum of squared distances per nearest centre; ``sample`` < 1 evaluates a random part of the rows."""
    rows = df if sample >= 1.0 else df.sample(fraction=sample, seed=seed)
    return nearest_center(rows, centers, features).groupBy("idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d2").alias("ssq")
    )


# ---------------------------------------------------------------- micro-clusters


def weighted_kmeans(
    points: np.ndarray, weights: np.ndarray, k: int, seed: int, iterations: int, centers: np.ndarray | None = None
) -> np.ndarray:
    """Weighted k-means labels for a small set of points, from given centres or with k-means++ style seeding."""
    if centers is None:
        centers = _seeded(points, weights, k, seed)
    centers = np.array(centers, dtype=np.float64)
    labels = nearest(points, centers)[0]
    for _ in range(iterations):
        for c in range(len(centers)):
            mine = labels == c
            if mine.any():
                centers[c] = np.average(points[mine], axis=0, weights=weights[mine])
        new = nearest(points, centers)[0]
        if np.array_equal(new, labels):
            break
        labels = new
    return labels


def _seeded(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    d2 = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = d2 * weights
        if mass.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=mass / mass.sum())))
        d2 = np.minimum(d2, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _shrink(cf: tuple, m: int, seed: int) -> tuple:
    """At most ``m`` CFs with the same total mass: group the centres with a short weighted k-means, add the CFs up."""
    n, ls, ss, st, stt = cf
    if len(n) <= m:
        return cf
    labels = weighted_kmeans(ls / n[:, None], n, m, seed, 3)
    _, labels = np.unique(labels, return_inverse=True)
    size = labels.max() + 1

    def add(v: np.ndarray) -> np.ndarray:
        out = np.zeros((size, *v.shape[1:]))
        np.add.at(out, labels, v)
        return out

    return tuple(add(v) for v in cf)


def _zero_cf(rows: int, dims: int) -> tuple:
    return np.zeros(rows), np.zeros((rows, dims)), np.zeros((rows, dims)), np.zeros(rows), np.zeros(rows)


def _add_rows(cf: tuple, idx: np.ndarray, x: np.ndarray, t: np.ndarray) -> None:
    for total, value in zip(cf, (np.ones(len(x)), x, x * x, t, t * t)):
        np.add.at(total, idx, value)


def _stack(a: tuple | None, b: tuple) -> tuple:
    return b if a is None else tuple(np.concatenate([x, y]) for x, y in zip(a, b))


def _cf_frame(cf: tuple) -> pd.DataFrame:
    n, ls, ss, st, stt = cf
    return pd.DataFrame({"n": n, "ls": ls.tolist(), "ss": ss.tolist(), "st": st, "stt": stt})


def absorb(
    known: tuple | None, new: tuple | None, x: np.ndarray, t: np.ndarray, centers: np.ndarray | None, radii: np.ndarray | None,
    m: int, seed: int,
) -> tuple[tuple | None, tuple | None]:
    """Some rows: those within the radius of their nearest kernel add to ``known``, all others to at most ``m`` ``new`` CFs."""
    if centers is not None:
        best, d2 = nearest(x, centers)
        inside = d2 <= radii[best] ** 2
        if known is None:
            known = _zero_cf(len(centers), x.shape[1])
        _add_rows(known, best[inside], x[inside], t[inside])
        x, t = x[~inside], t[~inside]
    if len(x):
        new = _shrink(_stack(new, (np.ones(len(x)), x, x * x, t, t * t)), m, seed)
    return known, new


NEW = -1


def local_kernels(
    df: DataFrame,
    m: int,
    features: str = "features",
    seq: str = "seq",
    centers: np.ndarray | None = None,
    radii: np.ndarray | None = None,
    seed: int = 1,
) -> DataFrame:
    """Local clusterers: one pass over the rows of each task.

    Rows within the radius of their nearest kernel add to that kernel (``idx`` >= 0); all others form at most ``m``
    new local CFs (``idx`` = -1).  ``part`` numbers the task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        new, known = None, None
        for pdf in frames:
            if not len(pdf):
                continue
            x, t = _matrix(pdf["features"]), pdf["seq"].to_numpy(np.float64)
            known, new = absorb(known, new, x, t, centers, radii, m, seed)
        if known is not None:
            hit = np.flatnonzero(known[0] > 0)
            if len(hit):
                yield _cf_frame(tuple(v[hit] for v in known)).assign(idx=hit)
        if new is not None:
            yield _cf_frame(new).assign(idx=NEW)

    rows = df.select(F.col(features).cast("array<double>").alias("features"), F.col(seq).cast("double").alias("seq"))
    return rows.mapInPandas(run, f"{CF_SCHEMA}, idx int").withColumn("part", F.spark_partition_id().cast("bigint"))


def reduce_kernels(kernels: DataFrame, m: int, parts: int, fan_in: int = 32, seed: int = 1) -> DataFrame:
    """Merge the local CFs of ``parts`` tasks down to ``m``, ``fan_in`` tasks at a time.

    Every group holds at most ``fan_in * m`` CFs whatever the data size; no CF is dropped, only added to another.
    """

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        cf = (pdf["n"].to_numpy(), _matrix(pdf["ls"]), _matrix(pdf["ss"]), pdf["st"].to_numpy(), pdf["stt"].to_numpy())
        frame = _cf_frame(_shrink(cf, m, seed))
        frame["part"] = pdf["part"].iloc[0]
        return frame

    while True:
        kernels = kernels.withColumn("part", F.floor(F.col("part") / fan_in).cast("bigint"))
        kernels = kernels.groupBy("part").applyInPandas(merge, f"{CF_SCHEMA}, part bigint")
        if parts <= fan_in:
            return kernels.drop("part")
        parts = -(-parts // fan_in)


def macro_kmeans(kernels: Sequence[tuple], k: int, seed: int = 1, iterations: int = 50) -> list[list[float]]:
    """k centres from at most m micro-clusters (the macro step works on the bounded model, not on rows).

    Random seeding leaves the order of centres open; they are returned in ascending order.
    """
    n = np.array([r[0] for r in kernels], dtype=np.float64)
    points = np.array([r[1] for r in kernels], dtype=np.float64) / n[:, None]
    labels = weighted_kmeans(points, n, k, seed, iterations)
    centers = [np.average(points[labels == c], axis=0, weights=n[labels == c]).tolist() for c in np.unique(labels)]
    return sorted(centers)


def centers_row(spark, centers: Sequence[Sequence[float]], k: int) -> DataFrame:
    """One row ``center0 .. center{k-1}`` with the formatted centres; a missing cluster is null."""
    cols = [
        (center_format(doubles(centers[i])) if i < len(centers) else F.lit(None).cast("string")).alias(f"center{i}")
        for i in range(k)
    ]
    return spark.range(1).select(*cols)


def centers_table(spark, emitted: Sequence[tuple[int, Sequence[Sequence[float]]]], k: int) -> DataFrame:
    """One such row for every (point, centres), with its ``point``."""
    rows = [(int(p), [[float(v) for v in c] for c in centers]) for p, centers in emitted]
    table = spark.createDataFrame(rows, "point bigint, centers array<array<double>>")
    texts = [
        F.when(F.size("centers") > i, center_format(F.get("centers", F.lit(i)))).alias(f"center{i}") for i in range(k)
    ]
    return table.select("point", *texts)
