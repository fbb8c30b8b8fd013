"""Upkeep and use of micro-clusters: relevance stamps, merging of the closest pair, snapshots in a pyramidal time frame,
and a silhouette from cluster features.

A kernel is a CF (see :mod:`driftline.operators.cluster`) with the list of ids of all kernels that went into it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.cluster import CF_SCHEMA, cf_vectors, nearest_center
from driftline.operators.observer import matrix

KERNEL_SCHEMA = f"{CF_SCHEMA}, ids array<bigint>"
LAST = 100  # a relevance stamp is that of the newest rows of a kernel, as many as this


# ---------------------------------------------------------------- relevance

# Rational approximation of the normal quantile, absolute error below 4.5e-4
# (Abramowitz & Stegun, Handbook of Mathematical Functions, formula 26.2.23).
QUANTILE_C = (2.515517, 0.802853, 0.010328)
QUANTILE_D = (1.432788, 0.189269, 0.001308)


def upper_quantile(p: Column) -> Column:
    """z with P(Z > z) = p of the standard normal distribution, for 0 < p <= 0.5."""
    t = F.sqrt(-2.0 * F.log(p))
    above = QUANTILE_C[0] + t * (QUANTILE_C[1] + t * QUANTILE_C[2])
    below = 1.0 + t * (QUANTILE_D[0] + t * (QUANTILE_D[1] + t * QUANTILE_D[2]))
    return t - above / below


def relevance(n: Column, st: Column, stt: Column, last: int = LAST) -> Column:
    """Relevance stamp of a CF: about the mean arrival time of its newest ``last`` rows.

    Arrival times are taken as normal with the CF's mean and deviation; the stamp is their value with a share of
    last / 2n above it.  With fewer than 2 ``last`` rows it is the mean.
    """
    mean = st / n
    deviation = F.sqrt(F.greatest(F.lit(0.0), stt / n - mean * mean))
    return F.when(n < 2.0 * last, mean).otherwise(mean + deviation * upper_quantile(last / (2.0 * n)))


def stamps(n: np.ndarray, st: np.ndarray, stt: np.ndarray, last: int = LAST) -> np.ndarray:
    """The same for the kernels of a model."""
    mean = st / n
    t = np.sqrt(-2.0 * np.log(np.minimum(0.5, last / (2.0 * n))))
    above = QUANTILE_C[0] + t * (QUANTILE_C[1] + t * QUANTILE_C[2])
    below = 1.0 + t * (QUANTILE_D[0] + t * (QUANTILE_D[1] + t * QUANTILE_D[2]))
    deviation = np.sqrt(np.maximum(stt / n - mean * mean, 0.0))
    return np.where(n < 2.0 * last, mean, mean + deviation * (t - above / below))


# ---------------------------------------------------------------- closest pair


class ClosestPairs:
    """Nearest other centre of each kernel, kept up while kernels merge: a merger costs one pass over the kernels, plus
    one for each kernel whose nearest was one of the two.  Ties go to the lower numbers."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers.astype(np.float64).copy()
        self.alive = np.ones(len(centers), dtype=bool)
        self.near = np.zeros(len(centers), dtype=np.int64)
        self.d2 = np.full(len(centers), np.inf)
        for i in range(len(centers)):
            self._look(i)

    def _distances(self, i: int) -> np.ndarray:
        d2 = ((self.centers - self.centers[i]) ** 2).sum(axis=1)
        d2[~self.alive] = np.inf
        d2[i] = np.inf
        return d2

    def _look(self, i: int) -> None:
        d2 = self._distances(i)
        self.near[i] = int(d2.argmin())
        self.d2[i] = d2[self.near[i]]

    def closest(self) -> tuple[int, int]:
        """The closest pair (i, j), i < j."""
        d2 = np.where(self.alive, self.d2, np.inf)
        ties = np.flatnonzero(d2 == d2.min())
        return min((min(i, int(self.near[i])), max(i, int(self.near[i]))) for i in ties.tolist())

    def merge(self, i: int, j: int, center: np.ndarray) -> None:
        """Kernel j goes into kernel i, whose centre moves."""
        self.alive[j] = False
        self.centers[i] = center
        for k in np.flatnonzero(self.alive & ((self.near == i) | (self.near == j))).tolist():
            self._look(k)
        self._look(i)
        d2 = self._distances(i)
        closer = self.alive & ((d2 < self.d2) | ((d2 == self.d2) & (i < self.near)))
        closer[i] = False
        self.near[closer], self.d2[closer] = i, d2[closer]


def keep_up(
    cf: tuple, ids: list[list[int]], m: int, oldest: float | None = None, last: int = LAST
) -> tuple[tuple, list[list[int]]]:
    """At most ``m`` kernels: those with a relevance stamp before ``oldest`` go, then the closest pairs merge.

    Nothing is dropped unless ``oldest`` is given.
    """
    cf = tuple(np.array(v, dtype=np.float64) for v in cf)
    if oldest is not None:
        fresh = stamps(cf[0], cf[3], cf[4], last) >= oldest
        cf, ids = tuple(v[fresh] for v in cf), [i for i, f in zip(ids, fresh) if f]
    if len(cf[0]) <= m:
        return cf, ids
    ids = [list(i) for i in ids]
    pairs = ClosestPairs(cf[1] / cf[0][:, None])
    while int(pairs.alive.sum()) > max(1, m):
        i, j = pairs.closest()
        for v in cf:
            v[i] += v[j]
        ids[i] += ids[j]
        pairs.merge(i, j, cf[1][i] / cf[0][i])
    return tuple(v[pairs.alive] for v in cf), [sorted(x) for x, a in zip(ids, pairs.alive) if a]


# ---------------------------------------------------------------- pyramidal time frame


def retained(tick: int, alpha: int = 2, keep: int = 5) -> set[int]:
    """Ticks whose snapshots are held at ``tick``: of each order i the last ``keep`` multiples of alpha^i.

    About keep · log(tick) of them; for any horizon one lies within a share of it that falls with ``keep``.
    """
    held, step = set(), 1
    while step <= max(1, tick):
        newest = tick - tick % step
        held |= {t for t in range(newest, newest - keep * step, -step) if t > 0}
        step *= alpha
    return held


class PyramidalFrame:
    """Snapshots of the kernels of a model in a shared folder, dense for the recent past and sparse before."""

    def __init__(self, spark: SparkSession, path: str, alpha: int = 2, keep: int = 5):
        if alpha < 2 or keep < 1:
            raise ValueError(f"alpha, keep: required 2 or more and 1 or more but found {alpha} and {keep}")
        self.spark, self.path, self.alpha, self.keep = spark, path.rstrip("/"), alpha, keep

    def _held(self) -> dict[int, tuple[int, object]]:
        """Clock and folder of every snapshot, by tick."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return {}
        found = {}
        for f in files.listStatus(root):
            parts = dict(p.split("=") for p in f.getPath().getName().split(",") if "=" in p)
            if "tick" in parts:
                found[int(parts["tick"])] = (int(parts["clock"]), f.getPath())
        return found

    def add(self, tick: int, clock: int, kernels: DataFrame) -> None:
        """Store the kernels after ``clock`` rows under ``tick`` (1, 2, 3, ...) and let go of those no longer held.

        A repeated tick replaces its snapshot.
        """
        kernels.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tick={tick},clock={clock}")
        wanted = retained(tick, self.alpha, self.keep)
        for t, (_, folder) in self._held().items():
            if t <= tick and t not in wanted:
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def kept(self, tick: int) -> set[int]:
        """Ticks whose snapshots are still held after ``tick``; those of all others need not be added."""
        return retained(tick, self.alpha, self.keep)

    def horizon(self, rows: int) -> tuple[DataFrame, int]:
        """Kernels of the newest ``rows`` rows, or of up to the next longer stretch a snapshot is held for, and how many rows
        that is."""
        held = sorted(self._held().items())
        if not held:
            return self.spark.createDataFrame([], KERNEL_SCHEMA), 0
        now = held[-1][1][0]
        read = lambda folder: self.spark.read.schema(KERNEL_SCHEMA).parquet(folder.toString())
        current = read(held[-1][1][1])
        before = [(clock, folder) for _, (clock, folder) in held if clock <= now - rows]
        if not before:
            return current, now
        clock, folder = before[-1]
        return subtract(current, read(folder)), now - clock


def subtract(current: DataFrame, past: DataFrame) -> DataFrame:
    """Kernels without what an earlier snapshot of them held, matched by ids; kernels with nothing left are gone.

    Kernels only ever merge, so all ids of a past kernel lie in one kernel of now.  A past kernel that has been deleted
    since is not taken from any other.
    """
    keyed = current.withColumn("key", F.array_min("ids"))
    ids = keyed.select("key", F.explode("ids").alias("id"))
    old = past.withColumn("id", F.array_min("ids")).drop("ids").join(ids, "id")
    flat = lambda df, sign: df.select(
        "key", (sign * F.col("n")).alias("n"), (sign * F.col("st")).alias("st"), (sign * F.col("stt")).alias("stt"),
        F.posexplode(F.arrays_zip("ls", "ss")).alias("dim", "v"),
    ).select("key", "dim", "n", "st", "stt", (sign * F.col("v.ls")).alias("ls"), (sign * F.col("v.ss")).alias("ss"))
    sums = flat(keyed, 1.0).unionByName(flat(old, -1.0)).groupBy("key", "dim").agg(*[F.sum(c).alias(c) for c in ("n", "st", "stt", "ls", "ss")])
    vectors = F.array_sort(F.collect_list(F.struct("dim", "ls", "ss")))
    left = sums.filter("n > 1e-6").groupBy("key").agg(F.max("n").alias("n"), vectors.alias("v"), F.max("st").alias("st"), F.max("stt").alias("stt"))
    return left.join(keyed.select("key", "ids"), "key").select(
        "n", F.transform("v", lambda s: s["ls"]).alias("ls"), F.transform("v", lambda s: s["ss"]).alias("ss"), "st", "stt", "ids"
    )


# ---------------------------------------------------------------- silhouette


def silhouettes(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features", idx: str = "idx") -> DataFrame:
    """Rows with their nearest centre ``idx`` and ``silhouette`` for squared distances, without looking at pairs.

    The mean squared distance of x to the rows of a cluster is |x|² − 2 x·LS/n + SS/n, so the clusters' CFs are enough:
    one pass for them, one for the rows.  A row alone in its cluster, or without another cluster, scores 0.
    """
    rows = nearest_center(df, centers, features, idx).drop("d2")
    found = cf_vectors(rows, idx, features).collect()  # one row a cluster
    if not found:
        return rows.withColumn("silhouette", F.lit(0.0))
    width = len(found[0]["ls"])
    place = np.full(len(centers), -1)
    place[[r["key"] for r in found]] = np.arange(len(found))
    sums = (np.array([r["n"] for r in found]), np.array([r["ls"] for r in found]), np.array([sum(r["ss"]) for r in found]))
    shared = df.sparkSession.sparkContext.broadcast((place, *sums))

    @F.arrow_udf("double")
    def scored(x: pa.Array, own: pa.Array) -> pa.Array:
        place, n, ls, ss = shared.value
        rows = matrix(x, width)
        mine, at = place[own.to_numpy()], np.arange(len(rows))
        mean = (rows**2).sum(axis=1)[:, None] - 2.0 * rows @ (ls / n[:, None]).T + ss / n
        inside = mean[at, mine] * n[mine] / np.maximum(n[mine] - 1.0, 1.0)
        mean[at, mine] = np.inf
        other = mean.min(axis=1)
        top = np.maximum(inside, other)
        score = np.where((n[mine] > 1) & np.isfinite(other) & (top > 0), (other - inside) / np.where(top > 0, top, 1.0), 0.0)
        return pa.array(np.where(np.isfinite(score), score, 0.0))

    return rows.withColumn("silhouette", scored(F.col(features), F.col(idx)))


def silhouette(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Rows and mean silhouette of each cluster."""
    return silhouettes(df, centers, features).groupBy("idx").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))
