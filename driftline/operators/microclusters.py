"""Micro-cluster learner: local kernels per task, merged into at most m global ones, and k centres from those."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence
from collections.abc import Set as AbstractSet

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.cluster import NEW, _distances, _stack, absorb, local_kernels, macro_kmeans, merge_cf, reduce_kernels
from driftline.operators.kernels import KERNEL_SCHEMA, LAST, keep_up
from driftline.operators.observer import matrix
from driftline.session import cut_lineage

# Rows of :meth:`ClusterModel.learn_run`, for Spark and for Arrow.
RUN_SCHEMA = f"tick bigint, clock bigint, centers array<array<double>>, kernels array<struct<{KERNEL_SCHEMA}>>"
_DOUBLES = pa.list_(pa.float64())
KERNEL = pa.struct(
    [("n", pa.float64()), ("ls", _DOUBLES), ("ss", _DOUBLES), ("st", pa.float64()), ("stt", pa.float64()), ("ids", pa.list_(pa.int64()))]
)
RUN = pa.schema([("tick", pa.int64()), ("clock", pa.int64()), ("centers", pa.list_(_DOUBLES)), ("kernels", pa.list_(KERNEL))])


@dataclasses.dataclass(frozen=True)
class ClusterParams:
    """``horizon``: kernels whose relevance stamp is further back than this many rows are deleted (None keeps all).
    ``last``: rows that a relevance stamp speaks for."""

    k: int
    m: int = 100
    radius_factor: float = 2.0
    horizon: int | None = None
    last: int = LAST
    seed: int = 1


@dataclasses.dataclass
class ClusterModel:
    """At most m kernels, with the ids of all kernels that went into each; the only state of the clusterer."""

    params: ClusterParams
    kernels: list[tuple] = dataclasses.field(default_factory=list)
    ids: list[list[int]] = dataclasses.field(default_factory=list)

    def _arrays(self) -> tuple:
        n, ls, ss, st, stt = zip(*self.kernels)
        return tuple(np.asarray(v, dtype=np.float64) for v in (n, ls, ss, st, stt))

    def radii(self) -> np.ndarray:
        """factor x RMS deviation; a kernel without spread takes the distance to its nearest neighbour."""
        n, ls, ss, _, _ = self._arrays()
        centers = ls / n[:, None]
        rms = np.sqrt(np.maximum(ss / n[:, None] - centers**2, 0.0).sum(axis=1))
        out = self.params.radius_factor * rms
        single = out <= 1e-12 * (1.0 + np.abs(centers).sum(axis=1))
        if single.any() and len(n) > 1:
            d2 = _distances(centers[single], centers)
            d2[d2 <= 0] = np.inf
            nearest_other = np.sqrt(d2.min(axis=1))
            out[single] = np.where(np.isfinite(nearest_other), nearest_other, 0.0)
        return out

    def learn(
        self, df: DataFrame, features: str = "features", seq: str = "seq", span: tuple[int, int] | None = None
    ) -> ClusterModel:
        """Kernels after one micro-batch: one pass over the rows, then merges of bounded groups."""
        p = self.params
        centers = radii = None
        if self.kernels:
            n, ls, *_ = self._arrays()
            centers, radii = ls / n[:, None], self.radii()
        local = cut_lineage(local_kernels(df, p.m, features, seq, centers, radii, p.seed))
        last_part = local.agg(F.max("part")).first()[0]
        if last_part is None:
            return self
        fresh = reduce_kernels(local.filter(F.col("idx") == NEW).drop("idx"), p.m, last_part + 1, seed=p.seed)
        new = [(r["n"], r["ls"], r["ss"], r["st"], r["stt"]) for r in fresh.collect()]
        new = tuple(np.asarray(v, dtype=np.float64) for v in zip(*new)) if new else None
        have = self._arrays() if self.kernels else None
        if have is not None:
            hit = merge_cf(local.filter(F.col("idx") != NEW), "idx").collect()
            for r in hit:
                for total, name in zip(have, ("n", "ls", "ss", "st", "stt")):
                    total[r["idx"]] += np.asarray(r[name])
        return self._joined(have, new, span)

    def _joined(self, have: tuple | None, new: tuple | None, span: tuple[int, int] | None) -> ClusterModel:
        """The model whose own kernels have become ``have``, with ``new`` ones, at most m in all."""
        p = self.params
        ids = [list(i) for i in self.ids]
        if new is not None:
            first = 1 + max((group[-1] for group in ids), default=0)  # the ids of a kernel ascend
            ids += [[first + i] for i in range(len(new[0]))]
            have = _stack(have, tuple(v[np.argsort(new[3] / new[0], kind="stable")] for v in new))
        oldest = None
        if p.horizon is not None:
            clock = span[1] if span else (have[3] / have[0]).max()
            oldest = clock - p.horizon
        have, ids = keep_up(have, ids, p.m, oldest, p.last)
        return ClusterModel(p, [tuple(v.tolist() if hasattr(v, "tolist") else v for v in row) for row in zip(*have)], ids)

    def learn_run(
        self, df: DataFrame, spans: Sequence[tuple[int, int]], first: int, wanted: AbstractSet[int], centers: bool = False
    ) -> DataFrame:
        """Consecutive short micro-batches learned by one task that takes their rows in order: (tick, clock, centers, kernels).

        ``spans`` are their first and last sequence numbers; they are ticks ``first``, ``first`` + 1, ...  There is a row for
        each tick in ``wanted`` and, with ``centers``, for every other, without its kernels.
        """
        begin, start = np.array([a for a, _ in spans]), self

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, now, known, new = start, None, None, None

            def close() -> pa.RecordBatch | None:
                nonlocal model, known, new
                have = model._arrays() if model.kernels else None
                if known is not None:
                    have = tuple(a + b for a, b in zip(have, known))
                model, known, new = model._joined(have, new, spans[now]), None, None
                kernels = [dict(zip(KERNEL.names, (*k, i))) for k, i in zip(model.kernels, model.ids)] if first + now in wanted else None
                if kernels is None and not centers:
                    return None
                found = model.centers() if centers else None
                return pa.RecordBatch.from_pylist([{"tick": first + now, "clock": spans[now][1], "centers": found, "kernels": kernels}], RUN)

            at = radii = None
            for frame in frames:
                if not len(frame):
                    continue
                seq = frame.column("seq").to_numpy()
                x = matrix(frame.column("features"), len(frame.column("features")[0]))
                batch = np.searchsorted(begin, seq, side="right") - 1
                for part in np.split(np.arange(len(seq)), np.flatnonzero(np.diff(batch)) + 1):
                    if now != batch[part[0]]:
                        if now is not None and (row := close()) is not None:
                            yield row
                        now, at, radii = int(batch[part[0]]), None, None
                        if model.kernels:
                            n, ls, *_ = model._arrays()
                            at, radii = ls / n[:, None], model.radii()
                    rows = slice(part[0], part[-1] + 1)
                    known, new = absorb(known, new, x[rows], seq[rows].astype(np.float64), at, radii, model.params.m, model.params.seed)
            if now is not None and (row := close()) is not None:
                yield row

        rows = df.select(F.col("seq").cast("bigint").alias("seq"), F.col("features").cast("array<double>").alias("features"))
        return rows.coalesce(1).sortWithinPartitions("seq").mapInArrow(run, RUN_SCHEMA)

    def centers(self) -> list[list[float]]:
        return macro_kmeans(self.kernels, self.params.k, self.params.seed) if self.kernels else []

    def table(self, spark) -> DataFrame:
        rows = [(float(n), list(ls), list(ss), float(st), float(stt), i) for (n, ls, ss, st, stt), i in zip(self.kernels, self.ids)]
        return spark.createDataFrame(rows, KERNEL_SCHEMA)

    @staticmethod
    def from_table(params: ClusterParams, table: DataFrame) -> ClusterModel:
        rows = sorted(table.select("n", "ls", "ss", "st", "stt", "ids").collect(), key=lambda r: min(r["ids"]))
        return ClusterModel(params, [tuple(r)[:5] for r in rows], [list(r["ids"]) for r in rows])
