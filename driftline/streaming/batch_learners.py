"""Streaming k-means and linear regression as calls on a stream, with learn types 0, 1 and 2.

Types 0 and 1 fit batches of ``batch_size`` arrivals (1: batches that advance by ``window_shift``), whatever the
micro-batches are: rows wait in the store until their batch is complete, at most ``batch_size`` of them.  ``finish``
fits the batches that are still open, so the rows in ``outputs("rows")`` then equal those of the call on a table.
Type 2 keeps one model that every micro-batch moves.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import vectorize
from driftline.operators.kmeans_stream import (
    INCREMENTAL,
    INDEPENDENT,
    batch_kmeans,
    batch_output,
    batch_shift,
    first_batch_of,
    output,
    update,
)
from driftline.operators.linear import batch_fits, batch_predict, confidence_interval, predict, sgd_step
from driftline.schema import known_target
from driftline.session import cut_lineage
from driftline.sources.sinks import write_batch
from driftline.streaming.curves import LAST
from driftline.streaming.learners import _Learner


@dataclasses.dataclass
class _BatchLearner(_Learner):
    features: Sequence[str] | str = ()
    learn_type: int = INDEPENDENT
    window_shift: int = 0
    batch_size: int = 1000
    num_iterations: int = 10
    alpha: float = 1.0
    ci: float = 0.95

    def __post_init__(self):
        if self.batch_size < 1 or self.num_iterations < 1:
            raise ValueError("required batch_size >= 1 and num_iterations >= 1")
        self.shift = batch_shift(self.learn_type, self.window_shift, self.batch_size)

    def _scored(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        """Rows that are new in batches first..last, with the output of their batch."""
        raise NotImplementedError

    def _moved(self, rows: DataFrame, batch_id: int, model: dict | None) -> tuple[DataFrame, dict]:
        """Output rows of one micro-batch and the model after it."""
        raise NotImplementedError

    def _coded(self, rows: DataFrame) -> DataFrame:
        single = isinstance(self.features, str)
        return rows.withColumn("features", F.col(self.features).cast("array<double>") if single else vectorize(self.features))

    def _write(self, scored: DataFrame, batch_id: int) -> None:
        write_batch(scored.drop("features"), f"{self.path}/rows", batch_id)

    def _learn(self, rows: DataFrame, batch_id: int, prior) -> dict:
        coded = self._stored("arrived", self._coded(rows), batch_id)
        if self.learn_type == INCREMENTAL:
            scored, model = self._moved(coded, batch_id, prior[1]["model"] if prior else None)
            self._write(scored, batch_id)
            return {"model": model}
        first = prior[1]["next"] if prior else 0
        upto = coded.agg(F.max("seq")).first()[0] or (prior[1]["upto"] if prior else 0)
        pool = coded.unionByName(self.store.read("waiting", prior[0], coded.schema)) if prior else coded
        following = max(first, (upto - self.batch_size) // self.shift + 1)
        if following > first:
            self._write(self._scored(pool, first, following - 1), batch_id)
        self.store.write("waiting", batch_id, pool.filter(F.col("seq") > following * self.shift))
        return {"next": following, "upto": upto, "schema": coded.schema.json()}

    def finish(self) -> None:
        """Fit the batches that no further row will complete."""
        found = self.store.latest_before()
        if found is None or self.learn_type == INCREMENTAL:
            return
        version, meta = found
        waiting = self.spark.read.parquet(f"{self.store.path}/waiting/version={version}")
        last = max(meta["next"], -(-(meta["upto"] - self.batch_size) // self.shift))
        self._write(self._scored(waiting, meta["next"], last), LAST)

    def interval_of_error(self) -> DataFrame:
        """Mean of ``stderr`` over all output rows, with its confidence interval at level ``ci``."""
        return confidence_interval(self.outputs("rows"), "stderr", self.ci)

    def _new_in(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        return rows.filter(first_batch_of(F.col("seq"), self.batch_size, self.shift).between(first, last))


@dataclasses.dataclass
class KMeansStream(_BatchLearner):
    """Every row with all its inputs, ``stderr`` (distance to the nearest centre) and ``center0 .. center{k-1}``.

    Type 2 starts with ``centers`` or the k-means of the first ``batch_size`` rows and decays old rows by ``alpha`` per
    micro-batch; a row is given the centres after its micro-batch.
    """

    k: int = 2
    centers: Sequence[Sequence[float]] | None = None

    def _scored(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        fits = batch_kmeans(
            rows, self.k, self.learn_type, self.window_shift, self.batch_size, self.num_iterations, batches=(first, last)
        )
        return batch_output(self._new_in(rows, first, last), cut_lineage(fits), self.k, self.batch_size, self.shift)

    def _moved(self, rows: DataFrame, batch_id: int, model: dict | None) -> tuple[DataFrame, dict]:
        if model is None and self.centers is not None:
            model = {"centers": self.centers, "counts": [0.0] * len(self.centers)}
        if model is None:
            start = batch_kmeans(rows.filter(F.col("seq") <= self.batch_size), self.k, INDEPENDENT, 0, self.batch_size, self.num_iterations)
            centers = [list(c) for c in start.first()["centers"]]
            model = {"centers": centers, "counts": [0.0] * len(centers)}
        state = sorted(update(rows, model["centers"], model["counts"], self.alpha).collect(), key=lambda r: r["idx"])
        model = {"centers": [list(r["center"]) for r in state], "counts": [r["n"] for r in state]}
        return output(rows, model["centers"]), model


@dataclasses.dataclass
class LinearStream(_BatchLearner):
    """Every row with all its inputs, ``prediction`` and ``stderr`` = |target − prediction|.

    Types 0 and 1 are least squares over the batch; rows without a target (null, NaN or the mark for prediction) are
    predicted and not learned from.  Type 2 predicts with the weights before the micro-batch and then takes
    ``num_iterations`` gradient steps of rate ``alpha`` over it; features should be of a similar scale.
    """

    target: str = "target"

    def _coded(self, rows: DataFrame) -> DataFrame:
        return super()._coded(rows).withColumn("__y", known_target(self.target))

    def _write(self, scored: DataFrame, batch_id: int) -> None:
        super()._write(scored.drop("__y"), batch_id)

    def _scored(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        fits = batch_fits(
            rows.filter("__y IS NOT NULL"), len(self.features), self.learn_type, self.window_shift, self.batch_size,
            target="__y", batches=(first, last),
        )
        return batch_predict(self._new_in(rows, first, last), cut_lineage(fits), self.batch_size, self.shift, target="__y")

    def _moved(self, rows: DataFrame, batch_id: int, model: dict | None) -> tuple[DataFrame, dict]:
        """Weights with one entry per feature: ``features`` has to be a list of columns here."""
        before = weights = model["weights"] if model else [0.0] * (len(self.features) + 1)
        known = rows.filter("__y IS NOT NULL")
        for _ in range(self.num_iterations):
            steps = {r["i"]: r["w"] for r in sgd_step(known, weights, self.alpha, target="__y").collect()}
            weights = [steps.get(i, w) for i, w in enumerate(weights)]
        scored = predict(rows, before, out="prediction").withColumn("stderr", F.abs(F.col("__y") - F.col("prediction")))
        return scored, {"weights": weights}
