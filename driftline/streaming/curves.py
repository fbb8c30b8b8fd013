"""Learning curves of a stream: a point is written in the micro-batch that completes it.

Between micro-batches only two rows of counters are kept: the sum of all complete steps (step 0) and the open step.
Outputs of batch b are folders that a replay of b replaces:

``curve``        one row per point
``curve_csv``    one line per measurement, without header; the header is the file in ``curve_header`` (written once)
``curve_log``    one line of text per point; each of them also goes to the log

``curve.csv`` is one file with the header, all lines and, after :meth:`StreamCurve.finish`, ``# COMPLETED``.
"""

from __future__ import annotations

import dataclasses
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.evaluate import (
    ERRORS,
    counter_names,
    curve_points,
    curve_steps,
    error_points,
    error_steps,
    measurements_long,
    no_change_flag,
    regression_errors,
    running_steps,
)
from driftline.operators.order import with_seq
from driftline.session import cut_lineage
from driftline.sources.sinks import callback, write_batch, write_curve_csv, write_curve_file
from driftline.streaming.store import ModelStore

log = logging.getLogger(__name__)

TABLE = "curve_state"
LAST = 2**31 - 1  # batch number of the lines written when the stream ends


@dataclasses.dataclass
class StreamCurve:
    """Evaluation of (seq, truth, pred) rows that arrive in micro-batches; ``n_classes`` None means regression."""

    spark: SparkSession
    path: str
    store: ModelStore
    n_classes: int | None = None
    every: int = 1000

    def __post_init__(self):
        if self.every < 1:
            raise ValueError(f"interval: required 1 or more but found {self.every}")

    @property
    def _counters(self) -> list[str]:
        return list(ERRORS) if self.n_classes is None else counter_names(self.n_classes)

    @property
    def _schema(self) -> str:
        return ", ".join(["step bigint", "rows bigint", *[f"{c} double" for c in self._counters]])

    def _steps(self, pairs: DataFrame, before: dict) -> DataFrame:
        numbered = with_seq(pairs.select("seq", "truth", "pred"), "seq", "pos")
        step = F.ceil((F.col("pos") + F.lit(before["labelled"])) / F.lit(self.every))
        if self.n_classes is None:
            errors = regression_errors(numbered, seq="pos", before=(before["total"], before["labelled"]))
            return error_steps(errors.withColumnRenamed("seq", "pos"), step)
        flagged = no_change_flag(numbered.withColumn("w", F.lit(1.0)), "truth", "pos", before=before["last"])
        return curve_steps(flagged, self.n_classes, step)

    def _points(self, steps: DataFrame, which: Column) -> DataFrame:
        sums = running_steps(steps, self._counters).filter((F.col("step") > 0) & which)
        if self.n_classes is None:
            return error_points(sums, self.every)
        return curve_points(sums, self.n_classes, self.every)

    def add(self, pairs: DataFrame, batch_id: int, prior: tuple[int, dict] | None) -> dict:
        """Write the points that ``pairs`` (a stored table) completes; returns what the commit has to hold."""
        before = prior[1]["curve"] if prior else {"labelled": 0, "last": 0, "total": 0.0}
        counters = self._counters
        steps = self._steps(pairs, before).select("step", "rows", *counters)
        if prior:
            steps = steps.unionByName(self.store.read(TABLE, prior[0], self._schema))
        merged = steps.groupBy("step").agg(*[F.sum(c).alias(c) for c in ("rows", *counters)])
        merged = cut_lineage(merged)
        new = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.max_by("truth", "seq").alias("last"), F.sum(F.col("truth").cast("double")).alias("total")
        ).first()
        labelled = before["labelled"] + new["n"]
        self._write(self._points(merged, F.col("rows") == self.every), batch_id, False)
        open_step = labelled // self.every + 1
        kept = merged.withColumn("step", F.when(F.col("step") < open_step, F.lit(0)).otherwise(F.col("step")).cast("bigint"))
        state = kept.groupBy("step").agg(*[F.sum(c).alias(c) for c in ("rows", *counters)])
        self.store.write(TABLE, batch_id, state)
        # The last truth of a regression is never looked at; its running mean needs the sum of the targets.
        last = before["last"] if new["last"] is None or self.n_classes is None else int(new["last"])
        return {"labelled": labelled, "last": last, "total": before["total"] + (new["total"] or 0.0)}

    def _write(self, points: DataFrame, batch_id: int, completed: bool) -> None:
        write_batch(points, f"{self.path}/curve", batch_id)
        written = self.spark.read.schema(points.schema).parquet(f"{self.path}/curve/batch_id={batch_id}")
        long = written if self.n_classes is None else measurements_long(written, self.n_classes)
        write_curve_csv(long, self.path, batch_id, completed)
        plain = written.drop("classes")
        line = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in plain.columns])
        plain.select(line.alias("value")).write.mode("overwrite").text(f"{self.path}/curve_log/batch_id={batch_id}")
        # Every point is one line of the log; they pass one partition at a time.
        for point in plain.orderBy("point").toLocalIterator():
            log.info("measurement: %s", point.asDict())

    def finish(self) -> None:
        """Write the final partial point, if rows follow the last complete one, and mark the CSV as completed."""
        found = self.store.latest_before()
        if found is not None:
            self._write(self._points(self.store.read(TABLE, found[0], self._schema), F.lit(True)), LAST, True)
            write_curve_file(self.spark, self.path)

    def file(self) -> str:
        """Path of one CSV file with the header and all lines so far, brought up to date."""
        return write_curve_file(self.spark, self.path)

    def points(self) -> DataFrame:
        """All points written so far."""
        return self.spark.read.parquet(f"{self.path}/curve").drop("batch_id")


def evaluation_stream(stream: DataFrame, curve: StreamCurve, trigger: dict | None = None):
    """Evaluate a stream of (seq, truth, pred) rows; ``seq`` is an arrival number that only grows."""

    def step(batch_id: int, rows: DataFrame) -> None:
        prior = curve.store.latest_before(batch_id)
        rows = rows.persist()
        try:
            curve.store.commit(batch_id, {"curve": curve.add(rows, batch_id, prior)})
        finally:
            rows.unpersist()

    return callback(stream, step, f"{curve.path}/checkpoint", trigger)
