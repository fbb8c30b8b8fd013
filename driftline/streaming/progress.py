"""Counters of streaming queries from Spark's own progress events and observations."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "driftline"


def counted(stream: DataFrame, label: str | None = None, marker: str = "?", name: str = OBSERVED) -> DataFrame:
    """The stream with an observation of its rows per micro-batch, and of those that ask for a prediction."""
    asked = F.count(F.when(F.col(label) == marker, 1)) if label else F.count(F.when(F.lit(False), 1))
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), asked.alias("asked"))


class RunCounter(StreamingQueryListener):
    """Adds up every progress event of the queries it is told about (all without ``query_id``), however many there are.

    ``session.streams.addListener(counter)`` starts it.  ``points`` has the running number of rows after each micro-batch
    with data.
    """

    def __init__(self, query_id: str | None = None, name: str = OBSERVED):
        self.query_id, self.name = query_id, name
        self.instances = self.asked = self.batches = 0
        self.seconds = 0.0
        self.points: list[tuple[int, int]] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.query_id is not None and str(p.id) != self.query_id:
            return
        seen = p.observedMetrics.get(self.name)
        rows = seen["rows"] if seen is not None else p.numInputRows
        if rows:
            self.instances += rows
            self.asked += seen["asked"] if seen is not None else 0
            self.batches += 1
            self.seconds += p.durationMs.get("triggerExecution", 0) / 1000.0
            self.points.append((p.batchId, self.instances))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.query_id is None or str(event.id) == self.query_id:
            self.ended.set()


def summary(query: StreamingQuery) -> dict:
    """Rows read, micro-batches with data, and seconds spent in triggers, over the reports Spark still holds."""
    reports = [p for p in query.recentProgress if p["numInputRows"] > 0]
    return {
        "instances": sum(p["numInputRows"] for p in reports),
        "batches": len(reports),
        "seconds": sum(p["durationMs"].get("triggerExecution", 0) for p in reports) / 1000.0,
    }
