"""Runs of short batches that one task learns in order: the results of batch after batch, with few jobs."""

import contextlib
import os
import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import driftline
from driftline import api
from driftline.operators.cluster import weighted_kmeans
from driftline.operators.kernels import PyramidalFrame, retained
from driftline.operators.microclusters import ClusterModel, ClusterParams
from driftline.operators.order import batch_starts, runs_of, with_batch
from driftline.plans.query_streams import TICK, stream_replay_rows
from driftline.session import fresh_path
from driftline.sources import rows as rows_source
from driftline.sources.sinks import insert_by_batch


def points(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(7 * i, rng.gauss(8 * (i % 3) + i / 200, 2), rng.gauss(-5 * (i % 3), 2)) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "k long, x double, y double").repartition(5)


@contextlib.contextmanager
def at_most_jobs(spark, limit):
    context = spark.sparkContext
    group = f"jobs-{random.random()}"
    context.setJobGroup(group, "counted")
    try:
        yield
        jobs = len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= limit


def test_runs_hold_every_batch_once():
    assert runs_of([1], 0, 10) == [] and runs_of([1, 11, 21], 25, 1) == [(0, 0), (1, 1), (2, 2)]
    assert runs_of([1, 11, 21, 31], 35, 20) == [(0, 1), (2, 3)]
    assert runs_of(batch_starts(700, 10, 2.0), 700, 100) == [(0, 2), (3, 3), (4, 4), (5, 5), (6, 6)]
    assert runs_of([1, 5, 25, 29, 33], 35, 100, longest=10) == [(0, 0), (1, 1), (2, 4)]


def test_batches_of_one_size_are_counted_off(spark):
    df = spark.range(1, 36).withColumnRenamed("id", "seq")
    for starts in ([1], [1, 11], [1, 11, 21, 31], [1, 8, 15], [1, 4, 30]):
        want = [sum(s <= i for s in starts[1:]) for i in range(1, 36)]
        assert [r.batch_id for r in with_batch(df, starts).orderBy("seq").collect()] == want


def after_each_batch(df, centers, alpha, size, growth):
    """Distances of all rows, by a loop over the batches."""
    rows = np.array([(r.k, r.x, r.y) for r in df.orderBy("k").collect()])
    c, n, out = np.array(centers, dtype=float), np.zeros(len(centers)), {}
    starts = [*batch_starts(len(rows), size, growth), len(rows) + 1]
    for a, b in zip(starts, starts[1:]):
        x = rows[a - 1 : b - 1, 1:]
        own = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        for i in range(len(c)):
            mine = x[own == i]
            if len(mine):
                c[i] = (c[i] * n[i] * alpha + mine.sum(axis=0)) / (n[i] * alpha + len(mine))
            n[i] = n[i] * alpha + len(mine)
        d = np.sqrt(((x[:, None] - c[None]) ** 2).sum(axis=2)).min(axis=1)
        out |= dict(zip(rows[a - 1 : b - 1, 0].astype(int).tolist(), d.tolist()))
    return out


GIVEN = [[0.0, 0.0], [9.0, -4.0], [400.0, 400.0]]


@pytest.mark.parametrize("values,growth", [(3_000_000, 1.0), (90, 1.0), (90, 1.4), (1, 1.0)])
def test_given_centers_move_as_batch_after_batch(spark, monkeypatch, values, growth):
    monkeypatch.setattr(api, "CHAIN_VALUES", values)
    df = points(spark, 215)
    out, interval = driftline.streaming_kmeans(df, ["x", "y"], 3, "k", 2, 0, 10, 1, 0.8, growth=growth, centers=GIVEN)
    assert out.columns == ["k", "x", "y", "seq", "stderr", "center0", "center1", "center2"]
    got = {r.k: r.stderr for r in out.collect()}
    assert got == pytest.approx(after_each_batch(df, GIVEN, 0.8, 10, growth)) and interval.first().n == 215
    assert {r.center2 for r in out.select("center2").distinct().collect()} == {"[400.0,400.0]"}


def test_jobs_of_given_centers_do_not_grow_with_the_batches(spark):
    df = points(spark, 600)
    with at_most_jobs(spark, 20):
        assert len(driftline.streaming_kmeans(df, ["x", "y"], 3, "k", 2, 0, 10, 1, 0.8, centers=GIVEN)[0].collect()) == 600


def test_columns_named_like_the_states_come_back(spark):
    df = points(spark, 60).withColumns({"batch": F.lit(5), "centers": F.lit("mine"), "counts": F.col("k")})
    rows = driftline.streaming_kmeans(df, ["x", "y"], 2, "k", 2, 0, 10, 1, 0.8, centers=GIVEN[:2])[0].collect()
    assert {(r.batch, r.centers, r.counts == r.k) for r in rows} == {(5, "mine", True)} and len(rows) == 60
    empty = driftline.streaming_kmeans(df.limit(0), ["x", "y"], 2, "k", 2, 0, 10, 1, 0.8, centers=GIVEN[:2])[0]
    assert empty.collect() == [] and empty.columns[-1] == "center1"


def test_centers_of_the_first_batch_move_on_with_few_jobs(spark):
    df = points(spark, 600)
    first = np.array([(r.x, r.y) for r in df.orderBy("k").limit(10).collect()])
    labels = weighted_kmeans(first, np.ones(10), 2, 1, 10)
    start = sorted(first[labels == c].mean(axis=0).tolist() for c in np.unique(labels))
    with at_most_jobs(spark, 24):
        rows = driftline.streaming_kmeans(df, ["x", "y"], 2, "k", 2, 0, 10, alpha=0.9)[0].collect()
    assert {r.k: r.stderr for r in rows} == pytest.approx(after_each_batch(df, start, 0.9, 10, 1.0))
    # Rows of one batch have the same centres, those of two batches other ones.
    assert len({(r.center0, r.center1) for r in rows}) == 60


def same(model, other):
    assert model.ids == other.ids
    for mine, its in zip(model.kernels, other.kernels):
        assert all(np.allclose(a, b, rtol=1e-9) for a, b in zip(mine, its))


@pytest.mark.parametrize("options", [{}, {"horizon": 90}])
def test_a_run_learns_what_batch_after_batch_learns(spark, options):
    df = points(spark, 300).selectExpr("k div 7 AS seq", "array(x, y) AS features")
    spans = [(a, min(a + 39, 300)) for a in range(1, 301, 40)]
    models = [ClusterModel(ClusterParams(k=2, m=12, **options))]
    for a, b in spans:
        batch = df.filter(F.col("seq").between(a, b)).coalesce(1).sortWithinPartitions("seq")
        models.append(models[-1].learn(batch, span=(a, b)))
    rows = models[2].learn_run(df.filter("seq > 80"), spans[2:], 3, {5, 8}, centers=True).collect()
    assert [(r.tick, r.clock, r.kernels is not None) for r in rows] == [(t, spans[t - 1][1], t in (5, 8)) for t in range(3, 9)]
    for r in rows:
        assert np.allclose(r.centers, models[r.tick].centers())
        if r.kernels is not None:
            table = spark.createDataFrame([tuple(k) for k in r.kernels], models[1].table(spark).schema)
            same(ClusterModel.from_table(models[0].params, table), models[r.tick])
    assert len(models[2].learn_run(df.filter("seq > 80"), spans[2:], 3, {8}).collect()) == 1


@pytest.mark.parametrize("short", [10_000, 39])
def test_short_and_long_batches_give_one_frame(spark, monkeypatch, short):
    monkeypatch.setattr(api, "SHORT_BATCH", short)
    monkeypatch.setattr(api, "CHAIN_VALUES", 400)
    df = points(spark, 300)
    frame = PyramidalFrame(spark, fresh_path(spark, "frame"))
    learned = driftline.microcluster_kmeans(df, ["x", "y"], 2, "k", emit_every=40, frame=frame, m=12)
    assert [r.point for r in learned.predictions.orderBy("point").collect()] == [40, 80, 120, 160, 200, 240, 280, 300]
    assert sorted(frame._held()) == sorted(retained(8)) and sum(n for n, *_ in learned.model.kernels) == pytest.approx(300)
    newest = np.array([(r.x, r.y) for r in df.orderBy("k").collect()][-100:])
    found, n = frame.horizon(90)
    sums = found.select(F.sum("n"), *[F.sum(F.get("ls", F.lit(i))) for i in range(2)]).first()
    assert n == 100 and tuple(sums) == pytest.approx((100, *newest.sum(axis=0)))


def test_jobs_of_clusters_grow_with_the_snapshots_only(spark):
    df = points(spark, 900).selectExpr("k", "array(x, y) AS v")
    frame = PyramidalFrame(spark, fresh_path(spark, "frame"))
    with at_most_jobs(spark, 60):
        driftline.microcluster_kmeans(df, "v", 2, "k", first_batch=10, growth=1.0, frame=frame, m=12)
    assert sorted(frame._held()) == sorted(retained(90)) and len(retained(90)) < 30


def test_clusters_of_no_rows(spark):
    frame = PyramidalFrame(spark, fresh_path(spark, "frame"))
    learned = driftline.microcluster_kmeans(points(spark, 30).limit(0), ["x", "y"], 2, "k", frame=frame)
    assert tuple(learned.predictions.first()) == (None, None) and frame.horizon(5)[0].count() == 0
    part = driftline.microcluster_kmeans(points(spark, 30), ["x", "y"], 2, "k", 25, first_batch=10, growth=1.0)
    assert sum(n for n, *_ in part.model.kernels) == pytest.approx(25)


def test_a_trigger_is_one_job_and_a_replayed_one_overwrites_its_files(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    pq.write_table(pa.table({"k": range(45), "text": [f"t{i}" for i in range(45)]}), f"{tmp_path}/in/part-0.parquet")
    monkeypatch.setattr(rows_source, "RANGE_ROWS", 5)
    killed = str(tmp_path / "killed")

    @F.udf("string")
    def once(k, text):  # fails in the third trigger, after another task of it has written its rows
        if k == 21 and not os.path.exists(killed):
            time.sleep(1)
            open(killed, "w").close()
            raise RuntimeError("killed")
        return text

    schema = spark.createDataFrame([], "k long, text string").schema
    key = "spark.sql.streaming.checkpointFileManagerClass"

    def run():
        stream = rows_source.stream_rows(spark, str(tmp_path / "in"), schema, 8, str(tmp_path / "position"))
        query = insert_by_batch(stream.withColumn("text", once("k", "text")), f"{tmp_path}/rows", f"{tmp_path}/checkpoint", {"processingTime": "0 seconds"})
        assert spark.conf.get(key, None) is None
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    run()
    rows = spark.read.parquet(f"{tmp_path}/rows").orderBy("k").collect()
    assert [(r.k, r.text, r.batch_id) for r in rows] == [(i, f"t{i}", i // 8) for i in range(45)]
    assert not [n for n in os.listdir(tmp_path / "rows") if os.path.isdir(tmp_path / "rows" / n)]


def test_replayed_events_by_trigger(spark, tmp_path):
    n = 3 * TICK + 7
    events = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 10).cast("double").alias("value"), F.lit("x").alias("more"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = [tuple(r) for r in stream_replay_rows(spark, str(tmp_path)).orderBy("batch_id").collect()]
    spans = [(a, min(a + TICK, n)) for a in range(0, n, TICK)]
    assert got == [(i, b - a, a, b - 1, float(sum(k % 10 for k in range(a, b)))) for i, (a, b) in enumerate(spans)]
