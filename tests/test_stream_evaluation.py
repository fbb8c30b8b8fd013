"""Stream evaluation, batch learners over streams, emission points, and what the model store keeps."""

import os
import random

import pytest
from pyspark.sql import functions as F

import driftline
from driftline.operators.evaluate import learning_curve, learning_curve_regression
from driftline.operators.order import with_seq
from driftline.session import fresh_path
from driftline.streaming.batch_learners import KMeansStream, LinearStream
from driftline.streaming.learners import ClassifierStream, ClusterStream, RegressorStream
from driftline.streaming.store import ModelStore

XY = "k long, x double, z double, y double"


def rows_xy(n, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, z = rng.random(), rng.random() + 4 * (i % 2)
        out.append((i, x, z, -0.0 if i % 9 == 8 else 1.0 + 2 * x - z))
    return out


def feed(learner, spark, rows, schema, cuts):
    for b, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        learner.step(spark.createDataFrame(rows[lo:hi], schema), b)


def rounded(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_classifier_curve_over_batches_equals_the_table_curve(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), "?" if i % 10 == 4 else rng.choice("abc")) for i in range(130)]
    learner = ClassifierStream(spark, fresh_path(spark, "c"), "k", interval=25, numeric=["x"], label="label", n_classes=3)
    feed(learner, spark, rows, "k long, x double, label string", [31, 40])
    learner.step(spark.createDataFrame(rows[40:], "k long, x double, label string"), 2)  # a replay of the last batch
    learner.curve.finish()
    got = learner.curve.points().orderBy("point").drop("classes")
    want = learning_curve(with_seq(learner.outputs("pairs"), "seq", "pos"), 3, 25, seq="pos").drop("classes")
    assert rounded(got) == rounded(want) and [r.point for r in got.collect()] == [25, 50, 75, 100, 117]
    assert learner.summary()["instances"] == 130 and learner.summary()["batches"] == 3
    assert spark.read.text(learner.path + "/curve_header").count() == 1
    assert spark.read.text(learner.path + "/curve_log").count() == 5


def test_regressor_curve_over_batches_equals_the_table_curve(spark):
    learner = RegressorStream(spark, fresh_path(spark, "r"), "k", interval=30, features=["x", "z"], target="y")
    feed(learner, spark, rows_xy(90), XY, [20, 70])
    learner.curve.finish()
    want = learning_curve_regression(with_seq(learner.outputs("pairs"), "seq", "pos"), 30, seq="pos")
    assert rounded(learner.curve.points()) == rounded(want)


@pytest.mark.parametrize("kind, shift", [(0, 0), (1, 20)])
def test_batch_learners_over_streams_equal_the_calls_on_tables(spark, kind, shift):
    rows = rows_xy(130)
    frame = spark.createDataFrame(rows, XY)
    for make, call in (
        (lambda **o: LinearStream(target="y", **o), lambda **o: driftline.streaming_linear(frame, ["x", "z"], "y", "k", **o)),
        (lambda **o: KMeansStream(k=2, **o), lambda **o: driftline.streaming_kmeans(frame, ["x", "z"], 2, "k", **o)),
    ):
        options = {"learn_type": kind, "window_shift": shift, "batch_size": 50}
        learner = make(spark=spark, path=fresh_path(spark, "b"), order_by="k", features=["x", "z"], **options)
        feed(learner, spark, rows, XY, [30, 100])
        learner.finish()
        want, _ = call(**options)
        got = learner.outputs("rows").drop("batch_id").select(*want.columns)
        assert rounded(got.fillna(-1)) == rounded(want.fillna(-1)) and got.count() == 130


def test_gradient_steps_reach_the_line(spark):
    rows = [(i, i % 7 / 7, i % 5 / 5, 1.0 + 2 * (i % 7) / 7 - (i % 5) / 5) for i in range(200)]
    frame = spark.createDataFrame(rows, XY)
    result, error = driftline.streaming_linear(
        frame, ["x", "z"], "y", "k", learn_type=2, batch_size=50, num_iterations=12, alpha=0.7
    )
    first, last = (result.filter(c).agg(F.avg("stderr")).first()[0] for c in ("k < 50", "k >= 150"))
    assert result.count() == 200 and last < 0.2 * first and error.first()["n"] == 200


def test_emission_points(spark):
    rows = [(i, float(i % 2 * 10), 0.0, 0.0) for i in range(60)]
    learner = ClusterStream(spark, fresh_path(spark, "e"), "k", features=["x", "z"], k=2, emit_every=20)
    feed(learner, spark, rows, XY, [30])
    assert sorted(r.point for r in learner.outputs("centers").collect()) == [20, 40, 60]
    table = driftline.microcluster_kmeans(spark.createDataFrame(rows, XY), ["x", "z"], 2, "k", emit_every=20).predictions
    assert sorted(r.point for r in table.collect()) == [20, 40, 60]


def test_store_keeps_the_newest_versions(spark):
    store = ModelStore(spark, fresh_path(spark, "store"), keep=2)
    for v in (0, 1, 4, 5):
        store.write("t", v, spark.range(v))
        store.commit(v, {"v": v})
    assert store.latest_before()[1] == {"v": 5} and store.latest_before(5)[1] == {"v": 4}
    assert store.read("t", 4, "id bigint").count() == 4
    for name in ("t", "commits"):
        assert sorted(n for n in os.listdir(f"{store.path}/{name}") if "=" in n) == ["version=4", "version=5"]
