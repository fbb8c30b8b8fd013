import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import driftline
from driftline.operators.cluster import (
    cf_vectors,
    cluster_ssq,
    local_kernels,
    merge_cf,
    nearest,
    nearest_center,
    reduce_kernels,
)
from driftline.operators.microclusters import ClusterModel, ClusterParams
from driftline.operators.kmeans_stream import learn_batches, output, update


def groups(spark, n=900, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(20 * (i % 3), 1), rng.gauss(-10 * (i % 3), 1)]) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "seq long, features array<double>")


def test_nearest_ties_go_to_the_lowest_index():
    idx, d2 = nearest(np.array([[0.0, 0.0], [1e6 + 1, 0.0]]), np.array([[1.0, 0.0], [-1.0, 0.0], [1e6, 0.0], [1e6 + 2, 0.0]]))
    assert idx.tolist() == [0, 2] and d2.tolist() == [1.0, 1.0]


def test_nearest_center_against_a_loop(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(0, 1, (50, 5)), rng.normal(0, 1, (7, 5))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, features array<double>")
    for r in nearest_center(df, c.tolist()).collect():
        d = ((x[r.i] - c) ** 2).sum(axis=1)
        assert r.idx == d.argmin() and r.d2 == pytest.approx(d.min())


def test_cf_additivity(spark):
    df = groups(spark).withColumn("g", F.col("seq") % 4)
    whole = cf_vectors(df.withColumn("one", F.lit(0)), "one", seq="seq").first()
    parts = cf_vectors(df, "g", seq="seq").withColumn("all", F.lit(0))
    merged = merge_cf(parts, "all").first()
    assert merged.n == whole.n and merged.ls == pytest.approx(whole.ls) and merged.ss == pytest.approx(whole.ss)
    assert (merged.st, merged.stt) == (whole.st, whole.stt)


@pytest.mark.parametrize("partitions,fan_in", [(1, 32), (9, 2), (40, 3)])
def test_kernels_keep_all_mass(spark, partitions, fan_in):
    df = groups(spark).repartition(partitions)
    local = local_kernels(df, 10).drop("idx")
    merged = reduce_kernels(local, 10, partitions, fan_in).collect()
    assert len(merged) <= 10 and sum(r.n for r in merged) == pytest.approx(900)
    total = df.select(F.sum(F.get("features", F.lit(0)))).first()[0]
    assert sum(r.ls[0] for r in merged) == pytest.approx(total)


def test_model_absorbs_and_finds_separated_groups(spark):
    df = groups(spark)
    model = ClusterModel(ClusterParams(k=3, m=20))
    for lo in (0, 300, 600):
        model = model.learn(df.filter((F.col("seq") > lo) & (F.col("seq") <= lo + 300)))
    assert len(model.kernels) <= 20 and sum(k[0] for k in model.kernels) == pytest.approx(900)
    centers = model.centers()
    assert np.abs(np.array(centers) - [[0, 0], [20, -10], [40, -20]]).max() < 0.5
    assert cluster_ssq(df, centers).agg(F.sum("n")).first()[0] == 900


def test_horizon_drops_old_kernels_only(spark):
    df = spark.createDataFrame([(i, [0.0 if i <= 100 else 100.0]) for i in range(1, 201)], "seq long, features array<double>")
    model = ClusterModel(ClusterParams(k=2, m=10, horizon=60))
    model = model.learn(df.filter("seq <= 100")).learn(df.filter("seq > 100"))
    assert sum(k[0] for k in model.kernels) == 100 and {k[1][0] / k[0] for k in model.kernels} == {100.0}


def test_clusters_end_to_end(spark):
    df = groups(spark).select("seq", *[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(2)])
    learned = driftline.microcluster_kmeans(df, ["x0", "x1"], 3, "seq", first_batch=200)
    row = learned.predictions.first()
    assert learned.predictions.columns == ["center0", "center1", "center2"]
    got = np.array([[float(v) for v in text.strip("[]").split(",")] for text in row])
    assert np.abs(got - [[0, 0], [20, -10], [40, -20]]).max() < 0.5


def test_decayed_update_and_untouched_center(spark):
    df = spark.createDataFrame([([1.0],), ([3.0],)], "features array<double>")
    got = {r.idx: (r.n, r.center) for r in update(df, [[0.0], [100.0]], [4.0, 4.0], alpha=0.5).collect()}
    assert got == {0: (4.0, [1.0]), 1: (2.0, [100.0])}


def test_learn_types(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "seq")
    sizes = lambda t, shift: [r["count"] for r in learn_batches(df, t, shift, 10).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes(0, 0) == [10, 10] and sizes(2, 0) == [10, 10] and sizes(1, 5) == [10, 10, 10, 5]
    with pytest.raises(ValueError):
        learn_batches(df, 3, 0, 10)


def test_output_keeps_inputs(spark):
    df = spark.createDataFrame([(1.0, [3.0, 4.0])], "x double, features array<double>")
    row = output(df, [[0.0, 0.0], [9.0, 9.0]]).first()
    assert (row.x, row.stderr, row.center0, row.center1) == (1.0, 5.0, "[0.0,0.0]", "[9.0,9.0]")


@pytest.mark.parametrize("learn_type,shift", [(0, 0), (1, 50), (2, 0)])
def test_streaming_kmeans_returns_every_row_once(spark, learn_type, shift):
    df = groups(spark, 450).select("seq", *[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(2)])
    df = df.withColumnRenamed("seq", "k").withColumn("tag", F.lit("t"))
    out, interval = driftline.streaming_kmeans(df, ["x0", "x1"], 3, "k", learn_type, shift, 100, 10, 0.9, 0.95)
    rows = out.orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 451))
    assert set(out.columns) == {"k", "seq", "x0", "x1", "tag", "stderr", "center0", "center1", "center2"}
    for r in rows:
        centers = np.array([[float(v) for v in r[f"center{i}"].strip("[]").split(",")] for i in range(3)])
        assert r.stderr == pytest.approx(np.sqrt(((centers - [r.x0, r.x1]) ** 2).sum(axis=1)).min())
        assert r.stderr < 8
    ci = interval.first()
    assert ci.n == 450 and ci.low < ci.mean < ci.high


def test_streaming_kmeans_parameters(spark):
    df = spark.createDataFrame([(1, 1.0)], "k long, x double")
    for args in ({"learn_type": 3}, {"learn_type": 1, "window_shift": 0}, {"learn_type": 1, "window_shift": 2000}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            driftline.streaming_kmeans(df, ["x"], 2, "k", **args)
