"""Upkeep of micro-clusters, snapshots, silhouettes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.api import microcluster_kmeans
from driftline.operators.cluster import nearest
from driftline.operators.kernels import ClosestPairs, PyramidalFrame, keep_up, relevance, retained, silhouette, silhouettes, stamps
from driftline.session import fresh_path


def kernels(n, dims=3, seed=1):
    rng = np.random.default_rng(seed)
    size = rng.integers(1, 400, n).astype(float)
    centers = rng.integers(0, 12, (n, dims)).astype(float)  # many ties
    time = rng.uniform(0, 1000, n)
    return size, centers * size[:, None], (centers**2 + 1) * size[:, None], time * size, (time**2 + 900) * size


def test_closest_pairs_against_brute_force():
    for seed in range(6):
        n, ls, *_ = kernels(30, seed=seed)
        n, ls, alive = n.copy(), ls.copy(), list(range(30))
        pairs = ClosestPairs(ls / n[:, None])
        while len(alive) > 2:
            centers = {i: ls[i] / n[i] for i in alive}
            best = min((float(((centers[i] - centers[j]) ** 2).sum()), i, j) for i in alive for j in alive if i < j)
            i, j = pairs.closest()
            assert float(((centers[i] - centers[j]) ** 2).sum()) == best[0] and (i, j) == best[1:]
            n[i] += n[j]
            ls[i] += ls[j]
            alive.remove(j)
            pairs.merge(i, j, ls[i] / n[i])


def test_upkeep_keeps_mass_and_ids_and_drops_only_what_is_old():
    cf = kernels(50)
    ids = [[i] for i in range(50)]
    merged, groups = keep_up(cf, ids, 12)
    assert len(merged[0]) == 12 and sorted(i for g in groups for i in g) == list(range(50))
    for v, w in zip(cf, merged):
        assert w.sum(axis=0) == pytest.approx(v.sum(axis=0))
    for g, n in zip(groups, merged[0]):
        assert n == pytest.approx(cf[0][g].sum())
    held, groups = keep_up(cf, ids, 50, oldest=400.0)
    assert [g[0] for g in groups] == np.flatnonzero(stamps(cf[0], cf[3], cf[4]) >= 400.0).tolist() and 0 < len(groups) < 50
    assert len(keep_up(cf, ids, 50, oldest=1e9)[1]) == 0


def test_relevance_is_the_mean_time_of_the_newest_rows(spark):
    rng = np.random.default_rng(3)
    n, last = 20_000, 100
    t = rng.normal(5000, 300, n)
    row = spark.createDataFrame([(float(n), float(t.sum()), float((t * t).sum()))], "n double, st double, stt double")
    stamp = row.select(relevance(F.col("n"), F.col("st"), F.col("stt"), last)).first()[0]
    assert stamp == pytest.approx(np.sort(t)[-last // 2], abs=40)  # the middle of the newest rows
    assert stamps(np.array([float(n)]), np.array([t.sum()]), np.array([(t * t).sum()]), last)[0] == pytest.approx(stamp)
    assert stamps(np.array([10.0]), np.array([50.0]), np.array([260.0]), 100)[0] == 5.0


def test_snapshots_are_dense_now_and_sparse_before():
    assert retained(0) == set() and retained(3) == {1, 2, 3}
    held = retained(1000)
    assert {996, 997, 998, 999, 1000, 992, 512} <= held and len(held) < 45
    for h in range(1, 800):  # every horizon has a snapshot within half of it
        assert min(abs(1000 - h - t) for t in held) <= 0.5 * h


def test_kernels_of_a_horizon(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i // 250 * 5, 1), rng.random()]) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "seq long, features array<double>")
    frame = PyramidalFrame(spark, fresh_path(spark, "frame"))
    microcluster_kmeans(df, "features", 2, "seq", first_batch=50, growth=1.0, frame=frame, m=15)
    assert sorted(frame._held()) == sorted(retained(20))
    for h, covered in ((50, 50), (100, 100), (130, 150), (390, 400), (5000, 1000)):
        found, rows_of = frame.horizon(h)
        got = found.select(F.sum("n"), F.sum(F.get("ls", F.lit(0))), F.sum(F.get("ss", F.lit(1))), F.sum("st")).first()
        newest = [r for r in rows if r[0] > 1000 - covered]
        want = (len(newest), sum(x[0] for _, x in newest), sum(x[1] ** 2 for _, x in newest), sum(i for i, _ in newest))
        assert rows_of == covered and tuple(got) == pytest.approx(want)
        # Each kernel is one of rows: no negative mass, centres among those of the stretch.
        assert found.filter("n <= 0").count() == 0
    with pytest.raises(ValueError):
        PyramidalFrame(spark, "x", alpha=1)
    assert PyramidalFrame(spark, fresh_path(spark, "none")).horizon(5)[1] == 0


def brute_silhouettes(x, own):
    out = []
    for i in range(len(x)):
        d2 = ((x - x[i]) ** 2).sum(axis=1)
        mine = own == own[i]
        others = [d2[own == c].mean() for c in set(own.tolist()) - {own[i]}]
        if mine.sum() < 2 or not others:
            out.append(0.0)
            continue
        a, b = d2[mine].sum() / (mine.sum() - 1), min(others)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return out


@pytest.mark.parametrize("centers", [[[0.0, 0.0], [4.0, 0.0], [0.0, 5.0], [99.0, 99.0]], [[0.0, 0.0]]])
def test_silhouettes_match_all_pairs(spark, centers):
    rng = np.random.default_rng(5)
    x = np.concatenate((rng.normal(size=(40, 2)), rng.normal(size=(30, 2)) + [4, 0], [[0.0, 6.0]]))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, features array<double>").repartition(4)
    own = nearest(x, np.array(centers))[0]
    want = brute_silhouettes(x, own)
    assert [r.silhouette for r in silhouettes(df, centers).orderBy("i").collect()] == pytest.approx(want)
    for r in silhouette(df, centers).collect():
        assert r.n == (own == r.idx).sum() and r.silhouette == pytest.approx(np.mean(np.array(want)[own == r.idx]))
    assert silhouette(df.limit(0), centers).count() == 0
