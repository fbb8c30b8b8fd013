import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

import driftline
from driftline.operators.tree import (
    LEAF,
    NOMINAL,
    POISSON_LIMITS,
    TreeModel,
    TreeParams,
    majority_vote,
    nominal_gain,
    numeric_gains,
    numeric_stats,
    split_decision,
    with_members,
)


def entropy(counts):
    n = sum(counts)
    return -sum(c / n * math.log2(c / n) for c in counts if c)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows, 1)], "seq long, features array<double>, label int")


def blobs(n, seed=1):
    rng = random.Random(seed)
    return [([rng.gauss(3 * (i % 2), 0.5), rng.gauss(0, 1)], i % 2) for i in range(n)]


def test_nominal_gain_against_entropies(spark):
    cells = {(0, 0): 5, (0, 1): 1, (1, 0): 2, (1, 1): 8, (2, 1): 4}
    df = spark.createDataFrame([(0, 0, v, c, float(n)) for (v, c), n in cells.items()], "leaf int, attr int, value int, label int, n double")
    total = sum(cells.values())
    inner = sum(sum(n for (v, _), n in cells.items() if v == w) / total * entropy([n for (v, _), n in cells.items() if v == w]) for w in range(3))
    assert nominal_gain(df).first().gain == pytest.approx(entropy([7, 13]) - inner)


def test_numeric_gain_and_left_mass(spark):
    stats = numeric_stats(frame(spark, blobs(400)).withColumn("leaf", F.lit(0)), 2)
    best = numeric_gains(stats).orderBy(F.desc("gain")).first()
    assert best.attr == 0 and 1.0 < best.threshold < 2.0 and best.gain > 0.9
    for s in best.sides:
        assert 0.0 <= s.left <= s.n


def test_statistics_do_not_depend_on_batches_or_order(spark):
    rows = frame(spark, blobs(120)).withColumn("leaf", F.lit(0))
    whole = {(r.label, r.attr): r for r in numeric_stats(rows, 2).collect()}
    for parts in (3, 10):
        pieces = [numeric_stats(rows.filter(F.col("seq") % parts == i), 2) for i in range(parts)]
        union = pieces[0]
        for p in pieces[1:]:
            union = union.unionByName(p)
        merged = union.groupBy("label", "attr").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        for r in merged.collect():
            w = whole[(r.label, r.attr)]
            assert (r.n, r.lo, r.hi) == (w.n, w.lo, w.hi)
            assert r.s == pytest.approx(w.s) and r.q == pytest.approx(w.q)


def test_hoeffding_bound_shrinks_and_ties_split(spark):
    rows = [(i, a, g, n) for i, (n, gs) in enumerate([(100.0, (0.3, 0.2)), (10_000.0, (0.3, 0.2)), (1e6, (0.2, 0.2)), (1e6, (0.0, 0.0))]) for a, g in enumerate(gs)]
    df = spark.createDataFrame(rows, "leaf int, attr int, gain double, n double")
    got = split_decision(df, n_classes=2).orderBy("leaf").collect()
    assert [r.split for r in got] == [False, True, True, False]
    assert got[0].epsilon > got[1].epsilon > got[2].epsilon
    assert got[1].epsilon == pytest.approx(math.sqrt(math.log(1e7) / 20_000))


def test_learner_finds_the_split_and_routes_by_it(spark):
    model = TreeModel.empty(TreeParams(2, (), 2))
    rows = frame(spark, blobs(600))
    model = model.learn(rows)
    root, left, right = model.trees[0]
    assert root.attr == 0 and 1.0 < root.threshold < 2.0
    assert (left.majority(), right.majority()) == (0, 1)
    assert sum(left.counts) + sum(right.counts) == pytest.approx(600)
    wrong = model.score(rows).filter("pred <> label").count()
    assert wrong < 15
    again = model.learn(rows)
    assert sum(sum(n.counts) for n in again.trees[0] if n.kind == LEAF) == pytest.approx(1200)


def test_nominal_split_and_unseen_value(spark):
    rng = random.Random(2)
    rows = [([rng.random(), float(i % 3)], 1 if i % 3 == 2 else 0) for i in range(600)]
    model = TreeModel.empty(TreeParams(1, (3,), 2)).learn(frame(spark, rows))
    assert model.trees[0][0].kind == NOMINAL and len(model.trees[0]) == 4
    asked = frame(spark, [([0.1, 2.0], 0), ([0.1, 0.0], 0), ([0.1, 7.0], 0)])
    assert [r.pred for r in model.score(asked).orderBy("seq").collect()] == [1, 0, 0]


def test_tree_size_is_bounded(spark):
    model = TreeModel.empty(TreeParams(2, (), 2, max_nodes=2)).learn(frame(spark, blobs(600)))
    assert len(model.trees[0]) == 1


def test_majority_by_prefix_matches_the_known_flower_labels(spark):
    """With fewer rows than one clear split needs, predictions are the majority class of the rows so far.

    Class counts of the flower stream before its three predict rows: 12/8/10 of 30 rows, 57/62/60 of 179 and 61/63/64
    of 188 (setosa, versicolor, virginica).
    """
    rng = random.Random(4)
    means = {"setosa": (5.0, 3.4, 1.5, 0.2), "versicolor": (5.9, 2.8, 4.3, 1.3), "virginica": (6.6, 3.0, 5.6, 2.0)}
    names = ["versicolor", "setosa", "virginica"]
    blocks = [(8, 12, 10), (62 - 8, 57 - 12, 60 - 10), (63 - 62, 61 - 57, 64 - 60)]
    asked = [[5.4, 3.4, 1.5, 0.4], [5.9, 3.2, 4.8, 1.8], [6.8, 3.0, 5.5, 2.1]]
    model, got, seq = TreeModel.empty(TreeParams(4, (), 3)), [], 0
    for block, x in zip(blocks, asked):
        rows = [(seq + j, [rng.gauss(m, 0.3) for m in means[names[c]]], c) for j, c in enumerate(c for c, k in enumerate(block) for _ in range(k))]
        seq += len(rows)
        model = model.learn(spark.createDataFrame(rows, "seq long, features array<double>, label int"))
        got.append(names[model.score(spark.createDataFrame([(x,)], "features array<double>")).first().pred])
    assert got == ["setosa", "versicolor", "virginica"]


def poisson_weight(seq, member, seed):
    u = int(hashlib.md5(f"{seq}:{member}:{seed}".encode()).hexdigest()[:8], 16) / 2**32
    return sum(u >= limit for limit in POISSON_LIMITS)


def test_bagging_weights_are_reproducible(spark):
    df = spark.range(1, 201).withColumnRenamed("id", "seq")
    got = {(r.seq, r.member): int(r.weight) for r in with_members(df, 3, seed=9).collect()}
    want = {(s, m): poisson_weight(s, m, 9) for s in range(1, 201) for m in range(3)}
    assert got == {k: v for k, v in want.items() if v > 0}
    assert sum(want.values()) / len(want) == pytest.approx(1.0, abs=0.15)


def test_vote_ties_go_to_the_lowest_class(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, 2), (1, 0), (2, 3)], "k int, pred int")
    assert {r.k: (r.vote, r.votes) for r in majority_vote(df, ["k"]).collect()} == {1: (0, 2), 2: (3, 1)}


@pytest.mark.parametrize("bagging", [0, 3])
def test_classifier_end_to_end(spark, bagging):
    rows = [(i, *x, "?" if i % 40 == 39 else "ab"[y], "uv"[i // 7 % 2]) for i, (x, y) in enumerate(blobs(1200))]
    df = spark.createDataFrame(rows, "k long, x double, z double, label string, side string")
    learned = driftline.hoeffding_classifier(
        df, ["x", "z"], "label", 2, "k", nominal={"side": 2}, interval=300, bagging=bagging, first_batch=400, parallelism=3
    )
    out = learned.predictions.orderBy("seq").collect()
    assert learned.predictions.columns == ["seq", "x", "z", "side", "prediction"]
    assert [r.seq for r in out] == [i + 1 for i in range(1200) if i % 40 == 39]
    late = [r for r in out if r.seq > 400]
    assert sum(r.prediction == ("a" if r.x < 1.5 else "b") for r in late) >= 0.95 * len(late)
    curve = learned.curve.orderBy("point").collect()
    assert [r.point for r in curve] == [300, 600, 900, 1170] and curve[-1].accuracy_pct > curve[0].accuracy_pct
    limited = driftline.hoeffding_classifier(df, ["x"], "label", 2, "k", max_instances=100, first_batch=50)
    assert limited.predictions.count() == 2 and limited.pairs.count() == 98


def test_undeclared_nominal_values_get_branches_and_are_learned(spark):
    rows = [(i, [float(i % 4)], i % 4 % 2) for i in range(4000)]
    df = spark.createDataFrame(rows, "seq long, features array<double>, label int")
    model = TreeModel.empty(TreeParams(0, (2,), 2)).learn(df.filter("seq < 2000")).learn(df.filter("seq >= 2000"))
    scored = model.score(df).select("label", "pred").collect()
    assert all(r.label == r.pred for r in scored)
    late = spark.createDataFrame([(9, [77.0], 0)], "seq long, features array<double>, label int")
    assert model.route(late).first()["leaf"] > 0  # the largest branch, not the split node


def test_a_wide_nominal_does_not_stop_growth(spark):
    rows = [(i, [float(i % 100), float(i * 7919 % 3000)], int(i % 100 >= 50)) for i in range(6000)]
    df = spark.createDataFrame(rows, "seq long, features array<double>, label int")
    model = TreeModel.empty(TreeParams(1, (3000,), 2)).learn(df)
    assert len(model.trees[0]) > 1
    assert sum(r.label == r.pred for r in model.score(df).select("label", "pred").collect()) >= 0.95 * len(rows)
