"""Quantile observers, the models grown from them, and row-by-row drift."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators import observer
from driftline.operators.rules import Rule, RuleModel, RuleParams, drift_states, quantile_stats
from driftline.operators.tree import LEAF, NOMINAL, FlatTree, Node, TreeModel, TreeParams


def prefix(cells, at):
    """Sums over the cells up to a value."""
    _, x, _, sums = cells
    return sums[x <= at].sum(axis=0)


@pytest.mark.parametrize("shape", ["uniform", "few", "outlier", "heavy"])
def test_cells_keep_sums_and_ranks(shape):
    rng = np.random.default_rng(1)
    n, k = 20_000, 64
    x = {"uniform": rng.random(n), "few": rng.integers(0, 40, n) * 1.0, "outlier": np.append(rng.random(n - 1), 1e12), "heavy": np.where(rng.random(n) < 0.4, 0.5, rng.random(n))}[shape]
    sums = np.stack((np.ones(n), x * 2), axis=1)
    held = observer.Observer(k)
    for part in np.array_split(np.arange(n), 23):
        held.add(np.zeros(len(part), dtype=int), x[part], np.zeros(len(part), dtype=int), sums[part])
    cells = held.cells()
    assert len(cells[1]) <= 2 * k and cells[3].sum(axis=0) == pytest.approx(sums.sum(axis=0))
    exact = shape == "few"
    assert not exact or len(cells[1]) == 40
    # Each merger moves at most one k-th; 23 batches take part in at most 5 and the last.
    for at in cells[1]:
        assert abs(prefix(cells, at)[0] - (x <= at).sum()) <= (0 if exact else 6 * n / k)


def test_groups_and_tags_stay_apart():
    rng = np.random.default_rng(2)
    group, x, tag = rng.integers(0, 5, 3000), rng.integers(0, 300, 3000) * 1.0, rng.integers(0, 3, 3000)
    x[:4] = np.nan
    g, _, t, s = observer.compact(group, x, tag, np.ones((3000, 1)), 20)
    for i in range(5):
        for c in range(3):
            assert s[(g == i) & (t == c)].sum() == ((group == i) & (tag == c)).sum()
    assert [len(np.unique(observer.compact(group, x, tag, np.ones((3000, 1)), 20)[1][g == i])) <= 40 for i in range(5)] == [True] * 5


def test_counter_levels():
    assert [observer.counter_level(n) for n in range(8)] == [0, 1, 0, 2, 0, 1, 0, 3]


@pytest.mark.parametrize("k", [500, 16])
def test_table_observers_match_numpy(spark, k):
    rng = np.random.default_rng(3)
    rows = [(int(i % 3), [float(rng.integers(0, 300)), float(i % 7)], float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "rule long, features array<double>, target double").repartition(9)
    cells = quantile_stats(df, cells=k, offset=10.0).collect()
    for rule in range(3):
        for attr in range(2):
            own = sorted((r.x, r.n, r.sy, r.syy) for r in cells if (r.rule, r.attr) == (rule, attr))
            x = np.array([r[1][attr] for r in rows if r[0] == rule])
            y = np.array([r[2] for r in rows if r[0] == rule]) - 10.0
            assert len(own) == len(set(x)) if len(set(x)) <= k else k <= len(own) <= 2 * k
            assert sum(r[2] for r in own) == pytest.approx(y.sum()) and sum(r[3] for r in own) == pytest.approx((y * y).sum())
            if k == 500 or attr == 1:
                for v, n, sy, _ in own:
                    assert (n, sy) == ((x == v).sum(), pytest.approx(y[x == v].sum()))
            upto = 0.0
            for v, n, *_ in own:
                upto += n
                assert abs(upto - (x <= v).sum()) <= 2 * len(x) / min(k, 300)


def steps(n, outlier=None, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.random(), rng.random()]) for i in range(n)]
    if outlier is not None:
        rows[17] = (17, [outlier, 0.5])
    return [(i, x, 10.0 if x[0] > 0.5 else 0.0) for i, x in rows]


def learned(model, df, size, **columns):
    for low in range(0, df.count(), size):
        model = model.learn(df.filter((F.col("seq") >= low) & (F.col("seq") < low + size)), **columns)
    return model


@pytest.mark.parametrize("outlier", [None, 1e6, -1e6])
def test_one_outlier_takes_no_resolution_from_rules(spark, outlier):
    df = spark.createDataFrame(steps(4000, outlier), "seq long, features array<double>, target double")
    model = learned(RuleModel.empty(RuleParams(2, head="mean")), df, 2000)
    literals = [c for r in model.rules for c in r.conditions]
    assert literals and all(a == 0 and abs(t - 0.5) < 0.02 for a, _, t in literals)
    assert model.score(df).select(F.avg(F.abs(F.col("pred") - F.col("target")))).first()[0] < 0.3
    assert sum(r.n for r in model.rules) == pytest.approx(4000)


@pytest.mark.parametrize("outlier", [None, 1e6, -1e6])
def test_one_outlier_takes_no_resolution_from_a_tree(spark, outlier):
    df = spark.createDataFrame(steps(4000, outlier), "seq long, features array<double>, target double")
    df = df.select("seq", "features", (F.col("target") > 5).cast("int").alias("label"))
    model = learned(TreeModel.empty(TreeParams(2, (), 2)), df, 2000)
    assert abs(model.trees[0][0].threshold - 0.5) < 0.02
    assert model.score(df).filter("pred = label").count() >= 0.99 * 4000


def test_rules_do_not_split_off_slivers_of_noise(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random()], rng.gauss(0, 1)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "seq long, features array<double>, target double")
    assert len(RuleModel.empty(RuleParams(2, head="mean")).learn(df).rules) == 1


def test_one_batch_grows_several_levels(spark):
    rng = random.Random(6)
    rows = []
    for i in range(6000):
        x = [rng.random() for _ in range(3)]
        rows.append((i, x, next((n for n, v in enumerate(x) if v <= 0.5), 3)))
    df = spark.createDataFrame(rows, "seq long, features array<double>, label int")
    model = TreeModel.empty(TreeParams(3, (), 4, levels=4)).learn(df)
    assert max(n.depth for n in model.trees[0]) >= 3
    assert sum(sum(n.counts) for n in model.trees[0] if n.kind == LEAF) == pytest.approx(6000, abs=1)
    assert model.score(df).filter("pred = label").count() >= 0.95 * 6000
    flat = TreeModel.empty(TreeParams(3, (), 4, levels=1)).learn(df)
    assert max(n.depth for n in flat.trees[0]) == 1


def test_growth_does_not_depend_on_tasks(spark):
    df = spark.createDataFrame([(i, [float(x[0] * 50 // 1), float(i % 9)], int(y > 5)) for i, x, y in steps(3000)], "seq long, features array<double>, label int")
    grown = [TreeModel.empty(TreeParams(2, (), 2)).learn(df.repartition(n)).trees for n in (1, 7)]
    assert grown[0] == grown[1]


def test_wide_nominal_makes_a_small_model(spark):
    rng = random.Random(7)
    rows = [(i, [float(i % 4 if i % 2 else 1_000_000 - i)], 1 if i % 4 == 1 else 0) for i in range(4000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "seq long, features array<double>, label int")
    model = TreeModel.empty(TreeParams(0, (1_000_000,), 2)).learn(df)
    root = model.trees[0][0]
    assert root.kind == NOMINAL and root.values == [1, 3] and root.n_children == 3 and len(model.trees[0]) == 4
    assert model.score(df).filter("pred <> label").count() == 0
    plan = model.score(df)._jdf.queryExecution().toString()
    assert len(plan) < 10_000


def test_flat_tree_routes_like_a_walk():
    rng = random.Random(8)
    tree = [Node([1.0, 2.0]) for _ in range(8)]
    tree[0] = Node([0, 0], 1, 0, 0.5, 1, 2, 0)
    tree[1] = Node([0, 0], 2, 1, 0.0, 3, 3, 1, values=[2, 5], other=2)
    tree[2] = Node([0, 0], 1, 2, -1.0, 6, 2, 1)
    for n in tree[3:]:
        n.depth = 2

    def walk(x):
        i = 0
        while tree[i].kind != LEAF:
            n = tree[i]
            v = x[n.attr]
            i = n.first_child + (int(not v <= n.threshold) if n.kind == 1 else n.values.index(v) if v in n.values else n.other)
        return i

    rows = [[rng.choice((0.2, 0.5, 0.9, float("nan"))), rng.choice((2.0, 5.0, 7.0, -1.0, float("nan"), 1e30)), rng.uniform(-2, 0)] for _ in range(300)]
    assert FlatTree.of(tree).route(np.array(rows)).tolist() == [walk(x) for x in rows]


@pytest.mark.parametrize("parts", [1, 6])
def test_drift_in_the_learner_is_tested_row_by_row(spark, parts):
    rng = random.Random(9)
    rows = [(i, [rng.random()], rng.gauss(0, 1) + (2.0 if i > 700 else 0.0)) for i in range(1, 1201)]
    df = spark.createDataFrame([(i, x, None if i % 50 == 0 else y) for i, x, y in rows], "seq long, features array<double>, target double")
    df = df.repartitionByRange(parts, "seq").sortWithinPartitions("seq") if parts > 1 else df.coalesce(1)
    model = RuleModel(RuleParams(1, head="mean"), [Rule(0, n=10.0, sy=1.0), Rule(1, [(0, True, 0.5)], 10.0, 2.0)], 2, 0.0, 1.0)
    got = drift_states(df, model._flat(), {0: (3.0, 2.0, 0.5, 0.1), 1: (0.0, 0.0, 0.0, 0.0)}, 2.0, 0.005)
    for rule, state in ((0, (3.0, 2.0, 0.5, 0.1)), (1, (0.0, 0.0, 0.0, 0.0))):
        k, s, m, low = state
        rise = 0.0
        for i, x, y in rows:
            if i % 50 and (x[0] <= 0.5) == (rule == 1):
                e = abs(y - (0.2 if rule else 0.1)) / 2.0
                k, s = k + 1, s + e
                m += e - s / k - 0.005
                low = min(low, m)
                rise = max(rise, m - low)
        assert got[rule][0] == pytest.approx(rise) and got[rule][1] == pytest.approx((k, s, m, low))
