import math
import random

import pytest

from driftline.operators.evaluate import (
    class_counts,
    confusion,
    learning_curve,
    learning_curve_regression,
    measurements_long,
    overall,
    per_class,
    regression_metrics,
    temporal_kappa,
)


def pairs(spark, rows):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows, 1)], "seq long, truth int, pred int")


def ratio(a, b):
    return a / b if b else float("nan")


def brute(rows, k):
    """Row-by-row evaluation with the published definitions."""
    n = len(rows)
    hit = sum(t == p for t, p in rows)
    same, last = 0, 0
    for t, _ in rows:
        same += t == last
        last = t
    pc = sum((sum(p == c for _, p in rows) / n) * (sum(t == c for t, _ in rows) / n) for c in range(k))
    p0, no = hit / n, same / n
    classes = []
    for c in range(k):
        tp = sum(t == p == c for t, p in rows)
        precision = ratio(tp, sum(p == c for _, p in rows))
        recall = ratio(tp, sum(t == c for t, _ in rows))
        classes.append((c, sum(t == c for t, _ in rows), precision, recall, ratio(2 * precision * recall, precision + recall)))
    return p0 * 100, ratio(p0 - pc, 1 - pc) * 100, ratio(p0 - no, 1 - no) * 100, classes


def close(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b)


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(5)
    return [(rng.choice([0, 0, 1, 2]), rng.choice([0, 1, 2])) for _ in range(137)]


@pytest.mark.parametrize("every,bucket", [(10, 7), (50, 1000), (137, 3)])
def test_learning_curve_equals_row_by_row_evaluation(spark, sample, every, bucket):
    curve = learning_curve(pairs(spark, sample), 4, every, bucket_rows=bucket).orderBy("point").collect()
    points = [*range(every, 137, every), 137]
    assert [r.point for r in curve] == points
    assert [r.final_partial for r in curve] == [p % every != 0 for p in points]
    for r in curve:
        acc, kap, tem, classes = brute(sample[: r.point], 4)
        assert close(r.accuracy_pct, acc) and close(r.kappa_pct, kap) and close(r.kappa_temporal_pct, tem)
        for got, want in zip(r.classes, classes):
            assert (got.cls, got.support) == want[:2]
            assert close(got.precision, want[2]) and close(got.recall, want[3]) and close(got.f1, want[4])


def test_never_predicted_and_never_true_classes_are_nan(spark):
    table = {r.cls: r for r in per_class(pairs(spark, [(0, 0), (1, 0), (0, 2)]), n_classes=4).collect()}
    assert math.isnan(table[1].precision) and table[1].recall == 0.0 and math.isnan(table[1].f1)
    assert math.isnan(table[2].recall) and table[2].precision == 0.0
    assert (table[3].support, table[3].tn) == (0, 3) and math.isnan(table[3].f1)
    assert (table[0].tp, table[0].fp, table[0].fn, table[0].tn) == (1, 1, 1, 0)


def test_first_row_of_class_zero_counts_as_no_change(spark):
    assert temporal_kappa(pairs(spark, [(0, 1), (0, 0), (1, 1)]), bucket_rows=1).first().no_change == 2
    assert temporal_kappa(pairs(spark, [(1, 1), (0, 0)])).first().no_change == 0


def test_empty_input_gives_zeros(spark):
    row = overall(class_counts(confusion(pairs(spark, [(0, 0)]).filter("false")), 2)).first()
    assert (row.instances, row.accuracy_pct, row.kappa_pct, row.error_fraction) == (0.0, 0.0, 0.0, 1.0)


def test_weights_only_count_when_positive(spark):
    df = pairs(spark, [(0, 0), (1, 0), (1, 1)]).selectExpr("*", "CAST(seq - 1 AS double) AS w")
    row = overall(class_counts(confusion(df, weight="w"))).first()
    assert row.instances == 3.0 and row.accuracy_pct == pytest.approx(200 / 3)


def test_measurement_names_and_order(spark, sample):
    rows = measurements_long(learning_curve(pairs(spark, sample), 2, 1000), 2).orderBy("ordinal").collect()
    assert [r.measurement for r in rows] == [
        "evaluation instances", "classified instances", "classifications correct (percent)", "Kappa Statistic (percent)",
        "Kappa Temporal Statistic (percent)", "class 0 support", "class 1 support", "class 0 precision",
        "class 1 precision", "class 0 recall", "class 1 recall", "class 0 f1-score", "class 1 f1-score",
    ]


def test_regression_metrics_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(10, 2), rng.gauss(10, 1)) for i in range(1, 84)]
    df = spark.createDataFrame(rows, "seq long, truth double, pred double")

    def loop(part):
        ae = se = ae0 = se0 = s = 0.0
        for k, (_, y, p) in enumerate(part):
            mean = s / k if k else 0.0
            ae, se = ae + abs(y - p), se + (y - p) ** 2
            ae0, se0 = ae0 + abs(y - mean), se0 + (y - mean) ** 2
            s += y
        return ae / len(part), math.sqrt(se / len(part)), ae / ae0, math.sqrt(se / se0)

    row = regression_metrics(df, bucket_rows=9).first()
    assert tuple(row)[1:] == pytest.approx(loop(rows))
    for r in learning_curve_regression(df, 20, bucket_rows=9).collect():
        assert (r.mae, r.rmse, r.relative_mae, r.relative_rmse) == pytest.approx(loop(rows[: r.point]))
