"""Cumulative evaluation of classifiers and regressors.

Input rows carry the true class index, the predicted index and optionally a weight and a sequence number.  Everything
derives from confusion counts (K x K rows) or from 3 K counters per learning-curve point; rows are never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import nan_ratio
from driftline.operators.order import BUCKET_ROWS, running, with_previous
from driftline.session import cut_lineage

# Names and order of the measurements of one evaluation record.
INSTANCES = "evaluation instances"
OVERALL_NAMES = (
    "classified instances",
    "classifications correct (percent)",
    "Kappa Statistic (percent)",
    "Kappa Temporal Statistic (percent)",
)
CLASS_NAMES = ("support", "precision", "recall", "f1-score")

POINT_SPAN = 10_000


def confusion(df: DataFrame, truth: str = "truth", pred: str = "pred", weight: str | None = None) -> DataFrame:
    """Rows and weight per (truth, pred)."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(w > 0, w).otherwise(0.0)).alias("weight")
    )


def class_counts(table: DataFrame, n_classes: int | None = None) -> DataFrame:
    """Support, TP, FP, FN, TN and weighted row/column totals per class, from a confusion table."""
    hit = F.col("truth") == F.col("pred")
    sides = F.array(
        F.struct(
            F.col("truth").alias("cls"),
            F.col("n").alias("support"),
            F.when(hit, F.col("n")).otherwise(0).alias("tp"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.col("weight").alias("w_true"),
            F.lit(0.0).alias("w_pred"),
            F.when(hit, F.col("weight")).otherwise(0.0).alias("w_hit"),
        ),
        F.struct(
            F.col("pred").alias("cls"),
            F.lit(0).cast("bigint").alias("support"),
            F.lit(0).cast("bigint").alias("tp"),
            F.col("n").alias("predicted"),
            F.lit(0.0).alias("w_true"),
            F.col("weight").alias("w_pred"),
            F.lit(0.0).alias("w_hit"),
        ),
    )
    stacked = table.select(F.inline(sides))
    if n_classes is not None:
        declared = table.sparkSession.range(n_classes).select(
            F.col("id").cast("int").alias("cls"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("support", "tp", "predicted")],
            *[F.lit(0.0).alias(c) for c in ("w_true", "w_pred", "w_hit")],
        )
        stacked = stacked.unionByName(declared)
    per_class = stacked.groupBy("cls").agg(
        *[F.sum(c).alias(c) for c in ("support", "tp", "predicted", "w_true", "w_pred", "w_hit")]
    )
    # One row with the K class records, so that the total is at hand without a second pass or a global window.
    packed = per_class.agg(F.sum("support").alias("total"), F.collect_list(F.struct(*per_class.columns)).alias("c"))
    return packed.select("total", F.inline("c")).select(
        "cls",
        "support",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"),
        (F.col("total") - F.col("support") - F.col("predicted") + F.col("tp")).alias("tn"),
        "w_true",
        "w_pred",
        "w_hit",
    )


def precision_recall(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class; 0/0 is NaN and NaN carries over to F1."""
    p = nan_ratio(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    r = nan_ratio(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    return (
        counts.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn("f1", nan_ratio(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )


def per_class(
    df: DataFrame, truth: str = "truth", pred: str = "pred", weight: str | None = None, n_classes: int | None = None
) -> DataFrame:
    return precision_recall(class_counts(confusion(df, truth, pred, weight), n_classes))


def kappa(observed: Column, expected: Column) -> Column:
    return nan_ratio(observed - expected, 1.0 - expected)


def overall(counts: DataFrame) -> DataFrame:
    """One row from class counts: instances, accuracy %, error fraction, Kappa %; zeros where nothing was seen."""
    sums = counts.agg(
        F.coalesce(F.sum("w_true"), F.lit(0.0)).alias("instances"),
        F.sum("w_hit").alias("w_hit"),
        F.sum(F.col("w_true") * F.col("w_pred")).alias("cross"),
    )
    n = F.col("instances")
    p0 = F.col("w_hit") / n
    pc = F.col("cross") / (n * n)
    seen = n > 0
    return sums.select(
        "instances",
        F.when(seen, p0 * 100.0).otherwise(0.0).alias("accuracy_pct"),
        F.when(seen, 1.0 - p0).otherwise(1.0).alias("error_fraction"),
        F.when(seen, kappa(p0, pc) * 100.0).otherwise(0.0).alias("kappa_pct"),
    )


def no_change_flag(
    df: DataFrame, truth: str = "truth", seq: str = "seq", bucket_rows: int = BUCKET_ROWS, before: int = 0
) -> DataFrame:
    """Flag rows whose truth equals the truth before; class ``before`` stands before the first row."""
    seen = with_previous(df, truth, "__previous", before, seq, bucket_rows)
    return seen.withColumn("no_change", (F.col("__previous") == F.col(truth)).cast("int")).drop("__previous")


def temporal_kappa(
    df: DataFrame, truth: str = "truth", pred: str = "pred", seq: str = "seq", bucket_rows: int = BUCKET_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Kappa against the predictor that repeats the last truth.

    With ``weight`` the counts are sums of weights, where a weight that is not above 0 adds nothing.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1)
    rows = df.select(seq, truth, pred, F.when(w > 0, w).otherwise(F.lit(0.0 if weight else 0)).alias("__w"))
    sums = no_change_flag(rows, truth, seq, bucket_rows).agg(
        F.coalesce(F.sum("__w"), F.lit(0)).alias("instances"),
        F.sum((F.col(truth) == F.col(pred)).cast("int") * F.col("__w")).alias("hits"),
        F.sum(F.col("no_change") * F.col("__w")).alias("no_change"),
    )
    n = F.col("instances")
    value = kappa(F.col("hits") / n, F.col("no_change") / n) * 100.0
    return sums.select("instances", "no_change", F.when(n > 0, value).otherwise(0.0).alias("kappa_temporal_pct"))


def counter_names(n_classes: int, weighted: bool = False) -> list[str]:
    """Counters that a learning-curve point needs; all of them add up over rows."""
    per_class = ["sup", "tp", "prd", *(["wt", "wp"] if weighted else [])]
    return ["w_all", "w_hit", "w_same", *[f"{name}{c}" for c in range(n_classes) for name in per_class]]


def curve_steps(flagged: DataFrame, n_classes: int, step: Column, weighted: bool = False) -> DataFrame:
    """Counters per step of a learning curve, from rows (truth, pred, w, no_change): ``step``, ``rows``, counters.

    Rows whose weight is not above 0 count as labelled rows but add no weight, as in :func:`confusion`.
    """
    rows = flagged.withColumn("w", F.when(F.col("w") > 0, F.col("w")).otherwise(F.lit(0.0)))
    hit = F.col("truth") == F.col("pred")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("w")).otherwise(F.lit(0.0)))

    found = {"w_all": F.sum("w"), "w_hit": total(hit), "w_same": F.sum(F.col("no_change") * F.col("w"))}
    for c in range(n_classes):
        t, p = F.col("truth") == c, F.col("pred") == c
        found |= {f"sup{c}": F.count_if(t), f"tp{c}": F.count_if(t & p), f"prd{c}": F.count_if(p)}
        if weighted:
            found |= {f"wt{c}": total(t), f"wp{c}": total(p)}
    names = counter_names(n_classes, weighted)
    return rows.groupBy(step.cast("bigint").alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), *[found[n].cast("double").alias(n) for n in names]
    )


def running_steps(steps: DataFrame, counters: Sequence[str]) -> DataFrame:
    """Counters of all steps so far (same names), with ``rows`` of the step itself and ``so_far``."""
    renamed = steps.select("step", "rows", *[F.col(c).alias(f"p_{c}") for c in counters])
    sums = {c: ("sum", f"p_{c}") for c in counters} | {"so_far": ("sum", "rows")}
    return running(renamed, sums, "step", span=POINT_SPAN).drop(*[f"p_{c}" for c in counters])


def curve_points(sums: DataFrame, n_classes: int, every: int, weighted: bool = False) -> DataFrame:
    """Metrics of each point, from the counters of :func:`running_steps`."""
    n = F.col("w_all")
    p0 = F.col("w_hit") / n
    row_w = [F.col(f"wp{c}") if weighted else F.col(f"prd{c}") for c in range(n_classes)]
    col_w = [F.col(f"wt{c}") if weighted else F.col(f"sup{c}") for c in range(n_classes)]
    pc = sum((r / n * (k / n) for r, k in zip(row_w, col_w)), F.lit(0.0))
    same = F.col("w_same") / n
    records = []
    for c in range(n_classes):
        tp = F.col(f"tp{c}")
        precision = nan_ratio(tp, F.col(f"prd{c}"))
        recall = nan_ratio(tp, F.col(f"sup{c}"))
        records.append(
            F.struct(
                F.lit(c).alias("cls"),
                F.col(f"sup{c}").cast("bigint").alias("support"),
                precision.alias("precision"),
                recall.alias("recall"),
                nan_ratio(2.0 * precision * recall, precision + recall).alias("f1"),
            )
        )
    return sums.select(
        F.col("so_far").cast("bigint").alias("point"),
        (F.col("rows") < every).alias("final_partial"),
        n.alias("instances"),
        F.when(n > 0, p0 * 100.0).otherwise(0.0).alias("accuracy_pct"),
        F.when(n > 0, kappa(p0, pc) * 100.0).otherwise(0.0).alias("kappa_pct"),
        F.when(n > 0, kappa(p0, same) * 100.0).otherwise(0.0).alias("kappa_temporal_pct"),
        F.array(*records).alias("classes"),
    )


def learning_curve(
    df: DataFrame,
    n_classes: int,
    every: int = 1000,
    truth: str = "truth",
    pred: str = "pred",
    seq: str = "seq",
    weight: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Cumulative metrics after every ``every`` labelled rows.

    ``df`` holds labelled rows numbered 1..N.  One row per point: ``point`` (labelled rows so far), ``final_partial``,
    the four overall metrics and one array of ``n_classes`` records.  Rows are aggregated per point first; the running
    sums then work on points only.
    """
    if every < 1 or n_classes < 1:
        raise ValueError(f"required every >= 1 and n_classes >= 1 but found {every} and {n_classes}")
    rows = df.select(
        F.col(seq).alias("seq"),
        F.col(truth).alias("truth"),
        F.col(pred).alias("pred"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    )
    weighted = weight is not None
    flagged = no_change_flag(rows, "truth", "seq", bucket_rows)
    steps = curve_steps(flagged, n_classes, F.ceil(F.col("seq") / F.lit(every)), weighted)
    # Points are few: storing them keeps the pass over all rows from running once per branch below.
    sums = running_steps(cut_lineage(steps), counter_names(n_classes, weighted))
    return curve_points(sums, n_classes, every, weighted)


def measurements_long(curve: DataFrame, n_classes: int) -> DataFrame:
    """One row per measurement in the fixed order: instances, the overall four, then each class metric by class."""
    values = [(INSTANCES, F.col("point").cast("double"))]
    values += list(
        zip(OVERALL_NAMES, [F.col(c) for c in ("instances", "accuracy_pct", "kappa_pct", "kappa_temporal_pct")])
    )
    for name, field in zip(CLASS_NAMES, ("support", "precision", "recall", "f1")):
        for c in range(n_classes):
            values.append((f"class {c} {name}", F.get(F.col("classes"), F.lit(c))[field].cast("double")))
    records = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("measurement"), v.alias("value"))
            for i, (name, v) in enumerate(values)
        ]
    )
    return curve.select("point", "final_partial", F.inline(records))


ERRORS = ("ae", "se", "ae0", "se0")


def regression_errors(
    df: DataFrame, truth: str = "truth", pred: str = "pred", seq: str = "seq", bucket_rows: int = BUCKET_ROWS,
    before: tuple[float, int] = (0.0, 0),
) -> DataFrame:
    """Errors of the model and of the running-mean predictor (mean of the targets before; 0 at the start).

    ``before``: sum and number of the targets that came ahead of these rows.
    """
    base = df.select(
        F.col(seq).alias("seq"), F.col(truth).cast("double").alias("y"), F.col(pred).cast("double").alias("p")
    )
    seen = running(base, {"s": ("sum", "y"), "k": ("count", "y")}, "seq", span=bucket_rows, exclusive=("s", "k"))
    s = F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(float(before[0]))
    k = F.coalesce(F.col("k"), F.lit(0)) + F.lit(int(before[1]))
    mean = F.when(k > 0, s / k).otherwise(F.lit(0.0))
    return seen.select(
        "seq",
        F.abs(F.col("y") - F.col("p")).alias("ae"),
        ((F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))).alias("se"),
        F.abs(F.col("y") - mean).alias("ae0"),
        ((F.col("y") - mean) * (F.col("y") - mean)).alias("se0"),
    )


def _regression_metrics(n: Column) -> list[Column]:
    return [
        (F.col("ae") / n).alias("mae"),
        F.sqrt(F.col("se") / n).alias("rmse"),
        nan_ratio(F.col("ae"), F.col("ae0")).alias("relative_mae"),
        F.sqrt(nan_ratio(F.col("se"), F.col("se0"))).alias("relative_rmse"),
    ]


def regression_metrics(
    df: DataFrame, truth: str = "truth", pred: str = "pred", seq: str = "seq", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    errors = regression_errors(df, truth, pred, seq, bucket_rows)
    sums = errors.agg(F.count(F.lit(1)).alias("instances"), *[F.sum(c).alias(c) for c in ERRORS])
    return sums.filter(F.col("instances") > 0).select("instances", *_regression_metrics(F.col("instances")))


def error_steps(errors: DataFrame, step: Column) -> DataFrame:
    """Error sums per step of a learning curve, from the rows of :func:`regression_errors`."""
    return errors.groupBy(step.cast("bigint").alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in ERRORS]
    )


def error_points(sums: DataFrame, every: int) -> DataFrame:
    """Metrics of each point, from the sums of :func:`running_steps`."""
    return sums.select(
        F.col("so_far").cast("bigint").alias("point"), (F.col("rows") < every).alias("final_partial"),
        *_regression_metrics(F.col("so_far")),
    )


def learning_curve_regression(
    df: DataFrame,
    every: int = 1000,
    truth: str = "truth",
    pred: str = "pred",
    seq: str = "seq",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    errors = regression_errors(df, truth, pred, seq, bucket_rows)
    steps = error_steps(errors, F.ceil(F.col("seq") / F.lit(every)))
    return error_points(running_steps(cut_lineage(steps), ERRORS), every)
