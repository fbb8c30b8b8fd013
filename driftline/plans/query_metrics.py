"""Queries over the evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.evaluate import (
    CLASS_NAMES,
    INSTANCES,
    OVERALL_NAMES,
    class_counts,
    confusion,
    learning_curve,
    learning_curve_regression,
    measurements_long,
    overall,
    precision_recall,
    regression_metrics,
    temporal_kappa,
)
from driftline.plans.tables import (
    SQL_EVENT_PAIRS,
    SQL_MEANS,
    SQL_ORDER_PAIRS,
    embedding_pairs,
    event_pairs,
    order_pairs,
)

DIGITS = 6
EVERY = 1000


def no_nan(column: str | Column, name: str | None = None) -> Column:
    """Rounded value; NaN as null, so that both engines of the comparison agree."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.isnan(c), None).otherwise(F.round(c, DIGITS)).alias(name or column)


def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(embedding_pairs(spark, sf_dir)).select("truth", "pred", "n")


def eval_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_counts(confusion(embedding_pairs(spark, sf_dir))).select("cls", "support")


def eval_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_counts(confusion(event_pairs(spark, sf_dir)), 6).select("cls", "support", "tp", "fp", "fn", "tn")


def eval_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = overall(class_counts(confusion(embedding_pairs(spark, sf_dir))))
    return row.select("instances", no_nan("accuracy_pct"), no_nan("error_fraction"))


def eval_overall_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = event_pairs(spark, sf_dir).withColumn("w", (F.col("seq") % 4).cast("double"))
    row = overall(class_counts(confusion(pairs, weight="w")))
    return row.select("instances", no_nan("accuracy_pct"), no_nan("kappa_pct"))


def eval_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overall(class_counts(confusion(embedding_pairs(spark, sf_dir)))).select(no_nan("kappa_pct"))


def eval_kappa_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = temporal_kappa(event_pairs(spark, sf_dir))
    return row.select("instances", "no_change", no_nan("kappa_temporal_pct"))


def eval_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = precision_recall(class_counts(confusion(embedding_pairs(spark, sf_dir))))
    return table.select(
        "cls", "support", "tp", "fp", "fn", "tn", no_nan("precision"), no_nan("recall"), no_nan("f1")
    )


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning_curve(event_pairs(spark, sf_dir), 5, EVERY)


def learning_curve_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curve(spark, sf_dir).select(
        "point", "final_partial", "instances", no_nan("accuracy_pct"), no_nan("kappa_pct"), no_nan("kappa_temporal_pct")
    )


def measurements_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements_long(_curve(spark, sf_dir), 5).select("point", "ordinal", "measurement", no_nan("value"))


def eval_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = regression_metrics(order_pairs(spark, sf_dir))
    return row.select("instances", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "relative_mae", "relative_rmse")])


def learning_curve_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = learning_curve_regression(order_pairs(spark, sf_dir), EVERY)
    return curve.select(
        "point", "final_partial",
        *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "relative_mae", "relative_rmse")],
    )


QUERIES = {
    "eval_confusion": eval_confusion,
    "eval_support": eval_support,
    "eval_class_counts": eval_class_counts,
    "eval_overall": eval_overall,
    "eval_overall_weighted": eval_overall_weighted,
    "eval_kappa": eval_kappa,
    "eval_kappa_temporal": eval_kappa_temporal,
    "eval_per_class": eval_per_class,
    "learning_curve": learning_curve_query,
    "measurements_long": measurements_query,
    "eval_regression": eval_regression,
    "learning_curve_reg": learning_curve_reg,
}

_CLASS_SQL = """
c AS (SELECT unnest([truth, pred]) AS cls, unnest([1, 0]) AS s, unnest([0, 1]) AS g,
             unnest([CASE WHEN truth = pred THEN 1 ELSE 0 END, 0]) AS h FROM {pairs}),
k AS (SELECT cls, CAST(sum(s) AS BIGINT) AS support, CAST(sum(h) AS BIGINT) AS tp,
             CAST(sum(g) - sum(h) AS BIGINT) AS fp, CAST(sum(s) - sum(h) AS BIGINT) AS fn,
             CAST((SELECT count(*) FROM {pairs}) - sum(s) - sum(g) + sum(h) AS BIGINT) AS tn FROM c GROUP BY cls)
"""

_POINTS = f"""
{SQL_EVENT_PAIRS},
z AS (SELECT q.*, CASE WHEN coalesce(lag(truth) OVER (ORDER BY seq), 0) = truth THEN 1 ELSE 0 END AS same FROM q),
pts AS (SELECT DISTINCT least(CAST(ceil(seq / {EVERY}.0) AS BIGINT) * {EVERY}, (SELECT max(seq) FROM q)) AS point FROM q),
cum AS (SELECT point, count(*) AS n, sum(CASE WHEN truth = pred THEN 1.0 ELSE 0 END) AS hit, sum(same) AS same
        FROM pts JOIN z ON seq <= point GROUP BY point),
cls AS (SELECT point, c, sum(CASE WHEN truth = c THEN 1.0 ELSE 0 END) AS sup, sum(CASE WHEN pred = c THEN 1.0 ELSE 0 END) AS prd,
               sum(CASE WHEN truth = c AND pred = c THEN 1.0 ELSE 0 END) AS tp
        FROM pts JOIN z ON seq <= point, (SELECT unnest(range(5)) AS c) GROUP BY point, c),
pc AS (SELECT point, sum((prd / n) * (sup / n)) AS pc FROM cls JOIN cum USING (point) GROUP BY point),
cur AS (SELECT point, n, hit / n * 100 AS acc, (hit / n - pc) / (1 - pc) * 100 AS kap,
               (hit / n - same / n) / (1 - same / n) * 100 AS tem FROM cum JOIN pc USING (point)),
prf AS (SELECT point, c, sup, tp / nullif(prd, 0) AS p, tp / nullif(sup, 0) AS r FROM cls)
"""

_LONG = [f"SELECT point, 0 AS ordinal, '{INSTANCES}' AS measurement, CAST(point AS DOUBLE) AS v FROM cur"]
_LONG += [
    f"SELECT point, {i + 1}, '{name}', {col} FROM cur"
    for i, (name, col) in enumerate(zip(OVERALL_NAMES, ("n", "acc", "kap", "tem")))
]
_LONG += [
    f"SELECT point, {5 + 5 * i} + c, 'class ' || c || ' {name}', {col} FROM prf"
    for i, (name, col) in enumerate(zip(CLASS_NAMES, ("sup", "p", "r", "2 * p * r / nullif(p + r, 0)")))
]

_REG = f"""
{SQL_ORDER_PAIRS},
b AS (SELECT q.*, coalesce(avg(truth) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mean
      FROM q),
er AS (SELECT seq, abs(truth - pred) AS ae, (truth - pred) * (truth - pred) AS se, abs(truth - mean) AS ae0,
              (truth - mean) * (truth - mean) AS se0 FROM b)
"""
_REG_METRICS = """round(sum(ae) / count(*), 4) AS mae, round(sqrt(sum(se) / count(*)), 4) AS rmse,
    round(sum(ae) / sum(ae0), 4) AS relative_mae, round(sqrt(sum(se) / sum(se0)), 4) AS relative_rmse"""

ORACLES = {
    "eval_confusion": f"WITH {SQL_MEANS} SELECT truth, pred, count(*) AS n FROM p GROUP BY truth, pred",
    "eval_support": f"WITH {SQL_MEANS}, {_CLASS_SQL.format(pairs='p')} SELECT cls, support FROM k",
    "eval_class_counts": f"""WITH {SQL_EVENT_PAIRS}, {_CLASS_SQL.format(pairs='q')}
        SELECT CAST(cls AS INTEGER) AS cls, support, tp, fp, fn, tn FROM k
        UNION ALL SELECT 5, 0, 0, 0, 0, (SELECT count(*) FROM q)""",
    "eval_overall": f"""WITH {SQL_MEANS} SELECT CAST(count(*) AS DOUBLE) AS instances,
        round(avg(CASE WHEN truth = pred THEN 1.0 ELSE 0 END) * 100, 6) AS accuracy_pct,
        round(1 - avg(CASE WHEN truth = pred THEN 1.0 ELSE 0 END), 6) AS error_fraction FROM p""",
    "eval_overall_weighted": f"""WITH {SQL_EVENT_PAIRS},
        w AS (SELECT truth, pred, CAST(seq % 4 AS DOUBLE) AS w FROM q),
        t AS (SELECT sum(w) AS n, sum(CASE WHEN truth = pred THEN w ELSE 0 END) AS hit FROM w),
        r AS (SELECT pred AS c, sum(w) AS rw FROM w GROUP BY 1), s AS (SELECT truth AS c, sum(w) AS cw FROM w GROUP BY 1),
        e AS (SELECT sum(rw * cw) AS x FROM r JOIN s USING (c))
        SELECT n AS instances, round(hit / n * 100, 6) AS accuracy_pct,
        round((hit / n - x / (n * n)) / (1 - x / (n * n)) * 100, 6) AS kappa_pct FROM t, e""",
    "eval_kappa": f"""WITH {SQL_MEANS}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n,
            avg(CASE WHEN truth = pred THEN 1.0 ELSE 0 END) AS p0 FROM p),
        r AS (SELECT pred AS c, count(*) AS rn FROM p GROUP BY 1), s AS (SELECT truth AS c, count(*) AS cn FROM p GROUP BY 1),
        e AS (SELECT sum(rn * cn) AS x FROM r JOIN s USING (c))
        SELECT round((p0 - x / (n * n)) / (1 - x / (n * n)) * 100, 6) AS kappa_pct FROM n, e""",
    "eval_kappa_temporal": f"""WITH {SQL_EVENT_PAIRS},
        z AS (SELECT truth, pred, coalesce(lag(truth) OVER (ORDER BY seq), 0) AS prev FROM q),
        t AS (SELECT count(*) AS n, count(*) FILTER (truth = pred) AS hit, count(*) FILTER (truth = prev) AS same FROM z)
        SELECT n AS instances, same AS no_change,
        round((hit / n - same / n) / (1 - same / n) * 100, 6) AS kappa_temporal_pct FROM t""",
    "eval_per_class": f"""WITH {SQL_MEANS}, {_CLASS_SQL.format(pairs='p')},
        f AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS p, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS r FROM k)
        SELECT cls, support, tp, fp, fn, tn, round(p, 6) AS "precision", round(r, 6) AS recall,
        round(2 * p * r / nullif(p + r, 0), 6) AS f1 FROM f""",
    "learning_curve": f"""WITH {_POINTS} SELECT point, point % {EVERY} <> 0 AS final_partial,
        CAST(n AS DOUBLE) AS instances, round(acc, 6) AS accuracy_pct, round(kap, 6) AS kappa_pct,
        round(tem, 6) AS kappa_temporal_pct FROM cur""",
    "measurements_long": f"""WITH {_POINTS} SELECT point, CAST(ordinal AS INTEGER) AS ordinal, measurement,
        round(v, 6) AS value FROM ({' UNION ALL '.join(_LONG)})""",
    "eval_regression": f"WITH {_REG} SELECT count(*) AS instances, {_REG_METRICS} FROM er",
    "learning_curve_reg": f"""WITH {_REG},
        pts AS (SELECT DISTINCT least(CAST(ceil(seq / {EVERY}.0) AS BIGINT) * {EVERY}, (SELECT max(seq) FROM er)) AS point FROM er)
        SELECT point, point % {EVERY} <> 0 AS final_partial, {_REG_METRICS} FROM pts JOIN er ON seq <= point GROUP BY point""",
}
