"""Queries over the learners' statistics kernels."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.bounds import ERF_A, ERF_P
from driftline.functions.vectors import argmax_votes, vectorize
from driftline.operators.cluster import cf_vectors, cluster_ssq, lloyd_step, merge_cf, nearest_center, radius
from driftline.operators.kmeans_stream import INCREMENTAL, SLIDING, output, update
from driftline.operators.linear import batch_fits, fit, normal_stats, sgd_step
from driftline.operators.order import number_rows, with_seq
from driftline.operators.rules import (
    Rule,
    RuleModel,
    RuleParams,
    best_splits,
    drift_states,
    page_hinkley,
    quantile_stats,
    sdr_table,
    target_stats,
)
from driftline.operators.tree import (
    NUMERIC,
    POISSON_LIMITS,
    Node,
    TreeModel,
    TreeParams,
    majority_vote,
    nominal_gain,
    nominal_stats,
    numeric_gains,
    numeric_stats,
    split_decision,
    with_members,
)
from driftline.plans.tables import (
    SQL_LINEITEM,
    SQL_MEANS,
    class_centers,
    embedding_rows,
    lineitem_vectors,
    table,
)
from driftline.session import stored

# ---------------------------------------------------------------- tree


def ht_route_depth1(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = [
        Node([0.0, 0.0, 0.0], kind=NUMERIC, attr=0, threshold=25.0, first_child=1, n_children=2),
        Node([3.0, 1.0, 2.0], depth=1),
        Node([1.0, 2.0, 2.0], depth=1),
    ]
    model = TreeModel(TreeParams(4, (), 3), [tree])
    rows = lineitem_vectors(spark, sf_dir)
    routed = model.score(model.route(rows))
    return routed.groupBy("leaf", "pred", "label").agg(F.count(F.lit(1)).alias("n"))


def _lineitem_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_vectors(spark, sf_dir).withColumn("leaf", F.col("status"))


def ht_numeric_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = numeric_stats(_lineitem_leaves(spark, sf_dir), 4)
    return stats.select(
        "leaf", "label", "attr", F.col("n").cast("bigint").alias("n"), F.round(F.col("s") / F.col("n"), 6).alias("mean"),
        F.round(F.col("q") / F.col("n"), 6).alias("mean_sq"), "lo", "hi",
    )


def _nominal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem_vectors(spark, sf_dir).withColumn("leaf", F.lit(0))
    return rows.withColumn("features", F.array(F.col("status").cast("double"), F.col("line").cast("double")))


def ht_nominal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = nominal_stats(_nominal_rows(spark, sf_dir), 0, 2)
    return stats.select("leaf", "label", "attr", "value", F.col("n").cast("bigint").alias("n"))


def ht_quantile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree's observers of three attributes with few values, for the rows of both leaves of a split by line status."""
    root = Node([0.0] * 3, kind=NUMERIC, attr=3, threshold=0.5, first_child=1, n_children=2)
    model = TreeModel(TreeParams(4, (), 3), [[root, Node([0.0] * 3, depth=1), Node([0.0] * 3, depth=1)]])
    features = F.array("l_quantity", "l_discount", "l_tax", F.col("status").cast("double"))
    rows = lineitem_vectors(spark, sf_dir).select(
        F.lit(0).alias("member"), features.alias("features"), "label", F.lit(1.0).alias("weight")
    )
    cells = model.cells(rows)
    return cells.filter("attr < 3").select("leaf", "attr", "x", "label", F.col("n").cast("bigint").alias("n"))


def ht_info_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    gains = nominal_gain(nominal_stats(_nominal_rows(spark, sf_dir), 0, 2))
    return gains.select("leaf", "attr", F.col("n").cast("bigint").alias("n"), F.round("gain", 9).alias("gain"))


def _candidate_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_gains(numeric_stats(_lineitem_leaves(spark, sf_dir), 4))


def ht_numeric_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    gains = _candidate_gains(spark, sf_dir)
    return gains.select("leaf", "attr", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"))


def ht_split_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = Window.partitionBy("leaf", "attr").orderBy(F.col("gain").desc(), "threshold")
    best = _candidate_gains(spark, sf_dir).withColumn("r", F.row_number().over(top)).filter("r = 1").drop("r", "sides")
    decided = split_decision(best, ["leaf"], n_classes=3)
    return decided.select(
        "leaf", "attr", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"),
        F.round("gain2", 9).alias("gain2"), F.round("epsilon", 9).alias("epsilon"), "split",
    )


def bagging_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"))
    return with_members(rows, 5, "seq", 7).select("seq", "member", F.col("weight").cast("int").alias("weight"))


def bagging_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five members that vote with ten coordinates each."""
    rows = embedding_rows(spark, sf_dir).withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(4))))
    block = F.slice("features", F.col("member") * 10 + 1, 10)
    voted = rows.select("vec_id", "member", argmax_votes(block).alias("pred"))
    return majority_vote(voted, ["vec_id"]).select("vec_id", "vote", "votes")


# ---------------------------------------------------------------- rules


def _part_rules() -> list[Rule]:
    return [
        Rule(0),
        Rule(1, [(0, True, 10.0)]),
        Rule(2, [(0, False, 5.0), (1, True, 1000.0)]),
        Rule(3, [(1, False, 1500.0)]),
    ]


def amr_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", vectorize(["p_size", "p_retailprice"]).alias("features"))
    ordered = RuleModel(RuleParams(2, ordered=True), _part_rules())
    every = RuleModel(RuleParams(2, ordered=False), _part_rules())
    return rows.select(
        "p_partkey", F.get(ordered.coverage(F.col("features")), F.lit(0)).alias("first_rule"),
        F.array_join(every.coverage(F.col("features")), ",").alias("all_rules"),
    )


LOWS, HIGHS, BINS, OFFSET = (0.0, 0.0, 0.0), (50.0, 0.1, 0.08), 8, 50000.0


def _target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem_vectors(spark, sf_dir).select(
        F.col("status").alias("rule"), vectorize(["l_quantity", "l_discount", "l_tax"]).alias("features"),
        F.col("l_extendedprice").alias("target"),
    )
    return target_stats(rows, LOWS, HIGHS, BINS, ("rule",), offset=OFFSET)


def amr_target_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    return _target_stats(spark, sf_dir).select(
        "rule", "attr", "bin", "n", F.round(F.col("sy") / n, 4).alias("mean_y"),
        F.round(F.col("syy") / n / 1e6, 6).alias("mean_yy"),
    )


def amr_sdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sdr_table(_target_stats(spark, sf_dir)).select("rule", "attr", "bin", "n_left", F.round("sdr", 4).alias("sdr"))


def amr_split_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = best_splits(sdr_table(_target_stats(spark, sf_dir)))
    return best.select(
        "rule", "attr", "bin", F.round("sdr", 4).alias("sdr"), F.round("ratio", 6).alias("ratio"),
        F.round("epsilon", 6).alias("epsilon"), "expand",
    )


def amr_quantile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile observers of three attributes with few values: every value is a cell."""
    rows = lineitem_vectors(spark, sf_dir).select(
        F.col("status").alias("rule"), vectorize(["l_quantity", "l_discount", "l_tax"]).alias("features"),
        F.col("l_extendedprice").alias("target"),
    )
    cells = quantile_stats(rows, offset=OFFSET)
    n = F.col("n")
    return cells.select(
        "rule", "attr", "x", n.cast("bigint").alias("n"), F.round(F.col("sy") / n, 4).alias("mean_y"),
        F.round(F.col("syy") / n / 1e6, 6).alias("mean_yy"),
    )


def page_hinkley_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.col("event_id").alias("seq"), "value")
    rows = with_seq(events, "seq", "position")
    ph = page_hinkley(rows, "value", ["event_type"], "position", 0.005, 2000.0, carry=["seq"])
    return ph.select("event_type", "seq", F.round("m", 4).alias("m"), F.round("m_min", 4).alias("m_min"), "alarm")


DRIFT_ALPHA, DRIFT_SHIFT = 0.005, 30.0


def amr_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learner's drift test of two rules over all events, whose values rise by DRIFT_SHIFT after the first half."""
    rows, total = number_rows(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), "event_id")
    rows = rows.select(
        "seq", F.array(F.col("user_id").cast("double")).alias("features"),
        (F.col("value") + F.when(F.col("seq") > total // 2, DRIFT_SHIFT).otherwise(0.0)).alias("target"),
    )
    model = RuleModel(RuleParams(1, head="mean"), [Rule(0, n=1.0, sy=50.0), Rule(1, [(0, True, 50.0)], 1.0, 40.0)], 2, 0.0, 10.0)
    states = drift_states(stored(rows, "drift"), model._flat(), {0: (0.0,) * 4, 1: (0.0,) * 4}, model.scale, DRIFT_ALPHA)
    found = [(i, int(n), round(rise, 4), round(m, 4), rise > 35.0) for i, (rise, (n, _, m, _)) in sorted(states.items())]
    return spark.createDataFrame(found, "rule bigint, n bigint, rise double, m double, drifted boolean")


# ---------------------------------------------------------------- clustering


def _long(cfs: DataFrame, key: str) -> DataFrame:
    flat = cfs.select(key, F.col("n").cast("bigint").alias("n"), F.posexplode(F.arrays_zip("ls", "ss")).alias("dim", "v"))
    return flat.select(key, "n", "dim", F.round("v.ls", 6).alias("ls"), F.round("v.ss", 6).alias("ss"))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    return nearest_center(rows, class_centers(rows))


def nearest_center_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).select("vec_id", "idx", F.round("d2", 6).alias("d2"))


def cf_vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(cf_vectors(_assigned(spark, sf_dir), "idx", seq="vec_id").withColumnRenamed("key", "idx"), "idx")


def cf_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfs = cf_vectors(_assigned(spark, sf_dir), "idx", seq="vec_id")
    return cfs.select(F.col("key").alias("idx"), F.col("st").cast("bigint").alias("st"), F.col("stt").cast("bigint").alias("stt"))


def cf_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = cf_vectors(embedding_rows(spark, sf_dir), "label").withColumn("grp", F.col("key") % 3)
    return _long(merge_cf(parts, "grp"), "grp")


def cf_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfs = cf_vectors(embedding_rows(spark, sf_dir), "label")
    return cfs.select(F.col("key").alias("label"), F.round(radius(F.col("n"), F.col("ls"), F.col("ss")), 6).alias("radius"))


def _centers_long(centers: DataFrame) -> DataFrame:
    flat = centers.select("idx", F.col("n"), F.posexplode("center").alias("dim", "v"))
    return flat.select("idx", F.round("n", 4).alias("n"), "dim", F.round("v", 6).alias("center"))


def kmeans_lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    return _centers_long(lloyd_step(rows, class_centers(rows)))


def cluster_ssq_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    return cluster_ssq(rows, class_centers(rows)).select("idx", "n", F.round("ssq", 6).alias("ssq"))


def stream_kmeans_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    centers = class_centers(rows)
    return _centers_long(update(rows, centers, [10.0] * len(centers), 0.5))


FIXED_CENTERS = ((10.0, 20000.0, 0.05, 0.04), (25.0, 50000.0, 0.05, 0.04), (40.0, 80000.0, 0.05, 0.04))


def stream_kmeans_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = table(spark, sf_dir, "lineitem").select(*names, vectorize(names).alias("features"))
    return output(rows, FIXED_CENTERS).select(
        *names, F.round("stderr", 4).alias("stderr"), "center0", "center1", "center2"
    )


# ---------------------------------------------------------------- linear regression


def _linear_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice") / 1000.0
    return table(spark, sf_dir, "lineitem").select(
        vectorize(["l_quantity", "l_discount"]).alias("features"), price.alias("target")
    )


def linreg_normal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = normal_stats(_linear_rows(spark, sf_dir), 2)
    packed = cells.agg(
        F.max(F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("v"))).alias("n"),
        F.collect_list(F.struct("i", "j", "v")).alias("c"),
    )
    return packed.select("n", F.inline("c")).select("i", "j", F.round(F.col("v") / F.col("n"), 7).alias("v"))


def linreg_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fit(_linear_rows(spark, sf_dir), 2)
    return spark.createDataFrame([(i, round(v, 4)) for i, v in enumerate(w)], "i int, w double")


SGD_WEIGHTS, SGD_RATE = (0.5, 0.1, -0.2), 0.01


def linreg_sgd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sgd_step(_linear_rows(spark, sf_dir), SGD_WEIGHTS, SGD_RATE).select("i", F.round("w", 6).alias("w"))


def _part_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", vectorize(["o_custkey"]).alias("features"), (F.col("o_totalprice") / 1000.0).alias("target")
    )
    return with_seq(rows, "o_orderkey")


def _weights_long(fits: DataFrame) -> DataFrame:
    return fits.select(
        "batch", "n", F.round(F.get("weights", F.lit(0)), 4).alias("w0"), F.round(F.get("weights", F.lit(1)), 6).alias("w1")
    )


def linreg_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights_long(batch_fits(_part_line(spark, sf_dir), 1, SLIDING, 500, 1000))


def linreg_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights_long(batch_fits(_part_line(spark, sf_dir), 1, INCREMENTAL, 0, 1000))


QUERIES = {
    "linreg_batches": linreg_batches,
    "linreg_cumulative": linreg_cumulative,
    "ht_route_depth1": ht_route_depth1,
    "ht_numeric_stats": ht_numeric_stats,
    "ht_nominal_stats": ht_nominal_stats,
    "ht_quantile_stats": ht_quantile_stats,
    "ht_info_gain": ht_info_gain,
    "ht_numeric_gain": ht_numeric_gain,
    "ht_split_decision": ht_split_decision,
    "bagging_weights": bagging_weights,
    "bagging_vote": bagging_vote,
    "amr_coverage": amr_coverage,
    "amr_target_stats": amr_target_stats,
    "amr_quantile_stats": amr_quantile_stats,
    "amr_sdr": amr_sdr,
    "amr_split_decision": amr_split_decision,
    "amr_drift": amr_drift,
    "page_hinkley": page_hinkley_query,
    "nearest_center": nearest_center_query,
    "cf_vectors": cf_vectors_query,
    "cf_time": cf_time,
    "cf_merge": cf_merge,
    "cf_radius": cf_radius,
    "kmeans_lloyd_step": kmeans_lloyd_step,
    "cluster_ssq": cluster_ssq_query,
    "stream_kmeans_update": stream_kmeans_update,
    "stream_kmeans_output": stream_kmeans_output,
    "linreg_normal_stats": linreg_normal_stats,
    "linreg_fit": linreg_fit,
    "linreg_sgd_step": linreg_sgd_step,
}

_ERF = " + ".join(f"{a!r}e0 * power(t, {i + 1})" for i, a in enumerate(ERF_A))

_NUMERIC_GAIN = f"""{SQL_LINEITEM},
s AS (SELECT status AS leaf, attr, label, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mu,
             sqrt(greatest(0, avg(x * x) - avg(x) * avg(x))) AS sd, min(x) AS lo, max(x) AS hi FROM lx GROUP BY 1, 2, 3),
r AS (SELECT leaf, attr, min(lo) AS glo, max(hi) AS ghi FROM s GROUP BY 1, 2),
c AS (SELECT s.*, glo + (ghi - glo) * k / 11.0 AS thr FROM s JOIN r USING (leaf, attr), (SELECT unnest(range(1, 11)) AS k)),
z AS (SELECT *, (thr - mu) / sd AS z, 1 / (1 + {ERF_P!r}e0 * (abs((thr - mu) / sd) / sqrt(2e0))) AS t FROM c),
g AS (SELECT *, 1 - ({_ERF}) * exp(-(z * z / 2)) AS er FROM z),
m AS (SELECT *, CASE WHEN thr < lo THEN 0 WHEN thr >= hi THEN n WHEN z >= 0 THEN n * (1 + er) / 2
                ELSE n * (1 - er) / 2 END AS lf FROM g),
e AS (SELECT leaf, attr, thr, sum(n) AS n, sum(lf) AS nl, sum(n - lf) AS nr, sum(n * log2(n)) AS lc,
             sum(CASE WHEN lf > 0 THEN lf * log2(lf) ELSE 0 END) AS ll,
             sum(CASE WHEN n - lf > 0 THEN (n - lf) * log2(n - lf) ELSE 0 END) AS lr FROM m GROUP BY 1, 2, 3),
gain AS (SELECT leaf, attr, thr, n, (log2(n) - lc / n) - (CASE WHEN nl > 0 THEN nl * (log2(nl) - ll / nl) ELSE 0 END
                + CASE WHEN nr > 0 THEN nr * (log2(nr) - lr / nr) ELSE 0 END) / n AS gain FROM e)
"""

_NOMINAL = f"""{SQL_LINEITEM},
v AS (SELECT label, unnest([0, 1]) AS attr, unnest([status, line]) AS value FROM l)
"""

_BINS = f"""raw AS (SELECT CAST(list_position(['F', 'O'], l_linestatus) - 1 AS INTEGER) AS rule, unnest([0, 1, 2]) AS attr,
               unnest([l_quantity, l_discount, l_tax]) AS x,
               unnest([{', '.join(f'{v!r}e0' for v in LOWS)}]) AS lo, unnest([{', '.join(f'{v!r}e0' for v in HIGHS)}]) AS hi,
               l_extendedprice - {OFFSET!r}e0 AS y FROM lineitem),
t AS (SELECT rule, attr, CAST(least({BINS - 1}, greatest(0, floor((x - lo) / (hi - lo) * {BINS}))) AS INTEGER) AS bin,
             count(*) AS n, sum(y) AS sy, sum(y * y) AS syy FROM raw GROUP BY 1, 2, 3)
"""

_SDR = f"""{_BINS},
w AS (SELECT *, sum(n) OVER o AS nl, sum(sy) OVER o AS sl, sum(syy) OVER o AS ql, sum(n) OVER a AS nt,
             sum(sy) OVER a AS st, sum(syy) OVER a AS qt FROM t
      WINDOW o AS (PARTITION BY rule, attr ORDER BY bin), a AS (PARTITION BY rule, attr)),
sd AS (SELECT rule, attr, bin, CAST(nl AS BIGINT) AS n_left, nt, sqrt(greatest(0, qt / nt - (st / nt) * (st / nt))) AS sd,
              sqrt(greatest(0, qt / nt - (st / nt) * (st / nt)))
              - nl / nt * sqrt(greatest(0, ql / nl - (sl / nl) * (sl / nl)))
              - (nt - nl) / nt * sqrt(greatest(0, (qt - ql) / (nt - nl) - ((st - sl) / (nt - nl)) * ((st - sl) / (nt - nl))))
              AS sdr FROM w WHERE nt > nl)
"""

_LIMITS = " + ".join(f"CASE WHEN u >= {p!r}e0 THEN 1 ELSE 0 END" for p in POISSON_LIMITS)
_LINEAR = "f AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice / 1000.0 AS y FROM lineitem)"
_Z = ("1e0", "a", "b", "y")
_W0, _W1, _W2 = (f"({v!r}e0)" for v in SGD_WEIGHTS)

_HOEFFDING3 = f"sqrt(power(log2(3), 2) * {math.log(1e7)!r}e0 / (2 * n))"

_FITS = """o AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS seq, CAST(o_custkey AS DOUBLE) AS x,
             o_totalprice / 1000.0 AS y FROM orders)
"""

ORACLES = {
    "linreg_batches": f"""WITH {_FITS}, g AS (SELECT b AS batch, x, y FROM o, LATERAL (SELECT unnest(range(greatest(0,
            CAST(floor((seq - 1 - 1000) / 500.0) AS BIGINT) + 1), CAST(floor((seq - 1) / 500.0) AS BIGINT) + 1)) AS b))
        SELECT batch, count(*) AS n, round(regr_intercept(y, x), 4) AS w0, round(regr_slope(y, x), 6) AS w1
        FROM g GROUP BY batch""",
    "linreg_cumulative": f"""WITH {_FITS}, b AS (SELECT DISTINCT (seq - 1) // 1000 AS batch FROM o)
        SELECT batch, count(*) AS n, round(regr_intercept(y, x), 4) AS w0, round(regr_slope(y, x), 6) AS w1
        FROM b JOIN o ON (seq - 1) // 1000 <= batch GROUP BY batch""",
    "ht_route_depth1": f"""WITH {SQL_LINEITEM} SELECT CAST(CASE WHEN f0 <= 25 THEN 1 ELSE 2 END AS INTEGER) AS leaf,
        CAST(CASE WHEN f0 <= 25 THEN 0 ELSE 1 END AS INTEGER) AS pred, CAST(label AS INTEGER) AS label, count(*) AS n
        FROM l GROUP BY 1, 2, 3""",
    "ht_numeric_stats": f"""WITH {SQL_LINEITEM} SELECT CAST(status AS INTEGER) AS leaf, CAST(label AS INTEGER) AS label,
        attr, count(*) AS n, round(avg(x), 6) AS mean, round(avg(x * x), 6) AS mean_sq, min(x) AS lo, max(x) AS hi
        FROM lx GROUP BY status, label, attr""",
    "ht_nominal_stats": f"""WITH {_NOMINAL} SELECT CAST(0 AS INTEGER) AS leaf, CAST(label AS INTEGER) AS label, attr,
        CAST(value AS INTEGER) AS value, count(*) AS n FROM v GROUP BY label, attr, value""",
    "ht_quantile_stats": f"""WITH {SQL_LINEITEM}, lq AS (SELECT CAST(status + 1 AS INTEGER) AS leaf, CAST(label AS INTEGER) AS label,
        unnest([0, 1, 2]) AS attr, unnest([f0, f2, f3]) AS x FROM l)
        SELECT leaf, CAST(attr AS INTEGER) AS attr, x, label, count(*) AS n FROM lq GROUP BY ALL""",
    "ht_info_gain": f"""WITH {_NOMINAL},
        c AS (SELECT attr, value, label, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY 1, 2, 3),
        hv AS (SELECT attr, value, sum(n) AS nv, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM c GROUP BY 1, 2),
        lab AS (SELECT attr, label, sum(n) AS n FROM c GROUP BY 1, 2),
        hr AS (SELECT attr, sum(n) AS n, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM lab GROUP BY 1),
        inn AS (SELECT attr, sum(nv * h) AS s FROM hv GROUP BY 1)
        SELECT CAST(0 AS INTEGER) AS leaf, attr, CAST(n AS BIGINT) AS n, round(h - s / n, 9) AS gain
        FROM hr JOIN inn USING (attr)""",
    "ht_numeric_gain": f"""WITH {_NUMERIC_GAIN} SELECT CAST(leaf AS INTEGER) AS leaf, attr, round(thr, 6) AS threshold,
        round(gain, 9) AS gain FROM gain""",
    "ht_split_decision": f"""WITH {_NUMERIC_GAIN},
        best AS (SELECT * FROM gain QUALIFY row_number() OVER (PARTITION BY leaf, attr ORDER BY gain DESC, thr) = 1),
        two AS (SELECT *, greatest(0, coalesce(lead(gain) OVER o, 0)) AS gain2, row_number() OVER o AS rn,
                       {_HOEFFDING3} AS eps FROM best WINDOW o AS (PARTITION BY leaf ORDER BY gain DESC, attr))
        SELECT CAST(leaf AS INTEGER) AS leaf, attr, round(thr, 6) AS threshold, round(gain, 9) AS gain,
        round(gain2, 9) AS gain2, round(eps, 9) AS epsilon, gain > 0 AND (gain - gain2 > eps OR eps < 0.05) AS split
        FROM two WHERE rn = 1""",
    "bagging_weights": f"""WITH k AS (SELECT event_id AS seq, unnest(range(5)) AS member FROM events),
        u AS (SELECT seq, member, CAST('0x' || substr(md5(seq || ':' || member || ':7'), 1, 8) AS BIGINT) / 4294967296e0 AS u
              FROM k), w AS (SELECT seq, member, {_LIMITS} AS weight FROM u)
        SELECT seq, CAST(member AS INTEGER) AS member, CAST(weight AS INTEGER) AS weight FROM w WHERE weight > 0""",
    "bagging_vote": """WITH b AS (SELECT vec_id, m, list_slice(embedding, m * 10 + 1, m * 10 + 10) AS v
            FROM embeddings, (SELECT unnest(range(5)) AS m)),
        p AS (SELECT vec_id, list_position(v, list_max(v)) - 1 AS pred FROM b),
        c AS (SELECT vec_id, pred, count(*) AS n FROM p GROUP BY 1, 2)
        SELECT vec_id, CAST(pred AS INTEGER) AS vote, n AS votes FROM c
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, pred) = 1""",
    "amr_coverage": """WITH c AS (SELECT p_partkey, p_size <= 10 AS a, p_size > 5 AND p_retailprice <= 1000 AS b,
            p_retailprice > 1500 AS c FROM part)
        SELECT p_partkey, CAST(CASE WHEN a THEN 1 WHEN b THEN 2 WHEN c THEN 3 ELSE 0 END AS INTEGER) AS first_rule,
        CASE WHEN a OR b OR c THEN concat_ws(',', CASE WHEN a THEN '1' END, CASE WHEN b THEN '2' END,
            CASE WHEN c THEN '3' END) ELSE '0' END AS all_rules FROM c""",
    "amr_target_stats": f"""WITH {_BINS} SELECT rule, attr, bin, n, round(sy / n, 4) AS mean_y,
        round(syy / n / 1e6, 6) AS mean_yy FROM t""",
    "amr_quantile_stats": f"""WITH {SQL_LINEITEM}, lp AS (SELECT l.*, f1 * 1000 - {OFFSET} AS y FROM l),
        lq AS (SELECT status AS rule, y, unnest([0, 1, 2]) AS attr, unnest([f0, f2, f3]) AS x FROM lp)
        SELECT CAST(rule AS BIGINT) AS rule, CAST(attr AS INTEGER) AS attr, x, count(*) AS n, round(avg(y), 4) AS mean_y,
        round(avg(y * y) / 1e6, 6) AS mean_yy FROM lq GROUP BY rule, attr, x""",
    "amr_sdr": f"WITH {_SDR} SELECT rule, attr, bin, n_left, round(sdr, 4) AS sdr FROM sd",
    "amr_drift": f"""WITH s AS (SELECT row_number() OVER (ORDER BY event_id) AS seq, user_id, value, count(*) OVER () AS total FROM events),
        e AS (SELECT seq, CASE WHEN user_id <= 50 THEN 1 ELSE 0 END AS rule, abs(value + CASE WHEN seq > total // 2 THEN {DRIFT_SHIFT} ELSE 0 END
              - CASE WHEN user_id <= 50 THEN 40 ELSE 50 END) / 10.0 AS e FROM s),
        t AS (SELECT *, e - avg(e) OVER w - {DRIFT_ALPHA} AS term FROM e WINDOW w AS (PARTITION BY rule ORDER BY seq)),
        m AS (SELECT *, sum(term) OVER w AS m FROM t WINDOW w AS (PARTITION BY rule ORDER BY seq)),
        r AS (SELECT *, m - least(0, min(m) OVER w) AS rise FROM m WINDOW w AS (PARTITION BY rule ORDER BY seq))
        SELECT CAST(rule AS BIGINT) AS rule, count(*) AS n, round(max(rise), 4) AS rise, round(max_by(m, seq), 4) AS m, max(rise) > 35 AS drifted
        FROM r GROUP BY 1""",
    "amr_split_decision": f"""WITH {_SDR},
        best AS (SELECT * FROM sd QUALIFY row_number() OVER (PARTITION BY rule, attr ORDER BY sdr DESC, bin) = 1),
        two AS (SELECT *, coalesce(lead(sdr) OVER o, 0) AS sdr2, row_number() OVER o AS rn,
                       sqrt({math.log(1e7)!r}e0 / (2 * nt)) AS eps FROM best
                WINDOW o AS (PARTITION BY rule ORDER BY sdr DESC, attr))
        SELECT rule, attr, bin, round(sdr, 4) AS sdr, round(greatest(0, sdr2) / sdr, 6) AS ratio,
        round(eps, 6) AS epsilon, (greatest(0, sdr2) / sdr + eps < 1 AND sdr / sd > eps) OR eps < 0.05 AS expand
        FROM two WHERE rn = 1 AND sdr > 0""",
    "page_hinkley": """WITH a AS (SELECT event_type, event_id AS seq, value, avg(value) OVER (PARTITION BY event_type
            ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS mean FROM events),
        b AS (SELECT event_type, seq, sum(value - mean - 0.005e0) OVER (PARTITION BY event_type ORDER BY seq
            ROWS UNBOUNDED PRECEDING) AS m FROM a),
        c AS (SELECT *, min(m) OVER (PARTITION BY event_type ORDER BY seq ROWS UNBOUNDED PRECEDING) AS m_min FROM b)
        SELECT event_type, seq, round(m, 4) AS m, round(m_min, 4) AS m_min, m - m_min > 2000 AS alarm FROM c""",
    "nearest_center": f"WITH {SQL_MEANS} SELECT vec_id, pred AS idx, round(d2, 6) AS d2 FROM p",
    "cf_vectors": f"""WITH {SQL_MEANS} SELECT pred AS idx, count(*) AS n, CAST(i - 1 AS INTEGER) AS dim,
        round(sum(v), 6) AS ls, round(sum(v * v), 6) AS ss FROM p JOIN x USING (vec_id) GROUP BY pred, i""",
    "cf_time": f"""WITH {SQL_MEANS} SELECT pred AS idx, CAST(sum(vec_id) AS BIGINT) AS st,
        CAST(sum(vec_id * vec_id) AS BIGINT) AS stt FROM p GROUP BY pred""",
    "cf_merge": f"""WITH {SQL_MEANS} SELECT label % 3 AS grp, count(*) AS n, CAST(i - 1 AS INTEGER) AS dim,
        round(sum(v), 6) AS ls, round(sum(v * v), 6) AS ss FROM x GROUP BY label % 3, i""",
    "cf_radius": f"""WITH {SQL_MEANS}, r AS (SELECT label, i, avg(v * v) - avg(v) * avg(v) AS s FROM x GROUP BY 1, 2)
        SELECT label, round(sqrt(sum(s)), 6) AS radius FROM r GROUP BY label""",
    "kmeans_lloyd_step": f"""WITH {SQL_MEANS} SELECT pred AS idx, CAST(count(*) AS DOUBLE) AS n,
        CAST(i - 1 AS INTEGER) AS dim, round(avg(v), 6) AS center FROM p JOIN x USING (vec_id) GROUP BY pred, i""",
    "cluster_ssq": f"WITH {SQL_MEANS} SELECT pred AS idx, count(*) AS n, round(sum(d2), 6) AS ssq FROM p GROUP BY pred",
    "stream_kmeans_update": f"""WITH {SQL_MEANS},
        s AS (SELECT pred AS c, i, count(*) AS k, sum(v) AS s FROM p JOIN x USING (vec_id) GROUP BY 1, 2)
        SELECT m.c AS idx, round(5e0 + coalesce(k, 0), 4) AS n, CAST(m.i - 1 AS INTEGER) AS dim,
        round(CASE WHEN k IS NULL THEN mu ELSE (mu * 5e0 + s) / (5e0 + k) END, 6) AS center
        FROM m LEFT JOIN s ON m.c = s.c AND m.i = s.i""",
    "stream_kmeans_output": """SELECT l_quantity, l_extendedprice, l_discount, l_tax, round(sqrt(least("""
    + ", ".join(
        f"power(l_quantity - {c[0]}, 2) + power(l_extendedprice - {c[1]}, 2) + power(l_discount - {c[2]!r}e0, 2)"
        f" + power(l_tax - {c[3]!r}e0, 2)"
        for c in FIXED_CENTERS
    )
    + ")), 4) AS stderr, "
    + ", ".join(f"'[{','.join(repr(v) for v in c)}]' AS center{i}" for i, c in enumerate(FIXED_CENTERS))
    + " FROM lineitem",
    "linreg_normal_stats": f"WITH {_LINEAR} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, round(avg({_Z[i]} * {_Z[j]}), 7) AS v FROM f"
        for i in range(4)
        for j in range(i, 4)
    ),
    "linreg_fit": f"""WITH {_LINEAR},
        s AS (SELECT covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb, covar_pop(a, y) AS ay,
                     covar_pop(b, y) AS byy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM f),
        w AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS w1, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS w2
              FROM s)
        SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS i, unnest([round(my - w1 * ma - w2 * mb, 4), round(w1, 4),
        round(w2, 4)]) AS w FROM w""",
    "linreg_sgd_step": f"""WITH {_LINEAR}, e AS (SELECT a, b, {_W0} + {_W1} * a + {_W2} * b - y AS e FROM f),
        g AS (SELECT avg(e) AS g0, avg(e * a) AS g1, avg(e * b) AS g2 FROM e)
        SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS i, unnest([round({_W0} - {SGD_RATE}e0 * g0, 6),
        round({_W1} - {SGD_RATE}e0 * g1, 6), round({_W2} - {SGD_RATE}e0 * g2, 6)]) AS w FROM g""",
}
