"""Queries that run the learners end to end over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.api import Learned, hoeffding_classifier, microcluster_kmeans, rules_regressor, streaming_kmeans
from driftline.operators.cluster import centers_row, cf_vectors, cluster_ssq
from driftline.operators.kernels import QUANTILE_C, QUANTILE_D, PyramidalFrame, relevance, silhouette
from driftline.operators.order import with_seq
from driftline.operators.tree import POISSON_LIMITS
from driftline.plans.tables import SQL_MARKED, SQL_MEANS, class_centers, embedding_rows, marked_events, table
from driftline.schema import predict_target
from driftline.session import fresh_path


def _classified(spark: SparkSession, sf_dir: str, **options) -> Learned:
    rows = marked_events(spark, sf_dir).select(
        "event_id", "value", F.hour("ts").cast("double").alias("hour"), F.col("user_id").cast("double").alias("user"),
        F.get_json_object("props", "$.k").alias("digit"), "label",
    )
    return hoeffding_classifier(
        rows, ["value", "hour", "user"], "label", 5, "event_id", nominal={"digit": 100}, **options
    )


def ht_train_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _classified(spark, sf_dir).model.nodes(spark)
    return nodes.select("member", "node", "kind", "attr", F.round("threshold", 4).alias("threshold"), "depth")


def ht_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).predictions


def ht_prequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).curve.drop("classes")


def ht_bagged_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, bagging=3).predictions


# A grace period no table reaches: the model stays a single leaf or rule, so its predictions have a SQL counterpart.
NEVER = 1e18


def ht_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-then-train of a tree that never splits: the majority class of the micro-batches before."""
    return _classified(spark, sf_dir, grace=NEVER).predictions.select("seq", "value", "prediction")


def ht_majority_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, grace=NEVER).pairs.select("seq", "truth", "pred")


FIRST, SIGNS = 400, 6


def ht_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One growth step: learn FIRST rows, split the root on the sign that tells most, predict all other rows."""
    signs = {f"sign{i}": F.when(F.get("embedding", F.lit(i)) > 0, "p").otherwise("n") for i in range(SIGNS)}
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[c.alias(n) for n, c in signs.items()], F.col("label").cast("string").alias("label")
    )
    learned = hoeffding_classifier(
        rows, [], "label", 10, "vec_id", nominal=dict.fromkeys(signs, 2), first_batch=FIRST, growth=1e9, tie=1.0,
        levels=1, least_gain=1e-12, branch_rows=0.0,
    )
    return learned.pairs.select("seq", "truth", "pred")


GRID = 4


def _grid(spark: SparkSession, sf_dir: str, **options) -> Learned:
    """Coordinates of embeddings rounded to a grid: attributes with few values, whose observers are exact."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.floor(F.get("embedding", F.lit(i)).cast("double") * 16).cast("double").alias(f"g{i}") for i in range(GRID)],
        F.col("label").cast("string").alias("label"),
    )
    return hoeffding_classifier(
        rows, [f"g{i}" for i in range(GRID)], "label", 10, "vec_id", first_batch=FIRST, growth=1e9, tie=10.0, grace=2.0,
        least_share=0.1, least_gain=1e-9, **options
    )


def ht_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels from one micro-batch of FIRST rows; all later rows are predicted by their leaf."""
    return _grid(spark, sf_dir, levels=2).pairs.select("seq", "truth", "pred")


def ht_bagged_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three bagged trees of one split each: the largest sum of the members' class shares."""
    signs = {f"sign{i}": F.when(F.get("embedding", F.lit(i)) > 0, "p").otherwise("n") for i in range(SIGNS)}
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[c.alias(n) for n, c in signs.items()], F.col("label").cast("string").alias("label")
    )
    learned = hoeffding_classifier(
        rows, [], "label", 10, "vec_id", nominal=dict.fromkeys(signs, 2), first_batch=FIRST, growth=1e9, tie=1.0, bagging=3,
        levels=1, least_gain=1e-12, branch_rows=0.0,
    )
    return learned.pairs.select("seq", "truth", "pred")


def ht_mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric and nominal attributes of documents against their quality label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    rows = docs.join(labels, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit("?")))
    learned = hoeffding_classifier(
        rows, ["n_chars"], "quality", 2, "doc_id", nominal={"lang": 4, "source": 20}, first_batch=200
    )
    return learned.predictions


def _regressed(spark: SparkSession, sf_dir: str, **options) -> Learned:
    target = F.when(F.col("p_partkey") % 50 == 0, predict_target()).otherwise(F.col("p_retailprice"))
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_partkey").cast("double").alias("part"),
        target.alias("price"),
    )
    return rules_regressor(rows, ["size", "part"], "price", "p_partkey", **options)


def amr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = _regressed(spark, sf_dir).model.table(spark)
    return table_.select("position", "rule", F.size("conditions").alias("literals"), F.round("n", 4).alias("n"))


def amr_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressed(spark, sf_dir).predictions


def amr_predict_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressed(spark, sf_dir, ordered=False, head="mean").predictions


def amr_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-then-train of the default rule alone: the mean target of the micro-batches before."""
    learned = _regressed(spark, sf_dir, grace=NEVER, head="mean")
    return learned.predictions.select("seq", "size", F.round("prediction", 6).alias("prediction"))


def amr_mean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = _regressed(spark, sf_dir, grace=NEVER, head="mean")
    return learned.pairs.select("seq", "truth", F.round("pred", 6).alias("pred"))


PART_FIRST = 100


def _first_rule(spark: SparkSession, sf_dir: str) -> Learned:
    """One expansion after PART_FIRST parts, by attributes with few values, whose observers are exact."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), (F.col("p_partkey") % 25).cast("double").alias("rest"),
        F.floor(F.col("p_partkey") / 10).cast("double").alias("tens"), F.col("p_retailprice").alias("price"),
    )
    return rules_regressor(
        rows, ["size", "rest", "tens"], "price", "p_partkey", head="mean", first_batch=PART_FIRST, growth=1e9, grace=2.0,
        tie=10.0, least_share=0.0, least_reduction=0.0, levels=1,
    )


def amr_first_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after the first batch with the mean of the first rule or of the default rule, whichever they meet."""
    return _first_rule(spark, sf_dir).pairs.select("seq", "truth", F.round("pred", 6).alias("pred"))


def amr_prequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regressed(spark, sf_dir).curve


def _clustered(spark: SparkSession, sf_dir: str) -> Learned:
    return microcluster_kmeans(table(spark, sf_dir, "embeddings"), "embedding", 3, "vec_id")


def cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).predictions


def kmeans_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the macro centres over all rows."""
    model = _clustered(spark, sf_dir).model
    return cluster_ssq(embedding_rows(spark, sf_dir), model.centers()).select("idx", "n", F.round("ssq", 4).alias("ssq"))


def mean_moments(kernels: DataFrame) -> DataFrame:
    """Rows per dimension, mean and mean square over all kernels: what clustering must not change."""
    flat = kernels.select("n", F.posexplode(F.arrays_zip("ls", "ss")).alias("dim", "v"))
    sums = flat.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("v.ls").alias("ls"), F.sum("v.ss").alias("ss"))
    return sums.select(
        "dim", F.round("n").cast("bigint").alias("n"), F.round(F.col("ls") / F.col("n"), 6).alias("mean"),
        F.round(F.col("ss") / F.col("n"), 6).alias("mean_sq"),
    )


def cluster_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_moments(_clustered(spark, sf_dir).model.table(spark))


HORIZON, CLUSTER_EVERY = 200, 100


def cluster_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of the newest HORIZON rows, from the kernels less a snapshot of them."""
    frame = PyramidalFrame(spark, fresh_path(spark, "frame"))
    microcluster_kmeans(
        table(spark, sf_dir, "embeddings"), "embedding", 3, "vec_id", first_batch=CLUSTER_EVERY, growth=1.0, frame=frame, m=40
    )
    return mean_moments(frame.horizon(HORIZON)[0])


def kernel_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance stamps of the micro-clusters that the classes of the embeddings form."""
    cfs = cf_vectors(with_seq(embedding_rows(spark, sf_dir), "vec_id"), "label", seq="seq")
    stamp = relevance(F.col("n"), F.col("st"), F.col("stt"), 10)
    return cfs.select(F.col("key").alias("label"), F.col("n").cast("bigint").alias("n"), F.round(stamp, 4).alias("stamp"))


def cluster_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    return silhouette(rows, class_centers(rows)).select("idx", "n", F.round("silhouette", 6).alias("silhouette"))


def cluster_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000.0).alias("price"), "l_discount", "l_tax"
    )
    learned = microcluster_kmeans(
        rows, ["l_quantity", "price", "l_discount", "l_tax"], 4, ["l_orderkey", "l_linenumber"]
    )
    return centers_row(spark, learned.model.centers(), 4)


def _kmeans_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "value", F.hour("ts").cast("double").alias("hour"), F.col("user_id").cast("double").alias("user")
    )


def kmeans_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming_kmeans(_kmeans_rows(spark, sf_dir), ["value", "hour", "user"], 2, "event_id", 0, 0, 1000)[0]


def kmeans_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming_kmeans(_kmeans_rows(spark, sf_dir), ["value", "hour", "user"], 2, "event_id", 1, 500, 1000)[0]


def kmeans_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming_kmeans(_kmeans_rows(spark, sf_dir), ["value", "hour", "user"], 2, "event_id", 2, alpha=0.9)[0]


GIVEN = ((20.0, 6.0, 100.0), (60.0, 18.0, 400.0))
GIVEN_BATCH, GIVEN_SHIFT, GIVEN_ALPHA = 1000, 500, 0.9


def _given(spark: SparkSession, sf_dir: str, learn_type: int, shift: int = 0, **options) -> DataFrame:
    """Streaming k-means from given centres: every event with its distance to the nearest centre."""
    rows, _ = streaming_kmeans(
        _kmeans_rows(spark, sf_dir), ["value", "hour", "user"], 2, "event_id", learn_type, shift, GIVEN_BATCH, 1, centers=GIVEN, **options
    )
    return rows.select("event_id", F.round("stderr", 5).alias("stderr"))


def kmeans_batches_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, 0)


def kmeans_sliding_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, 1, GIVEN_SHIFT)


def kmeans_incremental_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, 2, alpha=GIVEN_ALPHA)


QUERIES = {
    "kmeans_batches_given": kmeans_batches_given,
    "kmeans_sliding_given": kmeans_sliding_given,
    "kmeans_incremental_given": kmeans_incremental_given,
    "kmeans_batches": kmeans_batches,
    "kmeans_sliding": kmeans_sliding,
    "kmeans_incremental": kmeans_incremental,
    "ht_train_nodes": ht_train_nodes,
    "ht_predict": ht_predict,
    "ht_prequential": ht_prequential,
    "ht_bagged_predict": ht_bagged_predict,
    "ht_majority": ht_majority,
    "ht_majority_pairs": ht_majority_pairs,
    "ht_mixed_documents": ht_mixed_documents,
    "amr_rules": amr_rules,
    "amr_predict": amr_predict,
    "amr_predict_unordered": amr_predict_unordered,
    "amr_mean": amr_mean,
    "amr_mean_pairs": amr_mean_pairs,
    "amr_prequential": amr_prequential,
    "cluster_centers": cluster_centers,
    "kmeans_macro": kmeans_macro,
    "cluster_mass": cluster_mass,
    "cluster_lineitem": cluster_lineitem,
    "cluster_horizon": cluster_horizon,
    "kernel_relevance": kernel_relevance,
    "cluster_silhouette": cluster_silhouette,
    "ht_first_split": ht_first_split,
    "ht_two_levels": ht_two_levels,
    "ht_bagged_stumps": ht_bagged_stumps,
    "amr_first_rule": amr_first_rule,
}
# Micro-batch k starts after 1000 · (2^k − 1) rows.
_DOUBLING = "b AS (SELECT k, 1000 * (CAST(pow(2, k) AS BIGINT) - 1) AS before FROM (SELECT unnest(range(0, 30)) AS k))"
_BATCH_OF = "CAST(floor(log2((seq - 1) // 1000 + 1)) AS BIGINT)"

MAJORITY = """
d AS (SELECT label, row_number() OVER (ORDER BY min(seq)) - 1 AS idx FROM e WHERE label <> '?' GROUP BY label),
c AS (SELECT k, idx, count(*) AS n FROM b JOIN (SELECT seq, idx FROM e JOIN d USING (label)) ON seq <= before GROUP BY 1, 2),
m AS (SELECT k, idx FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, idx) = 1)
"""
_MEAN = f"""
p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS seq, CAST(p_size AS DOUBLE) AS size, p_retailprice AS y,
             p_partkey % 50 = 0 AS asked FROM part),
{_DOUBLING},
m AS (SELECT k, avg(y) AS mean FROM b JOIN p ON seq <= before WHERE NOT asked GROUP BY k)
"""

SQL_MASS = """SELECT CAST(i - 1 AS INTEGER) AS dim, count(*) AS n, round(avg(v), 6) AS mean, round(avg(v * v), 6) AS mean_sq
    FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i"""
_FIRST_SPLIT = f"""
e AS (SELECT row_number() OVER (ORDER BY vec_id) AS seq, CAST(label AS VARCHAR) AS label, embedding FROM embeddings),
d AS (SELECT label, row_number() OVER (ORDER BY min(seq)) - 1 AS idx FROM e GROUP BY label),
v AS (SELECT seq, idx, unnest(range({SIGNS})) AS attr, unnest(embedding[1:{SIGNS}]) > 0 AS value
      FROM e JOIN d USING (label)),
c AS (SELECT attr, value, idx, CAST(count(*) AS DOUBLE) AS n FROM v WHERE seq <= {FIRST} GROUP BY ALL),
hv AS (SELECT attr, value, sum(n) AS nv, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM c GROUP BY 1, 2),
root AS (SELECT attr, sum(n) AS n, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h
         FROM (SELECT attr, idx, sum(n) AS n FROM c GROUP BY 1, 2) GROUP BY 1),
best AS (SELECT attr FROM root JOIN (SELECT attr, sum(nv * h) AS s FROM hv GROUP BY 1) USING (attr)
         WHERE h - s / n > 1e-12 ORDER BY h - s / n DESC, attr LIMIT 1),
major AS (SELECT value, idx FROM c JOIN best USING (attr) QUALIFY row_number() OVER (PARTITION BY value ORDER BY n DESC, idx) = 1)
"""



def _grid_split(name: str, rows: str) -> str:
    """CTEs of the best threshold of each node: ``rows`` has seq, node, idx, attr, x of the rows learned from."""
    return f"""
{name}_c AS (SELECT node, attr, x, idx, count(*) AS n FROM {rows} WHERE seq <= {FIRST} GROUP BY ALL),
{name}_t AS (SELECT DISTINCT node, attr, x AS thr FROM {name}_c),
{name}_s AS (SELECT t.node, t.attr, thr, idx, sum(n) AS n, sum(CASE WHEN x <= thr THEN n ELSE 0 END) AS l
    FROM {name}_t t JOIN {name}_c c ON c.node = t.node AND c.attr = t.attr GROUP BY 1, 2, 3, 4),
{name}_m AS (SELECT node, attr, thr, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(l) AS DOUBLE) AS nl, CAST(sum(n - l) AS DOUBLE) AS nr,
    count(*) AS classes, sum(n * log2(n)) AS e, sum(CASE WHEN l > 0 THEN l * log2(l) ELSE 0 END) AS el,
    sum(CASE WHEN n > l THEN (n - l) * log2(n - l) ELSE 0 END) AS er FROM {name}_s GROUP BY 1, 2, 3),
{name}_g AS (SELECT *, round((n * log2(n) - e - (nl * log2(nl) - el) - (nr * log2(nr) - er)) / n, 11) AS gain FROM {name}_m
    WHERE nr > 0 AND nl > 0 AND least(nl, nr) >= 0.1 * n AND classes > 1),
{name}_b AS (SELECT node, attr, thr FROM {name}_g WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, attr, thr) = 1)"""


_TWO_LEVELS = f"""
e AS (SELECT row_number() OVER (ORDER BY vec_id) AS seq, CAST(label AS VARCHAR) AS label, embedding FROM embeddings),
d AS (SELECT label, row_number() OVER (ORDER BY min(seq)) - 1 AS idx FROM e GROUP BY label),
v AS (SELECT seq, idx, unnest(range({GRID})) AS attr,
      unnest(list_transform(embedding[1:{GRID}], lambda x: floor(CAST(x AS DOUBLE) * 16))) AS x FROM e JOIN d USING (label)),
r AS (SELECT *, 0 AS node FROM v),
{_grid_split("a", "r")},
r2 AS (SELECT v.*, k.node FROM v JOIN (SELECT seq, CASE WHEN x <= thr THEN 1 ELSE 2 END AS node FROM v JOIN a_b USING (attr)) k USING (seq)),
{_grid_split("b", "r2")},
leaf AS (SELECT seq, idx, node, min(CASE WHEN b_b.attr = r2.attr THEN CASE WHEN x <= thr THEN 1 ELSE 2 END ELSE 3 END) AS side
         FROM r2 LEFT JOIN b_b USING (node) GROUP BY 1, 2, 3),
major AS (SELECT node, side, idx FROM (SELECT node, side, idx, count(*) AS n FROM leaf WHERE seq <= {FIRST} GROUP BY 1, 2, 3)
          QUALIFY row_number() OVER (PARTITION BY node, side ORDER BY n DESC, idx) = 1)
"""

_STUMPS = f"""
e AS (SELECT row_number() OVER (ORDER BY vec_id) AS seq, CAST(label AS VARCHAR) AS label, embedding FROM embeddings),
d AS (SELECT label, row_number() OVER (ORDER BY min(seq)) - 1 AS idx FROM e GROUP BY label),
v AS (SELECT seq, idx, unnest(range({SIGNS})) AS attr, unnest(embedding[1:{SIGNS}]) > 0 AS value FROM e JOIN d USING (label)),
u AS (SELECT seq, member, CAST('0x' || substr(md5(concat_ws(':', seq, member, 1)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM e, range(3) AS m(member) WHERE seq <= {FIRST}),
p AS (SELECT seq, member, {" + ".join(f"CAST(u >= {limit!r}::DOUBLE AS INTEGER)" for limit in POISSON_LIMITS)} AS w FROM u),
c AS (SELECT member, attr, value, idx, CAST(sum(w) AS DOUBLE) AS n FROM v JOIN p USING (seq) WHERE w > 0 GROUP BY ALL),
hv AS (SELECT member, attr, value, sum(n) AS nv, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h FROM c GROUP BY 1, 2, 3),
root AS (SELECT member, attr, sum(n) AS n, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS h
         FROM (SELECT member, attr, idx, sum(n) AS n FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2),
best AS (SELECT member, attr FROM root JOIN (SELECT member, attr, sum(nv * h) AS s FROM hv GROUP BY 1, 2) USING (member, attr)
         WHERE h - s / n > 1e-12 QUALIFY row_number() OVER (PARTITION BY member ORDER BY h - s / n DESC, attr) = 1),
shares AS (SELECT member, attr, value, c.idx, n / nv AS share FROM c JOIN best USING (member, attr) JOIN hv USING (member, attr, value)),
votes AS (SELECT seq, shares.idx, sum(share) AS vote FROM v JOIN shares USING (attr, value) GROUP BY 1, 2),
won AS (SELECT seq, idx FROM votes QUALIFY row_number() OVER (PARTITION BY seq ORDER BY round(vote, 11) DESC, idx) = 1)
"""

_FIRST_RULE = f"""
p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS seq, p_retailprice AS y, CAST(p_size AS DOUBLE) AS a0,
             CAST(p_partkey % 25 AS DOUBLE) AS a1, CAST(p_partkey // 10 AS DOUBLE) AS a2 FROM part),
f AS (SELECT seq, y - (SELECT avg(y) FROM p WHERE seq <= {PART_FIRST}) AS y, unnest(range(3)) AS attr, unnest([a0, a1, a2]) AS x
      FROM p WHERE seq <= {PART_FIRST}),
t AS (SELECT DISTINCT attr, x AS thr FROM f),
s AS (SELECT attr, thr, count(*) AS n, count(*) FILTER (x <= thr) AS nl, stddev_pop(y) AS sd,
             stddev_pop(y) FILTER (x <= thr) AS sl, stddev_pop(y) FILTER (x > thr) AS sr FROM t JOIN f USING (attr) GROUP BY 1, 2),
b AS (SELECT attr, thr, nl * sl * sl <= (n - nl) * sr * sr AS le FROM s WHERE n > nl
      ORDER BY round(sd - nl / n * sl - (n - nl) / n * sr, 9) DESC, attr, thr LIMIT 1),
q AS (SELECT seq, y, (CASE attr WHEN 0 THEN a0 WHEN 1 THEN a1 ELSE a2 END <= thr) = le AS hit FROM p, b),
m AS (SELECT hit, avg(y) AS mean FROM q WHERE seq <= {PART_FIRST} GROUP BY 1)
"""



def _given_batches(shift: int) -> str:
    """One k-means iteration on every batch, then the means of its clusters, as CTEs ending in the distance of every row."""
    near = lambda c: (
        f"CASE WHEN (x0 - {c}a0) ** 2 + (x1 - {c}a1) ** 2 + (x2 - {c}a2) ** 2 <= (x0 - {c}z0) ** 2 + (x1 - {c}z1) ** 2 + (x2 - {c}z2) ** 2 THEN 0 ELSE 1 END"
    )
    means = lambda own, rows: ", ".join(
        f"coalesce(avg(x{d}) FILTER ({own} = {i}), {'NULL' if rows else GIVEN[i][d]}) AS {n}{d}" for i, n in enumerate("az") for d in range(3)
    )
    first = "CASE WHEN " + " + ".join(f"(x{d} - {GIVEN[0][d]}) ** 2" for d in range(3)) + " <= " + " + ".join(
        f"(x{d} - {GIVEN[1][d]}) ** 2" for d in range(3)
    ) + " THEN 0 ELSE 1 END"
    return f"""
e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS seq, value AS x0, CAST(hour(ts) AS DOUBLE) AS x1, CAST(user_id AS DOUBLE) AS x2 FROM events),
b AS (SELECT *, unnest(range(CAST(greatest(0, ceil((seq - {GIVEN_BATCH}) / {shift}.0)) AS BIGINT), CAST((seq - 1) // {shift} AS BIGINT) + 1)) AS batch FROM e),
l0 AS (SELECT *, {first} AS own FROM b),
c1 AS (SELECT batch, {means("own", False)} FROM l0 GROUP BY 1),
l1 AS (SELECT b.*, {near("")} AS own FROM b JOIN c1 USING (batch)),
c2 AS (SELECT batch, {means("own", True)} FROM l1 GROUP BY 1),
d AS (SELECT event_id, least(sqrt((x0 - a0) ** 2 + (x1 - a1) ** 2 + (x2 - a2) ** 2), sqrt((x0 - z0) ** 2 + (x1 - z1) ** 2 + (x2 - z2) ** 2)) AS stderr
      FROM e JOIN c2 ON batch = CAST(greatest(0, ceil((seq - {GIVEN_BATCH}) / {shift}.0)) AS BIGINT))
"""


def _given_incremental() -> str:
    old = [f"{n}{d}" for n in "az" for d in range(3)]
    moved = ", ".join(
        f"CASE WHEN n{i} * {GIVEN_ALPHA} + count(*) FILTER (own = {i}) > 0 AND count(*) FILTER (own = {i}) > 0 THEN (n{i} * {GIVEN_ALPHA} * {n}{d} + "
        f"coalesce(sum(x{d}) FILTER (own = {i}), 0)) / (n{i} * {GIVEN_ALPHA} + count(*) FILTER (own = {i})) ELSE {n}{d} END"
        for i, n in enumerate("az") for d in range(3)
    )
    return f"""RECURSIVE
f AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // {GIVEN_BATCH} AS batch, value AS x0, CAST(hour(ts) AS DOUBLE) AS x1,
      CAST(user_id AS DOUBLE) AS x2 FROM events),
st(batch, {", ".join(old)}, n0, n1) AS (
  SELECT CAST(-1 AS BIGINT), {", ".join(f"CAST({GIVEN[i][d]} AS DOUBLE)" for i in range(2) for d in range(3))}, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL SELECT batch + 1, {moved}, n0 * {GIVEN_ALPHA} + count(*) FILTER (own = 0), n1 * {GIVEN_ALPHA} + count(*) FILTER (own = 1)
  FROM (SELECT st.*, x0, x1, x2, CASE WHEN (x0 - a0) ** 2 + (x1 - a1) ** 2 + (x2 - a2) ** 2 <= (x0 - z0) ** 2 + (x1 - z1) ** 2 + (x2 - z2) ** 2
        THEN 0 ELSE 1 END AS own FROM st JOIN f ON f.batch = st.batch + 1) GROUP BY batch, {", ".join(old)}, n0, n1),
d AS (SELECT event_id, least(sqrt((x0 - a0) ** 2 + (x1 - a1) ** 2 + (x2 - a2) ** 2), sqrt((x0 - z0) ** 2 + (x1 - z1) ** 2 + (x2 - z2) ** 2)) AS stderr
      FROM f JOIN st USING (batch))
"""


ORACLES: dict[str, str] = {
    "kmeans_batches_given": f"WITH {_given_batches(GIVEN_BATCH)} SELECT event_id, round(stderr, 5) AS stderr FROM d",
    "kmeans_sliding_given": f"WITH {_given_batches(GIVEN_SHIFT)} SELECT event_id, round(stderr, 5) AS stderr FROM d",
    "kmeans_incremental_given": f"WITH {_given_incremental()} SELECT event_id, round(stderr, 5) AS stderr FROM d",
    "ht_two_levels": f"""WITH {_TWO_LEVELS} SELECT seq, CAST(leaf.idx AS INTEGER) AS truth,
        CAST(CASE WHEN seq <= {FIRST} THEN 0 ELSE major.idx END AS INTEGER) AS pred FROM leaf JOIN major USING (node, side)""",
    "ht_bagged_stumps": f"""WITH {_STUMPS} SELECT seq, CAST(d.idx AS INTEGER) AS truth,
        CAST(CASE WHEN seq <= {FIRST} THEN 0 ELSE won.idx END AS INTEGER) AS pred FROM e JOIN d USING (label) JOIN won USING (seq)""",
    "amr_first_rule": f"""WITH {_FIRST_RULE} SELECT seq, y AS truth, round(CASE WHEN seq <= {PART_FIRST} THEN 0 ELSE mean END, 6) AS pred
        FROM q JOIN m USING (hit)""",
    "cluster_mass": SQL_MASS,
    "cluster_horizon": SQL_MASS.replace(
        "FROM embeddings)", f"FROM (SELECT * FROM embeddings ORDER BY vec_id DESC LIMIT {HORIZON} + (SELECT count(*) FROM embeddings) % {CLUSTER_EVERY}))"
    ),
    "kernel_relevance": f"""WITH s AS (SELECT label, row_number() OVER (ORDER BY vec_id) AS t FROM embeddings),
        m AS (SELECT label, CAST(count(*) AS DOUBLE) AS n, avg(t) AS mu, stddev_pop(t) AS sd FROM s GROUP BY 1),
        q AS (SELECT *, sqrt(-2 * ln(least(0.5, 10 / (2 * n)))) AS z FROM m)
        SELECT label, CAST(n AS BIGINT) AS n, round(CASE WHEN n < 20 THEN mu ELSE mu + sd * (z
        - ({QUANTILE_C[0]}::DOUBLE + z * ({QUANTILE_C[1]}::DOUBLE + z * {QUANTILE_C[2]}::DOUBLE))
        / (1 + z * ({QUANTILE_D[0]}::DOUBLE + z * ({QUANTILE_D[1]}::DOUBLE + z * {QUANTILE_D[2]}::DOUBLE)))) END, 4) AS stamp FROM q""",
    "cluster_silhouette": f"""WITH {SQL_MEANS}, e AS (SELECT vec_id, pred, embedding AS v FROM p JOIN embeddings USING (vec_id)),
        pairs AS (SELECT a.vec_id, a.pred AS own, b.pred AS other, sum(d2) AS s, count(*) AS n FROM
            (SELECT x.vec_id AS i, y.vec_id AS j, sum((x.v - y.v) * (x.v - y.v)) AS d2 FROM x JOIN x y USING (i) GROUP BY 1, 2) t
            JOIN e a ON a.vec_id = t.i JOIN e b ON b.vec_id = t.j GROUP BY 1, 2, 3),
        means AS (SELECT vec_id, own, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a, max(CASE WHEN own = other THEN n END) AS n,
            min(CASE WHEN own <> other THEN s / n END) AS b FROM pairs GROUP BY 1, 2)
        SELECT CAST(own AS INTEGER) AS idx, count(*) AS n, round(avg(CASE WHEN n > 1 AND b IS NOT NULL AND greatest(a, b) > 0
        THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM means GROUP BY 1""",
    "ht_first_split": f"""WITH {_FIRST_SPLIT} SELECT seq, CAST(v.idx AS INTEGER) AS truth,
        CAST(CASE WHEN seq <= {FIRST} THEN 0 ELSE major.idx END AS INTEGER) AS pred
        FROM v JOIN best USING (attr) JOIN major USING (value)""",
    "ht_majority": f"""WITH {SQL_MARKED}, {_DOUBLING}, {MAJORITY}
        SELECT seq, value, d.label AS prediction FROM e LEFT JOIN m ON m.k = {_BATCH_OF}
        JOIN d ON d.idx = coalesce(m.idx, 0) WHERE e.label = '?'""",
    "ht_majority_pairs": f"""WITH {SQL_MARKED}, {_DOUBLING}, {MAJORITY}
        SELECT seq, CAST(d.idx AS INTEGER) AS truth, CAST(coalesce(m.idx, 0) AS INTEGER) AS pred
        FROM e JOIN d USING (label) LEFT JOIN m ON m.k = {_BATCH_OF}""",
    "amr_mean": f"""WITH {_MEAN} SELECT seq, size, round(coalesce(mean, 0), 6) AS prediction
        FROM p LEFT JOIN m ON m.k = {_BATCH_OF} WHERE asked""",
    "amr_mean_pairs": f"""WITH {_MEAN} SELECT seq, y AS truth, round(coalesce(mean, 0), 6) AS pred
        FROM p LEFT JOIN m ON m.k = {_BATCH_OF} WHERE NOT asked""",
}
