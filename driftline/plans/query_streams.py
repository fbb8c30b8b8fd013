"""Structured Streaming queries: run to completion (availableNow) over tables derived from the driver's data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.vectors import vectorize
from driftline.operators.evaluate import class_counts, confusion, precision_recall
from driftline.operators.linear import normal_stats, solve_normal
from driftline.operators.order import number_rows, with_batch
from driftline.operators.tree import numeric_stats
from driftline.plans.query_kernels import ORACLES as KERNEL_ORACLES
from driftline.plans.query_learners import MAJORITY, NEVER, SQL_MASS, mean_moments
from driftline.plans.query_metrics import EVERY, no_nan
from driftline.plans.tables import (
    EVENT_TYPES,
    SQL_EVENT_PAIRS,
    SQL_MARKED,
    class_centers,
    embedding_rows,
    index_in,
    marked_events,
    order_targets,
    table,
)
from driftline.schema import predict_target
from driftline.session import fresh_folder, fresh_path, stored
from driftline.sources.replay import stream_csv, stream_parquet
from driftline.sources.rows import stream_rows
from driftline.sources.sinks import insert_by_batch, insert_into, read_curve_csv
from driftline.streaming.batch_learners import KMeansStream, LinearStream
from driftline.streaming.curves import StreamCurve, evaluation_stream
from driftline.streaming.incremental import (
    accumulate,
    dictionary_stream,
    kmeans_stream,
    latest_centers,
    latest_dictionary,
    total,
)
from driftline.streaming.keyed import dictionary_entries, dictionary_state
from driftline.streaming.learners import ClassifierStream, ClusterStream, RegressorStream
from driftline.streaming.store import ModelStore

ARRIVALS = 4
SGD_STEPS, SGD_RATE = 2, 0.25


def arrive(
    df: DataFrame,
    order_by: str,
    name: str,
    run: Callable[[DataFrame], StreamingQuery],
    fmt: str = "parquet",
) -> None:
    """Let the rows arrive in four parts, in order, and let the stream catch up after each part."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    numbered, total_rows = number_rows(df, order_by)
    starts = [1 + i * total_rows // ARRIVALS for i in range(ARRIVALS)]
    parts_ = stored(with_batch(numbered, starts, name="arrival").drop("seq"), name, "arrival")
    for i in range(ARRIVALS):
        parts_.filter(F.col("arrival") == i).drop("arrival").write.mode("append").format(fmt).save(path)
        reader = stream_csv if fmt == "csv" else stream_parquet
        run(reader(spark, path, df.schema)).awaitTermination()


def stream_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events")
    stream = stream_parquet(spark, sf_dir, source.schema, file_glob="events.parquet")
    picked = stream.filter(F.col("value") > 10).select("event_id", F.col("event_type").alias("kind"), "value")
    out = fresh_path(spark, "insert")
    insert_into(picked, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(picked.schema).parquet(f"{out}/rows")


def stream_csv_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    out = fresh_path(spark, "csvout")
    arrive(rows, "event_id", "csv", lambda stream: insert_into(stream, f"{out}/rows", f"{out}/checkpoint"), "csv")
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


TICK = 2_500


def stream_replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events released TICK rows per trigger; each trigger's rows, by its number."""
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    out = fresh_path(spark, "replay")
    path = f"{sf_dir}/events.parquet"
    fresh_folder(spark, out)

    def run() -> None:
        stream = stream_rows(spark, path, rows.schema, TICK, f"{out}/position")
        query = insert_by_batch(stream, f"{out}/rows", f"{out}/checkpoint", {"processingTime": "0 seconds"})
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    run()  # a restart repeats no row
    ticks = spark.read.schema("event_id bigint, value double, batch_id int").parquet(f"{out}/rows").groupBy("batch_id")
    return ticks.agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
        F.round(F.sum("value"), 4).alias("value"),
    )


def _event_pairs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", index_in("event_type", EVENT_TYPES).alias("truth"), (F.col("user_id") % 5).cast("int").alias("pred")
    )


def stream_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "confusion")
    arrive(_event_pairs_rows(spark, sf_dir), "event_id", "pairs", lambda stream: accumulate(stream, confusion, out))
    merged = total(spark, out, ["truth", "pred"], n="sum", weight="sum")
    counts = precision_recall(class_counts(merged))
    return counts.select("cls", "support", "tp", no_nan("precision"), no_nan("recall"), no_nan("f1"))


LONG_SCHEMA = "point bigint, final_partial boolean, ordinal int, measurement string, value double"


def _streamed_curve(rows: DataFrame, order_by: str, n_classes: int | None) -> StreamCurve:
    """Evaluate rows that arrive in parts, and end the run."""
    spark = rows.sparkSession
    out = fresh_path(spark, "curve")
    curve = StreamCurve(spark, out, ModelStore(spark, f"{out}/model"), n_classes, EVERY)
    arrive(rows, order_by, "pairs", lambda s: evaluation_stream(s.withColumnRenamed(order_by, "seq"), curve))
    curve.finish()
    return curve


def stream_curve_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning curve written to CSV point by point during the run, and read back."""
    curve = _streamed_curve(_event_pairs_rows(spark, sf_dir), "event_id", 5)
    back = read_curve_csv(spark, curve.path, LONG_SCHEMA)
    return back.select("point", "ordinal", "measurement", no_nan("value"))


def stream_learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _streamed_curve(_event_pairs_rows(spark, sf_dir), "event_id", 5).points()
    return points.select(
        "point", "final_partial", "instances", no_nan("accuracy_pct"), no_nan("kappa_pct"), no_nan("kappa_temporal_pct")
    )


def stream_learning_curve_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _streamed_curve(order_targets(spark, sf_dir), "o_orderkey", None).points()
    return points.select(
        "point", "final_partial", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "relative_mae", "relative_rmse")]
    )


def stream_numeric_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of lineitem over micro-batches; equal to those of one batch."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *columns, index_in("l_returnflag", ("A", "N", "R")).alias("label"),
        index_in("l_linestatus", ("F", "O")).alias("leaf"),
    )
    out = fresh_path(spark, "stats")

    def run(stream: DataFrame) -> StreamingQuery:
        priced = stream.withColumn("l_extendedprice", F.col("l_extendedprice") / 1000.0)
        vectors = priced.select("leaf", "label", vectorize(columns).alias("features"))
        return accumulate(vectors, lambda b: numeric_stats(b, 4), out)

    arrive(rows, "l_orderkey", "lineitem", run)
    merged = total(spark, out, ["leaf", "label", "attr"], n="sum", s="sum", q="sum", lo="min", hi="max")
    return merged.select(
        "leaf", "label", "attr", F.col("n").cast("bigint").alias("n"), F.round(F.col("s") / F.col("n"), 6).alias("mean"),
        F.round(F.col("q") / F.col("n"), 6).alias("mean_sq"), "lo", "hi",
    )


def stream_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("user"))
    out = fresh_path(spark, "dictionary")
    arrive(rows, "event_id", "events", lambda s: dictionary_stream(s, ["event_type", "user"], "event_id", out))
    return latest_dictionary(spark, out).select("attr", "value", "idx", "first_seq", "n_rows")


def stream_dictionary_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same dictionaries kept as keyed state; every arrival is a restart of the query."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("user"))
    out = fresh_path(spark, "dictionary")
    arrive(rows, "event_id", "events", lambda s: dictionary_state(s, ["event_type", "user"], "event_id", out))
    return dictionary_entries(spark, out).select("attr", "value", "idx", "first_seq", "n_rows")


def stream_linreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice")
    out = fresh_path(spark, "linreg")

    def run(stream: DataFrame) -> StreamingQuery:
        vectors = stream.select(
            vectorize(["l_quantity", "l_discount"]).alias("features"), (F.col("l_extendedprice") / 1000.0).alias("target")
        )
        return accumulate(vectors, lambda b: normal_stats(b, 2), out)

    arrive(rows, "l_orderkey", "lineitem", run)
    w = solve_normal([(r["i"], r["j"], r["v"]) for r in total(spark, out, ["i", "j"], v="sum").collect()], 2)
    return spark.createDataFrame([(i, round(v, 4)) for i, v in enumerate(w)], "i int, w double")


def stream_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    out = fresh_path(spark, "kmeans")
    centers = class_centers(rows)
    arrive(rows, "vec_id", "embeddings", lambda stream: kmeans_stream(stream, centers, out, alpha=0.9))
    state = latest_centers(spark, out).select("idx", "n", F.posexplode("center").alias("dim", "value"))
    return state.select("idx", "dim", F.round("n", 4).alias("n"), F.round("value", 4).alias("value"))


def stream_kmeans_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its distance to the nearest centre after its arrival."""
    rows = embedding_rows(spark, sf_dir).select("vec_id", "label", "features")
    learner = KMeansStream(
        spark, fresh_path(spark, "kmeans"), "vec_id", features="features", learn_type=2, alpha=0.9, centers=class_centers(rows)
    )
    arrive(rows, "vec_id", "embeddings", learner.start)
    return learner.outputs("rows").select("vec_id", F.round("stderr", 4).alias("stderr"))


def stream_linreg_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-then-train of a line by gradient steps: every part is predicted with the weights before its arrival."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") / 50.0).alias("size"), (F.col("p_partkey") % 100 / 100.0).alias("key"),
        (F.col("p_retailprice") / 1000.0).alias("price"),
    )
    learner = LinearStream(
        spark, fresh_path(spark, "linreg"), "p_partkey", features=["size", "key"], target="price", learn_type=2,
        num_iterations=SGD_STEPS, alpha=SGD_RATE,
    )
    arrive(rows, "p_partkey", "part", learner.start)
    return learner.outputs("rows").select(
        "p_partkey", F.round("prediction", 6).alias("prediction"), F.round("stderr", 6).alias("stderr")
    )


def stream_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marked_events(spark, sf_dir).select(
        "event_id", "value", F.hour("ts").cast("double").alias("hour"), F.col("user_id").cast("double").alias("user"), "label"
    )
    learner = ClassifierStream(
        spark, fresh_path(spark, "classifier"), "event_id", numeric=["value", "hour", "user"], label="label", n_classes=5
    )
    arrive(rows, "event_id", "events", learner.start)
    return learner.outputs("predictions").select("seq", "value", "hour", "user", "prediction")


def stream_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed test-then-train of a tree that never splits: the majority class of the arrivals before."""
    rows = marked_events(spark, sf_dir).select("event_id", "value", "label")
    learner = ClassifierStream(
        spark, fresh_path(spark, "majority"), "event_id", numeric=["value"], label="label", n_classes=5,
        options={"grace": NEVER},
    )
    arrive(rows, "event_id", "events", learner.start)
    return learner.outputs("pairs").select("seq", "truth", "pred")


def stream_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(F.col("p_partkey") % 50 == 0, predict_target()).otherwise(F.col("p_retailprice"))
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_partkey").cast("double").alias("part"),
        target.alias("price"),
    )
    learner = RegressorStream(
        spark, fresh_path(spark, "regressor"), "p_partkey", features=["size", "part"], target="price"
    )
    arrive(rows, "p_partkey", "part", learner.start)
    return learner.outputs("predictions").select("seq", "size", "part", "prediction")


def stream_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    learner = ClusterStream(spark, fresh_path(spark, "clusters"), "vec_id", features="embedding", k=3)
    arrive(rows, "vec_id", "embeddings", learner.start)
    return learner.outputs("centers")


def stream_cluster_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    learner = ClusterStream(spark, fresh_path(spark, "mass"), "vec_id", features="embedding", k=3)
    arrive(rows, "vec_id", "embeddings", learner.start)
    return mean_moments(learner.model().table(spark))


QUERIES = {
    "stream_insert": stream_insert,
    "stream_csv_replay": stream_csv_replay,
    "stream_replay_rows": stream_replay_rows,
    "stream_confusion": stream_confusion,
    "stream_curve_csv": stream_curve_csv,
    "stream_learning_curve": stream_learning_curve,
    "stream_learning_curve_reg": stream_learning_curve_reg,
    "stream_numeric_stats": stream_numeric_stats,
    "stream_dictionary": stream_dictionary,
    "stream_dictionary_state": stream_dictionary_state,
    "stream_linreg": stream_linreg,
    "stream_kmeans": stream_kmeans,
    "stream_kmeans_rows": stream_kmeans_rows,
    "stream_linreg_sgd": stream_linreg_sgd,
    "stream_classifier": stream_classifier,
    "stream_majority": stream_majority,
    "stream_regressor": stream_regressor,
    "stream_clusters": stream_clusters,
    "stream_cluster_mass": stream_cluster_mass,
}


def _sql_kmeans() -> str:
    """Decayed centre updates over the arrivals, unrolled: centres c0 (class means), c1, ... and distances d0, d1, ..."""
    steps = [
        """r AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS seq, count(*) OVER () AS n, embedding FROM embeddings)""",
        f"""x AS MATERIALIZED (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v,
            (SELECT max(k) FROM (SELECT unnest(range({ARRIVALS})) AS k) WHERE k * n // {ARRIVALS} < seq) AS part FROM r)""",
        """c0 AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY label) - 1 AS idx, i, avg(v) AS v, 0.0::DOUBLE AS n
            FROM x GROUP BY label, i)""",
    ]
    for s in range(ARRIVALS):
        steps += [
            f"""a{s} AS MATERIALIZED (SELECT vec_id, c.idx, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{s} c USING (i)
                WHERE part = {s} GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c.idx) = 1)""",
            f"m{s} AS (SELECT a.idx, i, count(*) AS m, sum(v) AS s FROM a{s} a JOIN x USING (vec_id) GROUP BY 1, 2)",
            f"""c{s + 1} AS MATERIALIZED (SELECT c.idx, c.i, CASE WHEN m IS NULL THEN c.v ELSE (c.v * 0.9::DOUBLE * n + s)
                / (0.9::DOUBLE * n + m) END AS v, 0.9::DOUBLE * n + coalesce(m, 0) AS n FROM c{s} c LEFT JOIN m{s} USING (idx, i))""",
            f"""d{s} AS (SELECT vec_id, min(d) AS d FROM (SELECT vec_id, c.idx, sum((x.v - c.v) * (x.v - c.v)) AS d
                FROM x JOIN c{s + 1} c USING (i) WHERE part = {s} GROUP BY 1, 2) GROUP BY 1)""",
        ]
    return ", ".join(steps)


def _sql_sgd() -> str:
    """Weights w0 (zeros), w1, ... after every gradient step; SGD_STEPS of them per arrival."""
    steps = [
        f"""r AS (SELECT p_partkey, p_size / 50.0::DOUBLE AS x1, (p_partkey % 100) / 100.0::DOUBLE AS x2, p_retailprice / 1000.0::DOUBLE AS y,
            row_number() OVER (ORDER BY p_partkey) AS seq, count(*) OVER () AS n FROM part)""",
        f"""x AS MATERIALIZED (SELECT *, (SELECT max(k) FROM (SELECT unnest(range({ARRIVALS})) AS k)
            WHERE k * n // {ARRIVALS} < seq) AS part FROM r)""",
        "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)",
    ]
    for s in range(ARRIVALS * SGD_STEPS):
        error = "(a + b1 * x1 + b2 * x2 - y)"
        rate = f"{SGD_RATE}::DOUBLE"
        steps.append(
            f"""w{s + 1} AS MATERIALIZED (SELECT any_value(a) - {rate} * avg{error} AS a, any_value(b1) - {rate} * avg({error} * x1) AS b1,
                any_value(b2) - {rate} * avg({error} * x2) AS b2 FROM x, w{s} WHERE part = {s // SGD_STEPS})"""
        )
    rows = " UNION ALL ".join(
        f"SELECT p_partkey, a + b1 * x1 + b2 * x2 AS p, y FROM x, w{k * SGD_STEPS} WHERE part = {k}" for k in range(ARRIVALS)
    )
    return f"WITH {', '.join(steps)} SELECT p_partkey, round(p, 6) AS prediction, round(abs(y - p), 6) AS stderr FROM ({rows})"


def _oracles() -> dict[str, str]:
    from driftline.plans.query_metrics import ORACLES as METRIC_ORACLES
    from driftline.plans.query_metrics import _CLASS_SQL

    return {
        "stream_insert": "SELECT event_id, event_type AS kind, value FROM events WHERE value > 10",
        "stream_replay_rows": f"""SELECT CAST((seq - 1) // {TICK} AS INTEGER) AS batch_id, count(*) AS n, min(event_id) AS first_id,
            max(event_id) AS last_id, round(sum(value), 4) AS value
            FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS seq FROM events) GROUP BY 1""",
        "stream_csv_replay": "SELECT event_id, value, event_type FROM events",
        "stream_confusion": f"""WITH {SQL_EVENT_PAIRS}, {_CLASS_SQL.format(pairs='q')},
            f AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS p, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS r FROM k)
            SELECT CAST(cls AS INTEGER) AS cls, support, tp, round(p, 6) AS "precision", round(r, 6) AS recall,
            round(2 * p * r / nullif(p + r, 0), 6) AS f1 FROM f""",
        "stream_curve_csv": METRIC_ORACLES["measurements_long"],
        "stream_learning_curve": METRIC_ORACLES["learning_curve"],
        "stream_learning_curve_reg": METRIC_ORACLES["learning_curve_reg"],
        "stream_numeric_stats": KERNEL_ORACLES["ht_numeric_stats"],
        "stream_dictionary": f"""WITH {SQL_MARKED},
            s AS (SELECT unnest(['event_type', 'user']) AS attr, unnest([event_type, CAST(user_id AS VARCHAR)]) AS value,
                         seq FROM e),
            g AS (SELECT attr, value, min(seq) AS first_seq, count(*) AS n_rows FROM s GROUP BY 1, 2)
            SELECT attr, value, CAST(row_number() OVER (PARTITION BY attr ORDER BY first_seq) - 1 AS INTEGER) AS idx,
            first_seq, n_rows FROM g""",
        "stream_dictionary_state": f"""WITH {SQL_MARKED},
            s AS (SELECT unnest(['event_type', 'user']) AS attr, unnest([event_type, CAST(user_id AS VARCHAR)]) AS value,
                         event_id AS seq FROM e),
            g AS (SELECT attr, value, min(seq) AS first_seq, count(*) AS n_rows FROM s GROUP BY 1, 2)
            SELECT attr, value, CAST(row_number() OVER (PARTITION BY attr ORDER BY first_seq) - 1 AS INTEGER) AS idx,
            first_seq, n_rows FROM g""",
        "stream_majority": f"""WITH {SQL_MARKED},
            n AS (SELECT count(*) AS n FROM events),
            b AS (SELECT k, k * n // {ARRIVALS} AS before FROM n, (SELECT unnest(range(0, {ARRIVALS})) AS k)), {MAJORITY}
            SELECT seq, CAST(d.idx AS INTEGER) AS truth, CAST(coalesce(m.idx, 0) AS INTEGER) AS pred
            FROM e JOIN d USING (label) LEFT JOIN m ON m.k = (SELECT max(b.k) FROM b WHERE b.before < e.seq)""",
        "stream_linreg": KERNEL_ORACLES["linreg_fit"],
        "stream_cluster_mass": SQL_MASS,
        "stream_linreg_sgd": _sql_sgd(),
        "stream_kmeans": f"""WITH {_sql_kmeans()} SELECT CAST(idx AS INTEGER) AS idx, CAST(i AS INTEGER) AS dim, round(n, 4) AS n,
            round(v, 4) AS value FROM c{ARRIVALS}""",
        "stream_kmeans_rows": f"""WITH {_sql_kmeans()} SELECT vec_id, round(sqrt(d), 4) AS stderr FROM
            ({' UNION ALL '.join(f'SELECT vec_id, d FROM d{s}' for s in range(ARRIVALS))})""",
    }


ORACLES = _oracles()
