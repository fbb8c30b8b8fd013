"""Queries over sources, projection, roles, encoding and arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.vectors import argmax_votes, center_format, vectorize
from driftline.operators.cluster import class_means
from driftline.operators.encode import (
    decode,
    encode_label,
    encode_nominal,
    first_seen_dictionary,
    label_dictionary,
    nominal_cardinality,
)
from driftline.operators.linear import confidence_interval
from driftline.operators.kmeans_stream import batch_totals
from driftline.operators.order import limit_instances, sliding_batches, with_previous, with_seq
from driftline.plans.tables import SQL_MARKED, lineitem_vectors, marked_events, numbered_events, table
from driftline.functions.bounds import z_value
from driftline.schema import predict_target, role_of_label, role_of_target
from driftline.session import fresh_path
from driftline.sources.replay import replay_csv

QUANTITIES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def src_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    path = fresh_path(spark, "replay")
    rows.write.csv(path)
    return replay_csv(spark, path, rows.schema)


def vectorize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(vectorize(QUANTITIES).alias("features"), "l_returnflag")
    return rows.select(
        *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(4)], F.size("features").alias("dims"),
        F.col("l_returnflag").alias("label"),
    )


def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("att_0"), F.col("l_extendedprice").alias("att_1"), F.col("l_linestatus").alias("att_2"),
        F.col("l_returnflag").alias("prediction"),
    )


def role_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_events(spark, sf_dir).select("event_id", "label", role_of_label("label").alias("role"))


def role_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = (
        F.when(F.col("o_orderkey") % 50 == 0, predict_target())
        .when(F.col("o_orderkey") % 50 == 1, F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", target.alias("target"))
    return rows.select("o_orderkey", role_of_target("target").alias("role"))


def argmax_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", argmax_votes("embedding").alias("best"))


def center_format_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = class_means(lineitem_vectors(spark, sf_dir), "label")
    return means.select(
        "label", center_format(F.transform("center", lambda v: F.round(v, 2))).alias("center")
    )


def encode_label_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir)
    return encode_label(rows, "label", label_dictionary(rows, "label"), 5).select("event_id", "label", "label_idx")


def encode_label_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir)
    encoded = encode_label(rows, "label", label_dictionary(rows, "label"), 3, overflow="first")
    return encoded.select("event_id", "label", "label_idx")


def encode_nominal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_seq(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id")
    dictionary = first_seen_dictionary(rows, ["lang", "source"])
    return encode_nominal(rows, ["lang", "source"], dictionary).select("doc_id", "lang_idx", "source_idx")


def decode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir).withColumn("pred", (F.col("user_id") % 7).cast("int"))
    return decode(rows, "pred", label_dictionary(rows, "label"), "label", "prediction").select(
        "event_id", "pred", "prediction"
    )


def decode_nominal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir).withColumn("user", F.col("user_id").cast("string"))
    dictionary = first_seen_dictionary(rows, ["user", "event_type"])
    encoded = encode_nominal(rows, ["user", "event_type"], dictionary)
    back = decode(encoded, "user_idx", dictionary, "user", "user_back")
    back = decode(back, "event_type_idx", dictionary, "event_type", "type_back")
    return back.select("event_id", "user_idx", "user_back", "event_type_idx", "type_back")


def nominal_cardinality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nominal_cardinality(table(spark, sf_dir, "documents"), {"lang": 4, "source": 10})


def with_seq_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seq(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id", "ts"]).select(
        "event_id", "seq"
    )


def previous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir).select("seq", "event_id", "event_type")
    return with_previous(rows, "event_type", "previous").select("event_id", "event_type", "previous")


def limit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marked_events(spark, sf_dir).select("event_id", "ts", "label")
    return limit_instances(rows, 3000, order_by="event_id").select("event_id", "label")


def sliding_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir).select("seq", "value")
    totals = batch_totals(rows, 1000, 500, ["value"])
    return totals.select("batch", "n", F.round("value", 4).alias("sum_value"))


def sliding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_events(spark, sf_dir).select("seq", "event_id")
    return sliding_batches(rows, 700, 300).select("event_id", "batch")


def confidence_interval_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ci = confidence_interval(table(spark, sf_dir, "events"), "value", 0.95, ["event_type"])
    return ci.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


QUERIES = {
    "src_replay": src_replay,
    "vectorize": vectorize_query,
    "project_rename": project_rename,
    "role_class": role_class,
    "role_reg": role_reg,
    "argmax_votes": argmax_query,
    "center_format": center_format_query,
    "encode_label": encode_label_query,
    "encode_label_capped": encode_label_capped,
    "encode_nominal": encode_nominal_query,
    "decode_label": decode_label,
    "decode_nominal": decode_nominal,
    "nominal_cardinality": nominal_cardinality_query,
    "with_seq": with_seq_query,
    "previous_value": previous_value,
    "limit_instances": limit_query,
    "sliding_batches": sliding_batches_query,
    "sliding_rows": sliding_rows,
    "confidence_interval": confidence_interval_query,
}

_DICT = f"""WITH {SQL_MARKED},
dict AS (SELECT label, row_number() OVER (ORDER BY min(seq)) - 1 AS idx FROM e WHERE label <> '?' GROUP BY label)
"""

ORACLES = {
    "src_replay": "SELECT event_id, user_id, value, event_type FROM events",
    "vectorize": """SELECT l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
        CAST(4 AS INTEGER) AS dims, l_returnflag AS label FROM lineitem""",
    "project_rename": """SELECT l_quantity AS att_0, l_extendedprice AS att_1, l_linestatus AS att_2,
        l_returnflag AS prediction FROM lineitem""",
    "role_class": f"""WITH {SQL_MARKED} SELECT event_id, label,
        CASE WHEN label = '?' THEN 'predict' ELSE 'train' END AS role FROM e""",
    "role_reg": """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'predict' ELSE 'train' END AS role
        FROM orders""",
    "argmax_votes": """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best
        FROM embeddings""",
    "center_format": """SELECT CAST(list_position(['A', 'N', 'R'], l_returnflag) - 1 AS INTEGER) AS label,
        '[' || round(avg(l_quantity), 2) || ',' || round(avg(l_extendedprice / 1000.0), 2) || ','
            || round(avg(l_discount), 2) || ',' || round(avg(l_tax), 2) || ']' AS center
        FROM lineitem GROUP BY l_returnflag""",
    "encode_label": f"""{_DICT} SELECT event_id, e.label,
        CAST(CASE WHEN e.label = '?' THEN -1 ELSE idx END AS INTEGER) AS label_idx
        FROM e LEFT JOIN dict USING (label)""",
    "encode_label_capped": f"""{_DICT} SELECT event_id, e.label,
        CAST(CASE WHEN e.label = '?' THEN -1 WHEN idx < 3 THEN idx ELSE 0 END AS INTEGER) AS label_idx
        FROM e LEFT JOIN dict USING (label)""",
    "encode_nominal": """WITH a AS (SELECT lang, row_number() OVER (ORDER BY min(doc_id)) - 1 AS i
            FROM documents GROUP BY lang),
        b AS (SELECT source, row_number() OVER (ORDER BY min(doc_id)) - 1 AS j FROM documents GROUP BY source)
        SELECT doc_id, CAST(i AS INTEGER) AS lang_idx, CAST(j AS INTEGER) AS source_idx
        FROM documents JOIN a USING (lang) JOIN b USING (source)""",
    "decode_label": f"""{_DICT} SELECT event_id, CAST(user_id % 7 AS INTEGER) AS pred, dict.label AS prediction
        FROM e LEFT JOIN dict ON user_id % 7 = idx""",
    "decode_nominal": """WITH u AS (SELECT user_id, row_number() OVER (ORDER BY min(event_id)) - 1 AS i
            FROM events GROUP BY user_id),
        t AS (SELECT event_type, row_number() OVER (ORDER BY min(event_id)) - 1 AS j FROM events GROUP BY event_type)
        SELECT event_id, CAST(i AS INTEGER) AS user_idx, CAST(user_id AS VARCHAR) AS user_back,
            CAST(j AS INTEGER) AS event_type_idx, event_type AS type_back
        FROM events JOIN u USING (user_id) JOIN t USING (event_type)""",
    "nominal_cardinality": """SELECT attr, declared, actual, actual <= declared AS within FROM (
        SELECT 'lang' AS attr, CAST(4 AS INTEGER) AS declared, count(DISTINCT lang) AS actual FROM documents
        UNION ALL SELECT 'source', 10, count(DISTINCT source) FROM documents)""",
    "with_seq": "SELECT event_id, row_number() OVER (ORDER BY user_id, ts) AS seq FROM events",
    "previous_value": """SELECT event_id, event_type, lag(event_type) OVER (ORDER BY event_id) AS previous
        FROM events""",
    "limit_instances": f"WITH {SQL_MARKED} SELECT event_id, label FROM e WHERE seq <= 3000",
    "sliding_batches": f"""WITH {SQL_MARKED} SELECT b AS batch, count(*) AS n, round(sum(value), 4) AS sum_value
        FROM e, LATERAL (SELECT unnest(range(greatest(0, CAST(floor((seq - 1 - 1000) / 500.0) AS BIGINT) + 1),
            CAST(floor((seq - 1) / 500.0) AS BIGINT) + 1)) AS b) GROUP BY b""",
    "sliding_rows": f"""WITH {SQL_MARKED} SELECT event_id, b AS batch
        FROM e, LATERAL (SELECT unnest(range(greatest(0, CAST(floor((seq - 1 - 700) / 300.0) AS BIGINT) + 1),
            CAST(floor((seq - 1) / 300.0) AS BIGINT) + 1)) AS b)""",
    "confidence_interval": f"""SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
        round(avg(value) - {z_value(0.95)!r}e0 * stddev_samp(value) / sqrt(count(value)), 6) AS low,
        round(avg(value) + {z_value(0.95)!r}e0 * stddev_samp(value) / sqrt(count(value)), 6) AS high
        FROM events GROUP BY event_type""",
}
