"""Reading the driver's parquet tables, and the shapes several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.cluster import class_means, nearest_center
from driftline.operators.order import with_seq

# Class order of the order-free tables.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
RETURN_FLAGS = ("A", "N", "R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def index_in(column: str, values: tuple[str, ...]) -> Column:
    """Position of a value in a declared list of classes."""
    return (F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)) - 1).cast("int")


def marked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every fiftieth row asking for a prediction."""
    marker = F.when(F.col("event_id") % 50 == 0, "?").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").withColumn("label", marker)


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seq(marked_events(spark, sf_dir), "event_id")


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


def class_centers(rows: DataFrame) -> list[list[float]]:
    """Class means in class order; one row per class reaches the driver."""
    return [list(r["center"]) for r in class_means(rows, "label").orderBy("label").collect()]


def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, truth and the class of the nearest class mean."""
    rows = embedding_rows(spark, sf_dir)
    scored = nearest_center(rows, class_centers(rows), idx="pred", d2="d2")
    return scored.select("vec_id", F.col("label").alias("truth"), "pred")


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, truth and a fixed guess for every event, in order of event_id."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", index_in("event_type", EVENT_TYPES).alias("truth"), (F.col("user_id") % 5).cast("int").alias("pred")
    )
    return with_seq(rows, "event_id").drop("event_id")


def lineitem_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numeric features (price in thousands), class index and the two nominal attributes as indices."""
    price = F.col("l_extendedprice") / 1000.0
    return table(spark, sf_dir, "lineitem").select(
        F.array("l_quantity", price, F.col("l_discount"), F.col("l_tax")).alias("features"),
        index_in("l_returnflag", RETURN_FLAGS).alias("label"),
        index_in("l_linestatus", ("F", "O")).alias("status"),
        (F.col("l_linenumber") - 1).alias("line"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )


def order_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, o_totalprice and a fixed guess for every order."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("truth"),
        (F.lit(200000.0) + (F.col("o_custkey") % 100) * 1000.0).alias("pred"),
    )


def order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ``seq``, the number of the order, instead of its key."""
    return with_seq(order_targets(spark, sf_dir), "o_orderkey").drop("o_orderkey")


# SQL counterparts of the shapes above.

SQL_MEANS = """
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i
      FROM embeddings),
m AS (SELECT label AS c, i, avg(v) AS mu FROM x GROUP BY 1, 2),
d AS (SELECT vec_id, x.label AS truth, c, sum((v - mu) * (v - mu)) AS d2 FROM x JOIN m USING (i) GROUP BY 1, 2, 3),
p AS (SELECT vec_id, truth, c AS pred, d2 FROM d
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, c) = 1)
"""

SQL_MARKED = """
e AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN '?' ELSE event_type END AS label,
             row_number() OVER (ORDER BY event_id) AS seq FROM events)
"""

SQL_EVENT_PAIRS = """
q AS (SELECT row_number() OVER (ORDER BY event_id) AS seq,
             list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS truth,
             CAST(user_id % 5 AS INTEGER) AS pred FROM events)
"""

SQL_LINEITEM = """
l AS (SELECT l_quantity AS f0, l_extendedprice / 1000.0 AS f1, l_discount AS f2, l_tax AS f3,
             list_position(['A', 'N', 'R'], l_returnflag) - 1 AS label,
             list_position(['F', 'O'], l_linestatus) - 1 AS status, l_linenumber - 1 AS line FROM lineitem),
lx AS (SELECT l.*, unnest([0, 1, 2, 3]) AS attr, unnest([f0, f1, f2, f3]) AS x FROM l)
"""

SQL_ORDER_PAIRS = """
q AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS seq, o_totalprice AS truth,
             200000.0 + (o_custkey % 100) * 1000.0 AS pred FROM orders)
"""
