"""Bounded, repeatable samples of labelled rows for fitting a model on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows with longer texts are not used for fitting (they are scored like all others).
MAX_SAMPLE_BYTES = 200_000


def labelled_sample(df: DataFrame, text: str, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label: those with the smallest hash of ``key``.

    The rank limit is applied inside every task before the shuffle, so a label shared by most rows sends no more than
    ``per_label`` rows per task.  Rows without text or label are no examples.
    """
    rows = df.select(
        F.col(text).cast("binary").alias("text"), F.col(label).alias("label"), F.xxhash64(F.col(key), F.lit(17)).alias("h")
    ).filter(F.col("label").isNotNull() & (F.octet_length("text") > 0) & (F.octet_length("text") <= MAX_SAMPLE_BYTES))
    order = Window.partitionBy("label").orderBy("h", F.crc32("text"))
    return rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_label).drop("r", "h")
