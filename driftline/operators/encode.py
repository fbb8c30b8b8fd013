"""Categorical encoding by first appearance, and the way back.

A dictionary is a table (``attr``, ``value``, ``idx``, ``first_seq``, ``n_rows``).  Building it aggregates with map-side
combine, so a value that fills a third of the rows still shuffles one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.order import with_seq
from driftline.schema import PREDICT_INDEX, PREDICT_LABEL
from driftline.session import BROADCAST_ROWS, at_most, cut_lineage

OVERFLOW_MODES = ("error", "first", "skip")
HOT_ENTRIES = 1_000


def value_counts(
    df: DataFrame, columns: Sequence[str], seq: str = "seq", exclude: Mapping[str, str] | None = None
) -> DataFrame:
    """Distinct (attr, value) with first position and row count; ``exclude`` names one value to leave out per column."""
    if len(columns) == 1:
        stacked = df.select(seq, F.lit(columns[0]).alias("attr"), F.col(columns[0]).cast("string").alias("value"))
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("value")) for c in columns])
        stacked = df.select(seq, F.inline(pairs))
    kept = F.col("value").isNotNull()
    for attr, value in (exclude or {}).items():
        kept = kept & ~((F.col("attr") == attr) & (F.col("value") == value))
    return (
        stacked.filter(kept)
        .groupBy("attr", "value")
        .agg(F.min(seq).alias("first_seq"), F.count(F.lit(1)).alias("n_rows"))
    )


def number_entries(counts: DataFrame) -> DataFrame:
    """Add ``idx`` = rank of ``first_seq`` within ``attr``, starting at 0; values that appear together go by value."""
    if at_most(counts, BROADCAST_ROWS):
        rank = F.row_number().over(Window.partitionBy("attr").orderBy("first_seq", "value")) - 1
        return counts.withColumn("idx", rank.cast("int"))
    numbered = cut_lineage(with_seq(counts, ["attr", "first_seq", "value"], "__pos"))
    base = numbered.groupBy("attr").agg(F.min("__pos").alias("__base"))
    return numbered.join(F.broadcast(base), "attr").select(
        *counts.columns, (F.col("__pos") - F.col("__base")).cast("int").alias("idx")
    )


def first_seen_dictionary(
    df: DataFrame, columns: str | Sequence[str], seq: str = "seq", exclude: Mapping[str, str] | None = None
) -> DataFrame:
    """One dictionary per column, indexed by first appearance.  ``seq`` may be any column that follows the order."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return number_entries(cut_lineage(value_counts(df, columns, seq, exclude)))


def label_dictionary(df: DataFrame, label: str, seq: str = "seq") -> DataFrame:
    return first_seen_dictionary(df, label, seq, exclude={label: PREDICT_LABEL})


def extend_dictionary(old: DataFrame, new_counts: DataFrame) -> DataFrame:
    """Dictionary after another micro-batch: old entries keep their index, new values follow in order of arrival."""
    merged = (
        old.select("attr", "value", "first_seq", "n_rows", "idx")
        .unionByName(new_counts.withColumn("idx", F.lit(None).cast("int")))
        .groupBy("attr", "value")
        .agg(F.min("first_seq").alias("first_seq"), F.sum("n_rows").alias("n_rows"), F.max("idx").alias("idx"))
    )
    merged = cut_lineage(merged)
    top = merged.groupBy("attr").agg((F.coalesce(F.max("idx"), F.lit(-1)) + 1).alias("__next"))
    known = merged.filter(F.col("idx").isNotNull())
    fresh = number_entries(merged.filter(F.col("idx").isNull()).drop("idx"))
    fresh = fresh.join(F.broadcast(top), "attr").withColumn("idx", F.col("idx") + F.col("__next")).drop("__next")
    return known.unionByName(fresh)


def lookup(df: DataFrame, dictionary: DataFrame, key: Column, on: str, take: str, out: str) -> DataFrame:
    """Left join ``df`` with one dictionary: ``take`` of the entry whose ``on`` equals ``key``, as column ``out``.

    A dictionary of bounded size is broadcast.  A larger one is split: its most frequent entries (at most
    ``HOT_ENTRIES``, since each holds at least that share of all rows) are broadcast, and only the rows that match
    none of them shuffle, so no single value can overload a task.
    """
    entries = dictionary.select(F.col(on).alias("__on"), F.col(take).alias(out))
    keyed = df.withColumn("__key", key)
    match = F.col("__key") == F.col("__on")
    if at_most(dictionary, BROADCAST_ROWS):
        return keyed.join(F.broadcast(entries), match, "left").drop("__key", "__on")
    total = dictionary.agg(F.sum("n_rows")).first()[0]
    is_hot = F.col("n_rows") > total / HOT_ENTRIES
    hot = F.broadcast(dictionary.filter(is_hot).select(F.col(on).alias("__on"), F.col(take).alias(out)))
    cold = dictionary.filter(~is_hot).select(F.col(on).alias("__on"), F.col(take).alias(out))
    missing = keyed.filter(F.col("__key").isNull()).withColumn(out, F.lit(None).cast(entries.schema[out].dataType))
    present = keyed.filter(F.col("__key").isNotNull())
    in_hot = present.join(hot, match, "inner").drop("__on")
    rest = present.join(hot.select("__on"), match, "left_anti").join(cold, match, "left").drop("__on")
    return in_hot.unionByName(rest).unionByName(missing).drop("__key")


def encode_label(
    df: DataFrame,
    label: str,
    dictionary: DataFrame,
    n_classes: int | None = None,
    overflow: str = "error",
    out: str = "label_idx",
) -> DataFrame:
    """Class index of every row; rows marked ``?`` get -1.

    ``n_classes`` caps the dictionary.  Labels past the cap raise ('error'), become class 0 ('first') or leave the
    result ('skip').
    """
    if overflow not in OVERFLOW_MODES:
        raise ValueError(f"overflow: required one of {OVERFLOW_MODES} but found {overflow!r}")
    entries = dictionary.filter(F.col("attr") == label)
    if n_classes is not None:
        if overflow == "error" and not at_most(entries, n_classes):
            raise ValueError(f"label column '{label}' holds more than the declared {n_classes} classes")
        entries = entries.filter(F.col("idx") < n_classes)
    text = F.col(label).cast("string")
    found = lookup(df, entries, text, "value", "idx", out)
    is_predict = text == PREDICT_LABEL
    if overflow == "skip":
        found = found.filter(F.col(out).isNotNull() | is_predict)
    other = F.coalesce(F.col(out), F.lit(0)) if overflow == "first" else F.col(out)
    return found.withColumn(out, F.when(is_predict, PREDICT_INDEX).otherwise(other).cast("int"))


def encode_nominal(
    df: DataFrame, columns: Sequence[str], dictionary: DataFrame, suffix: str = "_idx"
) -> DataFrame:
    """First-seen index of every nominal column, in ``<column><suffix>``; declared cardinalities are not enforced."""
    for c in columns:
        entries = dictionary.filter(F.col("attr") == c)
        df = lookup(df, entries, F.col(c).cast("string"), "value", "idx", f"{c}{suffix}")
    return df


def decode(df: DataFrame, index: str, dictionary: DataFrame, attr: str, out: str) -> DataFrame:
    """Value behind an index; an index that no value has yet gives null."""
    entries = dictionary.filter(F.col("attr") == attr)
    return lookup(df, entries, F.col(index).cast("int"), "idx", "value", out)


def nominal_cardinality(df: DataFrame, declared: Mapping[str, int]) -> DataFrame:
    """Declared against actual number of distinct values per nominal column."""
    names = list(declared)
    counts = value_counts(df.withColumn("__one", F.lit(1)), names, "__one").groupBy("attr").agg(
        F.count(F.lit(1)).alias("actual")
    )
    wanted = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(int(declared[n])))])
    return counts.select(
        "attr",
        wanted[F.col("attr")].alias("declared"),
        "actual",
        (F.col("actual") <= wanted[F.col("attr")]).alias("within"),
    )
