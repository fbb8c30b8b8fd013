"""Test-then-train over a table: prepare rows once, then score each micro-batch with the model before it and learn."""

from __future__ import annotations

import dataclasses
import itertools
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import vectorize
from driftline.operators.encode import encode_label, encode_nominal, first_seen_dictionary
from driftline.operators.order import batch_starts, limit_instances, number_rows, order_keys, runs_of, with_batch
from driftline.schema import PREDICT, PREDICT_LABEL, TRAIN, role_of_label, role_of_target
from driftline.session import fresh_path, stored

FIRST_BATCH = 1_000
GROWTH = 2.0


@dataclasses.dataclass
class Prepared:
    """Rows with seq, features, label or target, role and batch_id, stored in folders by batch.

    ``labels`` holds the dictionaries of the label and the nominal columns.
    """

    rows: DataFrame
    starts: list[int]
    total: int
    labels: DataFrame | None = None
    runs: list[tuple[int, int]] = dataclasses.field(default_factory=list)

    def span(self, b: int) -> tuple[int, int]:
        """First and last sequence number of a micro-batch."""
        return self.starts[b], self.starts[b + 1] - 1 if b + 1 < len(self.starts) else self.total

    def parts(self) -> Iterator[tuple[tuple[int, int], DataFrame]]:
        """First and last micro-batch of every run, with the rows of all of them."""
        for i, run in enumerate(self.runs):
            yield run, self.rows.filter(F.col("run") == i)

    def batches(self) -> Iterator[tuple[tuple[int, int], DataFrame]]:
        """First and last sequence number of every micro-batch, with its rows."""
        for b, (first, following) in enumerate(itertools.pairwise([*self.starts, self.total + 1])):
            yield (first, following - 1), self.rows.filter(F.col("batch_id") == b)


def _numbered(df: DataFrame, order_by: str | Sequence[str], max_instances: int) -> tuple[DataFrame, int]:
    numbered, total = number_rows(df, order_by)
    if max_instances >= 0:
        total = min(total, max_instances)
    return limit_instances(numbered, max_instances), total


def prepare_classification(
    df: DataFrame,
    numeric: Sequence[str],
    nominal: Sequence[str],
    label: str,
    n_classes: int,
    order_by: str | Sequence[str],
    max_instances: int = -1,
    overflow: str = "error",
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
) -> Prepared:
    df = df.select(*dict.fromkeys([*order_keys(order_by), *numeric, *nominal, label]))
    numbered, total = _numbered(df, order_by, max_instances)
    # First appearance only needs the order keys, so without a limit the dictionaries come from one scan of the raw
    # table, with no row shuffle.
    if max_instances < 0:
        keys = order_keys(order_by)
        source = df.withColumn("seq", F.col(keys[0]) if len(keys) == 1 else F.struct(*keys))
    else:
        source = numbered
    dictionary = first_seen_dictionary(source, [label, *nominal], exclude={label: PREDICT_LABEL})
    rows = encode_label(numbered, label, dictionary, n_classes, overflow, "label_idx")
    if nominal:
        rows = encode_nominal(rows, nominal, dictionary)
    rows = (
        rows.withColumn("features", vectorize([*numeric, *[f"{c}_idx" for c in nominal]]))
        .withColumn("role", role_of_label(label))
        .drop(*[f"{c}_idx" for c in nominal])
    )
    starts = batch_starts(total, first_batch, growth)
    return Prepared(stored(with_batch(rows, starts), "prepared", "batch_id"), starts, total, dictionary)


def prepare_regression(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: str | Sequence[str],
    max_instances: int = -1,
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
) -> Prepared:
    df = df.select(*dict.fromkeys([*order_keys(order_by), *features, target]))
    numbered, total = _numbered(df, order_by, max_instances)
    rows = numbered.withColumn("features", vectorize(features)).withColumn("role", role_of_target(target))
    starts = batch_starts(total, first_batch, growth)
    return Prepared(stored(with_batch(rows, starts), "prepared", "batch_id"), starts, total)


def prepare_clustering(
    df: DataFrame,
    features: Sequence[str] | str,
    order_by: str | Sequence[str],
    max_instances: int = -1,
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
    run_values: int = 1,
    longest: int = 1,
) -> Prepared:
    """``features``: names of numeric columns, or the name of one array column.

    Rows are stored in folders by run: consecutive micro-batches of up to ``longest`` rows, ``run_values`` values together.
    """
    numbered, total = _numbered(df, order_by, max_instances)
    vector = F.col(features).cast("array<double>") if isinstance(features, str) else vectorize(features)
    starts = batch_starts(total, first_batch, growth)
    rows = numbered.select("seq", vector.alias("features"))
    one = df.select(F.size(features).alias("d")).first() if isinstance(features, str) else {"d": len(features)}
    width = max(1, one["d"] or 1) if one else 1
    runs = runs_of(starts, total, run_values // width, longest) or [(0, 0)]
    table = stored(with_batch(rows, [starts[a] for a, _ in runs], name="run"), "prepared", "run")
    return Prepared(table, starts, total, runs=runs)


@dataclasses.dataclass
class Outcome:
    """Final model, rows asked for with their prediction, and (seq, truth, pred) of labelled rows."""

    model: object
    predictions: DataFrame
    pairs: DataFrame


def test_then_train(
    prepared: Prepared, model, truth: str, inputs: Sequence[str], learn_args: Mapping[str, object]
) -> Outcome:
    """Batch b is scored with the model of batch b − 1, written once, and then learned from.

    ``learn_args`` tell the model its columns and, if needed, which rows train (``where``).  Every pass reads one folder
    of the prepared table.  The written rows are split by role, and only rows that ask for
    a prediction carry their inputs.
    """
    spark = prepared.rows.sparkSession
    out = fresh_path(spark, "outcome")
    is_predict = F.col("role") == PREDICT
    schema = None
    for b, ((first, last), batch) in enumerate(prepared.batches()):
        scored = model.score(batch).select(
            "seq", F.col(truth).alias("truth"), "pred",
            *[F.when(is_predict, F.col(c)).alias(f"in_{i}") for i, c in enumerate(inputs)], "role",
        )
        schema = scored.schema
        scored.write.partitionBy("role").parquet(f"{out}/batch_id={b}")
        model = model.learn(batch, span=(first, last), **learn_args)
    done = spark.read.schema(schema.add("batch_id", "integer")).parquet(out)
    asked = done.filter(is_predict).select("seq", *[F.col(f"in_{i}").alias(c) for i, c in enumerate(inputs)], "pred")
    return Outcome(model, asked, done.filter(F.col("role") == TRAIN).select("seq", "truth", "pred"))
