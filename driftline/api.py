"""The learners as calls on a DataFrame.  Parameters are checked against ``df.schema`` before any job starts."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.vectors import vectorize
from driftline.operators.cluster import centers_row, centers_table
from driftline.operators.encode import OVERFLOW_MODES, decode
from driftline.operators.evaluate import learning_curve, learning_curve_regression, measurements_long
from driftline.operators.kmeans_stream import (
    INCREMENTAL,
    INDEPENDENT,
    SLIDING,
    STATE_SCHEMA,
    batch_kmeans,
    batch_output,
    batch_shift,
    chained_updates,
    joined_output,
    update,
)
from driftline.operators.linear import batch_fits, batch_predict, confidence_interval, predict, sgd_step
from driftline.operators.order import batch_starts, number_rows, order_keys, runs_of, with_batch, with_seq
from driftline.operators.kernels import PyramidalFrame
from driftline.operators.microclusters import ClusterModel, ClusterParams
from driftline.operators.rules import RuleModel, RuleParams
from driftline.operators.tree import TreeModel, TreeParams
from driftline.plans.prequential import (
    FIRST_BATCH,
    GROWTH,
    prepare_classification,
    prepare_clustering,
    prepare_regression,
    test_then_train,
)
from driftline.schema import TRAIN, known_target, parse_cardinalities, require_columns, require_int, require_numeric
from driftline.session import BROADCAST_ROWS, cut_lineage, fresh_path, shuffle_partitions, stored

INTERVAL = 1_000
# Values (rows x features) that one task takes through a run of short batches, and of centres that are broadcast.
CHAIN_VALUES = 3_000_000
# Rows of a micro-batch that one task clusters as fast as a distributed round does.
SHORT_BATCH = 10_000


@dataclasses.dataclass
class Learned:
    """Result of a learner over a table.

    ``predictions``: rows marked for prediction with their inputs and ``prediction``.  ``model``: the final model.
    ``pairs``: (seq, truth, pred) of labelled rows, the input of the learning curve.
    """

    predictions: DataFrame
    model: object
    pairs: DataFrame | None = None
    interval: int = INTERVAL
    n_classes: int | None = None

    @functools.cached_property
    def curve(self) -> DataFrame:
        """Cumulative metrics every ``interval`` labelled rows."""
        numbered = with_seq(self.pairs, "seq", "pos")
        if self.n_classes is None:
            return learning_curve_regression(numbered, self.interval, seq="pos")
        return learning_curve(numbered, self.n_classes, self.interval, seq="pos")

    @property
    def measurements(self) -> DataFrame:
        """The classification curve with one row per measurement."""
        return measurements_long(self.curve, self.n_classes)


# Columns the learners add to the rows.
RESERVED = ("features", "role", "stderr", "batch_id", "pred", "label_idx", "prediction")


def _order_columns(df: DataFrame, order_by: str | Sequence[str]) -> None:
    require_columns(df, order_keys(order_by), (), "order")
    taken = [c for c in RESERVED if c in df.columns]
    if taken:
        raise ValueError(f"column names reserved by the learner: {taken}")


def hoeffding_classifier(
    df: DataFrame,
    numeric: Sequence[str],
    label: str,
    n_classes: int,
    order_by: str | Sequence[str],
    nominal: Mapping[str, int] | Sequence[str] = (),
    nominal_values: str = "",
    interval: int = INTERVAL,
    parallelism: int | None = None,
    bagging: int = 0,
    max_instances: int = -1,
    overflow: str = "error",
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
    **tree_options,
) -> Learned:
    """Incremental Hoeffding tree, bagged over ``bagging`` members if that is not 0.

    Rows whose label is ``?`` are scored and returned; all others are scored first and then learned from.
    """
    require_int("n_classes", n_classes, 1)
    require_int("interval", interval, 1)
    require_int("bagging", bagging, 0)
    require_int("max_instances", max_instances, -1)
    if parallelism is not None:
        require_int("parallelism", parallelism, 1)
    if overflow not in OVERFLOW_MODES:
        raise ValueError(f"overflow: required one of {OVERFLOW_MODES} but found {overflow!r}")
    nominal_names = list(nominal)
    cards = parse_cardinalities(nominal if isinstance(nominal, Mapping) else nominal_values, nominal_names)
    require_numeric(df, numeric)
    require_columns(df, nominal_names, (T.StringType,), "nominal")
    require_columns(df, [label], (), "label")
    _order_columns(df, order_by)
    params = TreeParams(
        numeric=len(numeric), cardinalities=tuple(cards[n] for n in nominal_names), n_classes=n_classes,
        members=max(1, bagging), bagging=bagging != 0, **tree_options,
    )
    with shuffle_partitions(df.sparkSession, parallelism):
        prepared = prepare_classification(
            df, numeric, nominal_names, label, n_classes, order_by, max_instances, overflow, first_batch, growth
        )
        inputs = [*numeric, *nominal_names]
        outcome = test_then_train(prepared, TreeModel.empty(params), "label_idx", inputs, {"label": "label_idx"})
    asked = decode(outcome.predictions, "pred", prepared.labels, label, "prediction")
    return Learned(asked.select("seq", *inputs, "prediction"), outcome.model, outcome.pairs, interval, n_classes)


def rules_regressor(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: str | Sequence[str],
    interval: int = INTERVAL,
    max_instances: int = -1,
    parallelism: int | None = None,
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
    **rule_options,
) -> Learned:
    """Adaptive model rules.  Rows whose target is negative zero are scored and returned; all others train."""
    if len(features) < 1:
        raise ValueError("features: required at least one attribute besides the target")
    require_int("interval", interval, 1)
    require_int("max_instances", max_instances, -1)
    if parallelism is not None:
        require_int("parallelism", parallelism, 1)
    require_numeric(df, features)
    require_numeric(df, [target], "target")
    _order_columns(df, order_by)
    params = RuleParams(attrs=len(features), **rule_options)
    with shuffle_partitions(df.sparkSession, parallelism):
        prepared = prepare_regression(df, features, target, order_by, max_instances, first_batch, growth)
        outcome = test_then_train(prepared, RuleModel.empty(params), target, list(features), {"target": target, "where": F.col("role") == TRAIN})
    asked = outcome.predictions.select("seq", *features, F.col("pred").alias("prediction"))
    return Learned(asked, outcome.model, outcome.pairs, interval)


def microcluster_kmeans(
    df: DataFrame,
    features: Sequence[str] | str,
    k: int,
    order_by: str | Sequence[str],
    max_instances: int = -1,
    first_batch: int = FIRST_BATCH,
    growth: float = GROWTH,
    emit_every: int = 0,
    frame: PyramidalFrame | None = None,
    **cluster_options,
) -> Learned:
    """Micro-clusters with a k-means macro step.  ``predictions`` is one row ``center0 .. center{k-1}``.

    With ``emit_every`` rows are learned in batches of that size, and ``predictions`` holds a row of centres for each of
    them, with the rows learned so far as ``point``.  ``frame`` gets a snapshot of the kernels after every batch.
    """
    require_int("k", k, 2)
    require_int("emit_every", emit_every, 0)
    if emit_every:
        first_batch, growth = emit_every, 1.0
    require_int("max_instances", max_instances, -1)
    if isinstance(features, str):
        require_columns(df, [features], (T.ArrayType,), "features")
    else:
        require_numeric(df, features)
    require_columns(df, order_keys(order_by), (), "order")
    columns = [features] if isinstance(features, str) else list(features)
    rows = df.select(*dict.fromkeys([*order_keys(order_by), *columns]))
    prepared = prepare_clustering(rows, features, order_by, max_instances, first_batch, growth, CHAIN_VALUES, SHORT_BATCH)
    model = ClusterModel(ClusterParams(k=k, **cluster_options))
    emitted = []
    kept = set() if frame is None else frame.kept(len(prepared.starts))
    for (a, b), part in prepared.parts():
        if a == b:
            model = model.learn(part, span=prepared.span(a))
            if a + 1 in kept:
                frame.add(a + 1, prepared.span(a)[1], model.table(df.sparkSession))
            if emit_every:
                emitted.append((prepared.span(a)[1], model.centers()))
            continue
        # Tick b + 1 is the state after micro-batch b.
        wanted = {t for t in kept if a < t <= b + 1} | {b + 1}
        spans = [prepared.span(i) for i in range(a, b + 1)]
        states = stored(model.learn_run(part, spans, a + 1, wanted, bool(emit_every)), "kernels")
        after = lambda tick: states.filter(F.col("tick") == tick).select(F.inline("kernels"))  # noqa: B023, E731
        for t in sorted(wanted & kept):
            frame.add(t, prepared.span(t - 1)[1], after(t))
        if emit_every:
            emitted += [(r["clock"], r["centers"]) for r in states.select("clock", "centers").orderBy("clock").collect()]
        model = ClusterModel.from_table(model.params, after(b + 1))
    if emitted:
        return Learned(centers_table(df.sparkSession, emitted, k), model)
    return Learned(centers_row(df.sparkSession, model.centers(), k), model)


def streaming_kmeans(
    df: DataFrame,
    features: Sequence[str],
    k: int,
    order_by: str | Sequence[str],
    learn_type: int = INDEPENDENT,
    window_shift: int = 0,
    batch_size: int = 1000,
    num_iterations: int = 10,
    alpha: float = 1.0,
    ci: float = 0.95,
    growth: float = 1.0,
    centers: Sequence[Sequence[float]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Streaming k-means over a table: all inputs + ``stderr`` + ``center0 .. center{k-1}``, and the error interval.

    ``learn_type`` 0 clusters each batch of ``batch_size`` rows on its own, 1 does so for batches that advance by
    ``window_shift``, 2 keeps one model that starts with the first batch and decays old rows by ``alpha`` per batch
    (``growth`` above 1 makes every batch that much longer than the one before, for fewer rounds).  ``centers`` are the
    start of every batch, or of the one model.  ``stderr`` is the distance to the nearest centre.
    """
    require_int("k", k, 2)
    require_int("batch_size", batch_size, 1)
    require_int("num_iterations", num_iterations, 1)
    if learn_type == SLIDING:
        require_int("window_shift", window_shift, 1)
        if window_shift > batch_size:
            raise ValueError("window_shift: required at most batch_size, so that every row is in a batch")
    elif learn_type not in (INDEPENDENT, INCREMENTAL):
        raise ValueError(f"learn_type: required 0, 1 or 2 but found {learn_type}")
    require_numeric(df, features)
    _order_columns(df, order_by)
    numbered, total = number_rows(df, order_by)
    rows = numbered.withColumn("features", vectorize(features))
    if learn_type == INCREMENTAL:
        rows = _incremental_kmeans(rows, total, k, len(features), batch_size, num_iterations, alpha, growth, centers)
    else:
        rows = stored(rows, "kmeans")
        shift = window_shift if learn_type == SLIDING else batch_size
        fits = cut_lineage(batch_kmeans(rows, k, learn_type, window_shift, batch_size, num_iterations, centers=centers))
        rows = batch_output(rows, fits, k, batch_size, shift)
    result = rows.drop("features", "batch_id")
    return result, confidence_interval(result, "stderr", ci)


def streaming_linear(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: str | Sequence[str],
    learn_type: int = INDEPENDENT,
    window_shift: int = 0,
    batch_size: int = 1000,
    num_iterations: int = 10,
    alpha: float = 0.1,
    ci: float = 0.95,
    growth: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Streaming linear regression over a table: all inputs + ``prediction`` + ``stderr``, and the error interval.

    ``learn_type`` 0 fits least squares on each batch of ``batch_size`` rows, 1 on batches that advance by
    ``window_shift``; a row is predicted by the batch it is new in.  2 keeps one model: a batch is predicted with the
    weights before it, followed by ``num_iterations`` gradient steps of rate ``alpha`` (``growth`` as for k-means;
    features should be of a similar scale).  ``stderr`` is |target − prediction|.  Rows whose target is null, NaN or
    the mark for prediction are predicted only.
    """
    require_int("batch_size", batch_size, 1)
    require_int("num_iterations", num_iterations, 1)
    shift = batch_shift(learn_type, window_shift, batch_size)
    require_numeric(df, [*features, target])
    _order_columns(df, order_by)
    numbered, total = number_rows(df, order_by)
    rows = numbered.withColumn("features", vectorize(features)).withColumn("__y", known_target(target))
    if learn_type == INCREMENTAL:
        scored = _gradient_batches(rows, total, len(features), batch_size, num_iterations, alpha, growth)
    else:
        rows = stored(rows, "linear")
        known = rows.filter("__y IS NOT NULL")
        fits = cut_lineage(batch_fits(known, len(features), learn_type, window_shift, batch_size, target="__y"))
        scored = batch_predict(rows, fits, batch_size, shift, target="__y")
    result = scored.drop("features", "batch_id", "__y")
    return result, confidence_interval(result, "stderr", ci)


def _gradient_batches(
    rows: DataFrame, total: int, attrs: int, batch_size: int, iterations: int, alpha: float, growth: float
) -> DataFrame:
    """Batch b predicted with the weights after batch b − 1; every batch is read from its own folder."""
    spark = rows.sparkSession
    starts = batch_starts(total, batch_size, growth)
    table = stored(with_batch(rows, starts), "linear", "batch_id")
    out = fresh_path(spark, "linear-output")
    weights = [0.0] * (attrs + 1)
    schema = None
    for b in range(len(starts)):
        batch = table.filter(F.col("batch_id") == b)
        scored = predict(batch.drop("batch_id"), weights, out="prediction")
        scored = scored.withColumn("stderr", F.abs(F.col("__y") - F.col("prediction")))
        schema = scored.schema
        scored.write.parquet(f"{out}/batch_id={b}")
        for _ in range(iterations):
            steps = {r["i"]: r["w"] for r in sgd_step(batch.filter("__y IS NOT NULL"), weights, alpha, target="__y").collect()}
            weights = [steps.get(i, w) for i, w in enumerate(weights)]
    return spark.read.schema(schema.add("batch_id", "integer")).parquet(out)


def _incremental_kmeans(
    rows: DataFrame, total: int, k: int, width: int, batch_size: int, iterations: int, alpha: float, growth: float,
    centers: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """One decayed model: batch b is scored with the centres after batch b.

    The model goes through runs of short batches in one task each, a folder of the table at a time; a batch longer than
    such a run is one round of distributed sums.  Then all rows meet the centres of their batch at once.
    """
    spark = rows.sparkSession
    starts = batch_starts(total, batch_size, growth)
    runs = runs_of(starts, total, max(1, CHAIN_VALUES // width))
    table = stored(with_batch(rows, [starts[a] for a, _ in runs] or starts, name="__run"), "kmeans", "__run")
    out = fresh_path(spark, "kmeans-states")
    counts = None if centers is None else [0.0] * len(centers)
    for i, (a, b) in enumerate(runs):
        part = table.filter(F.col("__run") == i)
        if centers is None:
            first = batch_kmeans(part.filter(F.col("seq") <= batch_size), k, INDEPENDENT, 0, batch_size, iterations).first()
            centers, counts = [list(c) for c in first["centers"]], [0.0] * len(first["centers"])
        if a == b:
            moved = sorted(update(part, centers, counts, alpha).collect(), key=lambda r: r["idx"])
            state = (a, [r["n"] for r in moved], [list(r["center"]) for r in moved])
            states = spark.createDataFrame([state], STATE_SCHEMA)
        else:
            states = chained_updates(part, centers, counts, alpha, starts[a : b + 1], a)
        states.write.parquet(f"{out}/run={i}")
        last = spark.read.schema(STATE_SCHEMA).parquet(f"{out}/run={i}").filter(F.col("batch") == b).first()
        centers, counts = last["centers"], last["counts"]
    found = spark.read.schema(STATE_SCHEMA).parquet(*[f"{out}/run={i}" for i in range(len(runs))]) if runs else spark.createDataFrame([], STATE_SCHEMA)
    states = found.withColumnRenamed("batch", "__batch")
    if len(starts) <= min(BROADCAST_ROWS, CHAIN_VALUES // (k * width)):
        states = F.broadcast(states)
    return joined_output(with_batch(table.drop("__run"), starts, name="__batch"), states, max(k, len(centers or ())), "__batch")
