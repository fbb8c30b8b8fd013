"""Learners as micro-batch steps: load model b−1, score, write outputs, learn, write model b.

``step(rows, batch_id)`` is what ``foreachBatch`` calls.  Outputs go to one folder per batch, so a replay replaces them.
"""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.vectors import vectorize
from driftline.operators.cluster import centers_row, centers_table
from driftline.operators.encode import decode, encode_label, encode_nominal, extend_dictionary, number_entries, value_counts
from driftline.operators.evaluate import confusion
from driftline.operators.kernels import KERNEL_SCHEMA
from driftline.operators.microclusters import ClusterModel, ClusterParams
from driftline.operators.order import limit_instances, with_seq
from driftline.operators.rules import MOMENTS_SCHEMA, RULE_SCHEMA, RuleModel, RuleParams, moments_from, moments_table
from driftline.operators.rules import STATS_SCHEMA as RULE_STATS_SCHEMA
from driftline.operators.tree import NODE_SCHEMA, STATS_SCHEMA, TreeModel, TreeParams
from driftline.schema import PREDICT, PREDICT_LABEL, TRAIN, role_of_label, role_of_target
from driftline.session import cut_lineage
from driftline.sources.sinks import callback, write_batch
from driftline.streaming.curves import StreamCurve
from driftline.streaming.store import ModelStore

DICTIONARY_SCHEMA = "attr string, value string, first_seq bigint, n_rows bigint, idx int"


@dataclasses.dataclass
class _Learner:
    """What the three learners share: numbering across batches, the limit, outputs and the streaming query."""

    spark: SparkSession
    path: str
    order_by: str | Sequence[str]
    max_instances: int = -1
    interval: int = 1000

    @property
    def store(self) -> ModelStore:
        return ModelStore(self.spark, f"{self.path}/model")

    @property
    def curve(self) -> StreamCurve:
        """Cumulative metrics every ``interval`` labelled rows; ``curve.finish()`` adds the last, partial point."""
        return StreamCurve(self.spark, self.path, self.store, getattr(self, "n_classes", None), self.interval)

    def summary(self) -> dict:
        """Rows, micro-batches with data and seconds spent in them, over the whole run and its restarts."""
        found = self.store.latest_before()
        return found[1]["run"] if found else {"instances": 0, "batches": 0, "seconds": 0.0}

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return callback(stream, lambda batch_id, rows: self.step(rows, batch_id), f"{self.path}/checkpoint", trigger)

    def outputs(self, name: str) -> DataFrame:
        """Output rows of all batches so far: ``predictions``, ``pairs``, ``confusion``, ``curve`` or ``centers``."""
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _number(self, rows: DataFrame, seen: int) -> DataFrame:
        numbered = with_seq(rows, self.order_by).withColumn("seq", F.col("seq") + F.lit(seen))
        return limit_instances(numbered, self.max_instances)

    def step(self, rows: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        prior = self.store.latest_before(batch_id)
        rows = rows.persist()
        try:
            count = rows.count()
            if count:
                seen = prior[1]["seen"] if prior else 0
                meta = self._learn(self._number(rows, seen), batch_id, prior)
                run = prior[1]["run"] if prior else {"instances": 0, "batches": 0, "seconds": 0.0}
                spent = run["seconds"] + time.monotonic() - started
                run = {"instances": seen + count, "batches": run["batches"] + 1, "seconds": spent}
                self.store.commit(batch_id, {**meta, "seen": seen + count, "run": run})
        finally:
            rows.unpersist()

    def _stored(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows of this micro-batch as a table of its version, so that what follows does not compute them again."""
        self.store.write(name, batch_id, rows)
        return self.store.read(name, batch_id, rows.schema)

    def _learn(self, rows: DataFrame, batch_id: int, prior: tuple[int, dict] | None) -> dict:
        raise NotImplementedError


@dataclasses.dataclass
class ClassifierStream(_Learner):
    """Hoeffding classifier over a stream with first-seen dictionaries that grow with it."""

    numeric: Sequence[str] = ()
    nominal: Mapping[str, int] = dataclasses.field(default_factory=dict)
    label: str = "label"
    n_classes: int = 2
    overflow: str = "error"
    options: dict = dataclasses.field(default_factory=dict)

    @property
    def params(self) -> TreeParams:
        bagging = self.options.get("bagging", 0)
        rest = {k: v for k, v in self.options.items() if k != "bagging"}
        return TreeParams(
            len(self.numeric), tuple(self.nominal.values()), self.n_classes, max(1, bagging), bagging != 0, **rest
        )

    def model(self, before: int | None = None) -> TreeModel:
        found = self.store.latest_before(before)
        if found is None:
            return TreeModel.empty(self.params)
        version, meta = found
        if not meta["trained"]:
            return TreeModel.empty(self.params)
        return TreeModel.from_tables(
            self.params, self.store.read("nodes", version, NODE_SCHEMA), meta["rounds"],
            self.store.read("stats", version, STATS_SCHEMA),
        )

    def _dictionary(self, name: str, counts: DataFrame, batch_id: int, prior) -> DataFrame:
        if prior is None:
            new = number_entries(cut_lineage(counts))
        else:
            new = extend_dictionary(self.store.read(name, prior[0], DICTIONARY_SCHEMA), counts)
        self.store.write(name, batch_id, new.select("attr", "value", "first_seq", "n_rows", "idx"))
        return self.store.read(name, batch_id, DICTIONARY_SCHEMA)

    def _learn(self, rows: DataFrame, batch_id: int, prior) -> dict:
        model = self.model(batch_id)
        labels = self._dictionary("labels", value_counts(rows, [self.label], exclude={self.label: PREDICT_LABEL}), batch_id, prior)
        coded = encode_label(rows, self.label, labels, self.n_classes, self.overflow, "label_idx")
        names = list(self.nominal)
        if names:
            values = self._dictionary("nominals", value_counts(rows, names), batch_id, prior)
            coded = encode_nominal(coded, names, values)
        coded = coded.withColumn("features", vectorize([*self.numeric, *[f"{c}_idx" for c in names]]))
        coded = coded.select("seq", *self.numeric, *names, self.label, "label_idx", "features")
        scored = self._stored("scored", model.score(coded.withColumn("role", role_of_label(self.label))), batch_id)
        asked = decode(scored.filter(F.col("role") == PREDICT), "pred", labels, self.label, "prediction")
        write_batch(asked.select("seq", *self.numeric, *names, "prediction"), f"{self.path}/predictions", batch_id)
        pairs = scored.filter(F.col("role") == TRAIN).select("seq", F.col("label_idx").alias("truth"), "pred")
        write_batch(pairs, f"{self.path}/pairs", batch_id)
        written = self.spark.read.schema(pairs.schema).parquet(f"{self.path}/pairs/batch_id={batch_id}")
        write_batch(confusion(written), f"{self.path}/confusion", batch_id)
        curve = self.curve.add(written, batch_id, prior)
        model = model.learn(scored.drop("pred", "role"), label="label_idx")
        trained = model.stats is not None
        if trained:
            self.store.write("nodes", batch_id, model.nodes(self.spark))
            self.store.write("stats", batch_id, model.stats)
        return {"trained": trained, "rounds": model.rounds, "curve": curve}


@dataclasses.dataclass
class RegressorStream(_Learner):
    """Adaptive model rules over a stream."""

    features: Sequence[str] = ()
    target: str = "target"
    options: dict = dataclasses.field(default_factory=dict)

    @property
    def params(self) -> RuleParams:
        return RuleParams(attrs=len(self.features), **self.options)

    def model(self, before: int | None = None) -> RuleModel:
        found = self.store.latest_before(before)
        if found is None or not found[1]["trained"]:
            return RuleModel.empty(self.params)
        version, m = found
        return RuleModel(
            self.params, RuleModel.rules_from(self.store.read("rules", version, RULE_SCHEMA)), m["next_id"], m["offset"],
            m["scale"], m["rounds"], self.store.read("stats", version, RULE_STATS_SCHEMA),
            moments_from(self.store.read("moments", version, MOMENTS_SCHEMA)),
        )

    def _learn(self, rows: DataFrame, batch_id: int, prior) -> dict:
        model = self.model(batch_id)
        coded = rows.withColumn("features", vectorize(self.features)).withColumn("role", role_of_target(self.target))
        coded = coded.select("seq", *self.features, self.target, "features", "role")
        scored = self._stored("scored", model.score(coded), batch_id)
        asked = scored.filter(F.col("role") == PREDICT)
        write_batch(
            asked.select("seq", *self.features, F.col("pred").alias("prediction")), f"{self.path}/predictions", batch_id
        )
        train = F.col("role") == TRAIN
        pairs = scored.filter(train).select("seq", F.col(self.target).alias("truth"), "pred")
        write_batch(pairs, f"{self.path}/pairs", batch_id)
        written = self.spark.read.schema(pairs.schema).parquet(f"{self.path}/pairs/batch_id={batch_id}")
        curve = self.curve.add(written, batch_id, prior)
        model = model.learn(scored.drop("pred"), target=self.target, where=train)
        trained = model.stats is not None
        if trained:
            self.store.write("rules", batch_id, model.table(self.spark))
            self.store.write("stats", batch_id, model.stats)
            self.store.write("moments", batch_id, moments_table(self.spark, model.moments))
        return {
            "trained": trained, "next_id": model.next_id, "offset": model.offset, "scale": model.scale,
            "rounds": model.rounds, "curve": curve,
        }


@dataclasses.dataclass
class ClusterStream(_Learner):
    """Micro-clusters over a stream; every micro-batch emits one row of k centres.

    With ``emit_every`` a row of centres, with its ``point``, follows every ``emit_every`` arrivals instead.
    """

    features: Sequence[str] | str = ()
    k: int = 2
    options: dict = dataclasses.field(default_factory=dict)
    emit_every: int = 0

    def model(self, before: int | None = None) -> ClusterModel:
        params = ClusterParams(k=self.k, **self.options)
        found = self.store.latest_before(before)
        if found is None:
            return ClusterModel(params)
        return ClusterModel.from_table(params, self.store.read("kernels", found[0], KERNEL_SCHEMA))

    def _learn(self, rows: DataFrame, batch_id: int, prior) -> dict:
        single = isinstance(self.features, str)
        vector = F.col(self.features).cast("array<double>") if single else vectorize(self.features)
        model, rows = self.model(batch_id), rows.select("seq", vector.alias("features"))
        if self.emit_every:
            return self._emit(model, self._stored("arrived", rows, batch_id), batch_id)
        model = model.learn(rows)
        self.store.write("kernels", batch_id, model.table(self.spark))
        write_batch(centers_row(self.spark, model.centers(), self.k), f"{self.path}/centers", batch_id)
        return {}

    def _emit(self, model: ClusterModel, rows: DataFrame, batch_id: int) -> dict:
        """Learn the rows up to each emission point in turn."""
        first, last = rows.agg(F.min("seq"), F.max("seq")).first()
        emitted = []
        while first is not None and first <= last:
            upto = min(last, -(-first // self.emit_every) * self.emit_every)
            model = model.learn(rows.filter(F.col("seq").between(first, upto)))
            if upto % self.emit_every == 0:
                emitted.append((upto, model.centers()))
            first = upto + 1
        self.store.write("kernels", batch_id, model.table(self.spark))
        write_batch(centers_table(self.spark, emitted, self.k), f"{self.path}/centers", batch_id)
        return {}
