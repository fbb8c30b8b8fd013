"""Hoeffding tree: sufficient statistics, split merit, and an incremental learner.

Features are one ``array<double>``: numeric attributes first, then nominal attributes as dictionary indices.  The tree
itself is a list of nodes on the driver (as many as the tests let grow, or ``max_nodes``) that tasks get as flat arrays;
rows are routed level by level, a whole Arrow batch at a time.  Statistics are quantile observers: a table of cells
(member, leaf, attr, x, label, n) that merges across tasks and micro-batches.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.bounds import hoeffding_bound_sql, normal_cdf_sql
from driftline.functions.vectors import doubles
from driftline.operators.observer import CELLS, Observer, counter_level, matrix, merge_cells, merged_levels
from driftline.session import cut_lineage

LEAF, NUMERIC, NOMINAL = 0, 1, 2
NO_VALUE = -1

STATS_KEYS = ("member", "leaf", "attr", "value", "label")
_CELLS = "array<struct<value:int,label:int,n:double>>"
_SIDES = "array<struct<label:int,left:double,n:double>>"


# ---------------------------------------------------------------- sufficient statistics


def numeric_stats(
    df: DataFrame,
    attrs: int,
    keys: Sequence[str] = ("leaf", "label"),
    features: str = "features",
    weight: str | None = None,
    offsets: Sequence[float] | None = None,
) -> DataFrame:
    """n, sum, sum of squares, min and max per (keys, attribute), over the first ``attrs`` features.

    ``offsets`` shift the values before squaring, which keeps q − s²/n accurate for attributes far from zero.
    """
    vec = F.slice(F.col(features), 1, attrs)
    if offsets is not None:
        vec = F.zip_with(vec, doubles(offsets), lambda x, o: x - o)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(*keys, w.alias("w"), F.posexplode(vec).alias("attr", "x"))
    return rows.groupBy(*keys, "attr").agg(
        F.sum("w").alias("n"),
        F.sum(F.col("w") * F.col("x")).alias("s"),
        F.sum(F.col("w") * F.col("x") * F.col("x")).alias("q"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
    )


def nominal_stats(
    df: DataFrame,
    first_attr: int,
    attrs: int,
    keys: Sequence[str] = ("leaf", "label"),
    features: str = "features",
    weight: str | None = None,
) -> DataFrame:
    """n per (keys, attribute, value) over nominal features ``first_attr .. first_attr + attrs - 1``."""
    vec = F.slice(F.col(features), first_attr + 1, attrs)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(*keys, w.alias("w"), F.posexplode(vec).alias("attr", "x"))
    return (
        rows.groupBy(*keys, (F.col("attr") + first_attr).alias("attr"), F.col("x").cast("int").alias("value"))
        .agg(F.sum("w").alias("n"))
    )


def merge_stats(parts: Sequence[DataFrame], keys: Sequence[str] = STATS_KEYS) -> DataFrame:
    """Sum of statistics tables with the same columns."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


# ---------------------------------------------------------------- split merit


def nominal_gain(stats: DataFrame, keys: Sequence[str] = ("leaf", "attr"), branch_rows: float = 0.0) -> DataFrame:
    """Information gain of a multiway split per (keys) from counts ``n`` per (keys, value, label).

    ``cells`` leaves out values with fewer than ``branch_rows`` rows.

    The gain is the mutual information of value and label, Σ n_vc (log n_vc + log N − log n_v − log n_c) / N, so one
    pass over the cells with three window totals is enough.  ``cells`` lists (value, label, n).
    """
    k = ", ".join(keys)
    cells = stats.filter("n > 0").selectExpr(
        *keys, "value", "label", "n",
        f"sum(n) OVER (PARTITION BY {k}, value) AS nv",
        f"sum(n) OVER (PARTITION BY {k}, label) AS nc",
        f"sum(n) OVER (PARTITION BY {k}) AS total",
    )
    return cells.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.expr("greatest(0D, sum(n * (log2(n) + log2(total) - log2(nv) - log2(nc))) / sum(n))").alias("gain"),
        F.expr(f"collect_list(CASE WHEN nv >= {float(branch_rows)!r}D THEN named_struct('value', value, 'label', label, 'n', n) END)").alias("cells"),
    )


_LEFT_MASS = f"""CASE
    WHEN threshold < lo THEN 0D
    WHEN threshold >= hi THEN n
    WHEN sd <= 0 THEN CASE WHEN mean <= threshold THEN n ELSE 0D END
    ELSE n * {normal_cdf_sql('((threshold - mean) / sd)')} END"""


def numeric_gains(
    stats: DataFrame, keys: Sequence[str] = ("leaf", "attr"), candidates: int = 10
) -> DataFrame:
    """Gain of every candidate threshold per (keys), with class-wise left mass from a Gaussian per class.

    Thresholds are equally spaced strictly inside (lo, hi).  ``sides`` lists (label, left, n) per candidate.
    """
    k = ", ".join(keys)
    spread = (
        stats.filter("n > 0")
        .selectExpr(
            *keys, "label", "n", "lo", "hi", "s / n AS mean",
            "sqrt(greatest(0D, q / n - (s / n) * (s / n))) AS sd",
            f"min(lo) OVER (PARTITION BY {k}) AS glo",
            f"max(hi) OVER (PARTITION BY {k}) AS ghi",
        )
        .filter("ghi > glo")
        .selectExpr(
            "*",
            f"explode(transform(sequence(1, {candidates}), i -> glo + (ghi - glo) * i / {candidates + 1}D)) AS threshold",
        )
        .selectExpr(*keys, "label", "n", "threshold", f"{_LEFT_MASS} AS left")
    )
    per = spread.groupBy(*keys, "threshold").agg(
        F.sum("n").alias("n"),
        F.sum("left").alias("nl"),
        F.expr("sum(n - left)").alias("nr"),
        F.expr("sum(n * log2(n))").alias("lc"),
        F.expr("sum(CASE WHEN left > 0 THEN left * log2(left) ELSE 0D END)").alias("ll"),
        F.expr("sum(CASE WHEN n - left > 0 THEN (n - left) * log2(n - left) ELSE 0D END)").alias("lr"),
        F.expr("collect_list(named_struct('label', label, 'left', left, 'n', n))").alias("sides"),
    )
    # N·H of counts n_c is N·log2 N − Σ n_c·log2 n_c.
    inner = "CASE WHEN nl > 0 THEN nl * log2(nl) - ll ELSE 0D END + CASE WHEN nr > 0 THEN nr * log2(nr) - lr ELSE 0D END"
    return per.selectExpr(*keys, "threshold", "n", f"(n * log2(n) - lc - ({inner})) / n AS gain", "sides")


def _entropy_mass(counts: np.ndarray) -> np.ndarray:
    """n times the entropy of the class counts in each row."""
    total = counts.sum(axis=-1)
    logs = np.where(counts > 0, counts * np.log2(np.where(counts > 0, counts, 1.0)), 0.0).sum(axis=-1)
    return np.where(total > 0, total * np.log2(np.where(total > 0, total, 1.0)), 0.0) - logs


def cell_gains(
    cells: DataFrame, n_classes: int, keys: Sequence[str] = ("leaf", "attr"), least_share: float = 0.0
) -> DataFrame:
    """Best threshold per (keys) with its gain, from observer cells (keys, x, label, n).

    A candidate is every cell but the last: rows up to its x go left.  Both sides have to hold ``least_share`` of the
    rows.  ``sides`` lists (label, left, n).  Ties go to the smaller threshold.
    """
    leaf, attr = list(keys[:-1]), keys[-1]
    schema = f"{', '.join(f'{k} int' for k in keys)}, n double, gain double, threshold double, sides {_SIDES}"
    side = pa.list_(pa.struct([("label", pa.int32()), ("left", pa.float64()), ("n", pa.float64())]))
    arrow = pa.schema(
        [(k, pa.int32()) for k in keys] + [(c, pa.float64()) for c in ("n", "gain", "threshold")] + [("sides", side)]
    )

    def best(at: np.ndarray, counts: np.ndarray) -> tuple | None:
        left, whole = np.cumsum(counts, axis=0)[:-1], counts.sum(axis=0)
        total, mass = whole.sum(), left.sum(axis=1)
        able = np.minimum(mass, total - mass) >= least_share * total
        if not able.any():
            return None
        gain = np.where(able, (_entropy_mass(whole) - _entropy_mass(left) - _entropy_mass(whole - left)) / total, -1.0)
        # Sums in another order differ in the last digits: such gains tie.
        i = int(np.flatnonzero(gain >= gain.max() - 1e-12)[0])
        sides = [{"label": c, "left": float(left[i, c]), "n": float(whole[c])} for c in np.flatnonzero(whole).tolist()]
        return float(total), float(gain[i]), float(at[i]), sides

    def of_leaf(key: tuple, table: pa.Table) -> pa.Table:
        own, x, label, n = (table.column(c).to_numpy() for c in (attr, "x", "label", "n"))
        rows = []
        for a in np.unique(own).tolist():
            mine = own == a
            at, place = np.unique(x[mine], return_inverse=True)
            counts = np.zeros((len(at), n_classes))
            np.add.at(counts, (place, label[mine]), n[mine])
            if len(at) > 1 and (found := best(at, counts)) is not None:
                rows.append((*(k.as_py() for k in key), a, *found))
        columns = list(zip(*rows)) if rows else [[] for _ in arrow]
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # One call for all attributes of a leaf: attributes x cells x classes rows.
    return cells.groupBy(*leaf).applyInArrow(of_leaf, schema).filter("gain >= 0")


def split_decision(
    gains: DataFrame,
    keys: Sequence[str] = ("leaf",),
    n_classes: int = 2,
    delta: float = 1e-7,
    tie: float = 0.05,
    least_gain: float = 0.0,
) -> DataFrame:
    """Best against second-best attribute per leaf, from one row (attr, gain, n) per attribute.

    "No split" counts as a candidate with gain 0.  ``split`` = gain difference above the Hoeffding bound, or the bound
    below the tie threshold; the gain has to exceed ``least_gain`` either way.
    """
    w = f"(PARTITION BY {', '.join(keys)} ORDER BY gain DESC, attr)"
    return (
        gains.selectExpr(
            "*", f"row_number() OVER {w} AS rank_", f"greatest(0D, coalesce(lead(gain) OVER {w}, 0D)) AS gain2",
            f"{hoeffding_bound_sql(math.log2(max(2, n_classes)), delta, 'n')} AS epsilon",
        )
        .filter("rank_ = 1")
        .drop("rank_")
        .withColumn("split", F.expr(f"gain > {least_gain!r}D AND (gain - gain2 > epsilon OR epsilon < {tie!r}D)"))
    )


# ---------------------------------------------------------------- model


@dataclasses.dataclass
class Node:
    """A nominal node has a child for each of ``values`` and, with ``rest``, a last one for all others; without ``rest``
    those take child number ``other``."""

    counts: list[float]
    kind: int = LEAF
    attr: int = -1
    threshold: float = 0.0
    first_child: int = -1
    n_children: int = 0
    depth: int = 0
    tested_at: float = 0.0
    values: list[int] = dataclasses.field(default_factory=list)
    other: int = 0

    def majority(self) -> int:
        return max(range(len(self.counts)), key=lambda i: (self.counts[i], -i))


@dataclasses.dataclass(frozen=True)
class FlatTree:
    """A tree as arrays over its nodes.  Branches of nominal nodes are sorted keys (node, value): only seen values."""

    attr: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    numeric: np.ndarray
    other: np.ndarray
    branch: np.ndarray
    target: np.ndarray
    depth: int
    majority: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of(tree: Sequence[Node]) -> FlatTree:
        branches = sorted(
            ((i << 32) + v, n.first_child + c) for i, n in enumerate(tree) if n.kind == NOMINAL for c, v in enumerate(n.values)
        )
        counts = np.array([n.counts for n in tree], dtype=np.float64)
        total = counts.sum(axis=1, keepdims=True)
        return FlatTree(
            np.array([max(n.attr, 0) for n in tree]), np.array([n.threshold for n in tree], dtype=np.float64),
            np.array([n.first_child for n in tree]), np.array([n.kind == NUMERIC for n in tree]),
            np.array([n.first_child + n.other for n in tree]), np.array([b for b, _ in branches], dtype=np.int64),
            np.array([t for _, t in branches], dtype=np.int64), max(n.depth for n in tree), counts.argmax(axis=1),
            counts / np.where(total > 0, total, 1.0),
        )

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row: one step down per level for all rows at once.  NaN goes right."""
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            first = self.child[node]
            v = x[rows, self.attr[node]]
            down = np.where(self.numeric[node], first + ~(v <= self.threshold[node]), self.other[node])
            if len(self.branch):
                known = ~self.numeric[node] & (v >= 0) & (v < 2.0**31)
                key = (node << 32) + np.where(known, v, 0).astype(np.int64)
                at = np.minimum(np.searchsorted(self.branch, key), len(self.branch) - 1)
                down = np.where(known & (self.branch[at] == key), self.target[at], down)
            node = np.where(first >= 0, down, node)
        return node


@dataclasses.dataclass(frozen=True)
class TreeParams:
    """Learner settings; the defaults are the usual published ones.

    ``levels``: how many levels a tree may grow by one micro-batch.  ``cells``: positions of a quantile observer.  A
    side of a numeric split holds ``least_share`` of the rows at least, a nominal value gets a branch of its own from
    ``branch_rows`` rows on, and a split has to gain more than ``least_gain`` bits.
    """

    numeric: int
    cardinalities: tuple[int, ...]
    n_classes: int
    members: int = 1
    bagging: bool = False
    grace: float = 200.0
    delta: float = 1e-7
    tie: float = 0.05
    cells: int = CELLS
    levels: int = 2
    least_share: float = 0.01
    least_gain: float = 1e-3
    branch_rows: float = 10.0
    max_nodes: int | None = None  # no limit unless asked for
    seed: int = 1

    @property
    def attrs(self) -> int:
        return self.numeric + len(self.cardinalities)


@dataclasses.dataclass
class TreeModel:
    """One tree per member.  ``stats`` is a Spark table; everything else has the size of the trees."""

    params: TreeParams
    trees: list[list[Node]]
    rounds: int = 0
    stats: DataFrame | None = None
    # Class counts a child started with, by (member, node); the leaf's own statistics are added to them.
    start: dict[tuple[int, int], list[float]] = dataclasses.field(default_factory=dict)

    @staticmethod
    def empty(params: TreeParams) -> TreeModel:
        return TreeModel(params, [[Node([0.0] * params.n_classes)] for _ in range(params.members)])

    # ---- routing and scoring

    def _flat(self, spark):
        return spark.sparkContext.broadcast([FlatTree.of(t) for t in self.trees])

    def route(self, df: DataFrame, features: str = "features", member: int = 0, out: str = "leaf") -> DataFrame:
        """Node index reached by every row in the tree of ``member``."""
        shared, width = self._flat(df.sparkSession), self.params.attrs

        @F.arrow_udf("int")
        def reached(x: pa.Array) -> pa.Array:
            return pa.array(shared.value[member].route(matrix(x, width)), pa.int32())

        return df.withColumn(out, reached(features))

    def score(self, df: DataFrame, features: str = "features", out: str = "pred") -> DataFrame:
        """Predicted class index; ties and an untrained model give the lowest index.

        One tree: the majority class of the leaf.  Several: the largest sum of the members' class shares.  Only the
        features of the rows go through Arrow.
        """
        if all(len(t) == 1 for t in self.trees) and self.params.members == 1:
            return df.withColumn(out, F.lit(self.trees[0][0].majority()))
        shared, width = self._flat(df.sparkSession), self.params.attrs

        @F.arrow_udf("int")
        def voted(x: pa.Array) -> pa.Array:
            trees, rows = shared.value, matrix(x, width)
            if len(trees) == 1:
                return pa.array(trees[0].majority[trees[0].route(rows)], pa.int32())
            votes = sum(t.shares[t.route(rows)] for t in trees)
            return pa.array(votes.argmax(axis=1), pa.int32())

        return df.withColumn(out, voted(features))

    # ---- learning

    def learn(
        self, df: DataFrame, features: str = "features", label: str = "label", seq: str = "seq", span: tuple[int, int] | None = None
    ) -> TreeModel:
        """Model after the labelled rows of one micro-batch (label index >= 0).

        After a split the batch is read again for the new leaves alone, so a tree can grow ``levels`` levels by one
        batch; ``df`` should be stored.
        """
        p = self.params
        rows = df.filter(F.col(label) >= 0).select(
            F.col(seq).alias("seq"), F.col(features).alias("features"), F.col(label).cast("int").alias("label")
        )
        if p.bagging:
            rows = with_members(rows, p.members, "seq", p.seed).select("member", "features", "label", "weight")
        else:
            rows = rows.select(F.lit(0).alias("member"), "features", "label", F.lit(1.0).alias("weight"))
        level = counter_level(self.rounds)
        model = dataclasses.replace(self, rounds=self.rounds + 1)
        model.stats = cut_lineage(merged_levels(self._observe(rows), self.stats, level, self._merge))
        counts = model._counts()
        if not counts and self.stats is None:
            return self
        model, new = model._grow(counts)
        for _ in range(p.levels - 1):
            if not new:
                break
            fresh = cut_lineage(model._merge(model._observe(rows, new)).withColumn("level", F.lit(level)))
            again = model._counts(fresh)
            for leaf, seen in again.items():  # what the batch shows again is not part of the start
                model.start[leaf] = [max(0.0, a - b) for a, b in zip(model.start[leaf], seen)]
            model.stats = fresh if model.stats is None else model.stats.unionByName(fresh)
            model, new = model._grow(again)
        return model

    def cells(self, rows: DataFrame) -> DataFrame:
        """Observer cells of rows (member, features, label, weight) in the leaves they reach."""
        return self._merge(self._observe(rows))

    def _observe(self, rows: DataFrame, only: Sequence[tuple[int, int]] | None = None) -> DataFrame:
        """Cells (member, leaf, attr, x, label, n) of the rows, of the leaves ``only`` if given: one pass, one table of
        cells per task."""
        p, shared = self.params, self._flat(rows.sparkSession)
        wanted = None if only is None else np.array(sorted((m << 32) + i for m, i in only))

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = shared.value
            seen = [Observer(p.cells if a < p.numeric else None) for a in range(p.attrs)]
            for batch in stream:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column("features"), p.attrs)
                member, label, weight = (batch.column(c).to_numpy() for c in ("member", "label", "weight"))
                leaf = np.zeros(len(x), dtype=np.int64)
                for m in np.unique(member).tolist():
                    leaf[member == m] = trees[m].route(x[member == m])
                group = (member.astype(np.int64) << 32) + leaf
                if wanted is not None:
                    kept = np.isin(group, wanted)
                    group, x, label, weight = group[kept], x[kept], label[kept], weight[kept]
                for a in range(p.attrs):
                    # Zero and minus zero are one value.
                    seen[a].add(group, x[:, a] + 0.0, label, weight[:, None])
            for a, observer in enumerate(seen):
                held = observer.cells()
                if held is not None and len(held[0]):
                    group, x, label, n = held
                    columns = [
                        pa.array(group >> 32, pa.int32()), pa.array(group & 0xFFFFFFFF, pa.int32()),
                        pa.array(np.full(len(group), a), pa.int32()), pa.array(x), pa.array(label, pa.int32()), pa.array(n[:, 0]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["member", "leaf", "attr", "x", "label", "n"])

        return rows.mapInArrow(run, "member int, leaf int, attr int, x double, label int, n double")

    def _merge(self, cells: DataFrame) -> DataFrame:
        p = self.params
        return merge_cells(cells, ("member", "leaf", "attr"), ("n",), ("label",), p.cells, f"attr >= {p.numeric}")

    def _counts(self, stats: DataFrame | None = None) -> dict[tuple[int, int], list[float]]:
        """Class counts of the leaves: leaves times classes rows reach the driver."""
        stats = self.stats if stats is None else stats
        totals: dict[tuple[int, int], list[float]] = {}
        for r in stats.filter("attr = 0").groupBy("member", "leaf", "label").agg(F.sum("n").alias("n")).collect():
            totals.setdefault((r["member"], r["leaf"]), [0.0] * self.params.n_classes)[r["label"]] += r["n"]
        return totals

    def _grow(self, totals: dict[tuple[int, int], list[float]]) -> tuple[TreeModel, list[tuple[int, int]]]:
        """The model with the splits that are due among leaves with these counts, and its new leaves."""
        p = self.params
        trees = [[dataclasses.replace(n, counts=list(n.counts)) for n in t] for t in self.trees]
        due = []
        for (m, leaf), seen in totals.items():
            node = trees[m][leaf]
            if node.kind != LEAF:
                continue
            start = self.start.get((m, leaf), [0.0] * p.n_classes)
            node.counts = [a + b for a, b in zip(start, seen)]
            if sum(c > 0 for c in seen) > 1 and sum(seen) - node.tested_at >= p.grace:
                node.tested_at = sum(seen)
                due.append((m, leaf))
        model = dataclasses.replace(self, trees=trees, start=dict(self.start))
        sizes = [len(t) for t in trees]
        if due:
            for r in self._winners(self.stats, due):
                model._split(r, totals[(r["member"], r["leaf"])])
            split = [(m, leaf) for m, leaf in due if trees[m][leaf].kind != LEAF]
            if split:
                model.stats = self.stats.filter(~_in_nodes(split))
        return model, [(m, i) for m, t in enumerate(trees) for i in range(sizes[m], len(t))]

    def _winners(self, stats: DataFrame, due: list[tuple[int, int]]) -> list:
        """Winning split per tested leaf; at most one row per leaf reaches the driver."""
        p = self.params
        keys = ["member", "leaf", "attr"]
        tested = stats.filter(_in_nodes(due))
        options = []
        if p.numeric:
            cells = tested.filter(F.col("attr") < p.numeric).select(*keys, "x", "label", "n")
            options.append(
                cell_gains(cells, p.n_classes, keys, p.least_share)
                .selectExpr(*keys, "n", "gain", "threshold", "sides", f"cast(NULL AS {_CELLS}) AS cells")
            )
        if p.cardinalities:
            # One exchange by attribute; every grouping and window below refines it.
            nominal = tested.filter(F.col("attr") >= p.numeric).repartition(*keys)
            summed = nominal.groupBy(*keys, F.col("x").cast("int").alias("value"), "label").agg(F.sum("n").alias("n"))
            options.append(
                nominal_gain(summed, keys, p.branch_rows).selectExpr(
                    *keys, "n", "gain", "cast(NULL AS double) AS threshold", f"cast(NULL AS {_SIDES}) AS sides", "cells"
                )
            )
        union = options[0] if len(options) == 1 else options[0].unionByName(options[1])
        decided = split_decision(union, ["member", "leaf"], p.n_classes, p.delta, p.tie, p.least_gain)
        return sorted(decided.filter("split").collect(), key=lambda r: (r["member"], r["leaf"]))

    def _split(self, r, seen: list[float]) -> None:
        p, tree = self.params, self.trees[r["member"]]
        node = tree[r["leaf"]]
        numeric = r["threshold"] is not None
        # Nominal: a branch for every value with enough rows, and one for the rest of the rows if there are any.
        values = [] if numeric else sorted({c["value"] for c in r["cells"]})
        children = [[0.0] * p.n_classes for _ in range(2 if numeric else len(values))]
        if numeric:
            for s in r["sides"]:
                children[0][s["label"]] += s["left"]
                children[1][s["label"]] += s["n"] - s["left"]
            other = 0
        else:
            place = {v: i for i, v in enumerate(values)}
            rest = list(seen)
            for c in r["cells"]:
                children[place[c["value"]]][c["label"]] += c["n"]
                rest[c["label"]] -= c["n"]
            if sum(rest) > 1e-6:
                children.append([max(0.0, v) for v in rest])
                other = len(values)
            else:
                sizes = [sum(c) for c in children]
                other = sizes.index(max(sizes)) if sizes else 0
        if len(children) < 2 or (p.max_nodes is not None and len(tree) + len(children) > p.max_nodes):
            return
        node.kind = NUMERIC if numeric else NOMINAL
        node.attr, node.values, node.other = r["attr"], values, other
        node.threshold = r["threshold"] if numeric else 0.0
        node.first_child, node.n_children = len(tree), len(children)
        for c in children:
            self.start[(r["member"], len(tree))] = c
            tree.append(Node(list(c), depth=node.depth + 1))

    # ---- state

    def nodes(self, spark) -> DataFrame:
        """The model as a table, one row per node."""
        rows = [
            (m, i, n.kind, n.attr, float(n.threshold), n.first_child, n.n_children, n.depth, n.tested_at, n.values, n.other,
             [float(c) for c in n.counts], [float(c) for c in self.start.get((m, i), [])])
            for m, t in enumerate(self.trees)
            for i, n in enumerate(t)
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @staticmethod
    def from_tables(params: TreeParams, nodes: DataFrame, rounds: int, stats: DataFrame) -> TreeModel:
        trees: list[list[Node]] = [[] for _ in range(params.members)]
        start = {}
        for r in nodes.orderBy("member", "node").collect():
            trees[r["member"]].append(
                Node(list(r["counts"]), r["kind"], r["attr"], r["threshold"], r["first_child"], r["n_children"],
                     r["depth"], r["tested_at"], list(r["values"]), r["other"])
            )
            if r["start"]:
                start[(r["member"], r["node"])] = list(r["start"])
        return TreeModel(params, trees, rounds, stats, start)


NODE_SCHEMA = (
    "member int, node int, kind int, attr int, threshold double, first_child int, n_children int, depth int, "
    "tested_at double, values array<int>, other int, counts array<double>, start array<double>"
)
STATS_SCHEMA = "member int, leaf int, attr int, x double, label int, n double, level int"


def _in_nodes(nodes: Sequence[tuple[int, int]]) -> Column:
    """Membership of (member, leaf) in a bounded list of nodes."""
    by_member: dict[int, list[int]] = {}
    for m, leaf in nodes:
        by_member.setdefault(m, []).append(leaf)
    test = F.lit(False)
    for m, leaves in by_member.items():
        test = test | ((F.col("member") == m) & F.col("leaf").isin(leaves))
    return test


# ---------------------------------------------------------------- bagging


def _poisson_limits() -> list[float]:
    """Cumulative Poisson(1) probabilities up to the resolution of a 32-bit draw."""
    limits, term, total, k = [], math.exp(-1.0), 0.0, 0
    while total < 1.0 - 2.0**-33:
        total += term
        limits.append(total)
        k += 1
        term /= k
    return limits


POISSON_LIMITS = _poisson_limits()


def with_members(df: DataFrame, members: int, seq: str = "seq", seed: int = 1) -> DataFrame:
    """Each row once per member with a positive Poisson(1) ``weight``.

    The draw is the md5 of "seq:member:seed", so it is the same on every replay and on every engine.
    """
    drawn = df.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1)))).withColumn(
        "__u", F.expr(f"cast(conv(substr(md5(concat_ws(':', {seq}, member, '{seed}')), 1, 8), 16, 10) AS bigint) / {2.0**32!r}D")
    )
    steps = " ".join(f"WHEN __u < {limit!r}D THEN {k}D" for k, limit in enumerate(POISSON_LIMITS))
    kept = drawn.filter(f"__u >= {POISSON_LIMITS[0]!r}D")
    return kept.withColumn("weight", F.expr(f"CASE {steps} ELSE {len(POISSON_LIMITS)}D END")).drop("__u")


def majority_vote(votes: DataFrame, keys: Sequence[str], pred: str = "pred", out: str = "vote") -> DataFrame:
    """Most frequent prediction per key over members; ties go to the lowest class index."""
    counted = votes.groupBy(*keys, pred).agg(F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*keys).agg(
        F.max_by(pred, F.struct(F.col("__n"), -F.col(pred))).alias(out), F.max("__n").alias("votes")
    )
