"""Adaptive model rules for regression: coverage, target statistics, expansion, drift, and an incremental learner.

A rule is a conjunction of literals ``x[attr] <= thr`` or ``x[attr] > thr`` with a head that predicts the target.  The
rule set is a small list on the driver (bounded by what the tests let grow, or by ``max_rules``).  Tasks match whole Arrow
batches against it.  Target statistics are quantile observers: a table of cells (rule, attr, x, n, sy, syy) that merges
across tasks and micro-batches.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.bounds import hoeffding_bound_sql
from driftline.functions.vectors import doubles
from driftline.operators.linear import solve_normal
from driftline.operators.observer import CELLS, Observer, counter_level, matrix, merge_cells, merged_levels
from driftline.operators.order import BUCKET_ROWS, with_block
from driftline.session import cut_lineage, stored

CELL_KEYS, CELL_SUMS = ("rule", "attr"), ("n", "sy", "syy")
STATS_SCHEMA = "rule bigint, attr int, x double, n double, sy double, syy double, level int"


# ---------------------------------------------------------------- kernels


def bin_index(x: Column, lo: Column | float, hi: Column | float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 on fixed edges; values outside fall into the first or last bin."""
    lo = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi = hi if isinstance(hi, Column) else F.lit(float(hi))
    raw = F.floor((x - lo) / (hi - lo) * bins)
    return F.when(hi <= lo, 0).otherwise(F.least(F.lit(bins - 1), F.greatest(F.lit(0), raw))).cast("int")


def target_stats(
    df: DataFrame,
    lows: Sequence[float],
    highs: Sequence[float],
    bins: int,
    keys: Sequence[str] = ("rule",),
    features: str = "features",
    target: str = "target",
    offset: float = 0.0,
) -> DataFrame:
    """n, sum y, sum y² per (keys, attribute, bin); the target is shifted by ``offset`` before squaring."""
    rows = df.select(
        *keys, (F.col(target) - F.lit(float(offset))).alias("y"), F.posexplode(F.col(features)).alias("attr", "x")
    )
    low, high = F.get(doubles(lows), F.col("attr")), F.get(doubles(highs), F.col("attr"))
    return rows.groupBy(*keys, "attr", bin_index(F.col("x"), low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")
    )


def _sd(n: str, s: str, ss: str) -> str:
    return f"CASE WHEN {n} > 0 THEN sqrt(greatest(0D, ({ss}) / ({n}) - pow(({s}) / ({n}), 2))) ELSE 0D END"


def sdr_table(stats: DataFrame, keys: Sequence[str] = ("rule", "attr"), position: str = "bin") -> DataFrame:
    """Standard-deviation reduction of splitting after each bin or cell: prefix sums along one attribute."""
    k = ", ".join(keys)
    upto = f"(PARTITION BY {k} ORDER BY {position} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sums = stats.selectExpr(
        *keys, position,
        *[f"sum({c}) OVER {upto} AS {c}_left" for c in ("n", "sy", "syy")],
        *[f"sum({c}) OVER (PARTITION BY {k}) AS {c}" for c in ("n", "sy", "syy")],
    )
    sides = sums.filter("n > n_left").selectExpr(
        "*", f"{_sd('n', 'sy', 'syy')} AS sd", f"{_sd('n_left', 'sy_left', 'syy_left')} AS sd_left",
        f"{_sd('n - n_left', 'sy - sy_left', 'syy - syy_left')} AS sd_right",
    )
    return sides.selectExpr("*", "sd - n_left / n * sd_left - (n - n_left) / n * sd_right AS sdr")


def best_splits(
    sdr: DataFrame, keys: Sequence[str] = ("rule",), delta: float = 1e-7, tie: float = 0.05, position: str = "bin",
    least_share: float = 0.0, least_reduction: float = 0.0,
) -> DataFrame:
    """Best attribute per rule with ratio second/best SDR; expand if ratio + ε < 1, or ε < tie.

    "No split" is a candidate too: before the tie, the relative reduction sdr / sd itself has to exceed ε, which keeps
    rules over pure noise from growing.  Both sides have to hold ``least_share`` of the rows, and sdr / sd has to exceed
    ``least_reduction`` also after the tie.
    """
    k = ", ".join(keys)
    if least_share > 0:
        sdr = sdr.filter(f"least(n_left, n - n_left) >= {least_share!r}D * n")
    pick = f"row_number() OVER (PARTITION BY {k}, attr ORDER BY sdr DESC, {position})"
    w = f"(PARTITION BY {k} ORDER BY sdr DESC, attr)"
    return (
        sdr.selectExpr("*", f"{pick} AS pick")
        .filter("pick = 1")
        .drop("pick")
        .selectExpr("*", f"row_number() OVER {w} AS pick", f"coalesce(lead(sdr) OVER {w}, 0D) AS sdr2")
        .filter("pick = 1 AND sdr > 0")
        .drop("pick")
        .selectExpr("*", "greatest(0D, sdr2) / sdr AS ratio", f"{hoeffding_bound_sql(1.0, delta, 'n')} AS epsilon")
        .selectExpr("*", f"((ratio + epsilon < 1 AND sdr / sd > epsilon) OR epsilon < {tie!r}D) AND sdr / sd > {least_reduction!r}D AS expand")
    )


def quantile_stats(
    df: DataFrame, keys: Sequence[str] = ("rule",), features: str = "features", target: str = "target", cells: int = CELLS,
    offset: float = 0.0,
) -> DataFrame:
    """Quantile observers (keys, attr, x, n, sy, syy) of a table: one pass with a table of cells per task, one merger.

    Keys are integers.  Up to ``cells`` distinct values of an attribute the cells are its values and all sums are exact.
    """
    rows = df.select(*[F.col(k).cast("bigint").alias(k) for k in keys], F.col(features).alias("__x"), F.col(target).cast("double").alias("__y"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Observer] = {}
        names: dict[tuple, int] = {}
        for batch in stream:
            if not batch.num_rows:
                continue
            vectors = batch.column("__x")
            x = matrix(vectors, len(vectors[0]))
            y = batch.column("__y").to_numpy() - offset
            held = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
            distinct, place = np.unique(held, axis=0, return_inverse=True)
            group = np.array([names.setdefault(tuple(d), len(names)) for d in distinct.tolist()])[place]
            for a in range(x.shape[1]):
                seen.setdefault(a, Observer(cells)).add(group, x[:, a] + 0.0, np.zeros(len(y), dtype=np.int64), np.stack((np.ones(len(y)), y, y * y), axis=1))
        key_of = np.array(list(names), dtype=np.int64).reshape(len(names), len(keys))
        for a, observer in seen.items():
            group, x, _, sums = observer.cells()
            columns = [*key_of[group].T, np.full(len(x), a, dtype=np.int32), x, *sums.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], [*keys, "attr", "x", *CELL_SUMS])

    schema = ", ".join([*(f"{k} bigint" for k in keys), "attr int, x double, n double, sy double, syy double"])
    return merge_cells(rows.mapInArrow(run, schema), (*keys, "attr"), CELL_SUMS, k=cells)


def page_hinkley(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    position: str = "seq",
    alpha: float = 0.005,
    threshold: float = 35.0,
    span: int = BUCKET_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Page–Hinkley test per key along ``position``: adds ``m``, ``m_min`` and ``alarm`` to every row.

    m_t sums e_i − mean_i − α with the mean of the first i values.  Blocks of ``span`` positions are added up first (no row
    moves for that); with the count and sum before its block a row's terms follow from one shuffle by (key, block), whose
    result is stored.  What the blocks end with then lifts the sums of the blocks after them.  A key of any size is spread
    over tasks.  ``position`` has to be dense (see :func:`with_seq`) for blocks to fill.
    """
    keys, blocks = list(keys), [*keys, "__block"]
    base = with_block(df.select(*keys, position, *carry, F.col(value).cast("double").alias("__e")), position, span)
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*blocks).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = base.groupBy(*blocks).agg(F.count("__e").alias("__n"), F.sum("__e").alias("__s"))
    before = totals.select(
        *blocks, F.coalesce(F.sum("__n").over(across), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__s").over(across), F.lit(0.0)).alias("__s0")
    )
    mean = (F.col("__s0") + F.sum("__e").over(upto)) / (F.col("__n0") + F.count("__e").over(upto))
    terms = base.join(before, blocks).withColumn("__term", F.col("__e") - mean - alpha)
    summed = terms.withColumn("__m", F.sum("__term").over(upto)).withColumn("__low", F.min("__m").over(upto))
    local = stored(summed.select(*blocks, position, *carry, "__e", "__m", "__low"), "page-hinkley")
    ends = local.groupBy(*blocks).agg(F.max_by("__m", position).alias("__step"), F.min("__low").alias("__least"))
    begun = ends.withColumn("__m0", F.coalesce(F.sum("__step").over(across), F.lit(0.0)))
    carried = begun.select(*blocks, "__m0", F.min(F.col("__m0") + F.col("__least")).over(across).alias("__low0"))
    m = F.col("__m0") + F.col("__m")
    least = F.least(F.col("__low0"), F.col("__m0") + F.col("__low"))
    return local.join(carried, blocks).select(
        *keys, position, *carry, F.col("__e").alias(value), m.alias("m"), least.alias("m_min"), (m - least > threshold).alias("alarm")
    )


# ---------------------------------------------------------------- model


@dataclasses.dataclass
class Rule:
    """Conditions are (attr, is_le, threshold).  Sums of y are relative to the model's target offset."""

    rule: int
    conditions: list[tuple[int, bool, float]] = dataclasses.field(default_factory=list)
    n: float = 0.0
    sy: float = 0.0
    linear: list[float] | None = None
    err_mean: float = 0.0
    err_linear: float = 0.0
    ph: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    tested_at: float = 0.0


@dataclasses.dataclass(frozen=True)
class RuleParams:
    """``levels``: how many times a rule may be extended by one micro-batch.  ``cells``: positions of a quantile observer.
    Each side of a split holds ``least_share`` of the rows at least, and the deviation has to fall by more than the share
    ``least_reduction``."""

    attrs: int
    ordered: bool = True
    head: str = "adaptive"
    cells: int = CELLS
    grace: float = 200.0
    delta: float = 1e-7
    tie: float = 0.05
    least_share: float = 0.01
    least_reduction: float = 0.01
    levels: int = 2
    ph_alpha: float = 0.005
    ph_lambda: float = 35.0
    max_rules: int | None = None  # no limit unless asked for

    def __post_init__(self):
        if self.head not in ("mean", "linear", "adaptive"):
            raise ValueError(f"head: required mean, linear or adaptive but found {self.head!r}")


@dataclasses.dataclass(frozen=True)
class FlatRules:
    """A rule set as tasks use it: literals, means and weights in the order of the rules."""

    ids: np.ndarray
    conditions: list[list[tuple[int, bool, float]]]
    means: np.ndarray
    weights: np.ndarray
    linear: np.ndarray
    ordered: bool

    def matches(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, position of a rule) that apply: the first match or all, the default rule if there is none."""
        free = np.ones(len(x), dtype=bool)
        rows, rules = [], []
        for i, literals in enumerate(self.conditions[1:], 1):
            hit = free.copy() if self.ordered else np.ones(len(x), dtype=bool)
            for attr, le, threshold in literals:
                low = x[:, attr] <= threshold
                hit &= low if le else ~low  # NaN is above every threshold
            at = np.flatnonzero(hit)
            rows.append(at)
            rules.append(np.full(len(at), i))
            free[at] = False
        rest = np.flatnonzero(free)
        rows, rules = np.concatenate([*rows, rest]), np.concatenate([*rules, np.zeros(len(rest), dtype=np.int64)])
        order = np.lexsort((rules, rows))
        return rows[order], rules[order]

    def heads(self, x: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions of the mean and of the linear head, pair by pair."""
        w = self.weights[rules]
        return self.means[rules], w[:, 0] + np.einsum("ij,ij->i", w[:, 1:], x)

    def predict(self, x: np.ndarray) -> np.ndarray:
        rows, rules = self.matches(x)
        mean, linear = self.heads(x[rows], rules)
        one = np.where(self.linear[rules], linear, mean)
        return np.bincount(rows, weights=one, minlength=len(x)) / np.bincount(rows, minlength=len(x))


@dataclasses.dataclass
class RuleModel:
    """``rules[0]`` is the default rule, which covers what no other rule does.  ``stats`` is a Spark table; ``moments``
    holds one matrix of Σ z_i z_j, z = [1, x.., y − offset], per rule."""

    params: RuleParams
    rules: list[Rule]
    next_id: int = 1
    offset: float | None = None
    scale: float = 1.0
    rounds: int = 0
    stats: DataFrame | None = None
    moments: dict[int, np.ndarray] = dataclasses.field(default_factory=dict)

    @staticmethod
    def empty(params: RuleParams) -> RuleModel:
        return RuleModel(params, [Rule(0)])

    # ---- scoring

    def coverage(self, features: Column) -> Column:
        """Positions (in ``rules``) of the rules a row uses: first match or all matches; the default rule if none."""
        default = F.array(F.lit(0))
        if len(self.rules) == 1:
            return default
        return F.coalesce(F.nullif(self._matches(features), F.array().cast("array<int>")), default)

    def _matches(self, features: Column) -> Column:
        table = F.array(
            *[
                F.struct(
                    F.lit(i).alias("i"),
                    F.array(
                        *[
                            F.struct(F.lit(a).alias("a"), F.lit(le).alias("le"), F.lit(float(t)).alias("t"))
                            for a, le, t in rule.conditions
                        ]
                    ).alias("c"),
                )
                for i, rule in enumerate(self.rules)
                if i > 0
            ]
        )

        def holds(c: Column) -> Column:
            x = F.get(features, c["a"])
            return (c["le"] & (x <= c["t"])) | (~c["le"] & (x > c["t"]))

        hits = F.transform(F.filter(table, lambda r: F.forall(r["c"], holds)), lambda r: r["i"])
        return F.slice(hits, 1, 1) if self.params.ordered else hits

    def _head(self, rule: Rule) -> str:
        if self.params.head == "mean" or rule.linear is None:
            return "mean"
        if self.params.head == "linear":
            return "linear"
        return "linear" if rule.err_linear <= rule.err_mean else "mean"

    def _flat(self) -> FlatRules:
        means = [(self.offset or 0.0) + (r.sy / r.n if r.n > 0 else 0.0) for r in self.rules]
        none = [0.0] * self.params.attrs
        return FlatRules(
            np.array([r.rule for r in self.rules]), [r.conditions for r in self.rules], np.array(means),
            # A rule without a linear head gets its mean as intercept.
            np.array([r.linear if r.linear is not None else [m, *none] for r, m in zip(self.rules, means)]),
            np.array([self._head(r) == "linear" for r in self.rules]), self.params.ordered,
        )

    def score(self, df: DataFrame, features: str = "features", out: str = "pred") -> DataFrame:
        """Prediction of the first covering rule (ordered) or the mean over covering rules (unordered).

        Only the features of the rows go through Arrow.
        """
        flat = self._flat()
        if len(self.rules) == 1 and not flat.linear[0]:
            return df.withColumn(out, F.lit(float(flat.means[0])))
        shared, width = df.sparkSession.sparkContext.broadcast(flat), self.params.attrs

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            return pa.array(shared.value.predict(matrix(x, width)))

        return df.withColumn(out, predicted(features))

    # ---- learning

    def learn(
        self, df: DataFrame, features: str = "features", target: str = "target", seq: str = "seq",
        span: tuple[int, int] | None = None, where: Column | None = None,
    ) -> RuleModel:
        """Model after the rows of one micro-batch for which ``where`` holds (all without it).

        One pass gives errors, moments and cells of all rules; a second one, once there are rules, tests them for drift
        row by row.  After an expansion the batch is read again for the new rules alone; ``df`` should be stored.
        """
        p = self.params
        known = F.col(target).cast("double")
        rows = df.select(
            F.col(seq).alias("seq"), F.col(features).alias("features"),
            (known if where is None else F.when(where, known)).alias("target"),
        )
        model = dataclasses.replace(
            self, rules=[dataclasses.replace(r) for r in self.rules], rounds=self.rounds + 1, moments=dict(self.moments)
        )
        if model.offset is None:
            first = rows.agg(F.avg("target"), F.stddev_pop("target")).first()
            if first[0] is None:
                return self
            model.offset, model.scale = float(first[0]), float(first[1]) or 1.0
        before = model._flat()
        model._drop_drifting(rows, before)
        by_id = {r.rule: r for r in model.rules}
        level = counter_level(self.rounds)
        alive = F.col("rule").isin(list(by_id))
        held = None if self.stats is None else self.stats.filter(alive)
        merged = cut_lineage(merged_levels(model._observe(rows, before).filter(alive), held, level, model._merge))
        sums = merged.filter("attr < 0").collect()  # a few rows a rule
        if not sums and self.stats is None and len(by_id) == len(self.rules):
            return self
        model.stats = merged.filter("attr >= 0")
        size = p.attrs + 2
        for r in sums:
            rule = by_id[r["rule"]]
            if r["attr"] == TOTALS:
                rule.n, rule.sy = rule.n + r["n"], rule.sy + r["sy"]
            elif r["attr"] == ERRORS and any(old.n > 0 for old in self.rules):
                rule.err_mean, rule.err_linear = rule.err_mean + r["sy"], rule.err_linear + r["syy"]
            elif r["attr"] == MOMENTS:
                m = model.moments[r["rule"]] = model.moments.get(r["rule"], np.zeros((size, size))).copy()
                m[int(r["x"]) // size, int(r["x"]) % size] += r["sy"]
        model.moments = {i: m for i, m in model.moments.items() if i in by_id}
        model._update_linear()
        new = model._expand(list(by_id))
        for _ in range(p.levels - 1):
            if not new:
                break
            fresh = cut_lineage(model._merge(model._observe(rows, model._flat(), new)).withColumn("level", F.lit(level)))
            model.stats = model.stats.unionByName(fresh)
            new = model._expand(new)
        return model

    def _merge(self, cells: DataFrame) -> DataFrame:
        return merge_cells(cells, CELL_KEYS, CELL_SUMS, k=self.params.cells, whole="attr < 0")

    def _observe(self, rows: DataFrame, flat: FlatRules, only: Sequence[int] | None = None) -> DataFrame:
        """What the rows show about the rules they meet, of the rules ``only`` if given, as cells (rule, attr, x, n, sy, syy).

        Sums that belong to no attribute are cells of attributes below 0: TOTALS (n, Σy), ERRORS (of the mean and of the
        linear head) and MOMENTS (x numbers the place in the matrix).  With ``only`` there are none.
        """
        p, offset = self.params, self.offset
        shared = rows.sparkSession.sparkContext.broadcast(flat)
        upper = np.triu_indices(p.attrs + 2)

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flat = shared.value
            size = len(flat.ids)
            seen = [Observer(p.cells) for _ in range(p.attrs)]
            totals, errors = np.zeros((size, 2)), np.zeros((size, 2))
            moments = np.zeros((size, p.attrs + 2, p.attrs + 2))
            for batch in stream:
                known = batch.filter(batch.column("target").is_valid())
                if not known.num_rows:
                    continue
                x, truth = matrix(known.column("features"), p.attrs), known.column("target").to_numpy()
                at, rule = flat.matches(x)
                if only is not None:
                    kept = np.isin(flat.ids[rule], only)
                    at, rule = at[kept], rule[kept]
                x, y = x[at], truth[at] - offset
                sums = np.stack((np.ones(len(y)), y, y * y), axis=1)
                for a in range(p.attrs):
                    # Zero and minus zero are one value.
                    seen[a].add(rule, x[:, a] + 0.0, np.zeros(len(y), dtype=np.int64), sums)
                if only is not None:
                    continue
                mean, linear = flat.heads(x, rule)
                for i in np.unique(rule).tolist():
                    own = rule == i
                    totals[i] += sums[own, :2].sum(axis=0)
                    errors[i] += np.abs(truth[at][own] - mean[own]).sum(), np.abs(truth[at][own] - linear[own]).sum()
                    if p.head != "mean":
                        z = np.column_stack((np.ones(own.sum()), x[own], y[own]))
                        moments[i] += z.T @ z
            for a, observer in enumerate(seen):
                held = observer.cells()
                if held is not None and len(held[0]):
                    rule, x, _, sums = held
                    yield _batch(flat.ids[rule], a, x, *sums.T)
            met = np.flatnonzero(totals[:, 0])
            if len(met):
                yield _batch(flat.ids[met], TOTALS, 0.0, totals[met, 0], totals[met, 1], 0.0)
                yield _batch(flat.ids[met], ERRORS, 0.0, 0.0, errors[met, 0], errors[met, 1])
                if p.head != "mean":
                    i, j = (np.tile(u, len(met)) for u in upper)
                    v = moments[np.repeat(met, len(upper[0])), i, j]
                    yield _batch(np.repeat(flat.ids[met], len(upper[0])), MOMENTS, i * (p.attrs + 2.0) + j, 0.0, v, 0.0)

        return rows.mapInArrow(run, OBSERVED)

    def _drop_drifting(self, rows: DataFrame, flat: FlatRules) -> None:
        """Page-Hinkley test of every rule's scaled error, row by row in order of arrival; drifting rules go."""
        if len(self.rules) == 1 or all(r.n == 0 for r in self.rules):
            return
        states = drift_states(rows, flat, {r.rule: r.ph for r in self.rules}, self.scale, self.params.ph_alpha)
        kept = []
        for rule in self.rules:
            rise, rule.ph = states.get(rule.rule, (0.0, rule.ph))
            if rule.rule == self.rules[0].rule or rise <= self.params.ph_lambda:
                kept.append(rule)
        self.rules = kept

    def _update_linear(self) -> None:
        """Least-squares head per rule from its moments."""
        for rule in self.rules:
            m = self.moments.get(rule.rule)
            if m is not None:
                cells = [(i, j, m[i, j]) for i, j in zip(*np.triu_indices(len(m)))]
                w = solve_normal(cells, self.params.attrs)
                rule.linear = [w[0] + self.offset, *w[1:]] if w is not None and np.isfinite(w).all() else None

    def _expand(self, among: Sequence[int]) -> list[int]:
        """Grow rules whose best split is clear, and return the ids of the new ones; at most one row per rule reaches the
        driver."""
        p = self.params
        due = [r.rule for r in self.rules if r.rule in among and r.n - r.tested_at >= p.grace]
        if not due:
            return []
        for rule in self.rules:
            if rule.rule in due:
                rule.tested_at = rule.n
        cells = self.stats.filter(F.col("rule").isin(due)).repartition(*CELL_KEYS)
        cells = cells.groupBy(*CELL_KEYS, "x").agg(*[F.sum(c).alias(c) for c in CELL_SUMS])  # levels put together
        # Deviations that are rounding errors of the sums are none.
        sdr = sdr_table(cells, position="x").filter(F.col("sd") > F.lit(1e-6 * self.scale))
        table = best_splits(sdr, ("rule",), p.delta, p.tie, "x", p.least_share, p.least_reduction)
        new, gone = [], []
        for r in sorted(table.filter("expand").collect(), key=lambda r: r["rule"]):
            at = next(i for i, rule in enumerate(self.rules) if rule.rule == r["rule"])
            n_right = r["n"] - r["n_left"]
            le = r["n_left"] * r["sd_left"] ** 2 <= n_right * r["sd_right"] ** 2
            n, sy = (r["n_left"], r["sy_left"]) if le else (n_right, r["sy"] - r["sy_left"])
            old = self.rules[at]
            if at == 0 and p.max_rules is not None and len(self.rules) >= p.max_rules:
                continue
            grown = Rule(self.next_id, [*old.conditions, (r["attr"], bool(le), r["x"])], float(n), float(sy), old.linear)
            self.next_id += 1
            gone.append(old.rule)
            new.append(grown.rule)
            if at == 0:
                self.rules.append(grown)
                # What the new rule does not take stays with the default rule.
                self.rules[0] = Rule(self.next_id, n=max(0.0, old.n - n), sy=old.sy - float(sy), linear=old.linear)
                new.append(self.next_id)
                self.next_id += 1
            else:
                self.rules[at] = grown
        if gone:
            self.stats = self.stats.filter(~F.col("rule").isin(gone))
            self.moments = {i: m for i, m in self.moments.items() if i not in gone}
        return new

    # ---- state

    def table(self, spark) -> DataFrame:
        """The rule set as a table, in evaluation order."""
        rows = [
            (i, r.rule, [(a, le, float(t)) for a, le, t in r.conditions], float(r.n), float(r.sy), r.linear,
             float(r.err_mean), float(r.err_linear), [float(v) for v in r.ph], float(r.tested_at))
            for i, r in enumerate(self.rules)
        ]
        return spark.createDataFrame(rows, RULE_SCHEMA)

    @staticmethod
    def rules_from(table: DataFrame) -> list[Rule]:
        return [
            Rule(r["rule"], [(c["attr"], c["le"], c["threshold"]) for c in r["conditions"]], r["n"], r["sy"],
                 list(r["linear"]) if r["linear"] is not None else None, r["err_mean"], r["err_linear"],
                 tuple(r["ph"]), r["tested_at"])
            for r in table.orderBy("position").collect()
        ]


RULE_SCHEMA = (
    "position int, rule bigint, conditions array<struct<attr:int,le:boolean,threshold:double>>, n double, sy double, "
    "linear array<double>, err_mean double, err_linear double, ph array<double>, tested_at double"
)

MOMENTS_SCHEMA = "rule bigint, place int, v array<double>"


def moments_table(spark, moments: dict[int, np.ndarray]) -> DataFrame:
    """Rows of the moment matrices, one per rule and line."""
    return spark.createDataFrame([(i, n, line) for i, m in moments.items() for n, line in enumerate(m.tolist())], MOMENTS_SCHEMA)


def moments_from(table: DataFrame) -> dict[int, np.ndarray]:
    lines: dict[int, list] = {}
    for r in sorted(table.collect(), key=lambda r: (r["rule"], r["place"])):
        lines.setdefault(r["rule"], []).append(r["v"])
    return {i: np.array(m) for i, m in lines.items()}


# ---------------------------------------------------------------- what tasks send

# Sums that belong to no attribute.
TOTALS, ERRORS, MOMENTS = -1, -2, -3
OBSERVED = "rule bigint, attr int, x double, n double, sy double, syy double"


def _batch(rule: np.ndarray, attr: int, x, n, sy, syy) -> pa.RecordBatch:
    wide = lambda v, kind: pa.array(np.ascontiguousarray(np.broadcast_to(v, len(rule))), kind)
    columns = [pa.array(rule, pa.int64()), wide(attr, pa.int32()), *(wide(v, pa.float64()) for v in (x, n, sy, syy))]
    return pa.RecordBatch.from_arrays(columns, ["rule", "attr", "x", *CELL_SUMS])


# ---------------------------------------------------------------- drift


def _runs(seq: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of consecutive arrival numbers."""
    cuts = np.flatnonzero(np.diff(seq) != 1) + 1
    return list(zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(seq)])).tolist()))


def drift_states(
    rows: DataFrame, flat: FlatRules, states: dict[int, tuple], scale: float, alpha: float
) -> dict[int, tuple[float, tuple]]:
    """For each rule the largest rise m − min m of the batch's Page-Hinkley sums, and its state (n, Σe, m, min m) after it.

    m adds e_i − mean_i − alpha over the rows the rule meets, in order of ``seq``, with e the scaled error of the head in
    use.  Rows stay where they are: every stretch of consecutive numbers in a task gives (n, Σe), the driver adds those up
    in order, and a second pass gives each stretch's sums from its own start.  A stored batch has a few stretches per
    task; rows that lie scattered only make more of them.
    """
    if not states:
        return {}
    shared = rows.sparkSession.sparkContext.broadcast(flat)

    def errors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        flat = shared.value
        seq = batch.column("seq").to_numpy()
        x, y = matrix(batch.column("features"), flat.weights.shape[1] - 1), batch.column("target").to_numpy(zero_copy_only=False).astype(float)
        at, rule = flat.matches(x)
        mean, linear = flat.heads(x[at], rule)
        e = np.abs(y[at] - np.where(flat.linear[rule], linear, mean)) / scale
        known = ~np.isnan(e)
        at, rule, e = at[known], rule[known], e[known]
        for a, b in _runs(seq):
            own = slice(*np.searchsorted(at, (a, b)))
            yield int(seq[a]), flat.ids[rule[own]], e[own]

    def sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start, rule, e in errors(batch) if batch.num_rows else ():
                ids, place = np.unique(rule, return_inverse=True)
                n, total = np.bincount(place, minlength=len(ids)), np.bincount(place, weights=e, minlength=len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), start)), pa.array(n), pa.array(total)], ["rule", "start", "n", "s"])

    parts = sorted(rows.mapInArrow(sums, "rule bigint, start bigint, n bigint, s double").collect(), key=lambda r: r["start"])
    before: dict[tuple[int, int], tuple[float, float]] = {}
    counts = {rule: state[:2] for rule, state in states.items()}
    for r in parts:
        k, s = counts.get(r["rule"], (0.0, 0.0))
        before[(r["rule"], r["start"])] = (k, s)
        counts[r["rule"]] = (k + r["n"], s + r["s"])
    known = rows.sparkSession.sparkContext.broadcast(before)

    def walks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = []
            for start, rule, e in errors(batch) if batch.num_rows else ():
                for i in np.unique(rule).tolist():
                    own = e[rule == i]
                    k, s = known.value[(i, start)]
                    steps = np.cumsum(own - (s + np.cumsum(own)) / (k + np.arange(1, len(own) + 1)) - alpha)
                    low = np.minimum.accumulate(steps)
                    out.append((i, start, steps[-1], low[-1], steps.max(), (steps - low).max()))
            if out:
                names = ["rule", "start", "step", "low", "high", "rise"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    schema = "rule bigint, start bigint, step double, low double, high double, rise double"
    found: dict[int, tuple[float, tuple]] = {}
    for r in sorted(rows.mapInArrow(walks, schema).collect(), key=lambda r: r["start"]):
        rise, (_, _, m, low) = found.get(r["rule"], (0.0, states.get(r["rule"], (0.0, 0.0, 0.0, 0.0))))
        rise = max(rise, m + r["high"] - low, r["rise"])
        found[r["rule"]] = (rise, (*counts[r["rule"]], m + r["step"], min(low, m + r["low"])))
    return found
