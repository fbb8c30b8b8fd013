"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Tokens are counted by cell (source, language, topic).  Raking scales the cells until their sums meet the targets of all
three margins.  A document is then taken with a probability in proportion to its cell's factor, capped at 1, with the
scale set so that the expected tokens meet the budget.

Cells are combinations of *named* values: what the targets do not name counts as ``other``.  The number of cells is thus
bounded by the targets, whatever the corpus holds, and only cell sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
MAX_CELLS = 1_000_000
RAKING_ROUNDS, BUDGET_ROUNDS = 25, 25
SEED = "mix-1"
# One token is a run of digits, ASCII letters and characters beyond ASCII.
TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


def topic_by_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Name of the first rule whose pattern occurs in the text, else ``other``."""
    found = F.lit(OTHER)
    for name, pattern in reversed(rules):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(4294967296.0)


def rake(mass: np.ndarray, targets: Sequence[np.ndarray], rounds: int = RAKING_ROUNDS) -> np.ndarray:
    """Weights of the cells after ``rounds`` passes over the margins; a margin value without mass keeps none."""
    weight = mass.astype(float)
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(mass.ndim) if a != axis)
            have = weight.sum(axis=others)
            live = have > 0
            goal = np.where(live, target, 0.0)
            if not goal.sum():
                continue
            factor = np.where(live, goal / goal.sum() / np.where(live, have, 1.0), 0.0)
            weight = weight * factor.reshape([-1 if a == axis else 1 for a in range(mass.ndim)])
    return weight


def calibrate(mass: np.ndarray, factor: np.ndarray, budget: float, rounds: int = BUDGET_ROUNDS) -> np.ndarray:
    """Probabilities min(1, c * factor) with c such that the expected mass is ``budget`` (or all that has a factor)."""
    scale = budget / max(float((mass * factor).sum()), 1e-300)
    for _ in range(rounds):
        full = scale * factor >= 1.0
        open_mass = float((mass * factor)[~full].sum())
        if open_mass <= 0:
            break
        scale = max(scale, (budget - float(mass[full & (factor > 0)].sum())) / open_mass)
    return np.minimum(1.0, scale * factor)


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    keep: float = 0.5,
    text: str = "text",
    key: str = "doc_id",
    seed: str = SEED,
) -> DataFrame:
    """Every row with ``tokens``, ``weight`` (share of the mix per share of the corpus), ``prob`` and ``sampled``.

    ``targets`` maps columns of ``docs`` to the weights of their named values; ``other`` is the weight of all remaining
    values, nulls included, and 0 if not given.  ``keep`` is the share of the corpus's tokens to take.  The draw depends
    on ``key`` and ``seed``: rows that repeat an id are taken or left together, and null ids count as one id.  A text
    without tokens has a probability like its cell; an empty table gives an empty one.
    """
    if not 0 < keep <= 1:
        raise ValueError(f"keep: required a share above 0 and up to 1 but found {keep}")
    names = list(targets)
    values = [list(dict.fromkeys([*targets[n], OTHER])) for n in names]
    shape = tuple(len(v) for v in values)
    if np.prod(shape) > MAX_CELLS:
        raise ValueError(f"targets: {np.prod(shape)} cells, more than {MAX_CELLS}")
    docs = docs.drop("tokens", "weight", "prob", "sampled")

    def place(name: str, known: list[str]) -> Column:
        table = F.create_map(*chain.from_iterable((F.lit(v), F.lit(i)) for i, v in enumerate(known)))
        return F.coalesce(F.try_element_at(table, F.coalesce(F.col(name).cast("string"), F.lit(OTHER))), F.lit(known.index(OTHER)))

    cell = F.lit(0)
    for name, known in zip(names, values):
        cell = cell * len(known) + place(name, known)
    rows = docs.withColumn("tokens", tokens(F.col(text))).withColumn("__cell", cell.cast("int"))
    mass = np.zeros(int(np.prod(shape)))
    for r in rows.groupBy("__cell").agg(F.sum("tokens").alias("t")).collect():
        mass[r["__cell"]] = float(r["t"])
    mass = mass.reshape(shape)
    goals = [np.array([float(targets[n].get(v, 0.0)) for v in known]) for n, known in zip(names, values)]
    raked = rake(mass, goals)
    total = max(float(mass.sum()), 1.0)
    factor = np.divide(raked * total, mass, out=np.zeros_like(raked), where=mass > 0)
    prob = calibrate(mass, factor, keep * total)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(i, float(f), float(p)) for i, (f, p) in enumerate(zip(factor.ravel(), prob.ravel()))], "__cell int, weight double, prob double"
    )
    # Bounded by the targets (see MAX_CELLS), never by the corpus.
    joined = rows.join(F.broadcast(table), "__cell").drop("__cell")
    return joined.withColumn("sampled", uniform(F.col(key), seed) < F.col("prob"))
