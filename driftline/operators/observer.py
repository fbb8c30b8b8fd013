"""Mergeable quantile observers: the sums of what is observed, along the ordered values of an attribute.

An observer is a list of cells (x, tag, sums): all rows with a value up to x and above the cell before it.  While an
attribute has no more than ``k`` distinct values, every value is its own cell and all prefix sums are exact.  Beyond that
neighbouring cells are put together so that each holds up to one k-th of the weight, at most 2 k of them; a value that
holds more stays a cell of its own.  A single far value takes no resolution from the rest, and nothing observed is lost:
sums always add up to all rows.

Putting cells together moves values up by at most one k-th of the weight.  So that this does not add up over many batches,
observers are merged like the digits of a counter: two of one level make one of the next, and a row takes part in no
more mergers than the logarithm of the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 128


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(vectors), width)


def _starts(*changed: np.ndarray) -> np.ndarray:
    """Places at which a new run begins; each argument holds the values of sorted rows."""
    new = np.zeros(len(changed[0]), dtype=bool)
    new[:1] = True
    for v in changed:
        differs = v[1:] != v[:-1]
        if v.dtype.kind == "f":
            differs &= ~(np.isnan(v[1:]) & np.isnan(v[:-1]))
        new[1:] |= differs
    return np.flatnonzero(new)


def compact(
    group: np.ndarray, x: np.ndarray, tag: np.ndarray, sums: np.ndarray, k: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each group in order of x: all positions up to ``k`` of them (or with None), else at most 2 k cells.  The
    first sum is the weight."""
    if not len(group):
        return group, x, tag, sums
    order = np.lexsort((tag, x, group))
    group, x, tag, sums = group[order], x[order], tag[order], sums[order]
    items = _starts(group, x, tag)
    sums = np.add.reduceat(sums, items, axis=0)
    group, x, tag = group[items], x[items], tag[items]
    if k is None:
        return group, x, tag, sums
    cells = _starts(group, x)
    first = np.searchsorted(cells, _starts(group))  # first cell of each group
    sizes = np.diff(np.append(first, len(cells)))
    if sizes.max() <= k:
        return group, x, tag, sums
    weight = np.add.reduceat(sums[:, 0], cells)
    upto = np.cumsum(weight)
    before = np.repeat(np.append(0.0, upto)[first], sizes)
    total = np.repeat(np.add.reduceat(weight, first), sizes)
    own = np.arange(len(cells)) - np.repeat(first, sizes)
    share = k / np.maximum(total, 1e-300)
    # A position that holds a k-th of the weight or more ends the cell before it and its own.
    packed = (np.ceil((upto - before) * share) + np.floor((upto - before - weight) * share)).astype(np.int64)
    bucket = np.where(np.repeat(sizes, sizes) <= k, own, packed)
    merged = _starts(np.repeat(np.arange(len(first)), sizes), bucket)
    number = np.repeat(np.arange(len(merged)), np.diff(np.append(merged, len(cells))))
    edge = x[cells[np.append(merged[1:], len(cells)) - 1]]  # the largest value of each merged cell
    of_item = np.repeat(number, np.diff(np.append(cells, len(x))))
    order = np.lexsort((tag, of_item))
    of_item, tag, sums, group = of_item[order], tag[order], sums[order], group[order]
    items = _starts(of_item, tag)
    return group[items], edge[of_item[items]], tag[items], np.add.reduceat(sums, items, axis=0)


class Observer:
    """Cells of one attribute in a task: batches come in one by one and are merged like the digits of a counter."""

    def __init__(self, k: int | None):
        self.k = k
        self.levels: list[tuple | None] = []

    def add(self, group: np.ndarray, x: np.ndarray, tag: np.ndarray, sums: np.ndarray) -> None:
        held = compact(group, x, tag, sums, self.k)
        for i, there in enumerate(self.levels):
            if there is None:
                self.levels[i] = held
                return
            self.levels[i] = None
            held = compact(*(np.concatenate(p) for p in zip(there, held)), self.k)
        self.levels.append(held)

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        held = [c for c in self.levels if c is not None]
        return compact(*(np.concatenate(p) for p in zip(*held)), self.k) if held else None


def merge_cells(
    cells: DataFrame, keys: Sequence[str], sums: Sequence[str], tags: Sequence[str] = (), k: int = CELLS, whole: str = "false"
) -> DataFrame:
    """Cells of several tasks or batches as one observer per ``keys``: see :func:`compact`.

    ``sums`` are the columns that add up, the first one the weight; ``tags`` tell rows of a position apart (classes).
    Groups for which ``whole`` holds keep every position.  One exchange by ``keys``; a task has sent at most 2 k
    cells per key, so a key held by all rows is no hot key here.
    """
    names = ", ".join(keys)
    added = [F.sum(c).alias(c) for c in sums]
    rows = cells.repartition(*keys)
    summed = rows.groupBy(*keys, "x", *tags).agg(*added)
    upto = f"(PARTITION BY {names} ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    placed = summed.selectExpr(
        "*", f"sum({sums[0]}) OVER {upto} AS __upto", f"sum({sums[0]}) OVER (PARTITION BY {names}, x) AS __here", f"sum({sums[0]}) OVER (PARTITION BY {names}) AS __all",
        f"dense_rank() OVER (PARTITION BY {names} ORDER BY x) AS __rank",
    ).selectExpr("*", f"max(__rank) OVER (PARTITION BY {names}) AS __cells")
    cell = f"CASE WHEN __cells <= {k} OR ({whole}) THEN __rank ELSE cast(ceil(__upto * {k} / __all) + floor((__upto - __here) * {k} / __all) AS int) END"
    edged = placed.selectExpr("*", f"{cell} AS __cell").selectExpr("*", f"max(x) OVER (PARTITION BY {names}, __cell) AS __edge")
    joined = edged.groupBy(*keys, "__cell", F.col("__edge").alias("x"), *tags).agg(*added)
    return joined.select(*keys, "x", *tags, *sums)


def counter_level(rounds: int) -> int:
    """Level that the observers of the next batch reach after ``rounds`` batches: the digits a counter carries over."""
    n = rounds + 1
    return (n & -n).bit_length() - 1


def merged_levels(fresh: DataFrame, held: DataFrame | None, level: int, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fresh`` cells put together with the ``held`` ones of lower levels, beside those of ``level`` and above."""
    if held is None:
        return merge(fresh).withColumn("level", F.lit(level))
    lower = held.filter(F.col("level") < level).drop("level")
    both = merge(fresh.unionByName(lower) if level else fresh).withColumn("level", F.lit(level))
    return both.unionByName(held.filter(F.col("level") >= level))
