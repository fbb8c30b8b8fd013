"""Hard negatives by threshold joins: rows of another label that score well below, but not far below, an anchor's positives.

Scores are integer inner products.  An anchor's pairs above a threshold come from an inverted index in the manner of L2AP:
dimensions have one order for all rows, by rising energy; a row's leading dimensions are left out of the index as long as
the norm over them is too small to reach any threshold of the round; posting lists are read from the last dimension
back, and a pair goes on accumulating only while its partial score plus the product of the norms that remain can reach
the anchor's threshold.  What is left is scored exactly.

Thresholds start high and are lowered, for the anchors whose windows are not full yet, until every window holds its
number of rows or its lower end is reached.  Anchors are taken in blocks of a fixed size that go to all tasks; rows are
never shuffled for the join, and each task returns at most the wanted number of rows per window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.session import fresh_path, stored

POSITIVES, NEGATIVES = 5, 10
# A window reaches from LOW to HIGH tenths of the positive score.
LOW, HIGH = 3, 9
# Bytes of the anchors of one block: the bound of what is broadcast and of what the driver holds at a time.
BLOCK_BYTES = 16_000_000
SEGMENT_ROWS = 4_096  # rows of one index in a task
ANCHOR_ROWS = 64  # anchors that are joined with an index at a time
CHECK = 4  # dimensions between two looks at the bounds
PAIR_SHARE = 0.25  # below this share of live pairs they are followed one by one
# Thresholds of the rounds: for positives as shares of the largest possible score (the last takes all rows), for windows
# as shares of their height from the upper end (the last is the whole window).
POSITIVE_STEPS = (0.5, 0.3, 0.15, -1.0)
WINDOW_STEPS = (0.1, 0.4, 1.0)
SCALE = 256


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def whole_rows(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """One row per id that takes part: id, label, components as whole numbers.  Of rows that share an id the smallest
    (label, components) counts, so that a row that repeats is one row."""
    double = F.col(vector).cast("array<double>")
    whole = F.transform(double, lambda x: F.floor(x * SCALE))
    taken = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("x"), usable(double).alias("ok"))
    taken = taken.filter(F.col("ok") & F.col("id").isNotNull() & F.col("label").isNotNull())
    return taken.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


@dataclass
class Segment:
    """An inverted index over some rows, dimensions in the common order.  ``lists[j]`` holds rows and values of dimension
    j without the omitted ones; ``before[:, j]`` is a row's norm over the dimensions before j, ``omitted`` the number of its
    leading dimensions that are in no list."""

    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    before: np.ndarray
    omitted: np.ndarray
    lists: list[tuple[np.ndarray | slice, np.ndarray]]

    @classmethod
    def build(cls, id: np.ndarray, label: np.ndarray, x: np.ndarray, least: float) -> Segment:
        """``least`` is the smallest threshold of the round over its anchor's norm: a norm below it reaches none."""
        values = x.astype(np.float64)
        before = np.zeros((len(x), x.shape[1] + 1))
        np.sqrt(np.cumsum(values**2, axis=1), out=before[:, 1:])
        omitted = (before[:, 1:] * (1 + 1e-9) < least).sum(1)
        lists = []
        for j in range(x.shape[1]):
            kept = np.flatnonzero(omitted <= j)
            lists.append((slice(None), values[:, j]) if len(kept) == len(x) else (kept, values[kept, j]))
        return cls(id, label, x, before, omitted, lists)


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows; whole numbers beyond 64 bits are cut to their range."""
    if not len(a):
        return np.zeros(0, dtype=np.int64)
    if float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1]) < 2.0**62:
        return np.einsum("ij,ij->i", a, x)
    exact = (a.astype(object) * x.astype(object)).sum(axis=1)
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in exact], dtype=np.int64)


def join(index: Segment, a: np.ndarray, allowed: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row) allowed and with a score of at least the anchor's threshold, and the scores."""
    dims = a.shape[1]
    av = a.astype(np.float64)
    rest = np.zeros((len(a), dims + 1))
    np.sqrt(np.cumsum(av**2, axis=1), out=rest[:, 1:])
    # Sums in doubles are off by far less than this.
    goal = least - 1e-9 * (1.0 + rest[:, -1] * index.before[:, -1].max(initial=0.0))
    part = np.zeros((len(a), len(index.id)))
    alive = allowed & (rest[:, -1:] * index.before[:, -1] >= goal[:, None])
    j = dims
    while j and alive.mean() > PAIR_SHARE:
        for _ in range(min(CHECK, j)):
            j -= 1
            at, values = index.lists[j]
            part[:, at] += av[:, j, None] * values
        # What is not in the sum of a row: its dimensions before j, or all that the index omits.
        left = np.maximum(index.omitted, j)
        alive &= part + rest[:, left] * index.before[np.arange(len(left)), left] >= goal[:, None]
    q, c = np.nonzero(alive)
    partial = part[q, c]
    ended = index.omitted[c] > j  # nothing more of them in the lists: they are scored
    out, (q, c, partial) = [(q[ended], c[ended])], (v[~ended] for v in (q, c, partial))
    while j and len(q):
        lower = max(0, j - CHECK)
        partial = partial + np.einsum("ij,ij->i", av[q, lower:j], index.x[c, lower:j])
        j = lower
        live = partial + rest[q, j] * index.before[c, j] >= goal[q]
        q, c, partial = q[live], c[live], partial[live]
    out.append((q, c))
    q, c = (np.concatenate(v) for v in zip(*out))
    s = scores(a[q], index.x[c])
    good = s >= least[q]
    return q[good], c[good], s[good]


def first_of(group: np.ndarray, score: np.ndarray, id: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each group by falling score, then id."""
    order = np.lexsort((id, -score, group))
    held = group[order]
    return order[np.arange(len(order)) - np.searchsorted(held, held) < n]


def segments(stream: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in stream:
        for begin in range(0, batch.num_rows, SEGMENT_ROWS):
            part = batch.slice(begin, SEGMENT_ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield part.column("id").to_numpy(), part.column("label").to_numpy(), x[:, order]


@dataclass
class Asked:
    """Anchors of a round.  Window w belongs to ``anchor[w]`` and takes the first ``n`` rows with ``low`` <= score <=
    ``high``; ``least`` is the threshold of each anchor, ``same`` whether its label is asked for or all others."""

    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    least: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    n: int
    same: bool
    order: np.ndarray


def search(rows: DataFrame, asked: Asked) -> DataFrame:
    """The first rows of each window at or above the thresholds: window, id, score, rank."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = shared.value
        norm = np.sqrt((ask.x.astype(np.float64) ** 2).sum(1))
        by_label = np.argsort(ask.label, kind="stable") if ask.same else np.arange(len(ask.id))
        # The windows of anchor q are those from first[q] to first[q + 1].
        first = np.searchsorted(ask.anchor, np.arange(len(ask.id) + 1))
        window, id, score = (np.zeros(0, dtype=np.int64) for _ in range(3))
        for row_id, row_label, x in segments(stream, ask.order):
            least = float(np.min(np.where(norm > 0, ask.least / np.maximum(norm, 1e-300), -np.inf)))
            index = Segment.build(row_id, row_label, x, least)
            parts = [(window, id, score)]
            for begin in range(0, len(by_label), ANCHOR_ROWS):
                block = by_label[begin : begin + ANCHOR_ROWS]
                alike = ask.label[block][:, None] == row_label[None, :]
                allowed = (alike if ask.same else ~alike) & (ask.id[block][:, None] != row_id[None, :])
                q, c, s = join(index, ask.x[block], allowed, ask.least[block])
                q = block[q]
                # A pair counts in each window of its anchor that holds its score.
                size = first[q + 1] - first[q]
                w = np.repeat(first[q], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                c, s = np.repeat(c, size), np.repeat(s, size)
                good = (s >= ask.low[w]) & (s <= ask.high[w])
                w, c, s = w[good], c[good], s[good]
                top = first_of(w, s, row_id[c], ask.n)
                parts.append((w[top], row_id[c[top]], s[top]))
            window, id, score = (np.concatenate(p) for p in zip(*parts))
            top = first_of(window, score, id, ask.n)
            window, id, score = window[top], id[top], score[top]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (window, id, score)], ["window", "id", "score"])

    found = rows.mapInArrow(run, "window bigint, id bigint, score bigint")
    order = Window.partitionBy("window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= asked.n)


def bounds(score: np.ndarray, low: int = LOW, high: int = HIGH) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score between ``low`` and ``high`` tenths of the given scores, without leaving 64 bits."""
    whole, tenth = score // 10, score % 10
    return whole * low + -((-tenth * low) // 10), whole * high + tenth * high // 10


def positives(rows: DataFrame, base: Asked, largest: float, n: int = POSITIVES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``n`` other rows of each anchor's label: places of anchors, ids and scores, in order of the anchors."""
    top = np.sqrt((base.x.astype(np.float64) ** 2).sum(1)) * largest
    everything = np.full(len(base.id), -(2**63), dtype=np.int64)
    open_, done = np.arange(len(base.id)), []
    for step in POSITIVE_STEPS:
        least = everything if step < 0 else np.minimum(np.floor(top * step), 2.0**62).astype(np.int64)
        m = len(open_)
        ask = Asked(
            base.id[open_], base.label[open_], base.x[open_], least[open_], np.arange(m), base.id[open_], everything[open_],
            np.full(m, 2**63 - 1, dtype=np.int64), n, True, base.order,
        )
        found = search(rows, ask).select("window", "id", "score").toPandas()  # at most n rows an anchor of the block
        full = np.bincount(found["window"], minlength=m) == n if step >= 0 else np.ones(m, dtype=bool)
        found = found[full[found["window"].to_numpy(dtype=np.int64)]]
        done.append((open_[found["window"].to_numpy(dtype=np.int64)], found["id"].to_numpy(dtype=np.int64), found["score"].to_numpy(dtype=np.int64)))
        open_ = open_[~full]
        if not len(open_):
            break
    place, id, score = (np.concatenate(p) for p in zip(*done))
    order = np.lexsort((id, -score, place))
    return place[order], id[order], score[order]


def negatives(rows: DataFrame, base: Asked, place: np.ndarray, name: np.ndarray, score: np.ndarray, n: int, path: str) -> int:
    """Write the first ``n`` rows of other labels in each positive's window below ``path``; returns the number of rounds."""
    low, high = bounds(score)
    open_ = np.flatnonzero(low <= high)
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, window bigint, done boolean"
    for round_, step in enumerate(WINDOW_STEPS):
        if not len(open_):
            return round_
        goal = low[open_] if step >= 1 else high[open_] - np.floor((high[open_] - low[open_]) * step).astype(np.int64)
        used, anchor = np.unique(place[open_], return_inverse=True)
        least = np.full(len(used), 2**63 - 1, dtype=np.int64)
        np.minimum.at(least, anchor, goal)
        ask = Asked(
            base.id[used], base.label[used], base.x[used], least, anchor, name[open_], np.maximum(low[open_], least[anchor]),
            high[open_], n, False, base.order,
        )
        found = stored(search(rows, ask), "window-rows")
        count = np.zeros(len(open_), dtype=np.int64)
        for r in found.groupBy("window").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a window of the block
            count[r["window"]] = r["n"]
        done = (count == n) | (least[anchor] <= low[open_])
        names = rows.sparkSession.createDataFrame(
            list(zip(*(x.tolist() for x in (base.id[place[open_]], name[open_], score[open_], np.arange(len(open_)), done)))), schema
        )
        kept = found.join(F.broadcast(names.filter("done")), "window")
        kept.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode(
            "append"
        ).parquet(path)
        open_ = open_[~done]
    return len(WINDOW_STEPS)


def mine(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each anchor and each of its positives the hard negatives: anchor_id, positive_id, rank, negative_id and scores.

    ``anchors`` is a predicate over ``id`` and ``label`` of the rows.  Rows with a null id, label, vector or component or
    with a non-finite component take no part, nor do vectors of another length than most rows have.  Rows of one id are
    one row (:func:`whole_rows`).  An anchor without another row of its label has no result; a zero vector scores 0.
    Ties go to the smaller id; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    source = rows.select(F.col(vec_id).alias("id"), F.col(vector).alias("x"), (F.col(label) if isinstance(label, str) else label).alias("label"))
    base = whole_rows(source, "id", "x", "label")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = stored(base.repartition(parts, "id"), "whole-rows")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    sizes = base.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None or not sizes["dim"]:
        return spark.createDataFrame([], schema)
    dim = sizes["dim"]
    base = base.filter(F.size("x") == dim)
    # Energy of the dimensions and the largest norm: one row per dimension.
    energy = base.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("double") ** 2).alias("e"))
    order = np.array([r["j"] for r in energy.orderBy("e", "j").collect()], dtype=np.int64)
    largest = base.agg(F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))).first()[0] ** 0.5
    path = fresh_path(spark, "negatives")
    spark.createDataFrame([], schema).write.parquet(path)
    block, last = max(1, block_bytes // (8 * dim)), None
    wanted = base.filter(anchors)
    while True:
        part = wanted if last is None else wanted.filter(F.col("id") > F.lit(last))
        held = part.orderBy("id").limit(block).collect()
        if not held:
            return spark.read.schema(schema).parquet(path)
        last = held[-1]["id"]
        x = np.array([r["x"] for r in held], dtype=np.int64)[:, order]
        id, own = (np.array([r[c] for r in held], dtype=np.int64) for c in ("id", "label"))
        empty = np.zeros(0, dtype=np.int64)
        asked = Asked(id, own, x, empty, empty, empty, empty, empty, 0, True, order)
        place, name, score = positives(base, asked, largest, n_positives)
        negatives(base, asked, place, name, score, n_negatives, path)
