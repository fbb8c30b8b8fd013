"""Resampling towards a target distribution: hashed features, importance weights, Gumbel scores, an exact cutoff.

Each feature (a run of consecutive words) falls into one of some buckets.  The logarithm of a bucket's share in the
target over its share in the corpus is its gain; a document's weight is the mean gain of its features.  Adding Gumbel
noise that follows from the document's id and taking the highest scores draws without replacement in proportion to the
weights.

The highest scores are found without a global sort.  Scores are stored once; jobs that only count rows narrow an interval
down to the cutoff, first of the score, then of the ids at that score, then of the rows of that id.  Only the selected
rows are shuffled, by ranges, for their ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.words import Words, batches, words_of
from driftline.session import stored

BUCKETS = 10_000
MIN_WORDS = 20
SEED = 2024
SCALE = 1000  # gains and noise are whole thousandths
# Points at which one job counts: 15 points are four halvings of the interval in one pass.
POINTS = 15
# Words longer than this are hashed one by one; shorter ones byte by byte, all at once.
LONG_WORD = 64
# Counted rows of the selection per range, for ranks.
RANGE_ROWS = 1_000_000
RESULTS = ("n_features", "weight", "score", "rank")
_LAST_ID = 2**63 - 1
_POSITION_BITS = 33  # of monotonically_increasing_id

_TABLE = np.zeros(256, dtype=np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _TABLE[_i] = _c


def _feed(state: np.ndarray, w: Words, at: np.ndarray) -> np.ndarray:
    """CRC-32 states (before the final inversion) after the bytes of words ``at``."""
    state = state.copy()
    start, size = w.start[at], w.end[at] - w.start[at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        word = w.buf[start[i] : start[i] + size[i]].tobytes()
        state[i] = zlib.crc32(word, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    left = np.flatnonzero(size <= LONG_WORD)
    k = 0
    while len(left):
        c = state[left]
        state[left] = _TABLE[(c ^ w.buf[start[left] + k]) & 0xFF] ^ (c >> np.uint32(8))
        k += 1
        left = left[size[left] > k]
    return state


def features(w: Words, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and buckets of all runs of 1 to ``max_run`` words: CRC-32 of the words joined by one space, modulo."""
    docs = w.docs()
    at = np.arange(len(docs))
    state = np.full(len(docs), 0xFFFFFFFF, dtype=np.uint32)
    owner, bucket = [], []
    for run in range(1, max_run + 1):
        if run > 1:
            keep = at + run - 1 < len(docs)
            keep[keep] = docs[at[keep] + run - 1] == docs[at[keep]]
            at, state = at[keep], state[keep]
            state = _TABLE[(state ^ np.uint32(32)) & 0xFF] ^ (state >> np.uint32(8))
        state = _feed(state, w, at + run - 1)
        owner.append(docs[at])
        bucket.append((state ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets)
    return np.concatenate(owner), np.concatenate(bucket)


def bucket_counts(texts: DataFrame, text: str = "text", max_run: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket.  A task sends at most one row per bucket; ``buckets`` rows reach the driver."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for _, part in batches(stream, "text"):
            sums += np.bincount(features(words_of(part), max_run, buckets)[1], minlength=buckets)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], ["bucket", "n"])

    parts = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed shares, rounded down."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of sha256('seed:key'); a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", max_run: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns with ``__words``, ``__n`` (features) and ``__weight`` (mean gain, rounded down; 0 without features)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    source = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("__text"))
    schema = source.drop("__text").withColumns({c: F.lit(0).cast("bigint") for c in ("__words", "__n", "__weight")}).schema

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch, part in batches(stream, "__text"):
            w = words_of(part)
            owner, bucket = features(w, max_run, len(gain))
            n = np.bincount(owner, minlength=len(part)).astype(np.int64)
            # Sums of whole numbers far below 2^53 are exact in doubles.
            total = np.bincount(owner, weights=gain[bucket], minlength=len(part)).astype(np.int64)
            added = [pa.array(w.counts.astype(np.int64)), pa.array(n), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *added], schema.fieldNames())

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "__words", "__n", "__weight")


def cut(rows: DataFrame, value: str, need: int) -> tuple[int, int]:
    """The smallest v with at least ``need`` rows at or below it, and how many rows lie below v.

    Every job counts the rows at or below some points of the interval that is left; no row moves.  ``need`` is at least 1
    and at most the number of rows; ``value`` is a bigint without nulls.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        step = max(1, -(-(high - low) // (POINTS + 1)))
        points = list(range(low, high, step))  # the answer is at most high
        counts = rows.agg(*[F.count(F.when(F.col(value) <= F.lit(p), True)).alias(f"n{i}") for i, p in enumerate(points)]).first()
        reached = [p for p, n in zip(points, counts) if n >= need]
        missed = [p for p, n in zip(points, counts) if n < need]
        high = min(reached, default=high)
        low = max(missed, default=low - 1) + 1
    return high, rows.filter(F.col(value) < F.lit(high)).count()


def highest(scored: DataFrame, draw: int, order: tuple[str, ...]) -> Column:
    """Predicate of the first ``draw`` rows by the bigint columns ``order``, ascending: one cutoff a column, each among
    the rows that tie in the columns before."""
    taken, tied, rows, need = F.lit(False), F.lit(True), scored, draw
    for at, name in enumerate(order):
        v, below = cut(rows, name, need)
        taken = taken | (tied & (F.col(name) < F.lit(v)))
        tied = tied & (F.col(name) == F.lit(v))
        need -= below
        rows = rows.filter(F.col(name) == F.lit(v))
        if rows.count() == need or at == len(order) - 1:
            return taken | tied
    raise ValueError("order: required at least one column")


def ranked(rows: DataFrame, order: tuple[str, ...], n: int) -> DataFrame:
    """``rank`` from 1 by ``order``: range partitions, places inside each, and the counts of the ranges before."""
    parts = max(1, -(-n // RANGE_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = stored(ranged, "ranges").withColumn("__part", F.shiftright("__at", _POSITION_BITS))
    # One row per range reaches the driver.
    before, offsets = 0, []
    for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect():
        offsets.append((r["__part"], before))
        before += r["n"]
    starts = rows.sparkSession.createDataFrame(offsets, "__part bigint, __before bigint")
    place = F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    found = placed.join(F.broadcast(starts), "__part").withColumn("__rank", F.col("__before") + place + 1)
    return found.select(*rows.columns, "__rank")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, key: str = "doc_id", text: str = "text", target_text: str = "text",
    min_words: int = MIN_WORDS, max_run: int = 1, buckets: int = BUCKETS, seed: int = SEED, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every document with n_features, weight, score and its rank in the draw (null: not drawn).

    Of the documents with at least ``min_words`` words the highest ``percent`` percent of the scores are drawn, rounded
    down; ties go to the smaller ``key`` (an integer; nulls last); rows that repeat with their key tie by their place in
    the table and are drawn one by one.  Null and empty texts have no words, weight 0 and are never drawn; an empty table
    gives an empty one.  ``carry`` names further columns of ``docs`` to return; results replace columns of their names.
    """
    if not 0 <= percent <= 100 or max_run < 1 or buckets < 1:
        raise ValueError(f"percent, max_run, buckets: required 0 to 100, 1 or more, 1 or more but found {percent}, {max_run}, {buckets}")
    extra = tuple(c for c in carry if c != key and c not in RESULTS)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), *extra)
    gain = gains(bucket_counts(docs, text, max_run, buckets), bucket_counts(target, target_text, max_run, buckets))
    weighed = weigh(rows, gain, "__text", max_run, ("__key", *extra))
    score = (F.col("__weight") + noise(F.col("__key"), seed)).cast("bigint")
    scored = stored(
        weighed.select(
            "__key", *extra, "__words", "__n", "__weight", score.alias("__score"), (-score).alias("__down"),
            F.coalesce(F.col("__key").cast("bigint"), F.lit(_LAST_ID)).alias("__id"), F.monotonically_increasing_id().alias("__row"),
        ),
        "scores",
    )
    order = ("__down", "__id", "__row")
    eligible = scored.filter(F.col("__words") >= min_words)
    draw = percent * eligible.count() // 100
    names = [F.col("__key").alias(key), *extra, F.col("__n").alias("n_features"), F.col("__weight").alias("weight"), F.col("__score").alias("score")]
    if not draw:
        return scored.select(*names, F.lit(None).cast("bigint").alias("rank"))
    chosen = (F.col("__words") >= min_words) & highest(eligible, draw, order)
    drawn = ranked(scored.filter(chosen), order, draw).select(*names, F.col("__rank").alias("rank"))
    return drawn.unionByName(scored.filter(~chosen).select(*names, F.lit(None).cast("bigint").alias("rank")))
