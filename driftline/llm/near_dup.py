"""Near-duplicate classes of documents: DartMinHash signatures, banded joining, exact check, connected components.

A document is a weighted set of five-word shingles.  For the signature, darts are thrown at random but repeatably into
the region that each shingle spans (its weight by a rank axis, cut into dyadic weight cells).  Every dart carries one
of ``COORDINATES`` coordinates, and each coordinate keeps its dart of lowest rank.  Two documents agree in a coordinate
with a probability equal to their weighted Jaccard similarity, and a document costs its shingles plus about
k ln k darts, not shingles times coordinates.

Equal word sequences are one node from the start, so copies cost nothing later.  In a bucket of the banded join every
node is first compared with one hub only.  Once the components of those links are known, the pairs of a bucket that are
still in different components are compared too, chunk by chunk.  Nothing is capped and no link is lost, and near copies
of one text cost one comparison per member and bucket; only the members that are no near copy of the hub cost more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.words import Words, batches, mix, unit, words_of
from driftline.session import stored

SHINGLE = 5
THRESHOLD = 0.8
# 20 bands of 5: a pair at the threshold shares a band with probability 0.9997, one at 0.9 always for any purpose.
BANDS, ROWS = 20, 5
COORDINATES = BANDS * ROWS
# Darts expected per document: the coordinates left empty number e^-2 on average; such documents are thrown again.
DARTS = COORDINATES * (math.log(COORDINATES) + 2.0)
WEIGHTS = ("set", "damped", "count")
CHUNK_ROWS = 2_000  # nodes of a bucket that are compared at once
_DOC_SHIFT = np.uint64(44)


def _odd(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_counts(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a slice of texts: text number, 44-bit hash and count, ordered by text and hash.

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    h = w.hashes()
    odd = _odd(SHINGLE)
    n = w.counts
    long = np.flatnonzero(n >= SHINGLE)
    if len(long):
        span = n[long] - SHINGLE + 1
        at = np.repeat(w.first[long] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        values = [mix(sum((h[at + j] * odd[j] for j in range(SHINGLE)), np.zeros(len(at), np.uint64)))]
        docs = [np.repeat(long, span)]
    else:
        values, docs = [], []
    for k in range(1, SHINGLE):
        short = np.flatnonzero(n == k)
        if len(short):
            values.append(mix(sum((h[w.first[short] + j] * odd[j] for j in range(k)), np.full(len(short), k, np.uint64))))
            docs.append(short)
    if not values:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    both = (np.concatenate(docs).astype(np.uint64) << _DOC_SHIFT) | (np.concatenate(values) >> (np.uint64(64) - _DOC_SHIFT))
    both, count = np.unique(both, return_counts=True)
    return (both >> _DOC_SHIFT).astype(np.int64), both & np.uint64((1 << 44) - 1), count


def weigh(count: np.ndarray, weights: str) -> np.ndarray:
    """Integer weights: 1, 1 + floor(log2 count), or the count."""
    if weights == "set":
        return np.ones(len(count), np.int64)
    return count if weights == "count" else 1 + np.floor(np.log2(count)).astype(np.int64)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """DartMinHash of each text: an array (texts, COORDINATES) of dart numbers; rows without shingles are 0."""
    k = COORDINATES
    result = np.zeros((n_docs, k), dtype=np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    cell = _odd(64)
    todo, darts = np.flatnonzero(total > 0), DARTS
    while len(todo):
        best = np.full(n_docs * k, np.inf)
        name = np.zeros(n_docs * k, dtype=np.uint64)
        limit = np.zeros(n_docs)
        limit[todo] = darts / total[todo]
        rows = np.flatnonzero(limit[doc] > 0)
        for level in range(int(weight.max()).bit_length()):
            # Weight cell [2^level - 1, 2^(level + 1) - 1) of every element that reaches into it.
            low, width = (1 << level) - 1, float(1 << level)
            e = rows[weight[rows] > low]
            seed = mix(shingle[e] + cell[level])
            top, own, part = limit[doc[e]], doc[e] * k, (weight[e] - low) / width
            rank = np.zeros(len(e))
            while len(e):
                # The next dart of each cell: ranks are a Poisson process of the cell's width.
                seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
                rank = rank - np.log(unit(seed)) / width
                live = rank < top
                if not live.all():
                    e, seed, rank, top, own, part = (x[live] for x in (e, seed, rank, top, own, part))
                    if not len(e):
                        break
                place = mix(seed ^ np.uint64(0xA0761D6478BD642F))
                slot = own + (place % np.uint64(k)).astype(np.int64)
                better = rank < best[slot]
                if level:  # a cell that the weight fills only in part keeps the darts inside
                    better &= unit(mix(place)) < part
                hit = np.flatnonzero(better)
                hit = hit[np.argsort(-rank[hit], kind="stable")]  # the lowest rank is written last
                best[slot[hit]], name[slot[hit]] = rank[hit], seed[hit]
        full = np.isfinite(best.reshape(n_docs, k)[todo]).all(axis=1)
        result[todo[full]] = name.reshape(n_docs, k)[todo[full]]
        todo, darts = todo[~full], darts * 2.0
    return result


def bands_of(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    odd = _odd(ROWS)
    parts = sig.reshape(len(sig), BANDS, ROWS)
    return mix((parts * odd).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * odd[0])


def _nodes(w: Words, texts: list[bytes | None]) -> list[int]:
    """A 64-bit number of each text's word sequence; texts without words go by their bytes (null as empty)."""
    h = w.hashes()
    out = []
    for d, t in enumerate(texts):
        own = h[w.first[d] : w.first[d + 1]]
        data = own.tobytes() if len(own) else b"\x00" + (t or b"")
        out.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True))
    return out


def prepare(docs: DataFrame, text: str, weights: str) -> DataFrame:
    """The rows, stored once with a row number, their node and band keys."""
    added = T.StructType(
        [
            T.StructField("__node", T.LongType()),
            T.StructField("__bands", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.withColumns({"__row": F.monotonically_increasing_id(), "__bytes": F.col(text).cast("binary")})
    keep = [*docs.columns, "__row"]
    schema = T.StructType([*[rows.schema[c] for c in keep], *added.fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, "__bytes"):
            w = words_of(texts)
            doc, shingle, count = shingle_counts(w)
            weight = weigh(count, weights)
            n = len(texts)
            size = np.bincount(doc, weights=weight, minlength=n).astype(np.int64)
            keys = bands_of(signatures(doc, shingle, weight, n)).view(np.int64)
            lengths = np.where(size > 0, BANDS, 0)
            flat = pa.array(keys[size > 0].ravel())
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(_nodes(w, texts), pa.int64()), pa.ListArray.from_arrays(offsets, flat)]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return stored(rows.mapInArrow(run, schema), "near-rows")


def shingle_sets(rows: DataFrame, text: str, weights: str) -> DataFrame:
    """``node`` and the ``set`` of its shingles as 32-bit numbers; a shingle of weight n stands for n elements."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("set", T.ArrayType(T.IntegerType()))])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, "__bytes"):
            doc, shingle, count = shingle_counts(words_of(texts))
            weight = weigh(count, weights)
            unit_of = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
            flat = mix(np.repeat(shingle, weight) + (unit_of.astype(np.uint64) << _DOC_SHIFT)).astype(np.uint32)
            ends = np.cumsum(np.bincount(np.repeat(doc, weight), minlength=len(texts)))
            offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
            sets = pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("__node"), sets], ["node", "set"])

    return rows.select("__node", F.col(text).cast("binary").alias("__bytes")).mapInArrow(run, schema)


def _similar(x: str, y: str, threshold: float) -> Column:
    """Jaccard similarity of two sets reaches the threshold; the sizes alone rule out many pairs."""
    small, big = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))
    shared = F.size(F.array_intersect(x, y))
    total = F.size(x) + F.size(y)
    return (small >= F.lit(threshold) * big - F.lit(1e-9)) & (shared >= F.lit(threshold) * (total - shared) - F.lit(1e-9))


def _open_links(placed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between nodes of one bucket in different components, from ``placed`` (bucket, node, part).

    At least one end lies outside the bucket's largest component, so only those outside are compared with all.  Both
    sides of a bucket are cut to chunks of about CHUNK_ROWS nodes; every pair of chunks is a group of its own.
    """
    sizes = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    tops = sizes.groupBy("bucket").agg(F.sum("n").alias("m"), F.max(F.struct("n", "part")).alias("top"))
    tops = tops.filter(F.col("m") > F.col("top.n")).select(
        "bucket", F.col("top.part").alias("top"),
        F.ceil(F.col("m") / F.lit(CHUNK_ROWS)).alias("chunks"), F.ceil((F.col("m") - F.col("top.n")) / F.lit(CHUNK_ROWS)).alias("strays"),
    )
    rows = stored(placed.join(tops, "bucket").join(sets, "node"), "near-open-sets")

    def dealt(n: str, of: str) -> tuple[Column, Column]:
        return F.pmod(F.xxhash64("node"), F.col(n)), F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1)

    own, other = dealt("strays", "chunks")
    left = rows.filter("part != top").select("bucket", own.alias("x"), F.explode(other).alias("y"), "node", "part", "set")
    own, other = dealt("chunks", "strays")
    right = rows.select("bucket", F.explode(other).alias("x"), own.alias("y"), "node", "part", "set")

    def links(strays: pa.Table, members: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("a", "b"), cross_links(strays, members, threshold))))

    keys = ("bucket", "x", "y")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(links, "a bigint, b bigint").distinct()


def cross_links(strays: pa.Table, members: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smaller node, larger node) of a stray and a member in different components that are similar enough."""
    found: list[np.ndarray] = [np.zeros((0, 2), dtype=np.int64)]
    if strays.num_rows and members.num_rows:
        sets = members.column("set").combine_chunks()
        node, part = members.column("node").to_numpy(), members.column("part").to_numpy()
        size = np.asarray(sets.value_lengths())
        flat = sets.flatten().to_numpy()
        names, number = np.unique(flat, return_inverse=True)
        ends = np.concatenate(([0], np.cumsum(size)))
        marked = np.zeros(len(names) + 1, dtype=np.int64)
        for x, p, own in zip(*(strays.column(c).to_pylist() for c in ("node", "part")), strays.column("set").combine_chunks()):
            mine = own.values.to_numpy()
            at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
            at = at[names[at] == mine]
            marked[at] = 1
            counted = np.concatenate(([0], np.cumsum(marked[number])))
            shared = counted[ends[1:]] - counted[ends[:-1]]
            marked[at] = 0
            good = (shared >= threshold * (size + len(mine) - shared) - 1e-9) & (part != p)
            found.append(np.stack([np.minimum(node[good], x), np.maximum(node[good], x)], axis=1))
    pairs = np.concatenate(found)
    return pairs[:, 0], pairs[:, 1]


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component (``part``), for all nodes with links.

    Each round takes the smallest label among the neighbours and then the label of that label, so the number of rounds
    grows with the logarithm of the longest path; every round is a stored table.
    """
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("part")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("part").alias("near"))
        hooked = labels.join(seen, "node").select("node", "part", F.least("part", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("part").alias("far"))
        moved = stored(
            hooked.join(jump, "next").select("node", F.col("part").alias("old"), F.least("next", "far").alias("part")), "labels"
        )
        labels = moved.select("node", "part")
        if not moved.filter(F.col("old") != F.col("part")).limit(1).count():
            return labels


def _classes(docs: DataFrame, text: str, doc_id: str, weights: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The stored rows, and for each node its class: class_id, class_size and the row that is kept."""
    if weights not in WEIGHTS:
        raise ValueError(f"weights: required one of {WEIGHTS} but found {weights!r}")
    rows = prepare(docs, text, weights)
    leader = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    first_row = stored(
        rows.groupBy("__node").agg(F.min("__row").alias("__row"), F.count(F.lit(1)).alias("n"), F.min(leader).alias("leader")),
        "near-nodes",
    )
    members = stored(rows.select(F.explode("__bands").alias("bucket"), F.col("__node").alias("node")).distinct(), "near-members")
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    buckets = stored(members.join(crowded, "bucket"), "near-buckets")
    # The hub of a bucket is the node whose buckets hold most nodes: among near copies, the one the others derive from.
    reach = buckets.groupBy("node").agg(F.sum("m").alias("reach"))
    hubs = buckets.join(reach, "node").groupBy("bucket").agg(F.max(F.struct("reach", "node"))["node"].alias("hub"))
    star = buckets.join(hubs, "bucket").filter("node != hub")
    star = stored(star.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "star")

    # Shingles of the nodes that share a bucket with others, from one row of each node.
    crowd = reach.select(F.col("node").alias("__node")).join(first_row, "__node").select("__row")
    sets = stored(shingle_sets(rows.select("__row", "__node", text).join(crowd, "__row", "left_semi"), text, weights), "near-sets")
    pairs = star.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    links = stored(pairs.filter(_similar("set_a", "set_b", threshold)).select("a", "b"), "near-links")
    parts = components(links)

    # Where a bucket holds different components a link is still possible, unless its only pair was just looked at.
    placed = stored(
        buckets.filter("m > 2").join(parts, "node", "left").select("bucket", "node", F.coalesce("part", "node").alias("part")),
        "near-open",
    )
    more = stored(_open_links(placed, sets, threshold), "near-links")
    if more.limit(1).count():
        parts = components(links.union(more))

    nodes = stored(
        first_row.join(parts.withColumnRenamed("node", "__node"), "__node", "left").select(
            "__node", "n", "leader", F.coalesce("part", "__node").alias("part")
        ),
        "near-placed",
    )
    classes = nodes.groupBy("part").agg(F.min("leader").alias("leader"), F.sum("n").alias("class_size"))
    found = nodes.select("__node", "part").join(classes, "part")
    return rows, stored(
        found.select("__node", F.col("leader.id").alias("class_id"), "class_size", F.col("leader.row").alias("__kept")), "near-classes"
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", weights: str = "set", threshold: float = THRESHOLD
) -> DataFrame:
    """All rows of ``docs`` (read from a stored copy) with ``class_id``, ``class_size`` and ``kept``.

    Rows are in one class when links of similarity ``threshold`` or more connect them, or their words are equal.
    ``class_id`` is the smallest ``doc_id`` of the class (null if it has none).  Exactly one row of a class is kept:
    the one with the smallest doc_id, null ids last, and among repeated rows the first stored one.  A text without
    words is only grouped with equal texts; null counts as empty.  Columns with the names of results are replaced.
    """
    docs = docs.drop("class_id", "class_size", "kept")
    rows, found = _classes(docs, text, doc_id, weights, threshold)
    joined = rows.drop("__bands").join(found, "__node")
    return joined.select(*docs.columns, "class_id", "class_size", (F.col("__row") == F.col("__kept")).alias("kept"))


def deduplicate(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", weights: str = "set", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps: one of each class."""
    rows, found = _classes(docs, text, doc_id, weights, threshold)
    kept = found.select(F.col("__kept").alias("__row")).distinct()
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)
