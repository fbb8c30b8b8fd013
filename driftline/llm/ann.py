"""Approximate nearest neighbours by cosine: inverted lists scanned with adaptive dimension sampling.

Vectors are scaled to length one, rotated at random and assigned to the nearest of some centres; the lists are stored in
order, a long one over several tasks, so one vector may be a third of all rows.  Queries come in blocks of a fixed size
that go to all tasks; vectors are not shuffled for them.  A first pass searches the lists next to each query and gives a
bound for its neighbours.  The second one probes the other lists: rotated vectors are read in blocks of columns, and after
each block a hypothesis test on the partial distance abandons the candidates that are, with high confidence, farther
than the bound.  Survivors are scored exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.session import fresh_path, stored

# Bounds of the sample on which centres are fitted, and the sample rows that a list has on average at least: the number of
# lists is the square root of the rows, or less if the sample is too small for so many.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 256_000_000
LIST_SAMPLE = 16
# The number of probed lists is calibrated on sample rows that took no part in fitting (at most a fifth of the sample).
SAMPLE_QUERIES = 300
TARGET_RECALL = 0.97
# Recall of the whole search, probes and test together, that the held-out rows have to reach; else more lists are probed.
LEAST_RECALL = 0.95
LLOYD_ROUNDS = 8
BLOCK = 16  # columns read between two tests
EPSILON = 2.1  # confidence of the test: larger drops fewer
SLAB = 1_024  # candidates between two updates of the best distances
QUERY_BYTES = 16_000_000  # vectors of the queries that are searched at a time: what the driver and every task hold
QUERY_ROWS = 256  # queries that meet a slab at a time
ROW_BLOCK = 2_048  # rows measured against all centres or calibration queries at once
SEED = 11

@dataclass
class Index:
    """What every task needs: rotation, centres and the number of lists to probe.  ``recall`` is that of the held-out queries."""

    rotation: np.ndarray
    centers: np.ndarray
    probes: int
    recall: float

    @property
    def dim(self) -> int:
        return self.rotation.shape[0]

    def turn(self, vectors: np.ndarray) -> np.ndarray:
        """Unit length, rotated."""
        return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ self.rotation

    def lists(self, turned: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the ``n`` nearest centres of each row, ties to the smaller number."""
        found = np.empty((len(turned), n), dtype=np.int64)
        for begin in range(0, len(turned), ROW_BLOCK):
            d = (self.centers**2).sum(1)[None, :] - 2.0 * turned[begin : begin + ROW_BLOCK] @ self.centers.T
            found[begin : begin + ROW_BLOCK] = d.argmin(1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, :n]
        return found


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_rows(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """One row per id: of rows that share an id the smallest vector counts."""
    taken = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    taken = taken.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    return taken.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def true_neighbours(rows: DataFrame, index: Index, asked: np.ndarray, asked_id: np.ndarray, k: int) -> np.ndarray:
    """(query, id, list) of the true ``k`` nearest rows of some turned queries, by an exact pass over all rows in blocks;
    each task keeps k rows a query."""
    shared = rows.sparkSession.sparkContext.broadcast((index, asked, asked_id))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, asked, asked_id = shared.value
        at = np.arange(len(asked))[:, None]
        best, name = np.full((len(asked), k), -np.inf), np.zeros((len(asked), k), dtype=np.int64)
        near = np.zeros((len(asked), k, index.dim))
        for batch in stream:
            if not batch.num_rows:
                continue
            ids, turned = batch.column("vec_id").to_numpy(), index.turn(vectors_of(batch))
            for begin in range(0, len(ids), ROW_BLOCK):
                block, own = turned[begin : begin + ROW_BLOCK], ids[begin : begin + ROW_BLOCK]
                score = np.concatenate((best, np.where(asked_id[:, None] == own[None, :], -np.inf, asked @ block.T)), axis=1)
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                old, new = np.minimum(top, k - 1), np.maximum(top - k, 0)
                near = np.where((top < k)[:, :, None], near[at, old], block[new])
                name = np.where(top < k, name[at, old], own[new])
                best = score[at, top]
        q, c = np.nonzero(best > -np.inf)
        if len(q):
            columns = (q, name[q, c], best[q, c], index.lists(near[q, c], 1)[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["q", "vec_id", "score", "list"])

    found = rows.mapInArrow(run, "q bigint, vec_id bigint, score double, list bigint")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    pairs = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("q", "vec_id", "list").collect()
    return np.array([tuple(r) for r in pairs], dtype=np.int64).reshape(-1, 3)


@dataclass
class HeldOut:
    """Calibration queries: vectors and ids of sample rows that took no part in fitting, and their true neighbours."""

    vectors: np.ndarray
    ids: np.ndarray
    truth: np.ndarray


def fit(rows: DataFrame, dim: int, k: int = 5, seed: int = SEED) -> tuple[Index, HeldOut]:
    """Centres from a sample of about SAMPLE_ROWS rows (or SAMPLE_BYTES) chosen by a hash of the id, probes from held-out
    rows of it.

    Neither the held-out rows nor copies of them are fitted, and their true neighbours are searched among all rows.
    """
    total = rows.count()
    share = min(1.0, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim) + 1) / max(total, 1))
    pick = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) if share < 1 else 1_000_000)
    sample = rows.filter(pick).toArrow()
    if not sample.num_rows:
        sample = rows.orderBy("vec_id").limit(1).toArrow()
    sample = sample.combine_chunks().sort_by("vec_id")
    ids = sample.column("vec_id").to_numpy()
    data = sample.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    index = Index(rotation, np.zeros((1, dim)), 1, 1.0)
    turned = index.turn(data)
    first = np.unique(np.round(turned, 9), axis=0, return_index=True)[1]
    first = first[rng.permutation(len(first))]
    held = min(SAMPLE_QUERIES, len(first) // 5)
    fitted = turned[first[held:]]
    n_lists = int(max(1, min(len(fitted) // LIST_SAMPLE, round(total**0.5))))
    index.centers = fitted[:n_lists]
    for _ in range(LLOYD_ROUNDS):
        own = index.lists(fitted, 1)[:, 0]
        size = np.bincount(own, minlength=n_lists)
        sums = np.zeros_like(index.centers)
        np.add.at(sums, own, fitted)
        index.centers = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], index.centers)
    asked = first[:held]
    known = HeldOut(data[asked], ids[asked], np.zeros((0, 3), dtype=np.int64))
    # In which probed list do the true neighbours of the held-out rows lie?
    if held and n_lists > 1:
        known.truth = true_neighbours(rows, index, turned[asked], known.ids, k)
        place = np.argsort(index.lists(turned[asked], n_lists), axis=1)
        depth = np.sort(place[known.truth[:, 0], known.truth[:, 2]])
        if len(depth):
            index.probes = int(depth[min(len(depth) - 1, int(np.ceil(TARGET_RECALL * len(depth))) - 1)]) + 1
    return index, known


def cosine(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision."""
    dot = np.einsum("ij,ij->i", queries, vectors)
    return dot / (np.sqrt(np.einsum("ij,ij->i", queries, queries)) * np.sqrt(np.einsum("ij,ij->i", vectors, vectors)))


def scan_list(
    q_turned: np.ndarray, turned: np.ndarray, allowed: np.ndarray, limit: np.ndarray, k: int, epsilon: float = EPSILON
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (query, candidate) of one list that may be among the query's k nearest, their squared distances, and the
    number of pairs that were abandoned before all columns were read.

    ``limit`` bounds the squared distance of each query; it falls as candidates come in, slab by slab.  The first block
    of columns is measured for all allowed pairs of a slab, later blocks only for pairs that passed the test
    ``partial * D / d <= (1 + epsilon / sqrt d)^2 * limit``.
    """
    n_q, dim = q_turned.shape
    best = np.full((n_q, k), np.inf)
    kept_q, kept_c, kept_d, abandoned = [], [], [], 0
    for begin in range(0, len(turned), SLAB):
        slab = turned[begin : begin + SLAB]
        block = min(BLOCK, dim)
        part = (
            (q_turned[:, :block] ** 2).sum(1)[:, None] + (slab[:, :block] ** 2).sum(1)[None, :]
            - 2.0 * q_turned[:, :block] @ slab[:, :block].T
        )
        bound = np.minimum(best[:, -1], limit)
        ok = allowed[:, begin : begin + SLAB]
        started = int(ok.sum())
        if block < dim:
            ok = ok & (part * (dim / block) <= (1.0 + epsilon / block**0.5) ** 2 * bound[:, None])
        q, c = np.nonzero(ok)
        d = np.maximum(part[q, c], 0.0)
        while block < dim:
            upper = min(block + BLOCK, dim)
            d = d + ((q_turned[q, block:upper] - slab[c, block:upper]) ** 2).sum(1)
            block = upper
            if block < dim:
                ok = d * (dim / block) <= (1.0 + epsilon / block**0.5) ** 2 * bound[q]
                q, c, d = q[ok], c[ok], d[ok]
        abandoned += started - len(q)
        ok = d <= bound[q] + 1e-9
        q, c, d = q[ok], c[ok], d[ok]
        kept_q.append(q)
        kept_c.append(c + begin)
        kept_d.append(d)
        # The k smallest distances of each query so far.
        order = np.lexsort((d, q))
        rank = np.arange(len(q)) - np.searchsorted(q[order], q[order])
        top = order[rank < k]
        fresh = np.full((n_q, k), np.inf)
        fresh[q[top], rank[rank < k]] = d[top]
        best = np.sort(np.concatenate((best, fresh), axis=1), axis=1)[:, :k]
    if not kept_q:
        return (*(np.zeros(0, dtype=np.int64),) * 2, np.zeros(0), 0)
    q, c, d = (np.concatenate(x) for x in (kept_q, kept_c, kept_d))
    good = d <= np.minimum(best[q, -1], limit[q]) + 1e-9
    return q[good], c[good], d[good], abandoned


def first_of(query: np.ndarray, score: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each query by falling score, then id."""
    order = np.lexsort((id, -score, query))
    held = query[order]
    return order[np.arange(len(order)) - np.searchsorted(held, held) < k]


@dataclass
class Block:
    """Queries of one round: they probe the lists ``order[:, begin:end]`` (a range for each query)."""

    ids: np.ndarray
    vectors: np.ndarray
    order: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    limit: np.ndarray


def probe(placed: DataFrame, index: Index, block: Block, k: int, counted: tuple | None = None) -> DataFrame:
    """The k nearest rows found of each query of a block: q, vec_id, score.  A task sends at most k rows a query."""
    shared = placed.sparkSession.sparkContext.broadcast((index, block))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, asked = shared.value
        turned_q = index.turn(asked.vectors)
        rank = np.arange(asked.order.shape[1])[None, :]
        q, at = np.nonzero((rank >= asked.begin[:, None]) & (rank < asked.end[:, None]))
        lists = asked.order[q, at]
        by_list = np.argsort(lists, kind="stable")
        lists, q = lists[by_list], q[by_list]
        limit = asked.limit.copy()
        held = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        pairs = abandoned = 0
        for batch in stream:
            if not batch.num_rows:
                continue
            ids, data, own = batch.column("vec_id").to_numpy(), vectors_of(batch), batch.column("list").to_numpy()
            turned = index.turn(data)
            edges = np.flatnonzero(np.diff(own, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                here = q[slice(*np.searchsorted(lists, (own[a], own[a] + 1)))]
                for begin in range(0, len(here), QUERY_ROWS):
                    some = here[begin : begin + QUERY_ROWS]
                    allowed = asked.ids[some][:, None] != ids[a:b][None, :]
                    x, c, _, dropped = scan_list(turned_q[some], turned[a:b], allowed, limit[some], k)
                    pairs, abandoned = pairs + int(allowed.sum()), abandoned + dropped
                    x, c = some[x], c + a
                    found = (x, ids[c], cosine(asked.vectors[x], data[c]))
                    held = [np.concatenate(v) for v in zip(held, found)]
                if len(held[0]) > 4 * k * len(asked.ids):
                    held, limit = tighten(held, limit)
            held, limit = tighten(held, limit)
        if counted is not None:
            counted[0].add(pairs)
            counted[1].add(abandoned)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in held], ["q", "vec_id", "score"])

    def tighten(held: list[np.ndarray], limit: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The k best of each query; a query that has k takes their worst as its bound."""
        top = first_of(held[0], held[2], held[1], k)
        held = [v[top] for v in held]
        number = np.bincount(held[0], minlength=len(limit))
        worst = np.full(len(limit), np.inf)
        np.minimum.at(worst, held[0], held[2])
        # Squared distance of unit vectors, with room for rounding.
        return held, np.where(number >= k, np.minimum(limit, 2.0 - 2.0 * worst + 1e-9), limit)

    return placed.mapInArrow(run, "q bigint, vec_id bigint, score double")


def nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(
    placed: DataFrame, index: Index, sizes: np.ndarray, ids: np.ndarray, vectors: np.ndarray, member: np.ndarray, k: int,
    counted: tuple | None = None,
) -> DataFrame:
    """The nearest rows of some queries: q (their place), vec_id, score, rank.  ``member`` tells which queries are rows."""
    order = index.lists(index.turn(vectors), len(index.centers))
    # The first list at which those so far hold k rows beside the query's own.
    enough = (np.cumsum(sizes[order], axis=1) < (k + member)[:, None]).sum(1) + 1
    end = np.minimum(np.maximum(enough, index.probes), len(index.centers))
    zero, open_ = np.zeros(len(ids), dtype=np.int64), np.full(len(ids), np.inf)
    near = np.minimum(enough, end)
    first = stored(nearest(probe(placed, index, Block(ids, vectors, order, zero, near, open_), k, counted), k), "near-rows")
    limit = open_.copy()
    for r in first.filter(F.col("rank") == k).select("q", "score").collect():  # one row a query of the block
        limit[r["q"]] = 2.0 - 2.0 * r["score"] + 1e-9
    rest = probe(placed, index, Block(ids, vectors, order, near, end, limit), k, counted)
    return nearest(first.drop("rank").unionByName(rest), k)


def search(
    rows: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", index: Index | None = None,
    report: dict | None = None, query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """For each query its ``k`` nearest rows found: query_id, rank, vec_id, score.

    ``queries`` has the columns of ``rows``; a row with the query's id is never its neighbour.  Rows that :func:`usable`
    refuses, with a null id or with another number of components than most rows take no part; rows that share an id are
    one row, among the queries too.  Ties go to the smaller vec_id.  A query whose probed lists hold fewer than k other
    rows goes on to its next lists until they hold as many, so fewer than k rows are returned only if there are no more.
    ``index`` takes the place of a fitted and calibrated one.  ``report`` is filled with lists, probes, the recall of the held-out rows, and pairs begun and abandoned.
    """
    spark = rows.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    base = stored(usable_rows(rows, vec_id, vector), "vectors")
    common = base.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = index.dim if index else common["dim"]
    base = base.filter(F.size("vector") == dim)
    known = None
    if index is None:
        index, known = fit(base, dim, k)
    shared = spark.sparkContext.broadcast(index)

    def assign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                near = shared.value.lists(shared.value.turn(vectors_of(batch)), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(near)], ["vec_id", "vector", "list"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = base.mapInArrow(assign, "vec_id bigint, vector array<double>, list bigint")
    placed = stored(placed.repartitionByRange(parts, "list", F.xxhash64("vec_id")).sortWithinPartitions("list"), "lists")
    sizes = np.zeros(len(index.centers), dtype=np.int64)
    for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a list
        sizes[r["list"]] = r["n"]
    if known is not None and len(known.truth):
        want = {(q, i) for q, i, _ in known.truth.tolist()}
        while True:
            got = search_block(placed, index, sizes, known.ids, known.vectors, np.ones(len(known.ids), dtype=np.int64), k).select("q", "vec_id").collect()
            index.recall = len(want & {(r["q"], r["vec_id"]) for r in got}) / len(want)
            if index.recall >= LEAST_RECALL or index.probes >= len(index.centers):
                break
            index.probes = min(len(index.centers), index.probes + max(1, index.probes // 4))
    counted = (spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0))
    wanted = usable_rows(queries, vec_id, vector).filter(F.size("vector") == dim)
    wanted = stored(wanted.join(base.select(F.col("vec_id"), F.lit(1).alias("member")), "vec_id", "left"), "queries")
    path, last = fresh_path(spark, "neighbours"), None
    spark.createDataFrame([], schema).write.parquet(path)
    while True:
        part = wanted if last is None else wanted.filter(F.col("vec_id") > F.lit(last))
        held = part.orderBy("vec_id").limit(max(1, query_bytes // (8 * dim))).toArrow().combine_chunks()
        if not held.num_rows:
            break
        ids = held.column("vec_id").to_numpy()
        last = int(ids[-1])
        data = held.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        member = held.column("member").fill_null(0).to_numpy().astype(np.int64)
        found = search_block(placed, index, sizes, ids, data, member, k, counted)
        names = spark.createDataFrame(list(enumerate(ids.tolist())), "q bigint, query_id bigint")
        found.join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    if report is not None:
        report.update(lists=len(index.centers), probes=index.probes, recall=index.recall, pairs=counted[0].value, abandoned=counted[1].value)
    return spark.read.schema(schema).parquet(path)
