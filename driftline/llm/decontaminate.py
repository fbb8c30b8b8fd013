"""Benchmark decontamination over a stored positional inverted index of the training documents.

The index is a table of segments, one row for some megabytes of documents, as in a search engine: a segment holds, for
each term of the test set that occurs in it, the sorted list of (document, position) pairs.  Segments are built and
searched where they lie; no posting list crosses the network, so a term that makes up a third of all words is spread
over all segments.  A phrase is found by taking the posting lists of its terms from the rarest on, moving each by the
term's offset and intersecting them; most phrases are gone after the first two lists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.words import slices, words_of
from driftline.session import fresh_path

WINDOW = 13
# Bytes of document text in a segment (a longer text is a segment of its own).
SEGMENT_BYTES = 16_000_000
# Largest test set, in bytes of text and in windows (13 term numbers each), that tasks hold in memory: about 100 MB.  A
# larger one is refused, never cut.
MAX_TEST_BYTES = 200_000_000
MAX_WINDOWS = 2_000_000
# Proximity: this many of an item's rarest terms (all of a shorter one) within PROXIMITY_SPAN words.
PROXIMITY_TERMS, PROXIMITY_SPAN = 4, 24
_SHIFT = 32

SEGMENT = T.StructType(
    [
        T.StructField("words", T.ArrayType(T.LongType())),  # of each document
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),  # where each term's postings end
        T.StructField("doc", T.ArrayType(T.IntegerType())),
        T.StructField("position", T.ArrayType(T.IntegerType())),
    ]
)
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("n_near", T.LongType()),
        T.StructField(
            "near", T.ArrayType(T.StructType([T.StructField("item_id", T.StringType()), T.StructField("position", T.LongType())]))
        ),
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("words", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
_NEAR = pa.list_(pa.struct([("item_id", pa.string()), ("position", pa.int64())]))
_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("words", pa.int64())]))


class TestSet:
    """Terms and windows of the test items, as arrays.

    Window w is the terms ``flat[off[w]:off[w + 1]]`` and belongs to the items ``held[held_off[w]:held_off[w + 1]]``.
    Items without words have none.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        w = words_of([text for _, text in items])
        self.terms, number = np.unique(w.hashes(), return_inverse=True)
        self.ids = [item for item, _ in items]
        windows: dict[bytes, list[int]] = {}
        self.sets: list[np.ndarray] = []
        for i in range(len(items)):
            own = number[w.first[i] : w.first[i + 1]].astype(np.int32)
            self.sets.append(np.unique(own))
            size = min(window, len(own))
            for s in range(len(own) - size + 1) if size else ():
                holders = windows.setdefault(own[s : s + size].tobytes(), [])
                if not holders or holders[-1] != i:
                    holders.append(i)
            if len(windows) > MAX_WINDOWS:
                raise ValueError(f"the test set has more than {MAX_WINDOWS} windows")
        self.flat = np.frombuffer(b"".join(windows), dtype=np.int32)
        self.off = np.concatenate(([0], np.cumsum([len(k) // 4 for k in windows], dtype=np.int64)))
        self.held = np.array([i for h in windows.values() for i in h], dtype=np.int32)
        self.held_off = np.concatenate(([0], np.cumsum([len(h) for h in windows.values()], dtype=np.int64)))

    @classmethod
    def collect(cls, items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> TestSet:
        """Bring the test set to the driver after checking its size; it does not grow with the documents."""
        size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
        if size > MAX_TEST_BYTES:
            raise ValueError(f"the test set has {size} bytes of text, more than {MAX_TEST_BYTES}")
        rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t")).collect()
        return cls(sorted(((r["i"], bytes(r["t"]) if r["t"] is not None else None) for r in rows), key=lambda x: (x[0] is None, x[0] or "")), window)


def build_index(docs: DataFrame, tests: TestSet, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Store the index in the shared folder and return it: one row per segment, with the ``carry`` columns of its
    documents as arrays.  Only words that are terms of the test set get postings; all words count as positions."""
    spark = docs.sparkSession
    terms = spark.sparkContext.broadcast(tests.terms)
    fields = [T.StructField(f"c_{c}", T.ArrayType(docs.schema[c].dataType)) for c in carry]
    schema = T.StructType([*fields, *SEGMENT.fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, list]] = []
        size = 0
        for batch in stream:
            texts = batch.column("__text").to_pylist()
            for a, b in slices(texts, SEGMENT_BYTES):
                piece = sum(len(t or b"") for t in texts[a:b])
                if held and size + piece > SEGMENT_BYTES:
                    yield segment(held)
                    held, size = [], 0
                held.append((batch.slice(a, b - a), texts[a:b]))
                size += piece
        if held:
            yield segment(held)

    def segment(held: list[tuple[pa.RecordBatch, list]]) -> pa.RecordBatch:
        known = terms.value
        counts, number, doc, position = [], [], [], []
        base = 0
        for _, texts in held:
            for a, b in slices(texts):
                w = words_of(texts[a:b])
                h = w.hashes()
                at = np.searchsorted(known, h)
                hit = np.flatnonzero(at < len(known))
                hit = hit[known[at[hit]] == h[hit]]
                d = w.docs()[hit]
                number.append(at[hit])
                doc.append(d + base + a)
                position.append(hit - w.first[d])
                counts.append(w.counts)
            base += len(texts)
        number = np.concatenate(number)
        order = np.argsort(number, kind="stable")  # documents and positions stay in order inside a term
        present, n = np.unique(number, return_counts=True)
        arrays = [pa.chunked_array([b.column(f"__c{i}") for b, _ in held]).combine_chunks() for i in range(len(carry))]
        arrays = [a if isinstance(a, pa.Array) else pa.concat_arrays(a.chunks) for a in arrays]
        lists = [
            *arrays, pa.array(np.concatenate(counts)), pa.array(present.astype(np.int32)), pa.array(np.cumsum(n)),
            pa.array(np.concatenate(doc)[order].astype(np.int32)), pa.array(np.concatenate(position)[order].astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], schema.fieldNames()
        )

    path = fresh_path(spark, "postings")
    source = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)], F.col(text).cast("binary").alias("__text"))
    source.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of every test term in all documents: one row per test term reaches the driver."""
    sizes = index.select(
        F.posexplode("terms").alias("i", "term"), F.col("offsets")
    ).select("term", (F.get("offsets", F.col("i")) - F.coalesce(F.get("offsets", F.col("i") - 1), F.lit(0))).alias("n"))
    counts = np.zeros(n_terms, dtype=np.int64)
    for r in sizes.groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[r["term"]] = r["n"]
    return counts


class Plan:
    """In which order to search: windows and items by their rarest term, so that a segment is only asked for those whose
    rarest term it holds."""

    def __init__(self, tests: TestSet, counts: np.ndarray):
        self.counts = counts
        size = np.diff(tests.off)
        place = np.arange(len(tests.flat)) - np.repeat(tests.off[:-1], size)
        # Ties of counts go to the earlier place, as in `intersect`.
        first = np.minimum.reduceat(counts[tests.flat] * 1024 + place, tests.off[:-1]) % 1024 if len(size) else size
        rarest = tests.flat[tests.off[:-1] + first]
        self.windows = np.argsort(rarest, kind="stable")
        self.window_terms = rarest[self.windows]
        self.near: dict[int, list[tuple[int, list[int]]]] = {}
        for item, terms in enumerate(tests.sets):
            rare = sorted(terms.tolist(), key=lambda t: (counts[t], t))[:PROXIMITY_TERMS]
            if rare:
                self.near.setdefault(rare[0], []).append((item, rare))

    def windows_of(self, term: int) -> list[int]:
        return self.windows[slice(*np.searchsorted(self.window_terms, (term, term + 1)))].tolist()


def intersect(lists: dict[int, np.ndarray], window: Sequence[int], counts: np.ndarray) -> np.ndarray:
    """Starts (document << 32 | position) at which the window's terms stand one after the other."""
    order = sorted(range(len(window)), key=lambda j: (counts[window[j]], j))
    starts = None
    for j in order:
        postings = lists.get(window[j])
        if postings is None:
            return np.zeros(0, dtype=np.int64)
        moved = postings - j
        if starts is None:
            # A start before the text would move into the document before it.
            starts = moved[(postings & 0xFFFFFFFF) >= j]
        else:
            at = np.minimum(np.searchsorted(moved, starts), len(moved) - 1)
            starts = starts[moved[at] == starts]
        if not len(starts):
            break
    return starts


def near(lists: dict[int, np.ndarray], rare: list[int]) -> np.ndarray:
    """Places (document << 32 | position) of the rarest term of an item that have its other rare terms within
    PROXIMITY_SPAN words before or after them."""
    if any(t not in lists for t in rare):
        return np.zeros(0, dtype=np.int64)
    anchors = lists[rare[0]]
    for t in rare[1:]:
        other = lists[t]
        # The span begins no earlier than the document.
        at = np.searchsorted(other, np.maximum(anchors - PROXIMITY_SPAN, (anchors >> _SHIFT) << _SHIFT))
        found = other[np.minimum(at, len(other) - 1)]
        good = (at < len(other)) & (found <= anchors + PROXIMITY_SPAN) & (found >> _SHIFT == anchors >> _SHIFT)
        anchors = anchors[good]
    return anchors


def search_index(index: DataFrame, tests: TestSet, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of the index: the ``carry`` columns, exact matches and what follows from them.

    ``n_hit`` counts words inside any occurrence of a window; ``n_items`` and ``items_sha256`` (sorted ids,
    comma-joined) the items with such windows; ``contaminated`` is n_hit > 0 and 20 n_hit >= n_words; ``near``
    lists items of which the rarest terms lie close together, with the places of the rarest one, and ``n_near`` counts
    them; ``matches`` lists the window places.  An item with a null id
    counts for the hits only.
    """
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((tests, Plan(tests, term_counts(index, len(tests.terms)))))
    schema = T.StructType([*[T.StructField(c, index.schema[f"c_{c}"].dataType.elementType) for c in carry], *HITS.fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(batch.num_rows):
                yield from search(batch.slice(i, 1))

    def search(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tests, plan = shared.value
        ids = tests.ids
        column = lambda name: row.column(name).flatten().to_numpy(zero_copy_only=False)
        n_words = column("words")
        where = (column("doc").astype(np.int64) << _SHIFT) | column("position")
        stop = column("offsets")
        lists = dict(zip(column("terms").tolist(), np.split(where, stop[:-1]))) if len(stop) else {}
        items: dict[int, set[int]] = {}
        matches: dict[int, list[dict]] = {}
        spans: dict[int, list[tuple[int, int]]] = {}
        close: dict[int, list[dict]] = {}
        for term in lists:
            for i in plan.windows_of(term):
                window = tests.flat[tests.off[i] : tests.off[i + 1]].tolist()
                for at in intersect(lists, window, plan.counts).tolist():
                    d, p = at >> _SHIFT, at & 0xFFFFFFFF
                    holders = tests.held[tests.held_off[i] : tests.held_off[i + 1]].tolist()
                    spans.setdefault(d, []).append((p, p + len(window)))
                    items.setdefault(d, set()).update(holders)
                    matches.setdefault(d, []).extend({"item_id": ids[h], "start": p, "words": len(window)} for h in holders)
            for item, rare in plan.near.get(term, ()):
                for at in near(lists, rare).tolist():
                    close.setdefault(at >> _SHIFT, []).append({"item_id": ids[item], "position": at & 0xFFFFFFFF, "item": item})
        out: list[list] = [[] for _ in HITS.fields]
        for d, n in enumerate(n_words.tolist()):
            hit, reach = 0, 0
            for a, b in sorted(spans.get(d, ())):
                hit += max(0, b - max(a, reach))
                reach = max(reach, b)
            names = sorted({ids[h] for h in items.get(d, ()) if ids[h] is not None})
            digest = hashlib.sha256(",".join(names).encode()).hexdigest()
            by = sorted(close.get(d, ()), key=lambda x: (x["position"], x["item"]))
            values = (
                n, hit, len(names), digest, hit > 0 and 20 * hit >= n, len({x["item"] for x in by}),
                [{"item_id": x["item_id"], "position": x["position"]} for x in by], matches.get(d, []),
            )
            for c, v in zip(out, values):
                c.append(v)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), _NEAR, _MATCH]
        arrays = [row.column(f"c_{c}").flatten() for c in carry] + [pa.array(v, type=k) for v, k in zip(out, types)]
        yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return index.mapInArrow(run, schema)


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Build the index of ``docs`` and search it for ``items``: see :func:`build_index` and :func:`search_index`.

    A null or empty document has no words and is not contaminated; repeated rows give repeated results; without items
    nothing is.  ``carry`` names the document columns to return; results replace columns of their names.
    """
    carry = tuple(c for c in carry if c not in HITS.fieldNames())
    tests = TestSet.collect(items, item_id, item_text, window)
    return search_index(build_index(docs, tests, text, carry), tests, carry)
