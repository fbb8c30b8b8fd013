"""Exact duplicates by Patricia tries.

Every text belongs to the owner that its length and content hash name.  An owner inserts the full byte strings into one
compressed radix trie: two texts are equal when they end in the same terminal node, which counts them and stores the
identifier to keep.  Before the shuffle each task runs its own rows through a small trie, so that a text which makes up a
third of all rows reaches its owner a few times a task and not once a row.

A trie has a memory bound.  Beyond it the owner gives away its largest subtree: the strings under one branch, and all
later ones that enter it, go to a table in the shared folder, and the next pass gives every such subtree an owner of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.session import stored

TRIE_BYTES = 64_000_000
COMBINE_BYTES = 16_000_000
# Text bytes of an owner on average; with uneven hashes it stays well below the bound of its trie.
OWNER_BYTES = 24_000_000
NODE_BYTES = 500  # a node without its label
# A class with more than this share of all rows is joined by broadcast; there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
BATCH_BYTES = 8_000_000
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# sub: owner of the string in the next pass (null: the counts are final).
FOUND = T.StructType(
    [
        T.StructField("sub", T.StringType()),
        T.StructField("sha", T.StringType()),
        T.StructField("text", T.BinaryType()),
        T.StructField("best", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("ties", T.LongType()),
    ]
)


@dataclass(slots=True)
class Node:
    """``label``: the bytes from the parent to here.  A terminal has ``n`` texts, ``ties`` of them with the id ``best``."""

    label: bytes
    children: dict[int, Node] = field(default_factory=dict)
    sha: str | None = None
    best: int | None = None
    n: int = 0
    ties: int = 0
    spilled: str | None = None  # the subtree was given away under this name
    cut: bool = False  # something below was given away

    def add(self, sha: str, best: int | None, n: int, ties: int, largest: bool) -> None:
        if not self.n:
            self.sha, self.best, self.ties = sha, best, ties
        elif best == self.best:
            self.ties += ties
        elif self.best is None or (best is not None and (best > self.best) == largest):
            self.best, self.ties = best, ties
        self.n += n


def common(a: bytes, b: bytes, at: int) -> int:
    """How many leading bytes ``a`` shares with ``b`` from ``at`` on: halves, compared as blocks."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed radix trie over byte strings.  An id is better if it is smaller, or larger with ``largest``; null ids
    are worse than all others."""

    def __init__(self, largest: bool = False):
        self.root, self.largest, self.size = Node(b""), largest, 0

    def insert(self, text: bytes, sha: str, best: int | None, n: int = 1, ties: int = 1) -> str | None:
        """Adds a text; returns the name of the subtree it falls into if that was given away."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += NODE_BYTES + len(child.label)
                node, at = child, len(text)
                continue
            if child.spilled is not None:
                return child.spilled
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = common(child.label, text, at)
            upper = Node(child.label[:shared], {child.label[shared]: child}, cut=child.cut)
            child.label = child.label[shared:]
            node.children[text[at]] = upper
            self.size += NODE_BYTES
            node, at = upper, at + shared
        node.add(sha, best, n, ties, self.largest)
        return None

    @staticmethod
    def walk(node: Node, prefix: bytes = b"") -> Iterator[tuple[bytes, Node]]:
        """Terminals below a node with their full strings, without recursion (a trie may be deep)."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            own = prefix + node.label
            if node.n:
                yield own, node
            stack += [(child, own) for child in node.children.values()]

    @staticmethod
    def weight(node: Node) -> int:
        stack, total = [node], 0
        while stack:
            node = stack.pop()
            total += NODE_BYTES + len(node.label)
            stack += node.children.values()
        return total

    def spill(self, name: str) -> tuple[str, list[tuple[bytes, Node]]] | None:
        """Gives away the largest subtree out of which nothing has been given yet: its name, which starts with ``name``,
        and its strings.  None if no string would stay."""
        # Nodes to look at, with the nodes above them: the root and those above earlier cuts.
        stack: list[tuple[Node, ...]] = [(self.root,)]
        whole: list[tuple[Node, ...]] = []
        kept = 0
        while stack:
            path = stack.pop()
            kept += bool(path[-1].n)
            for child in path[-1].children.values():
                if child.spilled is None:
                    (stack if child.cut else whole).append((*path, child))
            if not stack and not kept and len(whole) == 1:
                stack.append(whole.pop())  # the only one: its branches
        if not whole or len(whole) + kept < 2:
            return None
        *above, branch = max(whole, key=lambda p: (self.weight(p[-1]), p[-1].label))
        prefix = b"".join(n.label for n in above)
        strings = list(self.walk(branch, prefix))
        self.size -= self.weight(branch)
        for node in above:
            node.cut = True
        path_name = f"{name}/{hashlib.sha1(prefix + branch.label[:1]).hexdigest()}"
        above[-1].children[branch.label[0]] = Node(branch.label[:1], spilled=path_name)
        return path_name, strings


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size; the text is the third column."""
    types = pa.schema([("sub", pa.string()), ("sha", pa.string()), ("text", pa.binary()), ("best", pa.int64()), ("n", pa.int64()), ("ties", pa.int64())])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[2] or b"")
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), types)], schema=types)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), types)], schema=types)


def _inputs(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one at a time: a batch of long texts never becomes Python objects as a whole."""
    for batch in stream:
        columns = [batch.column(c) for c in ("sub", "sha", "text", "best", "n", "ties")]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def combine(rows: DataFrame, largest: bool, limit: int) -> DataFrame:
    """Equal texts of a task put together, in tries that are emptied at ``limit`` bytes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            trie = Trie(largest)
            for _, sha, text, best, n, ties in _inputs(stream):
                trie.insert(text, sha, best, n, ties)
                if trie.size > limit:
                    for own, node in trie.walk(trie.root):
                        yield None, node.sha, own, node.best, node.n, node.ties
                    trie = Trie(largest)
            for own, node in trie.walk(trie.root):
                yield None, node.sha, own, node.best, node.n, node.ties

        return _batches(found())

    return rows.mapInArrow(run, FOUND)


def own(rows: DataFrame, owners: int, largest: bool, limit: int) -> DataFrame:
    """Strings with the same ``sub`` meet in one trie.  Final terminals come out without their text (``sub`` is null),
    strings of subtrees that were given away with it."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            tries: dict[str, Trie] = {}
            total = 0
            for sub, sha, text, best, n, ties in _inputs(stream):
                trie = tries.setdefault(sub, Trie(largest))
                total -= trie.size
                away = trie.insert(text, sha, best, n, ties)
                total += trie.size
                if away is not None:
                    yield away, sha, text, best, n, ties
                while total > limit and (given := give(tries)) is not None:
                    freed, path, strings = given
                    total -= freed
                    for string, node in strings:
                        yield path, node.sha, string, node.best, node.n, node.ties
            for trie in tries.values():
                for _, node in trie.walk(trie.root):
                    yield None, node.sha, None, node.best, node.n, node.ties

        return _batches(found())

    def give(tries: dict[str, Trie]) -> tuple[int, str, list[tuple[bytes, Node]]] | None:
        # The largest trie of the task gives first; one that holds a single open string keeps it.
        for key in sorted(tries, key=lambda k: (-tries[k].size, k)):
            before = tries[key].size
            given = tries[key].spill(key)
            if given is not None:
                return before - tries[key].size, *given
        return None

    return rows.repartition(owners, "sub").mapInArrow(run, FOUND)


def classes(texts: DataFrame, keep: str = "smallest", trie_bytes: int = TRIE_BYTES, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """Distinct texts of ``texts`` (columns id, sha, text): sha, best id, number of rows, rows with that id.

    Runs passes until no subtree is left over; each pass is a stored table.
    """
    largest = keep == "largest"
    one = F.lit(1).cast("bigint")
    size = F.sum(F.octet_length("text") + NODE_BYTES)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = max(parts, -(-int(texts.agg(size).first()[0] or 0) // owner_bytes))
    start = texts.select(
        F.lit(None).cast("string").alias("sub"), "sha", "text", F.col("id").cast("bigint").alias("best"), one.alias("n"), one.alias("ties")
    )
    named = F.pmod(F.xxhash64(F.octet_length("text"), "sha"), F.lit(owners)).cast("string")
    combined = combine(start, largest, min(COMBINE_BYTES, trie_bytes)).withColumn("sub", named)
    found = stored(own(combined, owners, largest, trie_bytes), "tries")
    done = found.filter("sub IS NULL")
    while left_bytes := found.filter("sub IS NOT NULL").agg(size).first()[0]:
        left = found.filter("sub IS NOT NULL")
        found = stored(own(left, max(parts, -(-int(left_bytes) // owner_bytes)), largest, trie_bytes), "subtries")
        done = done.unionByName(found.filter("sub IS NULL"))
    return done.select("sha", "best", "n", "ties")


def with_classes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (with ``sha``) and what the tries say of their text.  The few classes that hold more than HOT_SHARE of the
    rows are broadcast; the other rows shuffle, and none of their texts can be hot."""
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > F.lit(int(total * HOT_SHARE))
    few = F.broadcast(found.filter(hot))
    return rows.join(few, "sha").unionByName(rows.join(few.select("sha"), "sha", "left_anti").join(found.filter(~hot), "sha"))


def _marked(docs: DataFrame, key: str, text: str, keep: str, fold_case: bool, carry: tuple[str, ...], trie_bytes: int, owner_bytes: int) -> DataFrame:
    """Rows under private names: id, sha, row, c0, c1, ... (the ``carry`` columns), best, n, ties, kept."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: required smallest or largest but found {keep}")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    norm = (F.translate(whole, _UPPER, _UPPER.lower()) if fold_case else whole).cast("binary")
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    texts = docs.select(F.col(key).cast("bigint").alias("id"), norm.alias("text"), *carried).withColumn("sha", F.sha2("text", 256))
    rows = stored(texts.drop("text").withColumn("row", F.monotonically_increasing_id()), "keys")
    found = stored(classes(texts.select("id", "sha", "text"), keep, trie_bytes, owner_bytes), "classes")
    # Rows that repeat with their key: the first one of them stays.
    repeated = found.filter("ties > 1")
    if repeated.limit(1).count():
        same = with_classes(rows.select("id", "sha", "row"), repeated).filter(F.col("id").eqNullSafe(F.col("best")))
        found = stored(found.join(same.groupBy("sha").agg(F.min("row").alias("first")), "sha", "left"), "classes")
    else:
        found = found.withColumn("first", F.lit(None).cast("bigint"))
    kept = F.col("id").eqNullSafe(F.col("best")) & (F.col("first").isNull() | (F.col("row") == F.col("first")))
    return with_classes(rows, found).withColumn("kept", kept)


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", fold_case: bool = False,
    carry: tuple[str, ...] = (), trie_bytes: int = TRIE_BYTES, owner_bytes: int = OWNER_BYTES,
) -> DataFrame:
    """Every row's key with the class of its text: keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, after lower-casing A-Z with ``fold_case``.  Of equal texts the row with the
    smallest (``keep="largest"``: largest) key stays; null keys come last, and of rows that share text and key one stays.
    A null text counts as empty, texts may have any length, an empty table gives an empty one.  ``key`` is an integer.
    ``carry`` names further columns to return; results replace columns of their names.
    """
    extra = tuple(c for c in carry if c != key and c not in RESULTS)
    marked = _marked(docs, key, text, keep, fold_case, extra, trie_bytes, owner_bytes)
    return marked.select(
        F.col("id").alias(key), *[F.col(f"c{i}").alias(c) for i, c in enumerate(extra)], F.col("best").alias("keep_id"),
        F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", fold_case: bool = False,
    trie_bytes: int = TRIE_BYTES, owner_bytes: int = OWNER_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that stay (see :func:`exact_duplicates`), with all their columns as they are."""
    names = tuple(docs.columns)
    marked = _marked(docs, key, text, keep, fold_case, names, trie_bytes, owner_bytes)
    return marked.filter("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
