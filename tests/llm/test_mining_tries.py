"""Hard negatives, exact duplicates and resampling against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftline.llm import exact_dedup, hard_negatives, resampling
from driftline.llm.words import words_of

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_negatives(rows, n_pos=5, n_neg=10, every=100):
    rows = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, l in rows]
    out = set()
    for a, own, x in rows:
        if a % every:
            continue
        score = sorted((-sum(p * q for p, q in zip(x, y)), i, l) for i, l, y in rows if i != a)
        for s, i, _ in [r for r in score if r[2] == own][:n_pos]:
            hard = [r for r in score if r[2] != own and 30 * -s <= 100 * -r[0] <= 90 * -s][:n_neg]
            out |= {(a, i, k, r[1], -s, -r[0]) for k, r in enumerate(hard, 1)}
    return out


def mined(df, **options):
    found = hard_negatives.mine(df, F.col("id") % 100 == 0, **options)
    return [tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


def clustered(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        v = centers[int(rng.integers(0, 6))] + rng.normal(size=dim) * rng.choice([0.3, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], label))
    same = rows[1][1]
    return [(i, same if i % 3 == 1 and copies else v, l) for i, v, l in rows]


@pytest.mark.parametrize("copies", [0, 1])
def test_negatives_match_brute_force(spark, copies):
    rows = clustered(700, 12, 3 + copies, copies)
    got = mined(spark.createDataFrame(rows, VECTORS).repartition(5))
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)


def test_blocks_of_anchors_and_short_lists_change_nothing(spark, monkeypatch):
    rows = clustered(620, 10, 8)
    monkeypatch.setattr(hard_negatives, "SEGMENT_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    assert set(mined(spark.createDataFrame(rows, VECTORS), block_bytes=2 * 8 * 10)) == brute_negatives(rows)


def test_index_omits_covered_dimensions_and_join_prunes():
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 41, size=(400, 16)) * np.linspace(0.2, 3, 16).astype(int).clip(1)
    a = x[:20]
    index = hard_negatives.Segment.build(np.arange(400), np.zeros(400), x, 150.0)
    assert sum(len(v) for _, v in index.lists) < x.size * 0.9
    truth = a @ x.T
    least = np.full(20, int(150 * np.sqrt((a**2).sum(1)).max()) + 1)
    q, c, s = hard_negatives.join(index, a, np.ones((20, 400), dtype=bool), least)
    assert {*zip(q.tolist(), c.tolist(), s.tolist())} == {(i, j, int(truth[i, j])) for i, j in zip(*np.nonzero(truth >= least[:, None]))}


def test_window_bounds_are_exact():
    for s in [*range(-45, 46), 10**17 + 7, 2**63 - 1, -(2**63)]:
        low, high = (int(x[0]) for x in hard_negatives.bounds(np.array([s])))
        assert low == -((-3 * s) // 10) and high == 9 * s // 10


def test_negatives_take_odd_rows(spark):
    plain = clustered(400, 6, 2)
    odd = [(0, None, 1), (100, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (7, [float("nan")] * 6, 0), (8, [float("inf")] * 6, 0), (None, [1.0] * 6, 1)]
    odd += [(300, [0.5] * 6, None), (2000, [1.0, 2.0], 1), (2100, [], 1)]
    base = [r for r in plain if r[0] not in (0, 100, 300)]
    df = spark.createDataFrame(base + base[:50] + odd, VECTORS).withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    assert set(mined(df)) == brute_negatives(base)
    assert mined(df.limit(0)) == []
    zero = [(i, [0.0] * 4, i % 2) for i in range(120)]
    assert set(mined(spark.createDataFrame(zero, VECTORS))) == brute_negatives(zero)
    huge = [(i, [float(3e38) if i % 5 else 1.0, 1.0, float(i)], i % 3) for i in range(110)]
    assert all(r[0] in (0, 100) for r in mined(spark.createDataFrame(huge, VECTORS)))


# ---------------------------------------------------------------- exact duplicates

DOCS = "doc_id bigint, text string, lang string, source string"


def brute_groups(rows, largest, fold=True):
    norm = lambda t: "".join(chr(ord(c) + 32) if fold and "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if largest else min)(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in ids:
            kept = i == best and not seen
            seen = seen or kept
            out.append((i, best, len(ids), kept, digest))
    return sorted(out, key=repr)


def shared_prefixes(rng, n):
    stems = ["", "a", "ab", "The license", "The licence", "x" * 3000, "é", "日本"]
    return [(i, rng.choice(stems) + "".join(rng.choice("abAB ") for _ in range(rng.randint(0, 3))), None, None) for i in range(n)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("limit", [60_000_000, 20_000, 1])
def test_tries_match_brute_force_also_when_they_spill(spark, keep, limit):
    rng = random.Random(limit)
    rows = shared_prefixes(rng, 400) + [(1, "Twice", None, None)] * 3 + [(None, "none", None, None)] * 2 + [(5000 + i, "HOT copy", None, None) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    got = exact_dedup.exact_duplicates(df, keep=keep, fold_case=True, trie_bytes=limit)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(rows, keep == "largest")


@pytest.mark.parametrize("limit", [20_000, 3_000, 1])
def test_trie_gives_away_its_largest_subtree(limit):
    rng = random.Random(3)
    texts = ["pre" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).replace("b", "b" * rng.randint(1, 40)) for _ in range(500)]
    trie = exact_dedup.Trie(largest=True)
    counts, away = {}, {}
    for i, t in enumerate(texts):
        t = t.encode()
        counts[t] = counts.get(t, 0) + 1
        path = trie.insert(t, "", i)
        if path:
            away.setdefault(path, []).append((t, 1))
        while trie.size > limit and (given := trie.spill("0")):
            away.setdefault(given[0], []).extend((s, n.n) for s, n in given[1])
    found = {}
    for t, n in [(s, n.n) for s, n in trie.walk(trie.root)] + [x for v in away.values() for x in v]:
        found[t] = found.get(t, 0) + n
    assert found == counts and away
    # Equal strings never lie in two places.
    kept = {s for s, _ in trie.walk(trie.root)}
    assert not kept & {t for v in away.values() for t, _ in v}
    assert sum(len(p) for p in ({t for t, _ in v} for v in away.values())) == len({t for v in away.values() for t, _ in v})

def test_trie_keeps_its_only_string():
    single = exact_dedup.Trie()
    single.insert(b"one" * 1000, "", 1)
    assert single.spill("0") is None


def test_deep_trie_needs_no_recursion():
    trie = exact_dedup.Trie()
    for n in range(3000):
        trie.insert(b"a" * n, "", n)
    assert [(len(s), node.best) for s, node in trie.walk(trie.root)] == [(n, n) for n in range(3000)]
    assert trie.spill("p")[1][0][0] == b"a"


def test_exact_duplicates_take_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.collect()]
    got = exact_dedup.exact_duplicates(odd.withColumnRenamed("lang", "kept"), keep="largest", fold_case=True, carry=("source", "kept"))
    assert got.columns == ["doc_id", "source", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.drop("source").collect()), key=repr) == brute_groups(rows, True)
    named = odd.withColumnRenamed("lang", "sha").withColumnRenamed("source", "kept").withColumn("best", F.lit(7)).withColumn("row", F.lit(8))
    left = exact_dedup.deduplicate(named)
    assert left.columns == named.columns and left.count() == 5 and {(r.best, r.row) for r in left.collect()} == {(7, 8)}
    assert exact_dedup.exact_duplicates(nothing).count() == 0 and exact_dedup.deduplicate(nothing).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(odd, keep="first")


# ---------------------------------------------------------------- resampling


def brute_resample(rows, target, plain, percent=10, max_run=1, min_words=20, buckets=10_000):
    def runs(t):
        w = plain(t)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]

    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, text in rows:
        np.add.at(s, runs(text), 1)
    for text in target:
        np.add.at(t, runs(text), 1)
    gain = [math.floor(1000 * math.log((y + 1.0) * float(s.sum() + buckets) / ((x + 1.0) * float(t.sum() + buckets)))) for x, y in zip(s, t)]
    out, order = [], []
    for n, (i, text) in enumerate(rows):
        f = runs(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(plain(text)) >= min_words:
            order.append((-score, i is None, i or 0, n))
    for rank, (*_, n) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[n][4] = rank
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize("max_run, percent", [(1, 10), (2, 35), (3, 100), (1, 0)])
def test_resample_matches_brute_force(spark, words, max_run, percent):
    rng = random.Random(max_run)
    vocabulary = [f"W{i}" for i in range(60)] + ["é" * 70, "日本", "z" * 200]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((0, 5, 19, 20, 21, 60))))) for i in range(300)]
    rows += [(None, None), (None, "a " * 25), (9000, "a " * 25), (9000, "a " * 25)]
    target = [" ".join(rng.choice(vocabulary[:20]) for _ in range(30)) for _ in range(20)] + [None, ""]
    got = resampling.resample(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"),
        percent=percent, max_run=max_run,
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(rows, target, words, percent, max_run)


def test_cutoff_is_exact_among_ties(spark):
    rng = random.Random(1)
    rows = [(rng.choice((-5, 0, 3)), rng.choice((1, 2**62, -(2**62))), n) for n in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    for draw in (1, 2, 77, 250, 499, 500):
        found = df.filter(resampling.highest(df, draw, ("a", "b", "c"))).collect()
        assert sorted(tuple(r) for r in found) == sorted(rows)[:draw]
    ranks = resampling.ranked(df, ("a", "b", "c"), 500).orderBy("__rank").collect()
    assert [tuple(r) for r in ranks] == [(*r, i) for i, r in enumerate(sorted(rows), 1)]


def test_buckets_are_checksums():
    w = words_of([("One two " + "x" * 300 + " é").encode(), b"", None, b"end"])
    owner, bucket = resampling.features(w, 2, 1000)
    want = ["one", "two", "x" * 300, "é", "end", "one two", "two " + "x" * 300, "x" * 300 + " é"]
    assert bucket.tolist() == [zlib.crc32(t.encode()) % 1000 for t in want] and owner.tolist() == [0, 0, 0, 0, 3, 0, 0, 0]


def test_resample_takes_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([("word word",)], "text string")
    named = odd.withColumnRenamed("lang", "score").withColumnRenamed("source", "__at")
    got = resampling.resample(named, items, percent=100, carry=("score", "__at", "text"))
    assert got.columns == ["doc_id", "__at", "text", "n_features", "weight", "score", "rank"] and got.count() == 8
    assert [(r.doc_id, r.rank) for r in got.filter("rank is not null").collect()] == [(6, 1)]
    assert resampling.resample(nothing, items).count() == 0
    assert resampling.resample(odd, items.limit(0)).count() == 8
    with pytest.raises(ValueError):
        resampling.resample(odd, items, percent=101)
