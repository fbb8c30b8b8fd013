"""Near duplicates, decontamination and vector search against brute force."""

import hashlib
import random

import numpy as np
import pytest

from driftline.llm import ann, decontaminate, near_dup, words


def brute_classes(rows, plain):
    sets = {i: ({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else {("", t or "")}) for i, t in rows for w in [plain(t)]}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            k = len(sets[a] & sets[b])
            if k and k >= 0.8 * (len(sets[a]) + len(sets[b]) - k):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(rng, base, share):
    return [w if rng.random() > share else f"x{rng.randint(0, 9999)}" for w in base]


def test_classes_match_all_pairs(spark, words):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (1, 3, 5, 40, 120, 300):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for share in (0, 0, 0.004, 0.01, 0.02, 0.05, 0.3):
            rows.append((n, " ".join(edited(rng, base, share))))
            n += 1
    rows += [(n, ""), (n + 1, None), (n + 2, "!!"), (n + 3, "!!")]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == brute_classes(rows, words)
    assert sorted(r.doc_id for r in found if r.kept) == sorted({r.class_id for r in found})


def test_a_large_group_keeps_its_links(spark, words):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 900)}" for _ in range(200)]
    rows = [(i, " ".join(edited(rng, base, 0.01))) for i in range(120)] + [(500 + i, " ".join(base)) for i in range(40)]
    rows += [(1000 + i, " ".join(base[:30] + [f"y{i}_{j}" for j in range(120)])) for i in range(30)]  # share a passage only
    found = {r.doc_id: r for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    truth = brute_classes(rows, words)
    assert {i: r.class_id for i, r in found.items()} == truth
    assert max(r.class_size for r in found.values()) > 140
    assert all(found[1000 + i].class_size == 1 for i in range(30))
    kept = near_dup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(truth.values()))


def test_near_duplicates_take_odd_rows(odd, nothing):
    rows = near_dup.near_duplicates(odd.withColumnRenamed("source", "class_id")).collect()
    assert len(rows) == 8 and sum(r.kept for r in rows if r.doc_id == 1) == 1
    assert near_dup.deduplicate(odd).count() == 5  # words, words, other, empty (three rows), "...!!", repeated rows once
    assert near_dup.near_duplicates(nothing).count() == 0
    with pytest.raises(ValueError):
        near_dup.near_duplicates(odd, weights="idf")


@pytest.mark.parametrize("weights", ["set", "count"])
def test_signatures_agree_as_often_as_sets_overlap(weights):
    rng = np.random.default_rng(1)
    weight = rng.integers(1, 9, 1500) if weights == "count" else np.ones(1500, int)
    other = np.where(rng.random(1500) < 0.2, rng.integers(1, 9, 1500), weight) if weights == "count" else weight
    a, b = np.arange(0, 1350), np.arange(150, 1500)
    shared = np.minimum(weight[150:1350], other[150:1350]).sum()
    truth = shared / (weight[a].sum() + other[b].sum() - shared)
    same = []
    for seed in range(40):
        names = words.mix(np.arange(1500, dtype=np.uint64) + np.uint64(10_000 * seed)) & np.uint64((1 << 44) - 1)
        sig = near_dup.signatures(np.repeat([0, 1], 1350), np.concatenate((names[a], names[b])), np.concatenate((weight[a], other[b])), 2)
        assert (sig != 0).all()
        same.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(same) - truth) < 0.03


def brute_windows(docs, items, plain):
    windows = {}
    for item, text in items:
        w = plain(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, names = plain(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    names |= windows[tuple(w[i : i + k])]
        ids = sorted(str(x) for x in names if x is not None)
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_decontamination_matches_brute_force(spark, words):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(n))) for i, n in enumerate((0, 1, 3, 12, 13, 14, 40, 60))]
    items += [(None, "zz yy"), (20, None)]
    docs = []
    for i in range(60):
        w = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            piece = items[rng.randint(3, 7)][1].split()
            at = rng.randint(0, len(piece))
            w[5:5] = piece[at : at + 20]
        docs.append((i, " ".join(w) + (" zz yy" if i % 7 == 0 else "")))
    docs += [(100, None), (101, "")]
    got = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == brute_windows(docs, items, words)
    for r in got:
        text = words(dict(docs)[r.doc_id])
        for m in r.matches:
            assert m.start + m.words <= len(text)


def test_proximity_and_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "delta x gamma y beta z alpha"), (2, "alpha " + "x " * 90 + "beta gamma delta epsilon"), (3, "other")], "doc_id long, text string"
    )
    near = {r.doc_id: r.n_near for r in decontaminate.decontaminate(docs, items).collect()}
    assert near[2] == 0 and near[3] == 0
    assert decontaminate.decontaminate(odd, items).count() == 8
    assert decontaminate.decontaminate(nothing, items).count() == 0
    none = decontaminate.decontaminate(odd, items.limit(0)).collect()
    assert len(none) == 8 and not any(r.contaminated for r in none)
    clash = decontaminate.decontaminate(odd.withColumnRenamed("source", "n_hit"), items, carry=("doc_id", "n_hit"))
    assert clash.columns.count("n_hit") == 1 and {r.n_hit for r in clash.collect()} == {0}


def test_proximity_matches_brute_force(spark, words, monkeypatch):
    rng = random.Random(21)
    monkeypatch.setattr(decontaminate, "PROXIMITY_SPAN", 3)
    vocabulary = [f"t{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 5)))) for i in range(8)]
    count = {t: sum(words(d).count(t) for _, d in docs) for t in vocabulary}
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for r in got.collect():
        own = words(dict(docs)[r.doc_id])
        found = set()
        for item, text in items:
            order = sorted(set(words(text)), key=lambda t: count[t])
            if len({count[t] for t in order}) < len(order):
                found = None  # ties of counts have an order of their own
                break
            rare = order[:4]
            for p, t in enumerate(own):
                if t == rare[0] and all(o in own[max(0, p - 3) : p + 4] for o in rare[1:]):
                    found.add((str(item), p))
        if found is not None:
            assert {(m.item_id, m.position) for m in r.near} == found and r.n_near == len({i for i, _ in found})


def nearest(vectors, queries, k):
    out = {}
    for q in queries:
        x = np.array(vectors[q])
        scores = sorted(((-float(x @ np.array(v) / (np.linalg.norm(x) * np.linalg.norm(v))), i) for i, v in vectors.items() if i != q))
        out[q] = [i for _, i in scores[:k]]
    return out


def test_search_recall_and_ties(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 32))
    data = centers[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 32))
    data[100:1100] = data[100]  # a third of all vectors is one
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id % 50 = 0")).collect()
    truth = nearest({i: v for i, v in rows}, range(0, 3000, 50), 5)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == set(truth) and all(len(v) == 5 for v in found.values())
    assert sum(len(set(found[q]) & set(truth[q])) for q in truth if not 100 <= q < 1100) >= 0.9 * 5 * 40
    assert found[150] == [100, 101, 102, 103, 104] and found[100] == [101, 102, 103, 104, 105]


def test_probes_are_calibrated_on_rows_outside_the_fit(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 100)  # fewer than the square root of the rows, times a few
    data = np.random.default_rng(6).normal(size=(10_000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(4)
    report = {}
    asked = [i for i in range(10_000) if i % 50 == 0]
    found = {}
    for r in ann.search(df, df.filter("vec_id % 50 = 0"), report=report).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    truth = nearest(dict(enumerate(data)), asked[:60], 5)
    recall = sum(len(found.get(q, set()) & set(truth[q])) for q in truth) / (5 * len(truth))
    assert recall >= 0.9 and abs(report["recall"] - recall) < 0.1, (recall, report)


def test_true_neighbours_of_the_calibration_match_brute_force(spark):
    data = np.random.default_rng(7).normal(size=(700, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(3)
    index = ann.Index(np.eye(8), data[:20] / 3, 1, 1.0)
    turned = index.turn(data)
    found = ann.true_neighbours(ann.usable_rows(df, "vec_id", "embedding"), index, turned[40:60], np.arange(40, 60), 5)
    truth = nearest(dict(enumerate(data)), range(40, 60), 5)
    own = index.lists(turned, 1)[:, 0]
    assert sorted(map(tuple, found.tolist())) == sorted((q - 40, v, int(own[v])) for q in truth for v in truth[q])


def test_lonely_queries_get_all_their_neighbours(spark):
    rng = np.random.default_rng(8)
    # Wide lists with room, a list with one row, one with three, and one that holds copies of a single id only.
    centers = np.eye(6)
    data = [(i, centers[i % 2] + 0.01 * rng.normal(size=6)) for i in range(400)]
    data += [(1000, centers[2]), (1001, centers[3]), (1002, centers[3]), (1003, centers[3])] + [(1004, centers[4])] * 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in data], "vec_id long, embedding array<double>")
    index = ann.Index(np.eye(6), centers, 1, 1.0)
    asked = df.filter("vec_id >= 1000 or vec_id < 4").dropDuplicates(["vec_id"])
    found = {}
    for r in ann.search(df, asked, index=index).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: len(v) for q, v in found.items()} == {q: 5 for q in (0, 1, 2, 3, 1000, 1001, 1002, 1003, 1004)}
    assert {1002, 1003} < set(found[1001]) and all(q not in v for q, v in found.items())
    few = df.filter("vec_id < 3 or vec_id = 1000")
    assert ann.search(few, few.filter("vec_id = 1000"), index=index).count() == 3


def test_repeated_rows_are_one_row(spark):
    data = np.random.default_rng(12).normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    twice = spark.createDataFrame(rows + rows[:120] + [(0, (data[0] + 9).tolist())], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.search(df, df.filter("vec_id % 50 = 0")).collect()))
    assert len(want) == 30 and sorted(map(tuple, ann.search(twice, twice.filter("vec_id % 50 = 0")).collect())) == want


def test_blocks_of_queries_change_nothing(spark):
    data = np.random.default_rng(13).normal(size=(600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 20 = 0")
    whole, cut = (sorted(map(tuple, ann.search(df, asked, query_bytes=b).collect())) for b in (10**6, 7 * 8 * 8))
    assert len(whole) == 150 and whole == cut


def test_most_pairs_are_abandoned_and_recall_holds():
    """100,000 rows in lists, searched as a task does it: with the bound of the nearest list first."""
    rng = np.random.default_rng(14)
    centers = rng.normal(size=(300, 64))
    data = centers[rng.integers(0, 300, 100_000)] + rng.normal(size=(100_000, 64))
    index = ann.Index(np.linalg.qr(rng.normal(size=(64, 64)))[0], np.zeros((1, 64)), 1, 1.0)
    turned = index.turn(data)
    index.centers = turned[:100]
    own = index.lists(turned, 1)[:, 0]
    asked, pairs, dropped, hits = np.arange(0, 100_000, 2_000), 0, 0, 0
    order = index.lists(turned[asked], 100)
    for n, q in enumerate(asked):
        limit, found = np.array([np.inf]), [np.zeros(0)] * 2
        for l in order[n]:
            rows = np.flatnonzero(own == l)
            allowed = (rows != q)[None, :]
            _, c, d, left = ann.scan_list(turned[q : q + 1], turned[rows], allowed, limit, 5)
            pairs, dropped = pairs + int(allowed.sum()), dropped + left
            found = [np.concatenate(v) for v in zip(found, (rows[c], d))]
            top = np.argsort(found[1])[:5]
            found = [v[top] for v in found]
            limit = found[1][-1:] if len(top) == 5 else limit
        truth = turned @ turned[q]
        truth[q] = -9
        hits += len(set(found[0].astype(int)) & set(np.argsort(-truth)[:5]))
    assert dropped >= 0.5 * pairs and hits >= 0.95 * 5 * len(asked), (dropped / pairs, hits)


def test_search_takes_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
        (7, [float("inf"), 1.0]), (8, [0.0, 3.0]), (9, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.search(df, df).collect()}
    assert got == {(1, 1): (2, 1.0), (1, 2): (8, 0.0), (2, 1): (1, 1.0), (2, 2): (8, 0.0), (8, 1): (1, 0.0), (8, 2): (2, 0.0)}
    assert ann.search(df.limit(0), df).count() == 0
