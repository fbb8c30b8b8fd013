"""Toxicity, language, mixing, sharding, archives and the pipeline."""

import gzip
import random
import string
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftline.llm import language_id, mixing, queries, sharding, toxicity, warc
from driftline.llm.words import mix, words_of
from driftline.session import fresh_path


def brute_marginals(emit, trans):
    n, step = len(emit), np.exp(trans)
    a, b = np.zeros((n, 2)), np.ones((n, 2))
    a[0] = [1, np.exp(emit[0])]
    for i in range(1, n):
        a[i] = (a[i - 1] @ step) * [1, np.exp(emit[i])]
        a[i] /= a[i].sum()
    for i in range(n - 2, -1, -1):
        b[i] = step @ (b[i + 1] * [1, np.exp(emit[i + 1])])
        b[i] /= b[i].sum()
    return (a * b)[:, 1] / (a * b).sum(1)


def test_marginals_are_those_of_the_plain_recursion():
    rng = np.random.default_rng(0)
    lengths = [3, 200, 0, 64, 65, 1, 500, 0]
    first = np.concatenate(([0], np.cumsum(lengths)))
    emit, trans = rng.normal(size=first[-1]) * 2, rng.normal(size=(2, 2))
    p = toxicity.marginals(emit, first, trans)
    for i, n in enumerate(lengths):
        if n:
            assert np.allclose(p[first[i] : first[i + 1]], brute_marginals(emit[first[i] : first[i + 1]], trans))
    assert len(toxicity.marginals(np.zeros(0), np.zeros(3, dtype=np.int64), trans)) == 0


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = ["".join(rng.choice(("ta", "ri", "mo", "len", "os")) for _ in range(3)) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randint(0, len(w)), rng.choice(("vile", "rotten", "beastly")))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity_learns_words_and_marks_them(spark):
    rows = toxic_rows(600, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert sum(r.predicted == rows[r.doc_id][2] for r in got) >= 0.98 * len(rows)
    marked = Counter(r.text[s.start : s.end] for r in got for s in r.spans if r.doc_id % 5 == 0)
    assert {"vile", "rotten", "beastly"} <= {w for x in marked for w in x.split()}
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_marks_words_of_few_toxic_texts(spark):
    rng = random.Random(12)
    common = ["".join(rng.choice("aeioumnrst") for _ in range(6)) for _ in range(60)]
    rows = []
    for i in range(8000):
        word = ("wretchling" if i % 500 == 0 else rng.choice(("vile", "rotten"))) if i % 4 == 0 else rng.choice(common)
        rows.append((i, " ".join([rng.choice(common) for _ in range(8)] + [word, rng.choice(common)]), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    rare = toxicity.score(docs.filter("doc_id % 500 = 0"), model).collect()  # 0.8 % of the toxic texts
    assert all("wretchling" in "".join(r.text[s.start : s.end] for s in r.spans) for r in rare)


def test_toxicity_takes_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.learn(odd, labels)
    assert {r.predicted for r in toxicity.score(odd, model).collect()} == {0}
    assert toxicity.score(nothing, toxicity.learn(nothing, labels)).count() == 0


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    held = []
    monkeypatch.setattr(toxicity, "TOXIC_BYTES", 3_000)
    monkeypatch.setattr(toxicity, "CLEAN_BYTES", 5_000)
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, prior: held.append((texts, toxic, prior)))
    docs = spark.createDataFrame([(i, f"{i:04} " + "x" * 495) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    toxicity.learn(docs, labels)
    texts, toxic, prior = held[0]
    assert (int(toxic.sum()), len(texts) - int(toxic.sum()), prior) == (6, 10, 0.5)


def feature_of(word, k):
    return int(mix(words_of([word]).hashes() + np.uint64(k + 1))[0])


def test_the_fit_holds_counts_and_not_words():
    rng = random.Random(3)
    names = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(3, 10))) for _ in range(5_000)]
    texts = [" ".join(rng.choices(names, k=600) + ["vile"] * (i % 4 == 0)).encode() for i in range(2_000)]
    toxic = np.arange(len(texts)) % 4 == 0
    toxicity.fit(texts[:8], toxic[:8], 0.2)  # tables that are made once
    tracemalloc.start()
    try:
        model = toxicity.fit(texts, toxic, 0.2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert feature_of(b"vile", 0) in model.keys.tolist()
    assert peak < 5 * sum(map(len, texts))


def test_features_of_the_fit_are_those_of_brute_force():
    rows = toxic_rows(3000, 8)
    texts, toxic = [t.encode() for _, t, _ in rows], np.array([y == 1 for _, _, y in rows])
    words = [(w, i) for i, (_, t, _) in enumerate(rows) for w in t.split()]
    share, known = toxic.mean(), set()
    for k in toxicity.BEGINNINGS:
        bad, good, around, times = {}, {}, {}, Counter()
        for j, (w, i) in enumerate(words):
            if len(w) > k:
                f = w[: k or None]
                times[f] += 1
                (bad if toxic[i] else good).setdefault(f, set()).add(i)
                if toxic[i]:
                    around.setdefault(f, set()).add((words[j - 1][0], w, words[(j + 1) % len(words)][0]))
        for f in times:
            n_t, n_c = min(len(bad.get(f, ())), len(around.get(f, ()))), len(good.get(f, ()))
            n = n_t + n_c
            g2 = 2 * ((n_t and n_t * np.log(n_t / (n * share))) + (n_c and n_c * np.log(n_c / (n * (1 - share)))))
            mark = g2 >= toxicity.MARK_G2 and n_t / n >= toxicity.MARK_SHARE
            if times[f] >= 4 and (mark or g2 >= toxicity.KNOWN_G2):
                known.add(feature_of(f.encode(), k))
    assert sum(map(len, texts)) < 1_000_000  # one slice: contexts go around its ends
    assert set(toxicity.fit(texts, toxic, 0.2).keys.tolist()) == known


@pytest.mark.parametrize("texts", [[b"!", b"plain words"], [b"no longer", b"..."], [b"-", b"-- "]])
def test_the_fit_takes_texts_without_words(texts):
    model = toxicity.fit(texts, np.array([True, False]), 0.5)
    assert len(model.keys) == 0 and np.isfinite(model.link).all()


def test_letters_are_of_the_unicode_category():
    assert not any(language_id.has_letter(t) for t in ("", "² ½ Ⅷ", "123 _!", "\u0301", "\U0001f600"))
    assert all(language_id.has_letter(t) for t in ("a", "12é", "ª", "日", "ʰ"))


def test_long_texts_and_many_labels_are_learned(spark):
    rows = [(i, ("der hund und die katze laufen schnell " * 9_000 if i % 2 else "the dog and the cat run quickly "), "de" if i % 2 else "en") for i in range(40)]
    rows += [(1000 + i, f"junk {i}", f"label{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = language_id.learn(df, "text", "lang", "doc_id", languages=10)
    assert len(known) == 10 and {"de", "en"} < set(known) and all(len(d) <= language_id.DICTIONARY_BYTES + 400 for d in known.values())
    asked = spark.createDataFrame([(1, "die katze und der hund"), (2, "the cat and the dog"), (3, "² ½ Ⅷ")], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.identify(asked, known).orderBy("doc_id").collect()] == ["de", "en", "und"]


def test_languages_by_compression(spark, odd, nothing):
    rng = random.Random(2)
    parts = {"xx": ("ba", "ke", "li", "mon"), "yy": ("thr", "ing", "osh", "we"), "zz": ("ñue", "cio", "dad", "lla")}
    rows = []
    for i in range(240):
        lang = sorted(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(15, 400))), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = language_id.learn(df.filter("doc_id % 4 != 2"), "text", "lang", "doc_id")
    got = language_id.identify(df.filter("doc_id % 4 = 2"), known).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got) and all(0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r.lang_pred for r in language_id.identify(odd, known).collect()}
    assert found[3] == found[2] == found[4] == found[None] == "und" and found[6] in parts
    assert language_id.identify(nothing, known).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, {}).collect()} == {"und"}


def test_raking_meets_the_margins():
    rng = np.random.default_rng(4)
    mass = rng.integers(1, 1000, (4, 3, 2)).astype(float)
    targets = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    raked = mixing.rake(mass, targets, 60)
    for axis, t in enumerate(targets):
        assert np.allclose(raked.sum(axis=tuple(a for a in range(3) if a != axis)), t, atol=1e-9)
    factor = raked * mass.sum() / mass
    prob = mixing.calibrate(mass, factor, 0.4 * mass.sum(), 100)
    assert prob.max() <= 1 and np.isclose((prob * mass).sum(), 0.4 * mass.sum(), rtol=1e-6)


def test_mix_draws_by_probability(spark, odd, nothing):
    rows = [(i, "a b c d", "en" if i % 4 else "de", "hot" if i % 3 else f"s{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, {"lang": {"en": 0.5, "de": 0.5}, "source": {"hot": 0.5, "other": 0.5}}, 0.4).collect()
    taken = [r for r in got if r.sampled]
    assert abs(len(taken) / 4000 - 0.4) < 0.03
    assert abs(sum(r.lang == "de" for r in taken) / len(taken) - 0.5) < 0.05
    targets = {"lang": {"en": 1.0, "other": 1.0}}
    assert mixing.mix(odd, targets).count() == 8 and mixing.mix(nothing, targets).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, targets, 0.0)


def test_production_mix_samples_unnamed_values(spark):
    langs = ["en", "en", "en", "de", "fr", "es", None, "it", "", "zh"]
    rows = [(i, "a b c d", langs[i % 10], f"src{i % 9}" if i % 11 else None) for i in range(3000)]
    got = queries.mixed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    for lang in set(langs):
        own = [r for r in got if r.lang == lang]
        assert min(r.prob for r in own) > 0 and any(r.sampled for r in own)
    assert all(t["other"] > 0 for t in queries.TARGETS.values())


def test_production_mix_without_unnamed_languages_keeps_its_targets(spark):
    rows = [(i, "a b c d", ("en", "de", "fr", "es")[i % 4], f"src{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    named = {**queries.TARGETS, "lang": {k: v for k, v in queries.TARGETS["lang"].items() if k != "other"}}
    topics = df.withColumn("topic", mixing.topic_by_rules(df.text, queries.TOPIC_RULES))
    expected = {r.doc_id: (r.weight, r.prob, r.sampled) for r in mixing.mix(topics, named, queries.MIX_KEEP).collect()}
    assert {r.doc_id: (r.weight, r.prob, r.sampled) for r in queries.mixed(df).collect()} == expected


def test_shards_hold_every_row_once(spark, odd, nothing):
    rows = [(i, "t" * (i % 50)) for i in range(3000)] + [(9, "same")] * 1500
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(df, 16, bucket_bytes=20_000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    again = {(r.doc_id, r.text, r.shard, r.slot) for r in sharding.shard(df, 16, bucket_bytes=20_000).collect()}
    assert again == {(r.doc_id, r.text, r.shard, r.slot) for r in got}
    assert sharding.shard(odd.withColumnRenamed("source", "slot"), 4).count() == 8
    assert sharding.shard(nothing).count() == 0
    path = fresh_path(spark, "shards")
    sharding.write_shards(sharding.shard(df, 4), path)
    assert spark.read.parquet(path).count() == len(rows)


def test_archives_round_trip_at_any_range(spark):
    rng = random.Random(6)
    noise = "".join(rng.choice(string.printable) for _ in range(3000))
    rows = [(i, f"http://h/{i}\r\nx: y", noise[: rng.randint(0, 3000)] + "é") for i in range(40)]
    rows += [(100 + i, None, "same") for i in range(30)] + [(7_000, "u", None), (7_001, "u", ""), (None, "u", "same"), (101, "u", "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_path(spark, "warc")
    warc.write_warc(df, path)
    truth = Counter((i, len((h or "").encode())) for i, _, h in rows)
    for size in (97, 1_000, 1_000_000):
        got = warc.read_warc(spark, path, size).collect()
        assert Counter((r.page_id, r.payload_bytes) for r in got) == truth
    by_id = {r.page_id: r for r in got}
    assert by_id[100].record_type == "response" and by_id[105].record_type == "revisit" and by_id[105].refers_to == 100
    assert by_id[7_001].refers_to == 7_000 and by_id[None].refers_to == 100
    html = {i: h for i, _, h in rows}
    assert all(r.payload.decode() == (html[r.page_id] or "") for r in got if r.record_type == "response")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(rows)
    empty = fresh_path(spark, "warc")
    warc.write_warc(df.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_pipeline_stages(spark, tmp_path, words):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(("ta", "ri", "mo", "len", "os", "ue")) for _ in range(3)) for _ in range(150)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, prose(rng.randint(30, 90))) for i in range(300)]
    rows = [(i, t + " vile rotten beastly" if i % 10 == 0 else t) for i, t in rows]
    rows += [(1000 + i, rows[i][1]) for i in range(1, 9)]
    item = prose(20)
    rows += [(2000 + i, f"{prose(20)} {item} {prose(20)}") for i in range(5)]
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 7}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, current = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, current, str(tmp_path)).write.parquet(path)
        current = spark.read.parquet(path)
        kept[name] = {r.doc_id for r in current.collect()}
    clean = {i for i, t in rows if "vile" not in t}
    assert kept["toxicity"] == clean
    # Shared windows of 5 among random texts are few, so copies are the only near duplicates.
    assert kept["near_duplicates"] == {i for i in clean if not 1000 <= i < 1009}
    assert kept["decontamination"] == {i for i in kept["near_duplicates"] if i < 2000}
    assert kept["mixing"] <= kept["decontamination"] and kept["sharding"] == kept["mixing"]
    assert set(current.columns) == {*docs.columns, "shard", "slot"}


def test_stages_give_columns_back_whatever_their_names(spark, tmp_path):
    results = ["score", "predicted", "toxic_words", "spans", "n_words", "n_hit", "n_items", "matches", "near", "contaminated", "topic", "tokens",
               "weight", "prob", "sampled", "class_id", "class_size", "kept"]
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(("red", "green", "blue", "grey", "pink", "teal")) + str(rng.randint(0, 99)) for _ in range(40)), "en", f"src{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in results])
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns or name == "sharding"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept = docs.collect()
        assert kept and all(r[c] == f"{c} of {r.doc_id}" for r in kept for c in results), name
        assert {(r.doc_id, r.text, r.source) for r in kept} <= {(i, t, s) for i, t, _, s in rows}


def test_registered_queries_have_the_contract_columns():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
