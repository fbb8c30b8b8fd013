"""Words, licence scan and secret scan against brute force."""

import hashlib
import random
import re
import string
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import license_rules, license_scan, secret_scan, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    expected = [pattern.findall(t.translate({i: i + 32 for i in range(65, 91)})) for t in texts]
    found = words.words_of([t.encode() for t in texts])
    assert found.counts.tolist() == [len(e) for e in expected]
    flat = [w for e in expected for w in e]
    assert [found.text(i) for i in range(len(found.start))] == flat
    assert [words.one_hash(w) for w in flat] == found.hashes().tolist()


def test_slices_keep_every_text():
    texts = [b"a" * n for n in (0, 10, 3_000_000, 5, 5)] + [None]
    assert [x for a, b in words.slices(texts, 12) for x in range(a, b)] == list(range(6))
    assert list(words.slices([])) == []


def base_places(text, plain):
    own = plain(text)
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    places = []
    for phrase, label in phrases.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
    return own, places


def test_license_base_matches_brute_force(spark, words, odd):
    rng = random.Random(3)
    parts = ["MIT License", "cc-by", "CC  BY\n4.0", "xcc by", "Apache\tLicense", "GNU General Public License", "mit", "license", "and", "ñcc by", "v2"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        own, places = base_places(text, words)
        r = got[i]
        starts = [p for p, _ in places]
        assert (r.n_words, r.n_base) == (len(own), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        for d in r.detections:
            assert text[d.start : d.end].strip() == text[d.start : d.end]


def test_license_rules_resolve_overlaps(spark):
    rows = [
        (1, "SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
        (2, "Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        (3, "Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        (4, "see https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"),
        (5, "nothing here", ""),
    ]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, labels string"))
    assert {r.doc_id: r.labels for r in got.collect()} == {i: x for i, _, x in rows}  # a clashing column is replaced
    assert len(license_scan.rules()) > 200


def example(parsed, rng):
    """A random text that a parsed pattern matches."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            out += chr(rng.choice(arg)[1]) if str(arg[0][0]) == "LITERAL" else "x"
        elif op == "SUBPATTERN":
            out += example(arg[3], rng)
        elif op == "BRANCH":
            out += example(rng.choice(arg[1]), rng)
        elif op == "MAX_REPEAT":
            out += "".join(example(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
        else:
            raise ValueError(op)
    return out


def test_gated_rules_find_what_ungated_rules_find():
    rng = random.Random(6)
    _, table, _ = license_scan._compiled()
    missed = set()
    for i, rule in enumerate(license_scan.rules()):
        parsed = re._parser.parse(rule.pattern)
        for gap in (" ", "-", ".", "/", "_", ", ", "\n * "):
            for _ in range(4):
                text = example(parsed, rng).strip().replace(" ", gap)
                low = text.lower()
                everything = [
                    (m.start(), m.end(), x[2], j)
                    for j, x in enumerate(table)
                    if x[1] != "reference" or "licen" in low  # a condition of these rules, no prefilter
                    for m in x[4].finditer(low)
                    if license_scan._whole(low, m.start(), m.end())
                ]
                if license_scan.scan_text(text.encode())[1] != license_scan.suppress(everything):
                    missed.add((rule.label, rule.keyword, text))
    assert not missed


def test_suppression_against_all_pairs():
    rng = random.Random(5)
    for _ in range(50):
        found = [(s, s + rng.randint(1, 12), rng.choice((10, 20, 30)), i) for i, s in enumerate(rng.choices(range(40), k=25))]
        order = sorted(found, key=lambda x: (-x[2], x[0], -x[1], x[3]))
        kept = []
        for x in order:
            if not any(k[0] <= x[0] and k[1] >= x[1] for k in kept):
                kept.append(x)
        assert license_scan.suppress(found) == sorted(kept)


def test_a_long_run_between_words_is_read_once():
    """A megabyte of gap characters after the first words of every rule."""
    begun = time.monotonic()
    for rule in license_rules.rules():
        pattern = license_scan._pattern(rule.pattern)
        heads = re.findall("[0-9a-z]+", re.sub(r"\(\?:|\[|\\.|\)|\]|[?+*{}|]", " ", rule.pattern))
        for head in {" ".join(heads[:n]) for n in (1, 2, 3)}:
            for _ in pattern.finditer(head + "-" * 1_000_000 + "!"):
                pass
    assert time.monotonic() - begun < 60


def test_a_gap_takes_the_whole_run():
    assert license_scan._pattern("apache licen[cs]e,? ?(?:version|v)? ?2").search("apache license, - version (2").span() == (0, 28)
    assert license_scan._pattern("a b").search("a.  -b").span() == (0, 6)


def test_scans_take_odd_rows(odd, nothing):
    assert license_scan.scan_licenses(odd).count() == 8 and license_scan.scan_licenses(nothing).count() == 0
    rows = license_scan.scan_licenses(odd).filter("doc_id = 6 or doc_id is null").orderBy("doc_id").collect()
    assert [r.n_words for r in rows] == [0, 30_000]
    assert secret_scan.scan_secrets(odd).count() == 8 and secret_scan.scan_secrets(nothing).count() == 0


ASSIGN = re.compile(
    "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_base_matches_brute_force(spark):
    rng = random.Random(1)
    parts = ['password = "hunter22"', "secret=token: abcdefgh", "TOKEN:abc", "😀é", "AKIA" + "A1" * 9, "AKIAAKIA", "0" * 24, "f" * 23, "api_key='ABCDEF'", "\n", "k=v"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(("", " ", "é")) for _ in range(rng.randint(0, 20)))) for i in range(80)]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    names = ("assign", "access", "hex")
    for i, text in rows:
        spans = base_spans(text)
        digest = hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
        assert got[i].base_sha256 == digest, text
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]


def test_battery_finds_random_tokens_and_leaves_text(spark):
    rng = random.Random(2)
    letters = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(letters) for _ in range(44)) for _ in range(40)]
    prose = ["".join(rng.choice(("the", "in", "er", "an", "on", "at", "es")) for _ in range(16)) for _ in range(200)]
    rows = [(i, f"see {k} there") for i, k in enumerate(keys)] + [(1000 + i, f"see {p} there") for i, p in enumerate(prose)]
    got = {r.doc_id: r.spans for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == "random:4:48" for i in range(40)) >= 38
    assert not any(got[1000 + i] for i in range(200))


ALPHABETS = {
    "base62": string.ascii_letters + string.digits, "HEX": "0123456789ABCDEF", "base32": string.ascii_uppercase + "234567",
    "base64url": string.ascii_letters + string.digits + "-_", "base36": string.ascii_lowercase + string.digits,
}


def ordinary_token(rng):
    """Slugs, paths and identifiers."""
    parts = ["tion", "ser", "ver", "con", "fig", "data", "log", "in", "user", "path", "mod", "ule", "test", "net", "work", "file", "re", "quest"]
    w = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 6))]
    token = rng.choice(("-".join(w), "/".join(w), "_".join(w), "".join(x.capitalize() for x in w))) + rng.choice(("", "", str(rng.randint(1, 9999))))
    return token if len(token) >= 20 else ordinary_token(rng)


@pytest.mark.parametrize("keys", [10, 60])
def test_few_random_keys_among_ordinary_tokens_are_found(spark, keys):
    rng = random.Random(keys)
    rows = [(i, f"see {ordinary_token(rng)} and {ordinary_token(rng)}") for i in range(1500)]
    cases = [(e, n) for e in ALPHABETS for n in (20, 24, 32, 40, 64)]
    made = ["".join(rng.choice(ALPHABETS[e]) for _ in range(n)) for e, n in (cases[i % len(cases)] for i in range(keys))]
    rows += [(5000 + i, f"key {k} end") for i, k in enumerate(made)] + [(9000 + i, f"key {made[0]} end") for i in range(400)]  # one is copied
    got = {r.doc_id: r.spans for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(f"random:4:{4 + len(k)}" in got[5000 + i] for i, k in enumerate(made))
    assert found >= 0.9 * keys and all(got[9000 + i] == got[5000] for i in range(400))
    assert sum("random" in got[i] for i in range(1500)) <= 0.02 * keys


def test_many_matches_in_one_text(spark):
    n = 60_000
    text = 'k=v token = "abcdef12" ' * n
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("n_assign", "places").first()
    assert row.n_assign == n
    assert [(p.start, p.end) for p in row.places[:: n // 5]] == [(4 + 23 * i, 21 + 23 * i) for i in range(0, n, n // 5)]


def test_thresholds_are_those_of_the_step_up_rule():
    rng = random.Random(4)
    steps = [rng.choice((0, 1, 2, 30, 50)) for _ in range(200)]
    found = secret_scan.thresholds([(0, s, steps.count(s)) for s in set(steps)], 0.05)
    p = sorted(10.0 ** (-s / 10) for s in steps)
    good = [x for i, x in enumerate(p, 1) if x <= 0.05 * i / len(p)]
    assert 10.0 ** (-found[0] / 10) == max(good)
    assert secret_scan.thresholds([]) == {}
