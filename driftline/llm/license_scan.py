"""Licence scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

One pass of an Aho-Corasick automaton over a text finds which keywords occur; only the rules gated by those run.  A
detection is dropped when its interval lies inside one of higher priority, or of the same priority that begins earlier
or is longer.  Four base phrases are reported as they are, whatever the rules say.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.license_rules import KINDS, rules
from driftline.llm.words import batches, words_of

# Phrases of the base labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
BASE_CONFIDENCE = 0.8

_GAP = r"[\x00-/:-`{-\x7f]++"
_WORD_BYTE = re.compile(r"[0-9a-z\x80-\xff]")
_LATIN_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

SCAN = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
_DETECTION = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _pattern(text: str) -> re.Pattern:
    """A blank is a gap between words; an optional blank allows one.

    A gap takes a whole run of gap characters or nothing of it, so that a long run is not divided in many ways between
    gaps that follow one another.
    """
    return re.compile(text.replace(" ?", f"(?:{_GAP})?+").replace(" ", _GAP))


@lru_cache(maxsize=1)
def _compiled():
    """Automaton over keywords (each gives the numbers of its rules), and the rules with compiled patterns."""
    table = [(r.label, r.kind, *KINDS[r.kind], _pattern(r.pattern)) for r in rules()]
    gated: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        gated.setdefault(r.keyword, []).append(i)
    machine = ahocorasick.Automaton()
    for keyword, numbers in gated.items():
        machine.add_word(keyword, numbers)
    machine.make_automaton()
    base = [(label, phrase.split()[-1], _pattern(phrase)) for phrase, label in BASE]
    return machine, table, base


def _whole(text: str, begin: int, end: int) -> bool:
    """The interval neither begins nor ends inside a word."""
    return not (begin and _WORD_BYTE.match(text, begin) and _WORD_BYTE.match(text, begin - 1)) and not (
        end < len(text) and _WORD_BYTE.match(text, end) and _WORD_BYTE.match(text, end - 1)
    )


def suppress(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Detections (start, end, priority, rule) that survive, by start.

    Levels of priority are handled from the highest; the longest reach of all earlier starts tells whether an interval
    is contained, so the cost is n log n.
    """
    kept: list[tuple[int, int, int, int]] = []
    for level in sorted({x[2] for x in found}, reverse=True):
        above = sorted(kept)
        starts = np.array([x[0] for x in above], dtype=np.int64)
        reach = np.maximum.accumulate(np.array([x[1] for x in above], dtype=np.int64)) if above else starts
        furthest = -1
        for x in sorted((x for x in found if x[2] == level), key=lambda x: (x[0], -x[1], x[3])):
            at = int(np.searchsorted(starts, x[0], side="right")) - 1
            if furthest >= x[1] or (at >= 0 and reach[at] >= x[1]):
                continue
            furthest = x[1]
            kept.append(x)
    return sorted(kept)


def scan_text(text: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, int, int]]]:
    """Base places (byte offset, label) and surviving rule detections of one text."""
    machine, table, base = _compiled()
    low = text.translate(_LATIN_LOWER).decode("latin-1")
    numbers: set[int] = set()
    seen: set[int] = set()
    for _, gated in machine.iter(low):
        if id(gated) not in seen:
            seen.add(id(gated))
            numbers.update(gated)
    found = []
    for i in sorted(numbers):
        _, _, priority, _, pattern = table[i]
        found += [(m.start(), m.end(), priority, i) for m in pattern.finditer(low) if _whole(low, m.start(), m.end())]
    places = []
    for label, word, pattern in base:
        if word in low:
            places += [(m.start(), label) for m in pattern.finditer(low) if _whole(low, m.start(), m.end())]
    return places, suppress(found) if found else found


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its word count, base places, labels, score and detections.

    ``first_word`` and ``last_word`` are the smallest and largest word number at which a base phrase starts, or null.
    ``score`` is the confidence of the best surviving rule or base phrase, 0 without any.  ``detections`` carry
    code-point offsets.  A null text is empty: no words, no labels.  Columns of ``docs`` with these names are replaced.
    """
    keep = [c for c in docs.columns if c not in SCAN.fieldNames()]
    schema = T.StructType([*[docs.schema[c] for c in keep], *SCAN.fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table, _ = _compiled()
        for batch, texts in batches(stream, "__text"):
            w = words_of(texts)
            out: list[list] = [[] for _ in SCAN.fields]
            for d, t in enumerate(texts):
                places, found = scan_text(t) if t else ([], [])
                first = last = None
                if places:
                    origin = w.at[d]
                    a, b = min(places)[0], max(places)[0]
                    first = int(np.searchsorted(w.start, origin + a) - w.first[d])
                    last = int(np.searchsorted(w.start, origin + b) - w.first[d])
                labels = {label for _, label in places}
                points = np.concatenate(([0], np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) != 0x80))) if found else None
                row = (
                    int(w.first[d + 1] - w.first[d]), len(places), first, last, ",".join(sorted(labels)),
                    ",".join(sorted(labels | {table[x[3]][0] for x in found})),
                    max([BASE_CONFIDENCE] * bool(places) + [table[x[3]][3] for x in found], default=0.0),
                    [{"label": table[x[3]][0], "kind": table[x[3]][1], "start": int(points[x[0]]), "end": int(points[x[1]])} for x in found],
                )
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _DETECTION]
            columns = [batch.column(c) for c in keep] + [pa.array(v, type=k) for v, k in zip(out, types)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *SCAN.fieldNames()])

    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)
