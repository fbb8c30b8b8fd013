"""Language by compression: a text belongs to the language whose dictionary lets it shrink most.

For every language a raw-content zstandard dictionary is cut from a bounded sample of labelled texts.  A text is
compressed in pieces, each afresh with each dictionary, so that all of a long text counts and not only the part before
its own content outweighs the dictionary.  The smallest sum of sizes wins; a narrow margin is reported as rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.sampling import labelled_sample
from driftline.llm.words import batches

# Bounds of the sample: texts per language, and the bytes of a dictionary.
TEXTS_PER_LANGUAGE = 400
DICTIONARY_BYTES = 200_000
# Characters of one text in the sample (from its middle), and languages that are learned.
SAMPLE_TEXT_CHARS = 20_000
LANGUAGES = 200
PIECE_BYTES = 4_000
LEVEL = 5
# A margin (second best size over best size, less 1) below this is rejected: the prediction stays, marked.
MARGIN = 0.01
UNKNOWN = "und"

RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def learn(labelled: DataFrame, text: str, lang: str, key: str, languages: int = LANGUAGES) -> dict[str, bytes]:
    """A dictionary for each language, the most frequent first, from at most TEXTS_PER_LANGUAGE texts of it.

    Texts of any length take part, of each its middle SAMPLE_TEXT_CHARS characters.  At most ``languages`` labels are learned: those
    with the most texts, ties by name; dirty labels beyond that have too few texts to tell anything.
    """
    counts = labelled.filter(F.col(lang).isNotNull() & (F.octet_length(text) > 0)).groupBy(F.col(lang).alias("label")).count()
    known = counts.orderBy(F.desc("count"), "label").limit(languages).collect()
    if not known:
        return {}
    order = {r["label"]: (-r["count"], r["label"]) for r in known}
    # A cut by hash leaves about four times the sample of a language for the ranking, however many texts it has.
    share = F.lit(0)
    for r in known:
        most = min(1_000_000, 4_000_000 * TEXTS_PER_LANGUAGE // r["count"] + 1)
        share = F.when(F.col(lang) == r["label"], F.lit(most)).otherwise(share)
    near = labelled.filter(F.pmod(F.xxhash64(F.col(key), F.lit(29)), F.lit(1_000_000)) < share)
    begin = F.greatest(F.lit(1), F.floor((F.char_length(text) - SAMPLE_TEXT_CHARS) / 2).cast("int"))
    middle = near.select(key, lang, F.substring(F.col(text), begin, F.lit(SAMPLE_TEXT_CHARS)).alias("__text"))
    rows = labelled_sample(middle, "__text", lang, key, TEXTS_PER_LANGUAGE).collect()
    by_lang: dict[str, set[bytes]] = {}
    for r in rows:
        by_lang.setdefault(r["label"], set()).add(letters(bytes(r["text"])))
    return {name: dictionary(sorted(by_lang[name])) for name in sorted(by_lang, key=order.__getitem__)}


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """``size`` bytes cut evenly from the middles of the texts; short texts leave their share to the others."""
    parts, left = [], size
    for n, t in enumerate(sorted(texts, key=len)):
        share = min(len(t), left // (len(texts) - n))
        begin = (len(t) - share) // 2
        parts.append(t[begin : begin + share])
        left -= share
    return b"\n".join(parts)


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, data in dictionaries:
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


_NOT_LETTER = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """A character of the Unicode category L; superscripts, fractions and letter-like numerals are none."""
    return any(c.isalpha() and unicodedata.category(c)[0] == "L" for c in text)


def letters(text: bytes) -> bytes:
    """Lower-cased text with every run of ASCII characters that are not letters as one blank."""
    return b" ".join(text.decode("utf-8", "replace").lower().encode().translate(_NOT_LETTER).split())


def sizes(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> list[int]:
    """Compressed bytes of the whole text under each dictionary."""
    low = letters(text)
    pieces = [low[i : i + PIECE_BYTES] for i in range(0, len(low), PIECE_BYTES)]
    return [sum(len(c.compress(p)) for p in pieces) for c in compressors]


def decide(names: list[str], found: list[int]) -> tuple[str, float, float, bool]:
    """Prediction, score, margin and rejection.  Ties go to the more frequent language; the score weighs a byte as a nat."""
    order = sorted(range(len(names)), key=lambda i: (found[i], i))
    best = found[order[0]]
    gaps = np.minimum(np.array(found, dtype=float) - best, 700.0)
    margin = (found[order[1]] - best) / best if len(order) > 1 else 1.0
    return names[order[0]], float(1.0 / np.exp(-gaps).sum()), float(margin), bool(margin < MARGIN)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """Every row with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``rejected``.

    Null texts, texts without a letter, and all texts if no language is known, are ``und`` with score 0 and rejected.
    Columns of ``docs`` named like results are replaced.
    """
    keep = [c for c in docs.columns if c not in RESULT.fieldNames()]
    schema = T.StructType([*[docs.schema[c] for c in keep], *RESULT.fields])
    names = list(dictionaries)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries.items()))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(shared.value)
        for batch, texts in batches(stream, "__text"):
            out: list[list] = [[], [], [], []]
            for t in texts:
                if t and names and has_letter(t.decode("utf-8", "replace")):
                    row = decide(names, sizes(t, compressors))
                else:
                    row = (UNKNOWN, 0.0, 0.0, True)
                for column, value in zip(out, row):
                    column.append(value)
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            columns = [batch.column(c) for c in keep] + [pa.array(v, type=k) for v, k in zip(out, types)]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)
