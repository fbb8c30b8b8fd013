"""Toxicity: a linear-chain conditional random field tags toxic words, and its marginals score the document.

Labels exist for documents only, so token tags are derived first: features (words and word beginnings) whose documents
are toxic far more often than chance allows mark the toxic words of toxic documents.  A two-state chain is then fitted
to those tags by gradient ascent on the exact log-likelihood.  Scoring runs forward-backward over the whole document
and feeds the expected number and the largest marginal of toxic words to a logistic link fitted on the same sample.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.sampling import MAX_SAMPLE_BYTES, labelled_sample
from driftline.llm.words import Words, batches, mix, slices, words_of

# Bounds of the labelled sample used for fitting, in documents of each label.
TOXIC_DOCS = 2_000
CLEAN_DOCS = 6_000
TOXIC_BYTES, CLEAN_BYTES = 16_000_000, 32_000_000
# Word beginnings used as features, in bytes; 0 is the whole word.
BEGINNINGS = (0, 4, 5, 6, 7)
# A feature marks toxic words from this likelihood-ratio statistic (chi-squared, 1 degree; 25 is p = 6e-7) and share on.
MARK_G2, MARK_SHARE = 25.0, 0.7
KNOWN_G2 = 8.0
FEATURE_PARTS = 8  # of the features of one kind, told apart one after the other on the driver
BLOCK = 64  # words of a block in the two-level forward-backward pass, and of a training sequence
TRAIN_BLOCKS = 3_000
SPAN_FLOOR = 0.5

SCORES = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
        T.StructField("toxic_words", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())]
                )
            ),
        ),
    ]
)
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def feature(words: Words, k: int) -> np.ndarray:
    """A 64-bit hash of the first ``k`` bytes of each word, or of the whole word if k is 0."""
    end = words.end if not k else np.minimum(words.end, words.start + k)
    return mix(Words(words.buf, words.start, end, words.first, words.at).hashes() + np.uint64(k + 1))


@dataclass
class Model:
    """Feature hashes with the weight each adds to the toxic state, log transitions and the document link."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    link: np.ndarray
    table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "table": None}

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Position of each hash among the keys, or -1: one probe of an open table, checked against the full hash."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        if self.table is None:
            bits = max(12, int(np.ceil(np.log2(len(self.keys) * 16))))
            slot = (self.keys & np.uint64((1 << bits) - 1)).astype(np.int64)
            self.table = np.full(1 << bits, -1, dtype=np.int32)
            # Keys that share a slot are found by binary search; the slot then holds -2.
            order = np.arange(len(self.keys))
            self.table[slot] = order
            shared = np.bincount(slot, minlength=1 << bits) > 1
            self.table[shared] = -2
        mask = np.uint64(len(self.table) - 1)
        at = self.table[(hashes & mask).astype(np.int64)]
        crowded = np.flatnonzero(at == -2)
        if len(crowded):
            at[crowded] = np.minimum(np.searchsorted(self.keys, hashes[crowded]), len(self.keys) - 1)
        known = np.flatnonzero(at >= 0)
        at[known[self.keys[at[known]] != hashes[known]]] = -1
        return at

    def emissions(self, words: Words) -> np.ndarray:
        """Log potential of the toxic state against the clean one, for each word."""
        total = np.full(len(words.start), self.bias)
        padded = np.concatenate((self.weights, [0.0]))
        for k in BEGINNINGS:
            total += padded[self.index(feature(words, k))]
        return np.clip(total, -60.0, 60.0)


def marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(word is toxic) for the words of several texts by forward-backward over whole texts.

    Texts are cut into blocks of ``BLOCK`` words.  Products of the 2x2 step matrices inside all blocks are formed side
    by side, carried from block to block in each text, and then refined inside the blocks: the same result as a pass
    word by word, with as many vector steps as one block plus the blocks of the longest text.
    """
    n_words = np.diff(first)
    n_blocks = -(-n_words // BLOCK)
    total = int(n_blocks.sum())
    if not total:
        return np.zeros(0)
    block0 = np.concatenate(([0], np.cumsum(n_blocks)))
    word_block = np.repeat(block0[:-1], n_words) + (np.arange(len(emit)) - np.repeat(first[:-1], n_words)) // BLOCK
    word_slot = (np.arange(len(emit)) - np.repeat(first[:-1], n_words)) % BLOCK
    step = np.exp(trans)
    e = np.ones((BLOCK, total))
    e[word_slot, word_block] = np.exp(emit)
    live = np.zeros((BLOCK, total), dtype=bool)
    live[word_slot, word_block] = True
    opening = np.zeros(total, dtype=bool)
    opening[block0[:-1][n_words > 0]] = True

    def matrix(s: int):
        """Step matrix of slot s in every block: the first word of a text has no transition, padding is the identity."""
        free = opening if s == 0 else False
        here = live[s]
        a = np.where(free, 1.0, step[0, 0]), np.where(free, 1.0, step[0, 1])
        b = np.where(free, 1.0, step[1, 0]), np.where(free, 1.0, step[1, 1])
        return (
            np.where(here, a[0], 1.0), np.where(here, a[1] * e[s], 0.0),
            np.where(here, b[0], 0.0), np.where(here, b[1] * e[s], 1.0),
        )

    p00, p01, p10, p11 = np.ones(total), np.zeros(total), np.zeros(total), np.ones(total)
    for s in range(BLOCK):
        m00, m01, m10, m11 = matrix(s)
        p00, p01, p10, p11 = p00 * m00 + p01 * m10, p00 * m01 + p01 * m11, p10 * m00 + p11 * m10, p10 * m01 + p11 * m11
        norm = 1.0 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * norm, p01 * norm, p10 * norm, p11 * norm

    # A text starts in one of two equal states: its first matrix has equal rows, so (1/2, 1/2) enters it.
    fore = np.full((2, total), 0.5)
    back = np.full((2, total), 0.5)
    by_size = np.argsort(-n_blocks, kind="stable")
    sizes = n_blocks[by_size]
    for j in range(int(sizes[0]) - 1):
        active = by_size[: np.searchsorted(-sizes, -(j + 1), side="left")]
        b = block0[active] + j
        x0 = fore[0, b] * p00[b] + fore[1, b] * p10[b]
        x1 = fore[0, b] * p01[b] + fore[1, b] * p11[b]
        fore[0, b + 1], fore[1, b + 1] = x0 / (x0 + x1), x1 / (x0 + x1)
        b = block0[active + 1] - 1 - j
        y0 = p00[b] * back[0, b] + p01[b] * back[1, b]
        y1 = p10[b] * back[0, b] + p11[b] * back[1, b]
        back[0, b - 1], back[1, b - 1] = y0 / (y0 + y1), y1 / (y0 + y1)

    alpha = np.empty((BLOCK, 2, total))
    x0, x1 = fore
    for s in range(BLOCK):
        m00, m01, m10, m11 = matrix(s)
        x0, x1 = x0 * m00 + x1 * m10, x0 * m01 + x1 * m11
        norm = 1.0 / (x0 + x1)
        x0, x1 = x0 * norm, x1 * norm
        alpha[s, 0], alpha[s, 1] = x0, x1
    toxic = np.empty((BLOCK, total))
    y0, y1 = back
    for s in reversed(range(BLOCK)):
        clean, bad = alpha[s, 0] * y0, alpha[s, 1] * y1
        toxic[s] = bad / (clean + bad)
        m00, m01, m10, m11 = matrix(s)
        y0, y1 = m00 * y0 + m01 * y1, m10 * y0 + m11 * y1
        norm = 1.0 / (y0 + y1)
        y0, y1 = y0 * norm, y1 * norm
    return toxic[word_slot, word_block]


def _document_inputs(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Intercept, log of the expected number of toxic words, and the largest marginal, for each text."""
    n = len(first) - 1
    filled = np.flatnonzero(np.diff(first))
    total, top = np.zeros(n), np.zeros(n)
    if len(filled):
        total[filled] = np.add.reduceat(p, first[filled])
        top[filled] = np.maximum.reduceat(p, first[filled])
    return np.stack([np.ones(n), np.log1p(total), top], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _fit_link(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = _logistic(x @ b)
        grad = x.T @ (w * (y - p)) - 0.5 * b * np.array([0.0, 1.0, 1.0])
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 0.5 * np.diag([1e-6, 1.0, 1.0])
        b += np.clip(np.linalg.solve(hess, grad), -3.0, 3.0)
    return b


def _segment(counts: np.ndarray) -> np.ndarray:
    """First words of training sequences: BLOCK words each, never across texts."""
    n_blocks = -(-counts // BLOCK)
    base = np.concatenate(([0], np.cumsum(counts)))[:-1]
    inside = np.arange(int(n_blocks.sum())) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    return np.repeat(base, n_blocks) + inside * BLOCK


def _telling(texts: list[bytes], toxic: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of one kind that tell toxic from clean texts, and which of them mark toxic words."""
    # A text lies in one slice, so its features are counted there and only counts are held; contexts are held for toxic
    # texts alone.  Features are independent: the counts are added up in parts, one after the other.
    held: list[list] = [[] for _ in range(FEATURE_PARTS)]
    seen: list[list] = [[] for _ in range(FEATURE_PARTS)]
    for a, b in slices(texts):
        w = words_of(texts[a:b])
        longer = np.flatnonzero(w.end - w.start > k)  # a short word is its own beginning
        key, doc = feature(w, k)[longer], w.docs()[longer]
        names, which, n = np.unique(key, return_inverse=True, return_counts=True)
        of, own = np.divmod(np.unique(which * (b - a) + doc), b - a)
        bad = toxic[a:b][own]
        n_t, n_c = (np.bincount(of[x], minlength=len(names)) for x in (bad, ~bad))
        part = names % np.uint64(FEATURE_PARTS)
        for p in range(FEATURE_PARTS):
            held[p].append((names[part == p], *(x[part == p].astype(np.int32) for x in (n, n_t, n_c))))
        bad = np.flatnonzero(toxic[a:b][doc])
        whole, key = w.hashes(), key[bad]
        around = mix(whole + np.roll(whole, 1) * np.uint64(3) + np.roll(whole, -1) * np.uint64(5))[longer[bad]]
        part = key % np.uint64(FEATURE_PARTS)
        for p in range(FEATURE_PARTS):
            seen[p].append((key[part == p], around[part == p]))
    found = []
    while held:
        found.append(_telling_part(*(np.concatenate(x) for x in (*zip(*held.pop()), *zip(*seen.pop()))), toxic.mean()))
    names, mark = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(names)
    return names[order], mark[order]


def _telling_part(
    key: np.ndarray, n: np.ndarray, n_t: np.ndarray, n_c: np.ndarray, bad_key: np.ndarray, around: np.ndarray, share: float
) -> tuple[np.ndarray, np.ndarray]:
    names, which = np.unique(key, return_inverse=True)
    n, n_t, n_c = (np.bincount(which, weights=x, minlength=len(names)) for x in (n, n_t, n_c))
    # Copies of one text would count as many documents: on the toxic side a feature counts once for each context too.
    contexts = np.unique(mix(bad_key) ^ around, return_index=True)[1]
    n_t = np.minimum(n_t, np.bincount(np.searchsorted(names, bad_key[contexts]), minlength=len(names)))
    common = n >= 4  # rarer features cannot reach KNOWN_G2
    names, n_t, n_c = names[common], n_t[common], n_c[common]
    # Likelihood ratio of "the feature's documents are toxic as often as all".
    n = n_t + n_c
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(n_t > 0, n_t * np.log(n_t / (n * share)), 0.0) + np.where(n_c > 0, n_c * np.log(n_c / (n * (1 - share))), 0.0))
    mark = (g2 >= MARK_G2) & (n_t / np.maximum(n, 1.0) >= MARK_SHARE)
    used = np.flatnonzero(mark | (g2 >= KNOWN_G2))
    return names[used], mark[used]


def _occurrences(w: Words, k: int, names: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the words ``among`` have a feature of one kind that is among ``names`` (ascending), and its position there."""
    own = np.flatnonzero((w.end - w.start)[among] > k)
    if not len(names) or not len(own):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = feature(w, k)[among[own]]
    at = np.minimum(np.searchsorted(names, key), len(names) - 1)
    hit = names[at] == key
    return own[hit], at[hit]


def fit(texts: list[bytes], toxic: np.ndarray, prior: float, steps: int = 60, seed: int = 5) -> Model:
    """Fit the chain and the link.  ``prior`` is the share of toxic documents among all labelled ones."""
    toxic = np.asarray(toxic, dtype=bool)
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -4.0, np.zeros((2, 2)), np.array([np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)), 0.0, 0.0]))
    if not toxic.any() or toxic.all():
        return empty
    kinds = [_telling(texts, toxic, k) for k in BEGINNINGS]  # one after the other: the driver holds the counts of one kind
    names, mark = (np.concatenate(x) for x in zip(*kinds))
    if not mark.any():
        return empty
    # Keys in ascending order, for Model.index; column: position among them by kind.
    order = np.argsort(names)
    column = np.split(np.argsort(order), np.cumsum([len(own) for own, _ in kinds])[:-1])
    names = names[order]
    big_t, big_c = float(toxic.sum()), float((~toxic).sum())
    counts, tag = [], []
    for a, b in slices(texts):
        w = words_of(texts[a:b])
        hit = np.zeros(len(w.start), dtype=bool)
        for k, (own, marked) in zip(BEGINNINGS, kinds):
            hit[_occurrences(w, k, own[marked], np.arange(len(hit)))[0]] = True
        counts.append(w.counts)
        tag.append(hit & np.repeat(toxic[a:b], w.counts))
    counts, tag = np.concatenate(counts), np.concatenate(tag)

    # Training sequences: those with tags, and as many others drawn evenly from the rest.
    start = _segment(counts)
    stop = np.minimum(start + BLOCK, np.repeat(np.cumsum(counts), -(-counts // BLOCK)))
    tagged = np.add.reduceat(tag, start) > 0
    rng = np.random.default_rng(seed)
    plain = np.flatnonzero(~tagged)
    some = rng.permutation(np.flatnonzero(tagged))[: TRAIN_BLOCKS // 2]
    picked = np.sort(np.concatenate((some, rng.permutation(plain)[: TRAIN_BLOCKS - len(some)])))
    lengths = (stop - start)[picked]
    chosen = np.repeat(start[picked] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    slot = np.arange(len(chosen)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = np.repeat(np.arange(len(picked)), lengths)
    token, feat, base = [], [], 0
    for a, b in slices(texts):
        w = words_of(texts[a:b])
        low, high = np.searchsorted(chosen, (base, base + len(w.start)))
        for k, (own, _), at_key in zip(BEGINNINGS, kinds, column):
            at, which = _occurrences(w, k, own, chosen[low:high] - base)
            token.append(at + low)
            feat.append(at_key[which])
        base += len(w.start)
    token, feat = np.concatenate(token), np.concatenate(feat)
    y = tag[chosen]

    theta = np.concatenate((np.zeros(len(names)), [-4.0], np.zeros(4)))
    moment, speed = np.zeros_like(theta), np.zeros_like(theta)
    follows = np.flatnonzero(slot > 0)
    pair = y[follows - 1] * 2 + y[follows]
    seen = np.bincount(pair, minlength=4).astype(float)
    live = np.zeros((BLOCK, len(picked)), dtype=bool)
    live[slot, row] = True
    for it in range(steps):
        weight, bias, trans = theta[: len(names)], theta[-5], theta[-4:].reshape(2, 2)
        emit = np.clip(np.bincount(token, weights=weight[feat], minlength=len(chosen)) + bias, -30, 30)
        e = np.ones((BLOCK, len(picked)))
        e[slot, row] = np.exp(emit)
        step = np.exp(trans)
        alpha = np.zeros((BLOCK, 2, len(picked)))
        x = np.stack([np.ones(len(picked)), e[0]])
        alpha[0] = x / x.sum(0)
        for s in range(1, BLOCK):
            x = step.T @ alpha[s - 1]
            x[1] *= e[s]
            alpha[s] = np.where(live[s], x / x.sum(0), alpha[s - 1])
        beta = np.ones((BLOCK, 2, len(picked)))
        expect = np.zeros(4)
        for s in range(BLOCK - 1, 0, -1):
            lower = np.stack([beta[s, 0], beta[s, 1] * e[s]])
            joint = alpha[s - 1][:, None, :] * step[:, :, None] * lower[None, :, :]
            joint /= joint.sum((0, 1))
            expect += (joint * live[s]).sum(2).ravel()
            up = step @ lower
            beta[s - 1] = np.where(live[s], up / up.sum(0), 1.0)
        both = alpha * beta
        p = (both[:, 1] / both.sum(1))[slot, row]
        grad = np.concatenate((np.bincount(feat, weights=(y - p)[token], minlength=len(names)), [(y - p).sum()], seen - expect))
        grad -= 0.5 * theta * np.concatenate((np.ones(len(names)), [0.0], np.ones(4)))
        moment = 0.9 * moment + 0.1 * grad
        speed = 0.99 * speed + 0.01 * grad**2
        theta = theta + 0.2 * (moment / (1 - 0.9 ** (it + 1))) / (np.sqrt(speed / (1 - 0.99 ** (it + 1))) + 1e-8)
    model = Model(names, theta[: len(names)], float(theta[-5]), theta[-4:].reshape(2, 2), empty.link)

    inputs = []
    for a, b in slices(texts):
        w = words_of(texts[a:b])
        inputs.append(_document_inputs(marginals(model.emissions(w), w.first, model.trans), w.first))
    weight = np.where(toxic, prior / big_t, (1 - prior) / big_c) * len(texts)
    model.link = _fit_link(np.concatenate(inputs), toxic.astype(float), weight)
    return model


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Fit on a bounded sample: at most TOXIC_DOCS and CLEAN_DOCS rows, of TOXIC_BYTES and CLEAN_BYTES of text, reach the
    driver.

    ``labels`` holds ``key`` and ``label`` (1 or 0; other values and nulls are no labels).  The share of toxic documents
    is counted over all labelled rows.  The sample is drawn by the hash of the key from keys alone, so the texts of the
    other documents are not moved.  Without examples of both labels the model gives every text that share (0 if there
    are no labels at all).
    """
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label")).filter(F.col("__label").isin(0, 1))
    # Keys and sizes only: what is shuffled is some bytes a document.
    keys = docs.select(F.col(key).alias("__key"), F.octet_length(text).alias("__size")).join(known, "__key")
    share = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("__label").alias("t")).first()
    if not share["n"]:
        return fit([], np.zeros(0, bool), 0.0)
    usable = keys.filter((F.col("__size") > 0) & (F.col("__size") <= MAX_SAMPLE_BYTES))
    by_text: dict[bytes, int] = {}
    for value, most, bytes_ in ((1, TOXIC_DOCS, TOXIC_BYTES), (0, CLEAN_DOCS, CLEAN_BYTES)):
        first = Window.orderBy("h", "__key")
        own = usable.filter(F.col("__label") == value).groupBy("__key", "__label", F.xxhash64("__key", F.lit(17)).alias("h")).agg(
            F.max("__size").alias("__size")
        )
        # A cut by hash leaves about four times the sample for the ranking, however many labels there are.
        held = share["t"] if value else share["n"] - share["t"]
        own = own.filter(F.pmod("h", F.lit(1_000_000)) < F.lit(min(1_000_000, 4_000_000 * most // max(held, 1) + 1)))
        ranked = own.withColumns({"r": F.row_number().over(first), "upto": F.sum("__size").over(first)})
        within = (F.col("r") <= most) & ((F.col("upto") <= bytes_) | (F.col("r") == 1))
        chosen = ranked.filter(within).select(F.col("__key").alias(key), "__label")
        # At most ``most`` keys; keys that repeat are ranked again with their texts.
        rows = labelled_sample(docs.select(key, text).join(F.broadcast(chosen), key), text, "__label", key, most)
        # In parts of about 1 MB: the driver's JVM holds one at a time.
        for r in rows.repartition(1 + bytes_ // 1_000_000).toLocalIterator():
            by_text[bytes(r["text"])] = value
    texts = sorted(by_text)
    model = fit(texts, np.array([by_text[t] for t in texts], dtype=bool), float(share["t"]) / share["n"])
    del texts, by_text
    _give_back()
    return model


def _give_back() -> None:
    """Returns the memory that the fit has freed to the system, where the C library can: later work on the driver needs it."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row with its ``score``, ``predicted`` (score >= 0.5), expected ``toxic_words`` and toxic ``spans``.

    Spans are code-point offsets of neighbouring words with a marginal of at least SPAN_FLOOR and the largest marginal
    of the span.  A null or empty text has no words and gets the score of a document without toxic words.  Columns of
    ``docs`` named like the new ones are replaced.
    """
    keep = [c for c in docs.columns if c not in SCORES.fieldNames()]
    schema = T.StructType([*[docs.schema[c] for c in keep], *SCORES.fields])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(stream, "__text"):
            w = words_of(texts)
            p = marginals(model.emissions(w), w.first, model.trans)
            x = _document_inputs(p, w.first)
            value = _logistic(x @ model.link)
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(value), pa.array((value >= 0.5).astype(np.int32)), pa.array(np.expm1(x[:, 1]))]
            columns.append(pa.array(_spans(w, p), type=_SPAN_TYPE))
            yield pa.RecordBatch.from_arrays(columns, [*keep, *SCORES.fieldNames()])

    return docs.select(*keep, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def _spans(w: Words, p: np.ndarray) -> list[list[dict]]:
    found: list[list[dict]] = [[] for _ in range(len(w.first) - 1)]
    hit = np.flatnonzero(p >= SPAN_FLOOR)
    if not len(hit):
        return found
    point = np.cumsum((w.buf & 0xC0) != 0x80)
    doc = np.searchsorted(w.first, hit, side="right") - 1
    last = (-1, -1)
    for i, d in zip(hit.tolist(), doc.tolist()):
        origin = point[w.at[d]]
        begin, end = int(point[w.start[i]] - origin), int(point[w.end[i] - 1] - origin) + 1
        if last == (d, i - 1):
            found[d][-1] = {"start": found[d][-1]["start"], "end": end, "p": max(found[d][-1]["p"], float(p[i]))}
        else:
            found[d].append({"start": begin, "end": end, "p": float(p[i])})
        last = (d, i)
    return found
