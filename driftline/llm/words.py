"""Words of many texts at once: byte tables and prefix sums instead of a loop per word.

A word is a maximal run of ASCII digits, ASCII letters (lower-cased) and characters beyond ASCII, which in UTF-8 is a
run of bytes from those classes.  All helpers take lists of UTF-8 byte strings and treat ``None`` as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# One slice of work: bounds the memory of a task however long an Arrow batch is (a longer text is a slice of its own).
SLICE_BYTES = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of the splitmix generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hash values as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 65_536), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have


@dataclass
class Words:
    """Words of a slice of texts; ``first[d] .. first[d + 1]`` are the words of text d."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    at: np.ndarray  # where each text begins in buf

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word: a polynomial over its bytes, scrambled."""
        n = len(self.buf)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n)[:n], out=sums[1:])
        poly = (sums[self.end] - sums[self.start]) * _power("down", _INVERSE, n)[self.start]
        return mix(poly ^ ((self.end - self.start).astype(np.uint64) << np.uint64(56)))

    def text(self, i: int) -> str:
        return bytes(self.buf[self.start[i] : self.end[i]]).decode("utf-8", "replace")


def words_of(texts: list[bytes | None]) -> Words:
    parts = [t or b"" for t in texts]
    lengths = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    buf = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    inside = _IS_WORD[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[::2], edge[1::2]
    return Words(buf, start, end, np.searchsorted(start, at), at[:-1])


def one_hash(word: str) -> int:
    return int(words_of([word.encode()]).hashes()[0])


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together stay under ``limit`` bytes; none is left out."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t or b"")
        if i > begin and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts)


def batches(stream: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Arrow batches cut to slices, with the texts (a binary column) as a list."""
    for batch in stream:
        texts = batch.column(text).to_pylist()
        for a, b in slices(texts):
            yield batch.slice(a, b - a), texts[a:b]
