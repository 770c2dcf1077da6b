"""Words of whole texts as numpy arrays, cut batch by batch inside tasks.

A batch of texts is one UTF-8 buffer. Separator bytes are found with a table,
so cutting, lower-casing and hashing are array operations. Every byte of a
multi-byte character belongs to a word in both word classes used here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Separators of blank-separated words, for the JVM and as bytes.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_BYTES = (0x20, *range(0x09, 0x0E))
# Bytes outside ASCII letters and digits.
SYMBOL_BYTES = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))

# Bytes of text handled at once; a single longer text is handled alone.
BLOCK_BYTES = 1 << 20
# Powers are kept up to this many; two such tables a base and worker.
KEPT_POWERS = 2 << 20

# Odd multipliers of the polynomial hashes.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15 | 2 | 1)
WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def native_words(text: Column | str) -> Column:
    """Blank-separated words of a text as an array; none for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(column, F.lit("")), BLANKS), lambda w: w != "")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; those of a usual block are kept."""
    known = _POWERS.get(int(base))
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if n <= KEPT_POWERS:
        _POWERS[int(base)] = out
    return out


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


@dataclass
class Words:
    """Words of a block: word w is data[start[w]:end[w]]; those of document d are
    bounds[d] to bounds[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def text(self, w: int) -> bytes:
        return self.data[self.start[w] : self.end[w]].tobytes()


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of at most `block_bytes`, or of one text, with their position."""
    _, at = _buffers(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, texts.slice(first, last - first)
        first = last


def cut(texts: pa.Array, separators=BLANK_BYTES, lower: bool = False) -> Words:
    """Words of every text; `lower` lower-cases A to Z first."""
    raw, at = _buffers(texts)
    n = len(raw)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        raw = table[raw]
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    inside = is_word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[(at > 0) & (at < n)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(raw, start, np.flatnonzero(ends) + 1, np.searchsorted(start, at))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(words.data)
    values = (words.data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(BYTE_BASE, n), out=sums[1:])
    back = powers(inverse(BYTE_BASE), n)
    out = (sums[words.end] - sums[words.start]) * back[words.start]
    return mix(out ^ (words.end - words.start).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, whatever document they belong to."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(WORD_BASE, len(hashes)), out=sums[1:])
    back = powers(inverse(WORD_BASE), len(hashes))
    return mix((sums[n:] - sums[:-n]) * back[: len(hashes) - n + 1])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All members of the ranges start .. start + length, one after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def joined_by_space(words: Words) -> Words:
    """The same words with exactly one space between neighbours of a text."""
    n = len(words.data)
    keep = np.zeros(n, bool)
    keep[spans(words.start, words.end - words.start)] = True
    gap = words.end[words.end < n]
    gap = gap[~keep[gap]]
    keep[gap] = True
    data = words.data.copy()
    data[gap] = 0x20
    at = np.cumsum(keep) - keep
    start = at[words.start]
    return Words(data[keep], start, start + (words.end - words.start), words.bounds)


def covered(first: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in at least one range."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + lengths, -1)
    return np.cumsum(steps[:-1]) > 0
