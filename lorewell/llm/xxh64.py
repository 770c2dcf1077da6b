"""XXH64 of many byte ranges at once, as numpy arrays (public algorithm)."""

from __future__ import annotations

import numpy as np
import xxhash

# The five primes of the algorithm.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)

# Longer ranges are rare in shingles of words and are hashed one by one.
LONG = 256


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[start[i]:end[i]] for every i, unsigned."""
    size = (end - start).astype(np.int64)
    s = np.uint64(seed)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    halves = np.ndarray((len(data) + 1,), "<u4", padded, 0, (1,))
    at = start.astype(np.int64).copy()
    with np.errstate(over="ignore"):
        out = np.full(len(size), s + P5, np.uint64)
        wide = np.flatnonzero((size >= 32) & (size <= LONG))
        if len(wide):
            acc = [np.full(len(wide), v, np.uint64) for v in (s + P1 + P2, s + P2, s, s - P1)]
            stripes = size[wide] // 32
            for k in range(int(stripes.max())):
                live = np.flatnonzero(stripes > k)
                base = at[wide[live]] + 32 * k
                for j in range(4):
                    acc[j][live] = _round(acc[j][live], lanes[base + 8 * j])
            h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                h = (h ^ _round(np.uint64(0), a)) * P1 + P4
            out[wide] = h
            at[wide] += 32 * stripes
        out += size.astype(np.uint64)
        rest = np.where(size <= LONG, size, 0)
        rest = np.where(rest >= 32, rest % 32, rest)
        for k in range(3):
            live = np.flatnonzero(rest >= 8 * (k + 1))
            h = out[live] ^ _round(np.uint64(0), lanes[at[live]])
            out[live] = _rotl(h, 27) * P1 + P4
            at[live] += 8
        rest = rest % 8
        live = np.flatnonzero(rest >= 4)
        h = out[live] ^ (halves[at[live]].astype(np.uint64) * P1)
        out[live] = _rotl(h, 23) * P2 + P3
        at[live] += 4
        rest = rest % 4
        for k in range(3):
            live = np.flatnonzero(rest > k)
            h = out[live] ^ (padded[at[live]].astype(np.uint64) * P5)
            out[live] = _rotl(h, 11) * P1
            at[live] += 1
        out = (out ^ (out >> np.uint64(33))) * P2
        out = (out ^ (out >> np.uint64(29))) * P3
        out ^= out >> np.uint64(32)
    view = memoryview(data)
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh64_intdigest(view[start[i] : end[i]], seed)
    return out
