import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lorewell.llm import words as W
from lorewell.llm.xxh64 import xxh64

CASES = [
    (W.BLANK_BYTES, rb"[^\x20\x09-\x0D]+", False),
    (W.SYMBOL_BYTES, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
]


@pytest.mark.parametrize("separators,pattern,low", CASES)
@pytest.mark.parametrize("offset", [0, 7])
def test_cut_hash_and_join(separators, pattern, low, offset):
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab A\t\n.é9Z漢") for _ in range(draw.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "  ", "x"]
    got = W.cut(pa.array(texts).slice(offset), separators, low)
    joined = W.joined_by_space(got)
    for d, text in enumerate(texts[offset:]):
        raw = (text or "").encode()
        if low:
            raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
        want = re.findall(pattern, raw)
        lo, hi = got.bounds[d], got.bounds[d + 1]
        assert [got.text(i) for i in range(lo, hi)] == want
        if want:
            assert joined.data[joined.start[lo] : joined.end[hi - 1]].tobytes() == b" ".join(want)
    hashes, known = W.word_hashes(got), {}
    for i, h in enumerate(hashes):
        assert known.setdefault(got.text(i), h) == h
    assert len(set(known.values())) == len(known)
    grams, known = W.gram_hashes(hashes, 3), {}
    for i, h in enumerate(grams):
        assert known.setdefault((got.text(i), got.text(i + 1), got.text(i + 2)), h) == h
    assert len(set(known.values())) == len(known)


def test_blocks_cover_all_texts():
    texts = pa.array(["ab", None, "", "c" * 50, "d"] * 7)
    parts = list(W.blocks(texts, 20))
    assert sum(len(p) for _, p in parts) == len(texts)
    assert [first for first, _ in parts] == list(np.cumsum([0, *[len(p) for _, p in parts]])[:-1])


def test_xxh64_matches_the_library():
    draw = random.Random(3)
    data = bytes(draw.randrange(256) for _ in range(4000))
    start = np.array([draw.randrange(3000) for _ in range(600)] + [0, 5])
    end = start + np.array([draw.choice([0, 1, 3, 4, 7, 8, 20, 31, 32, 33, 63, 64, 100, 256, 257, 900]) for _ in range(602)])
    got = xxh64(np.frombuffer(data, np.uint8), start, end, 42)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(data[s:e], 42) for s, e in zip(start, end)]
