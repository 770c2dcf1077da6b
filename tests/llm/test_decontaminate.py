import random
import re

import pyarrow as pa
import pytest
from llm_help import lower

from lorewell.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts, items, window):
    out = []
    for text in texts:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for item, value in items:
            v = WORD.findall(lower(value))
            k = min(window, len(v))
            grams = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in grams:
                    found.add(item or "")
                    hit.update(range(p, p + k))
        out.append((len(w), len(hit), found))
    return out


def cases(draw):
    letters = ["a", "B", "cé", "d1"][: draw.randint(1, 4)]
    texts = [
        None if draw.random() < 0.1 else draw.choice([" ", "-", ", "]).join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        for _ in range(20)
    ]
    items = [(str(i), " ".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))) for i in range(6)]
    return texts, items


@pytest.mark.parametrize("seed", range(30))
def test_matches_brute_force(seed, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 300)
    draw = random.Random(seed)
    texts, items = cases(draw)
    window = draw.choice([2, 3, 5, 10])
    sent = D.build_items([i for i, _ in items], [t for _, t in items], window)
    got = D.match_texts(pa.array(texts), sent, window).to_pylist()
    for g, want, text in zip(got, brute(texts, items, window), texts):
        assert (g["n_words"], g["n_hit"], {m["item_id"] for m in g["matches"]}) == want
        w = WORD.findall(lower(text))
        by_id = dict(items)
        for m in g["matches"]:
            v, s, q, n = WORD.findall(lower(by_id[m["item_id"]])), m["start"], m["item_start"], m["length"]
            assert w[s : s + n] == v[q : q + n]
            assert s == 0 or q == 0 or w[s - 1] != v[q - 1]
            assert s + n == len(w) or q + n == len(v) or w[s + n] != v[q + n]


def test_suffixes_are_sorted():
    shard = D.build_shard(pa.array(["b a b a b", "a b a", "", "b a b a b"]), 4)
    h, stop = shard.hashes, shard.stop
    keys = [tuple(h[p : min(p + 4, stop[p])]) for p in shard.order]
    assert keys == sorted(keys) and sorted(shard.order) == list(range(len(h)))


@pytest.mark.parametrize("item_bytes", [D.ITEM_BYTES, 60])
def test_one_or_many_blocks_of_items(spark, odd_docs, monkeypatch, item_bytes):
    monkeypatch.setattr(D, "ITEM_BYTES", item_bytes)
    items = [("1", "a B cé a"), ("2", "one"), (None, "line one line one"), ("4", None), ("2", "one"), ("5", " . ")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = D.find_matches(odd_docs, benchmark, window=3)
    assert got.columns == [*odd_docs.columns, "n_words_", "n_hit", "matches_"]
    rows = got.collect()
    want = brute([r["text"] for r in rows], items, 3)
    assert [(r["n_words_"], r["n_hit"], {m["item_id"] for m in r["matches_"]}) for r in rows] == want
    kept = D.decontaminate(odd_docs, benchmark, window=3)
    assert kept.columns == odd_docs.columns and kept.count() == sum(not w[1] for w in want)


def test_empty_tables(spark, odd_docs):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(odd_docs, benchmark).count() == odd_docs.count()
    assert D.find_matches(odd_docs.limit(0), benchmark).count() == 0
