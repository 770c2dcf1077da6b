import random
import time

import numpy as np
import pytest

from lorewell.llm import packing

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_against_a_plain_search(seed):
    draw = random.Random(seed)
    size = draw.choice([1, 5, 16, 100])
    lengths = np.array([draw.randint(1, size) for _ in range(draw.randint(0, 80))], np.int64)
    rows = packing.best_fit_decreasing(lengths, size)
    free = []
    for piece in np.argsort(-lengths, kind="stable"):
        fitting = [c for c in free if c >= lengths[piece]]
        if fitting:
            free.remove(min(fitting))
        free.append((min(fitting) if fitting else size) - lengths[piece])
    assert sorted(p for row in rows for p in row) == list(range(len(lengths)))
    assert sorted(size - sum(lengths[p] for p in row) for row in rows) == sorted(free)


def unpack(rows, row_tokens):
    """Tokens of every document, put together from its segments."""
    docs = {}
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["positions"], "<i4")
        cu = r["cu_seqlens"]
        assert len(ids) == len(positions) == row_tokens and cu[0] == 0 and cu[-1] == r["n_tokens"] <= row_tokens
        assert len(cu) == len(r["segments"]) + 1
        assert (ids[cu[-1] :] == 50256).all() and (positions[cu[-1] :] == 0).all()
        for start, end, s in zip(cu, cu[1:], r["segments"]):
            assert end - start == s["length"] and list(positions[start:end]) == list(range(s["length"]))
            docs.setdefault((s["id"], s["key"], s["n_doc_tokens"]), []).append((s["first"], ids[start:end]))
    return docs


@pytest.mark.parametrize("block_tokens", [packing.BLOCK_TOKENS, 500])
def test_round_trip(spark, odd_docs, block_tokens):
    rows = packing.pack(odd_docs, VOCABULARY, row_tokens=64, block_tokens=block_tokens).collect()
    encoder = packing._encoder(packing.read_vocabulary(VOCABULARY), packing.PATTERN)
    texts = {}
    for r in odd_docs.select("doc_id", "text").collect():
        if r["text"]:
            key = (None if r["doc_id"] is None else str(r["doc_id"]), r["text"])
            texts[key] = texts.get(key, 0) + 1
    got = {}
    for (doc_id, _, n), pieces in unpack(rows, 64).items():
        firsts = sorted({f for f, _ in pieces})
        copies = len(pieces) // len(firsts)
        assert firsts == list(range(0, n, 64)) and len(pieces) == copies * len(firsts)
        by_first = {f: ids for f, ids in pieces}
        ids = np.concatenate([by_first[f] for f in firsts])
        assert len(ids) == n and ids[-1] == 50256
        got[doc_id, encoder.decode(ids[:-1].tolist())] = copies
    assert got == texts
    assert len({(r["block"], r["row"]) for r in rows}) == len(rows)


def test_little_is_padded(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), cast(id % 90 + 1 as int)) as text")
    rows = packing.pack(docs, VOCABULARY, row_tokens=512).collect()
    assert sum(r["n_tokens"] for r in rows) > 0.97 * 512 * len(rows)


def test_long_words_do_not_stall(spark):
    docs = spark.createDataFrame([(1, "x" * 300_000)], "doc_id long, text string")
    start = time.perf_counter()
    assert packing.pack(docs, VOCABULARY).count() > 10
    assert time.perf_counter() - start < 60


def test_empty(odd_docs):
    assert packing.pack(odd_docs.limit(0), VOCABULARY).count() == 0
