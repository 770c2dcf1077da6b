"""LP packing: pieces against a plain encoder, sequences checked for room and gaps."""

import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lorewell.llm import lp_packing as L

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def test_cut_keeps_every_token():
    for n in (1, 5, 1024, 1025, 2048, 3000):
        parts = L.cut(n)
        assert sum(k for _, k in parts) == n and all(0 < k <= 1024 for _, k in parts)
        assert all(k == 1024 for _, k in parts[1:]) and [s for s, _ in parts] == list(itertools.accumulate([0] + [k for _, k in parts[:-1]]))


def test_knapsack_against_all_configurations():
    rng = np.random.default_rng(3)
    for _ in range(20):
        values = np.zeros(17)
        for l in rng.choice(np.arange(1, 17), 5, replace=False):
            values[l] = rng.random()
        config = L.best_configuration(values, 16)
        got = sum(values[l] * a for l, a in config.items())
        assert sum(l * a for l, a in config.items()) <= 16
        best = 0.0
        for combo in itertools.product(*[range(16 // l + 1) for l in range(1, 17) if values[l] > 0]):
            ls = [l for l in range(1, 17) if values[l] > 0]
            if sum(l * a for l, a in zip(ls, combo)) <= 16:
                best = max(best, sum(values[l] * a for l, a in zip(ls, combo)))
        assert abs(got - best) < 1e-9


def test_plan_covers_every_count_within_room():
    counts = {1024: 7, 1000: 3, 24: 5, 600: 4, 400: 4, 13: 100, 1: 1}
    plan = L.plan(counts)
    covered = {}
    for m, content in plan:
        assert m > 0 and sum(l * a for l, a in content.items()) <= 1024
        for l, a in content.items():
            covered[l] = covered.get(l, 0) + m * a
    assert all(covered.get(l, 0) >= n for l, n in counts.items())
    total = sum(l * n for l, n in counts.items())
    assert sum(m for m, _ in plan) <= -(-total // 1024) + 1


def _check(rows, docs):
    tok = Tokenizer.from_file(VOCAB)
    want = set()
    for d, t in docs:
        ids = np.asarray(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (s, n) in enumerate(L.cut(len(ids))):
            want.add((d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str) or sorted(map(str, got)) == sorted(map(str, _multi(docs, tok)))
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in seqs.values():
        v.sort()
        assert v[0][0] == 0 and sum(n for _, n in v) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(v, v[1:]))


def _multi(docs, tok):
    out = []
    for d, t in docs:
        ids = np.asarray(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (s, n) in enumerate(L.cut(len(ids))):
            out.append((d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    return out


def test_pack_odd_rows(spark):
    docs = [(1, "Hello world"), (2, None), (3, ""), (None, "no id <|endoftext|> here"), (5, "word " * 3000),
            (6, "Hello world"), (6, "Hello world")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sequence_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(9))
    rows = L.pack(df, VOCAB).collect()
    assert sorted(map(str, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows])) == sorted(
        map(str, _multi(docs, Tokenizer.from_file(VOCAB)))
    )
    _check(rows, docs)
    assert max(r.piece for r in rows if r.doc_id == 5) >= 2


def test_pack_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.pack(empty, VOCAB).count() == 0
