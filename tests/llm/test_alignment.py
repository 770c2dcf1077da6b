"""Cross-tokenizer alignment against a plain aligner, with tiny merge-path pieces."""

import numpy as np
from align_brute import A, B, brute

from lorewell.llm import alignment

DOCS = [
    (1, "Hello  wörld <s> <|endoftext|> 日本\ttab\nnew line, and more words here."),
    (2, None),
    (3, ""),
    (None, "A text without an id, but with words."),
    (5, "Hello  wörld <s> <|endoftext|> 日本\ttab\nnew line, and more words here."),
    (5, "Hello  wörld <s> <|endoftext|> 日本\ttab\nnew line, and more words here."),
    (7, "long " * 400 + "end."),
    (8, "Ⅻ full-width ＡＢＣ text that a normaliser may change"),
    (9, "word " * 5000),
]


def test_diagonal_split_is_the_merge():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(1, 60, rng.integers(0, 20)))
        b = np.unique(rng.integers(1, 60, rng.integers(0, 20)))
        merged = sorted([(x, 0, k) for k, x in enumerate(a)] + [(x, 1, k) for k, x in enumerate(b)])
        for d in range(len(a) + len(b) + 1):
            i, j = alignment.diagonal_split(a, b, d)
            head = merged[:d]
            want = sum(1 for m in head if m[1] == 0)
            assert i == want and j in (d - want, d - want + 1)
            if j == d - want + 1:
                assert a[i - 1] == b[j - 1]


def test_align_against_brute_force(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("n_links", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    want = sorted(brute([(d, t) for d, t in DOCS]), key=str)
    for piece in (3, 7, alignment.PIECE):
        got = sorted((tuple(r) for r in alignment.align(df, A, B, piece=piece).collect()), key=str)
        assert got == want
    assert any(w[1] == 0 for w in want) and any(w[3] > 1 for w in want)


def test_align_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, A, B).count() == 0


def test_links_and_fragments_are_built_in_slices(monkeypatch):
    import pyarrow as pa

    enc = alignment.Encoders(A, B)
    docs = pa.RecordBatch.from_pydict({"key": [0, 1, 2], "doc_id": [7, 8, 9], "text": ["word and words " * 300, "", "end of it"]})
    pieces = pa.Table.from_batches(alignment._encode_batch(enc, docs, 50)).to_batches()[0]
    slices = list(alignment._token_slices(pieces, 200))
    tokens = [sum(len(x) for n in ("a_ids", "b_ids") for x in s.column(n).to_pylist()) for s in slices]
    assert sum(s.num_rows for s in slices) == pieces.num_rows and max(tokens) <= 200  # one slice before
    parts = pa.Table.from_batches([alignment._piece_batch(enc, s) for s in slices])
    whole = pa.Table.from_batches([alignment._piece_batch(enc, pieces)])
    assert parts.to_pylist() == whole.to_pylist()


def test_complete_groups_of_a_piece_are_one_text():
    ends = np.arange(1, 2001)
    links, cuts, frags = alignment.piece_groups(ends, ends, ends, ends, 2000)
    assert (len(links), cuts, len(frags)) == (2000, 2000, 3)  # 4,000 fragments before
    assert "".join(t for _, _, t in sorted(frags)) == "".join(f"{i}|{i}" + (";" if i < 2000 else "") for i in ends)


def test_nothing_is_stored_but_the_counted_links_and_fragments(spark, monkeypatch):
    stored, freeze = [], alignment.freeze_python

    def watch(df, label, **options):
        stored.append((label, df.columns, freeze(df, label, **options)))
        return stored[-1][2]

    monkeypatch.setattr(alignment, "freeze_python", watch)
    df = spark.createDataFrame([(1, "the the the the " * 40), (2, None), (3, "one two")], "doc_id long, text string")
    alignment.align(df, A, B, piece=64).collect()
    assert [s[0] for s in stored] == ["align-pieces"] and "a_ids" not in stored[0][1]
    rows = stored[0][2].collect()
    assert {r.doc_id: r.pieces for r in rows}[3] == 1 and {r.doc_id: r.pieces for r in rows}[1] > 1
    assert all(len({(x.a, x.b) for x in r.links}) == len(r.links) for r in rows)
    assert max(x.n for r in rows for x in r.links) > 5


def plain_groups(a_ids, a_ends, b_ids, b_ends, total):
    common = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    group = lambda end: sum(c < end for c in common)
    texts = {}
    for side, ids, ends, sep in ((0, a_ids, a_ends, "|"), (1, b_ids, b_ends, ";")):
        for i, end in zip(ids.tolist(), ends.tolist()):
            last = "" if side and end == total else sep if end in common else ","
            texts[group(end), side] = texts.get((group(end), side), "") + f"{i}{last}"
    body = "".join(texts.pop((g, side)) for g in range(1, len(common)) for side in (0, 1))
    head = [(0, side, texts.pop((0, side))) for side in (0, 1) if (0, side) in texts]
    tail = [(g, side, text) for (g, side), text in sorted(texts.items())]
    links = [(int(a_ids[a_ends == c][0]), int(b_ids[b_ends == c][0])) for c in common]
    return links, len(common), head + [(1, 0, body)] * bool(body) + tail


def test_groups_of_pieces_are_those_of_a_plain_search():
    rnd = np.random.default_rng(5)
    alignment._decimals.cache_clear()
    for case in range(300):
        top = 2 ** int(rnd.integers(1, 16))
        a_ends, b_ends = (np.sort(rnd.choice(60, int(n), replace=False)) for n in rnd.integers(0, 30, 2))
        if case % 2:  # the last piece of a document
            a_ends, b_ends = np.append(a_ends, 60), np.append(b_ends, 60)
        a_ids, b_ids = (rnd.integers(0, top, len(x)).astype(np.int32) for x in (a_ends, b_ends))
        args = (a_ids, a_ends, b_ids, b_ends, 60)
        assert alignment.piece_groups(*args) == plain_groups(*args), case
    # The texts of the ids are made once, whatever the largest id of a piece.
    assert alignment._decimals.cache_info().misses == 1
