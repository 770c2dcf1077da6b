import random

import pytest
from llm_help import words
from pyspark.sql import functions as F

from lorewell.llm import substring_dedup as S


def brute(docs, k):
    """{(id, text): (n_words, n_removed, kept)} with windows judged on the input."""
    order = sorted({(i, t) for i, t in docs}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    first, out = {}, {}
    for doc in order:
        w = words(doc[1])
        for p in range(len(w) - k + 1):
            first.setdefault(tuple(w[p : p + k]), (doc, p))
    for doc in order:
        w, gone = words(doc[1]), set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] != (doc, p):
                gone.update(range(p, p + k))
        out[doc] = (len(w), len(gone), None if doc[1] is None else " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def random_docs(seed):
    draw = random.Random(seed)
    letters = ["a", "b", "cé", "d"][: draw.choice([1, 2, 4])]
    base = [draw.choice(letters) for _ in range(60)]
    docs = []
    for i in draw.sample(range(1000), 60):
        kind, at = draw.random(), draw.randint(0, 40)
        if kind < 0.1:
            text = None
        elif kind < 0.3:
            text = " ".join(base)
        elif kind < 0.6:
            text = "  ".join(base[at : at + draw.randint(0, 50)] + [draw.choice(letters) for _ in range(20)])
        else:
            text = "\n".join(draw.choice(letters) for _ in range(draw.randint(0, 50)))
        docs.append((i, text))
    return docs


@pytest.mark.parametrize("seed,k,m,group,hot", [
    (1, 4, 2, 2, 1e-9), (2, 6, 3, 1_000_000, 0.05), (3, 20, 5, 2, 2e-5), (4, 3, 3, 1_000_000, 0.3), (5, 20, 5, 3, 0.01),
])
def test_matches_brute_force(spark, monkeypatch, seed, k, m, group, hot):
    monkeypatch.setattr(S, "BLOCK_BYTES", 300)
    monkeypatch.setattr(S, "GROUP_EDGES", group)
    monkeypatch.setattr(S, "HOT_SHARE", hot)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = random_docs(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        rows = S.dedup_substrings(df, k=k, m=m).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r["doc_id"], r["text"]): (r["n_words"], r["n_removed"], r["kept_text"]) for r in rows} == brute(docs, k)


def test_odd_rows(spark, odd_docs):
    got = S.dedup_substrings(odd_docs)
    assert got.columns == [*odd_docs.columns, "kept_text_", "n_words_", "n_removed"]
    rows = got.collect()
    want = brute([(r["doc_id"], r["text"]) for r in rows], S.K)
    assert len(rows) == odd_docs.count()
    assert all((r["n_words_"], r["n_removed"], r["kept_text_"]) == want[r["doc_id"], r["text"]] for r in rows)
    assert sum(w[1] for w in want.values()) > 1000


def test_text_ids_and_spans(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [("b", f"x y z {text} end"), ("a", text), ("c", f"{text} {text}")]
    docs = spark.createDataFrame(rows, "name string, body string")
    kept = {r["name"]: r["kept_text"] for r in S.dedup_substrings(docs, "name", "body").collect()}
    assert kept == {"a": text, "b": "x y z end", "c": ""}
    spans = S.repeated_spans(docs, "name", "body").orderBy("id", "start").collect()
    places = {(r["id"], r["start"], r["length"], r["src_id"], r["src_start"]) for r in spans}
    assert ("b", 3, 51, "a", 0) in places and ("c", 0, 51, "a", 0) in places
    assert sum(r["length"] for r in spans if r["id"] == "c") == 140 - 19 - 19 or len(places) > 3


def test_false_match_is_not_removed(spark, monkeypatch):
    """A hash that calls other words equal does not survive the check at the source."""
    real = S.W.gram_hashes
    docs = spark.createDataFrame(
        [(1, " ".join(f"a{i}" for i in range(30))), (2, " ".join(f"b{i}" for i in range(30)))], "doc_id long, text string"
    )
    spans = spark.createDataFrame([(2, 0, 0, 5, 1, 0, 0)], "id long, key int, start int, length int, src_id long, src_key int, src_start int")
    keys = {r["doc_id"]: r["k"] for r in docs.select("doc_id", F.hash("text").alias("k")).collect()}
    spans = spans.withColumns({"key": F.lit(keys[2]), "src_key": F.lit(keys[1])})
    monkeypatch.setattr(S, "repeated_spans", lambda *a, **k: spans)
    assert {r["n_removed"] for r in S.dedup_substrings(docs).collect()} == {0}
    assert S.W.gram_hashes is real


def test_empty(odd_docs):
    assert S.dedup_substrings(odd_docs.limit(0)).count() == 0
