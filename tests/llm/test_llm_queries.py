"""Registered queries beside their SQL, and the pipeline beside plain code."""

import duckdb
import pytest
from llm_help import lower, words
from test_decontaminate import brute as matches
from test_mixing import targets
from test_quality import base, verdict
from test_simhash import brute as components

import __spark_entry__ as entry_module
import corpus_pipeline
from checks.compare import rows_of, sql_rows
from lorewell.llm import quality
from lorewell.llm.queries import ORACLES, QUERIES
from lorewell.llm.scratch import freeze

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    names, want = sql_rows(SF_DIR, ORACLES[name])
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, want)


def documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet'").fetchall()


def test_op1(spark):
    import zlib

    rows = QUERIES["op1_sharding"](spark, SF_DIR).collect()
    want = {d: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in documents()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == want and len(rows) == len(want)
    for shard in range(40):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 40, -(-len(rows) // 40))


def test_op7(spark):
    rows = QUERIES["op7_simhash"](spark, SF_DIR).collect()
    want = {d: (f"{p:016x}", c) for d, p, c in components([(d, t) for d, t, _ in documents()])}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want


def test_op9(spark):
    rows = QUERIES["op9_mixing"](spark, SF_DIR).collect()
    sizes, most = {}, {}
    for _, text, source in documents():
        sizes[source] = sizes.get(source, 0) + len(words(text))
        most[source] = max(most.get(source, 0), len(words(text)))
    want = targets(sizes)
    for source in sizes:
        mine = [r for r in rows if r["source"] == source]
        assert all(r["target"] == pytest.approx(want[source]) and r["source_size"] == sizes[source] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[source]) <= most[source]
        assert all(r["taken"] <= 2 * r["size"] for r in mine)


def test_op4_and_op8_cover_their_tables(spark):
    assert QUERIES["op4_layout"](spark, SF_DIR).filter("length(text) > 0").count() == 50
    segments = QUERIES["op8_packing"](spark, SF_DIR).selectExpr("explode(segments) s").select("s.id").distinct()
    assert segments.count() == sum(bool(t) for _, t, _ in documents())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {d: t for d, t, _ in documents()}
    stage = dict(corpus_pipeline.STAGES)

    docs = freeze(stage["quality_rules"](spark, docs, SF_DIR))
    want = {}
    for d, t in kept.items():
        n, _, _, _, repeat = base(t)
        text, lost = verdict(t)
        if n >= 50 and 100 * repeat <= 50 * n and lost <= quality.MAX_LOST * n:
            want[d] = text
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    assert docs.columns == columns and docs.filter("n_chars != length(text)").count() == 0

    docs = freeze(stage["near_duplicates"](spark, docs, SF_DIR))
    want = {d: want[d] for d, _, c in components(list(want.items())) if c == d}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want

    docs = freeze(stage["decontamination"](spark, docs, SF_DIR))
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    hit = matches(list(want.values()), [(str(i), t) for i, t in items], 10)
    want = {d: t for (d, t), h in zip(want.items(), hit) if not h[1]}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want and docs.columns == columns

    before = {r["doc_id"]: r for r in docs.collect()}
    docs = freeze(stage["source_mix"](spark, docs, SF_DIR))
    assert docs.columns == columns
    sizes, taken, most = {}, {}, {}
    for r in before.values():
        n = len(words(r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        most[r["source"]] = max(most.get(r["source"], 0), n)
    rows = docs.collect()
    for r in rows:
        assert r == before[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    for source, target in targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= most[source]

    last = stage["sharding"](spark, docs, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in rows)
    assert lower("A") == "a"


def test_pipeline_runs_whole(spark):
    df = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} == set(df.columns) and df.count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
