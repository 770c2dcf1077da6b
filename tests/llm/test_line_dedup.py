import re

import pytest

from lorewell.llm import line_dedup


def trim(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)


def brute(rows, min_sites):
    sites = {}
    for text, source in rows:
        for line in (text or "").split("\n"):
            sites.setdefault(trim(line), set()).add(source)
    bad = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for text, _ in rows:
        lines = (text or "").split("\n")
        kept = None if text is None else "\n".join(x for x in lines if trim(x) not in bad)
        out.append((sum(bool(trim(x)) for x in lines), sum(trim(x) in bad for x in lines), kept))
    return out


@pytest.mark.parametrize("min_sites", [2, 4])
def test_matches_brute_force(spark, odd_docs, min_sites):
    own = [(1000 + i, f"Shared line.\n own {i}\n\tMenu \nrare {i % 3}\n\nMenu", f"s{i % 8}") for i in range(24)]
    docs = odd_docs.unionByName(spark.createDataFrame(own, "doc_id long, text string, source string"), allowMissingColumns=True)
    got = line_dedup.dedup_lines(docs, min_sites=min_sites)
    assert got.columns == [*docs.columns, "clean_text_", "n_lines", "n_removed_lines"]
    rows = got.collect()
    want = brute([(r["text"], r["source"]) for r in rows], min_sites)
    assert [(r["n_lines"], r["n_removed_lines"], r["clean_text_"]) for r in rows] == want
    assert sum(w[1] for w in want) > 24


def test_many_sites_are_estimated(spark):
    """Far above the threshold the sketch decides alone."""
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "concat('everywhere\\nonly ', id, '\\nhalf ', id % 500) as text", "concat('site', id) as source"
    )
    rows = line_dedup.dedup_lines(docs, min_sites=8).collect()
    assert {r["clean_text"] for r in rows} == {f"only {r['doc_id']}\nhalf {r['doc_id'] % 500}" for r in rows}


def test_empty_and_native(spark, odd_docs):
    assert line_dedup.dedup_lines(odd_docs.limit(0)).count() == 0
    plan = line_dedup.dedup_lines(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
