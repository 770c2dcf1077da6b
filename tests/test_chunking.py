import hypothesis.strategies as st
from hypothesis import given, settings
from pyspark.sql import functions as F

from lorewell.config import CorpusConfig
from lorewell.operators import chunking as ch


def words(n, prefix="w"):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_small_sections_merge_up_to_half():
    assert ch.merge_sections([("A", words(3)), ("B", words(3))], 20) == [f"A\n{words(3)}\nB\n{words(3)}"]
    merged = ch.merge_sections([("A", words(6)), ("B", words(6))], 20)
    assert merged == [f"A\n{words(6)}", f"B\n{words(6)}"]


def test_first_section_over_half_gives_no_empty_chunk():
    assert ch.merge_sections([("", words(30)), ("B", "x")], 20) == [words(30), "B\nx"]


def test_minimum_is_strict():
    assert ch.chunk_page([""], [words(20)], 500, 50, 20) == []
    assert ch.chunk_page([""], [words(21)], 500, 50, 20) == [words(21)]


def test_long_word_is_cut_by_a_character_counter():
    parts = ch.split_text("x" * 100, 30, 0, count=len)
    assert "".join(parts) == "x" * 100 and max(map(len, parts)) <= 30


def test_references_are_decoded_once():
    text = "&amp;lt; &eacute; " + words(30)
    assert ch.chunk_page([""], [text], 500, 50, 20)[0].startswith("&lt; é ")


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text(alphabet="ab \n", max_size=40), max_size=30).map("".join),
    st.integers(2, 12),
    st.integers(0, 4),
)
def test_split_keeps_every_word_within_size(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = ch.split_text(text, size, overlap)
    assert all(ch.count_words(c) <= size for c in chunks)
    ours = [w for c in chunks for w in ch.WORD.findall(c)]
    rest = iter(ours)
    assert all(w in rest for w in ch.WORD.findall(text))
    if overlap == 0:
        assert ours == ch.WORD.findall(text)


def test_overlap_repeats_the_tail():
    chunks = ch.split_text(words(25), 10, 3)
    assert chunks[0].split()[-3:] == chunks[1].split()[:3]


PAGE = '<html><div itemprop="articleBody"><h2>T</h2><p>{}</p></div><div>{}</div></html>'


def test_chunk_pages(spark):
    rows = [("a", PAGE.format(words(40), words(90, "no"))), ("b", "<p>no container</p>"), ("c", None), ("d", PAGE.format("short", "x"))]
    pages = spark.createDataFrame(rows, "doc_uri string, html_content string")
    out = ch.chunk_pages(pages).collect()
    assert [(r.doc_uri, r.pos, r.n_tokens) for r in out] == [("a", 0, 41)]
    assert out[0].text == f"T\n{words(40)}"
    assert ch.chunk_pages(pages.limit(0)).columns == ["doc_uri", "pos", "text", "n_tokens"]


def test_token_counter_hook(spark):
    pages = spark.createDataFrame([("a", PAGE.format(words(40), ""))], "doc_uri string, html_content string")
    config = CorpusConfig(chunk_size=50, chunk_overlap=0, min_chunk_size=5)
    by_chars = ch.chunk_pages(pages, config, token_counter=len).collect()
    assert len(by_chars) > 2 and all(len(r.text) <= 50 for r in by_chars)


def test_sliding_windows(spark):
    docs = spark.createDataFrame([("a", words(25)), ("b", ""), ("c", words(4)), ("d", None)], "doc_uri string, content string")
    config = CorpusConfig(chunk_size=10, chunk_overlap=4, min_chunk_size=2)
    out = ch.sliding_chunks(docs, "content", config).orderBy("doc_uri", "pos").collect()
    a = [r.text.split() for r in out if r.doc_uri == "a"]
    assert [x[0] for x in a] == ["w0", "w6", "w12", "w18"]
    assert a[0][-4:] == a[1][:4]
    assert [r.n_tokens for r in out if r.doc_uri == "c"] == [4]
    stats = {r.doc_uri: r for r in ch.chunk_statistics(ch.sliding_chunks(docs, "content", config)).collect()}
    assert (stats["a"].n_chunks, stats["a"].max_tokens) == (len(a), 10)


def test_parse_runs_once_per_page(spark):
    pages = spark.createDataFrame([("a", PAGE.format(words(40), ""))], "doc_uri string, html_content string")
    plan = ch.chunk_pages(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--(?:-?>|.*?(?:-->|") == 1
    assert "Exchange" not in ch.chunk_pages(pages)._jdf.queryExecution().executedPlan().toString()
