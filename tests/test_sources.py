import pytest
from pyspark.sql import functions as F

from lorewell.config import CorpusConfig
from lorewell.plans.corpus import build_corpus
from lorewell.schemas import EVAL_DATASET
from lorewell.sources import docstore, index, pages, scratch, sitemap, tables

XML = (
    '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    "<url><loc>http://x/a?b=1&amp;c=2</loc></url><url><loc>http://x/b</loc></url><url><loc>http://x/c</loc></url></urlset>"
)


def column(df):
    return [r[0] for r in df.collect()]


def test_sitemap_files(spark, tmp_path):
    (tmp_path / "one.xml").write_text(XML)
    (tmp_path / "two.xml").write_text(XML.replace("http://x", "http://y"))
    urls = column(sitemap.read_sitemaps(spark, str(tmp_path)))
    assert len(urls) == 6 and "http://x/a?b=1&c=2" in urls
    assert column(sitemap.read_sitemaps(spark, str(tmp_path), max_documents=4)) == [
        "http://x/a?b=1&c=2", "http://x/b", "http://x/c", "http://y/a?b=1&c=2",
    ]
    rows = spark.createDataFrame([("m", XML), ("n", XML)], "s string, xml string")
    assert sitemap.first_per_source(rows, "xml", "s", 2).count() == 4


def test_pages_from_snapshot_and_fetch(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_uri string")
    snapshot = spark.createDataFrame([("a", "<p>"), ("b", None), ("z", "x")], "doc_uri string, html_content string")
    assert [tuple(r) for r in pages.pages_from_snapshot(urls, snapshot).collect()] == [("a", "<p>")]
    fetched = pages.fetch_pages(urls, lambda u: None if u == "b" else f"<{u}>")
    assert sorted(map(tuple, fetched.collect())) == [("a", "<a>"), ("c", "<c>")]
    with pytest.raises(pages.NoPagesError):
        pages.require_pages(pages.fetch_pages(urls, lambda u: None), "site")
    assert pages.require_pages(snapshot, "site") is snapshot


def test_document_store_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("https://x/a b.html", "A"), ("https://x/c/d.html", "C"), ("http://b/y", "B"), ("c/d.html", "D")],
                               "doc_uri string, html_content string")
    path = str(tmp_path / "store")
    docstore.save_content(df, path, "https://x/")
    assert sorted(column(spark.read.parquet(path).select("rel_path"))) == ["a b.html", "c/d.html", "c/d.html", "http://b/y"]
    assert sorted(map(tuple, docstore.load_content(spark, path, "https://x/").collect())) == sorted(map(tuple, df.collect()))


def test_document_folder(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "a b.html").write_text("A\nA")
    (tmp_path / "c" / "d.html").write_text("C")
    got = docstore.load_content_files(spark, str(tmp_path), "https://x/")
    assert sorted(map(tuple, got.collect())) == [("https://x/a b.html", "A\nA"), ("https://x/c/d.html", "C")]


def test_versioned_table_overwrites_itself(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() == 0
    with pytest.raises(ValueError):
        table.read()
    table.overwrite(spark.range(10))
    old = table.read()
    table.overwrite(old.filter("id < 4"))
    assert (table.version(), table.read().count(), old.count()) == (2, 4, 10)


def test_failed_overwrite_keeps_the_old_version(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    with pytest.raises(Exception):
        table.overwrite(spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("id")))
    assert (table.version(), table.read().count()) == (1, 3)
    table.overwrite(spark.range(5))
    assert (table.version(), table.read().count()) == (2, 5)


def test_write_modes(spark, tmp_path):
    modes = tables.WriteModes(spark, str(tmp_path / "state"))

    def next_mode(experiment, version):
        mode = modes.peek(experiment, version)
        assert modes.peek(experiment, version) == mode
        modes.commit(experiment, version)
        return mode

    got = [next_mode(e, v) for e, v in (("x", 1), ("x", 1), ("y", 1), ("x", 2), ("x", 1), ("y", 1))]
    assert got == ["overwrite", "append", "overwrite", "overwrite", "overwrite", "append"]


def test_template_and_view(spark, tmp_path):
    path = str(tmp_path / "template")
    tables.write_template(spark, path)
    empty = tables.read_table(spark, path)
    assert empty.count() == 0 and empty.schema.names == EVAL_DATASET.names
    tables.register_view(spark.range(3), "three")
    assert spark.sql("select count(*) from three").first()[0] == 3
    assert tables.read_table(spark, "three").count() == 3


def test_catalog_table(spark):
    name = "lorewell_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.write_table(spark.range(2), name, "overwrite")
    tables.write_table(spark.range(2), name, "append")
    assert tables.read_table(spark, name).count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_index_update(spark):
    have = spark.createDataFrame([("a", 1), ("b", 1)], "chunk_id string, v int")
    want = spark.createDataFrame([("b", 2), ("c", 2), ("c", 2)], "chunk_id string, v int")
    assert sorted(map(tuple, index.index_delta(have, want).collect())) == [("a", "retire"), ("c", "add")]
    assert sorted(map(tuple, index.sync_index(have, want.distinct()).collect())) == [("b", 1), ("c", 2)]


def test_rebuilt_corpus_changes_nothing(spark):
    html = '<div itemprop="articleBody"><p>' + "word " * 40 + "</p></div>"
    rows = spark.createDataFrame([("u", html), ("v", html)], "doc_uri string, html_content string")
    first = build_corpus(rows, CorpusConfig(embed_dim=8))
    again = build_corpus(rows.repartition(4), CorpusConfig(embed_dim=8))
    assert first.columns == ["chunk_id", "doc_uri", "text", "embedding"]
    assert first.count() == 2 and index.index_delta(first, again).count() == 0


def test_shared_folder_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert scratch.shared_folder(spark) == before.rstrip("/")
    else:
        assert "lorewell-" in scratch.shared_folder(spark)
    frozen = scratch.freeze(spark.range(5))
    assert frozen.count() == 5 and scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_small_scans_are_spread(spark, tmp_path):
    path = str(tmp_path / "small")
    spark.range(100).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    assert tables.spread_small(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 64)
    assert tables.spread_small(wide) is wide


def test_scratch_scope_removes_what_was_made_inside(spark):
    outer = scratch.freeze(spark.range(3))
    with scratch.scratch_scope(spark):
        inner = scratch.freeze(spark.range(4))
        assert inner.count() == 4
        path = scratch._made[-1]
    assert not tables.path_exists(spark, path) and outer.count() == 3


def test_package_is_shipped_once(spark):
    from lorewell.sources.shipping import ship_package

    ship_package(spark)
    before = spark.sparkContext.listFiles
    ship_package(spark)
    assert list(before) == list(spark.sparkContext.listFiles) and any("lorewell" in f for f in before)


def test_index_store(spark, tmp_path):
    def frame(*pairs):
        return spark.createDataFrame(list(pairs), "chunk_id string, n int")

    store = index.IndexStore(spark, str(tmp_path / "index"))
    store.sync(frame(("a", 1), ("b", 2), ("b", 2)))
    store.sync(frame(("b", 9), ("c", 3)))
    assert sorted(map(tuple, store.read(with_batch=True).collect())) == [("b", 2, 1), ("c", 3, 2)]
    # What an update left behind that failed before its commit.
    frame(("x", 1)).write.parquet(f"{store.root}/added/batch=3")
    frame(("b", 1)).select("chunk_id").write.parquet(f"{store.root}/retired/batch=3")
    assert sorted(map(tuple, store.read().collect())) == [("b", 2), ("c", 3)]
    store.sync(frame(("a", 5), ("c", 3)))
    assert sorted(map(tuple, store.read(with_batch=True).collect())) == [("a", 5, 3), ("c", 3, 2)]
    store.compact()
    assert sorted(map(tuple, store.read(with_batch=True).collect())) == [("a", 5, 4), ("c", 3, 4)]
    store.sync(frame())
    assert store.read().count() == 0
