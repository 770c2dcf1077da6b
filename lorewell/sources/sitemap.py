"""Page addresses from sitemap documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import _col

# Fixed pattern: every `loc` element in document order, whatever its namespace.
LOC_PATH = '//*[local-name()="loc"]/text()'


def locations(xml: Column | str) -> Column:
    return F.xpath(_col(xml), F.lit(LOC_PATH))


def read_sitemaps(
    spark: SparkSession, path: str, url_col: str = "doc_uri", max_documents: int | None = None
) -> DataFrame:
    """Addresses of all sitemap files under `path`.

    A sitemap file is limited to 50,000 addresses by its protocol, so a file
    is one row here and files are read in parallel.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_file"), F.col("value")
    )
    return sitemap_urls(files, "value", url_col, max_documents, source="_file")


def sitemap_urls(
    sitemaps: DataFrame, xml_col: str, url_col: str = "doc_uri",
    max_documents: int | None = None, source: str | None = None,
) -> DataFrame:
    """One row per address; `max_documents` keeps the first ones in reading order.

    The order is (source, position). Every task keeps at most `max_documents`
    rows before the merge, as for any sorted limit.
    """
    order = [source] if source else []
    rows = sitemaps.select(*order, F.posexplode(locations(xml_col)).alias("_pos", url_col))
    if max_documents is not None:
        rows = rows.orderBy(*order, "_pos").limit(max_documents)
    return rows.select(url_col)


def first_per_source(
    sitemaps: DataFrame, xml_col: str, source: str, n: int, url_col: str = "doc_uri"
) -> DataFrame:
    """The first `n` addresses of each sitemap."""
    rows = sitemaps.select(source, F.posexplode(locations(xml_col)).alias("_pos", url_col))
    window = Window.partitionBy(source).orderBy("_pos")
    ranked = rows.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n)
    return ranked.select(source, url_col)
