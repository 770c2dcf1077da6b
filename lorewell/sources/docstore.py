"""Stored documents, keyed by their address without a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import relative_path


def save_content(
    df: DataFrame, path: str, url_prefix: str = "",
    uri_col: str = "doc_uri", content_col: str = "html_content", mode: str = "overwrite",
) -> None:
    """Write (relative path, whether under the prefix, content) rows as one Parquet table.

    Addresses outside the prefix keep their whole address as the path.

    A table instead of one file per document: millions of small files would
    cost more to list than to read.
    """
    df.select(
        relative_path(uri_col, url_prefix).alias("rel_path"),
        F.coalesce(F.col(uri_col).startswith(url_prefix), F.lit(False)).alias("under_prefix"),
        F.col(content_col).alias("content"),
    ).write.mode(mode).parquet(path)


def load_content(
    spark: SparkSession, path: str, url_prefix: str = "",
    uri_col: str = "doc_uri", content_col: str = "html_content",
) -> DataFrame:
    """Read stored documents and rebuild their addresses."""
    stored = spark.read.schema("rel_path string, under_prefix boolean, content string").parquet(path)
    prefix = F.when(F.col("under_prefix"), F.lit(url_prefix)).otherwise(F.lit(""))
    return stored.select(
        F.concat(prefix, F.col("rel_path")).alias(uri_col),
        F.col("content").alias(content_col),
    )


def load_content_files(
    spark: SparkSession, folder: str, url_prefix: str = "",
    uri_col: str = "doc_uri", content_col: str = "html_content",
) -> DataFrame:
    """Read one-file-per-document folders written by other tools."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base)
    root_path = root.toUri().getPath().rstrip("/") + "/"
    files = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    local = F.url_decode(F.substring_index(F.col("_metadata.file_path"), root_path, -1))
    return files.select(
        F.concat(F.lit(url_prefix), local).alias(uri_col), F.col("value").alias(content_col)
    )
