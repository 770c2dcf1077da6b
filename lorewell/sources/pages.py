"""Page contents: from a snapshot table, or through a fetch function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..operators.joins import lookup_join


class NoPagesError(ValueError):
    """No page of the list could be read."""


def pages_from_snapshot(
    urls: DataFrame, snapshot: DataFrame, url_col: str = "doc_uri", html_col: str = "html_content"
) -> DataFrame:
    """Contents of the listed pages; failed pages (null or absent) are left out."""
    present = snapshot.select(url_col, html_col).filter(F.col(html_col).isNotNull())
    return lookup_join(urls.select(url_col), present, url_col)


def fetch_pages(
    urls: DataFrame,
    fetch: Callable[[str], str | None],
    url_col: str = "doc_uri",
    html_col: str = "html_content",
) -> DataFrame:
    """Contents through `fetch`, which returns null for a page it cannot read.

    Write the result before reading it twice: every action fetches again.
    """
    schema = T.StructType([T.StructField(url_col, T.StringType()), T.StructField(html_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {url_col: batch[url_col], html_col: [fetch(u) for u in batch[url_col]]}
            )

    pages = urls.select(url_col).mapInPandas(run, schema)
    return pages.filter(F.col(html_col).isNotNull())


def require_pages(written: DataFrame, origin: str) -> DataFrame:
    """Raise when a written page table is empty."""
    if written.isEmpty():
        raise NoPagesError(f"no page of {origin} could be read")
    return written
