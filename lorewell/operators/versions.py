"""Selecting and listing application versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import _col

ALL_VERSIONS = "*"


def select_versions(
    df: DataFrame, versions: Sequence[str] | None, column: Column | str
) -> DataFrame:
    """Keep rows of the given version URIs; `*` anywhere in the list keeps all."""
    if versions is None or ALL_VERSIONS in versions:
        return df
    return df.filter(_col(column).isin(list(versions)))


def distinct_versions(requests: DataFrame) -> DataFrame:
    """Version URIs present in a request log, sorted."""
    return (
        requests.select(F.col("trace.app_version_id").alias("app_version_id"))
        .distinct()
        .orderBy("app_version_id")
    )
