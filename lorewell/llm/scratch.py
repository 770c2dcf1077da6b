"""Intermediate tables of the operators, in the folder the cluster shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import freeze, freeze_python

__all__ = ["freeze", "freeze_python", "partitions_for", "free_name", "column"]


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(wanted: str, taken: list[str]) -> str:
    """`wanted`, with underscores added until no column is called so in any case."""
    lower = {t.lower() for t in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def partitions_for(df: DataFrame) -> int:
    """Partitions of explicit exchanges: the session's number, set for the cluster."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
