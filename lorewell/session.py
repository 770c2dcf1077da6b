"""Session construction and the settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column is slow for wide structs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def get_session(
    app_name: str = "lorewell", master: str | None = None, **extra: str
) -> SparkSession:
    """Return a session with the package settings; `extra` overrides them.

    Shuffle parallelism is left to the cluster: adaptive execution coalesces
    from whatever `spark.sql.shuffle.partitions` says. Local runs pass their own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
