"""Grouped means over a join, and exact quantiles that never gather a group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import version_number
from ..sources.scratch import freeze
from .joins import hot_keys, salted_join


def version_weights(requests: DataFrame) -> DataFrame:
    """How many request rows each (request id, version number) has."""
    return (
        requests.select(
            F.col("request.request_id").alias("request_id"),
            version_number("trace.app_version_id").alias("rag_version"),
        )
        .groupBy("request_id", "rag_version")
        .agg(F.count(F.lit(1)).alias("n_requests"))
    )


def means_over_join(
    assessments: DataFrame, requests: DataFrame, values: Sequence[str], n_rows: str | None = None
) -> DataFrame:
    """Mean of `values` by version over assessments JOIN requests.

    `assessments` has `request_id` and the value columns. Both sides are summed
    per request id before the join, so the map side combines a frequent id and
    the join sees one assessment row per id. Nulls are left out of a mean.
    `n_rows` adds the number of joined rows under that name.
    """
    sums = [F.sum(v).alias(f"_s_{v}") for v in values]
    counts = [F.count(v).alias(f"_n_{v}") for v in values]
    per_request = assessments.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_rows"), *sums, *counts
    )
    joined = per_request.join(version_weights(requests), "request_id")
    weight = F.col("n_requests")
    means = [
        F.try_divide(
            F.sum(F.col(f"_s_{v}").cast("double") * weight), F.sum(F.col(f"_n_{v}") * weight)
        ).alias(v)
        for v in values
    ]
    if n_rows:
        means.append(F.sum(F.col("_rows") * weight).alias(n_rows))
    return joined.groupBy("rag_version").agg(*means)


def values_over_join(assessments: DataFrame, requests: DataFrame, value: str) -> DataFrame:
    """Distinct (version, value) of assessments JOIN requests with its row count."""
    per_request = assessments.groupBy("request_id", value).agg(F.count(F.lit(1)).alias("_n"))
    frequent = hot_keys(assessments, "request_id")
    joined = salted_join(per_request, version_weights(requests), "request_id", hot=frequent)
    return joined.groupBy("rag_version", value).agg(
        F.sum(F.col("_n") * F.col("n_requests")).alias("n")
    )


# Distinct values ranked in one task at most, about.
ROWS_A_RANGE = 1_000_000


def exact_quantiles(
    counted: DataFrame,
    group: str,
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    count: str = "n",
    ranges: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation from distinct values and their counts.

    Values are range-partitioned over the whole cluster, in ranges whose number
    follows that of the values, and stored with their
    partition number. Row counts per (group, partition) then tell which few
    partitions hold the wanted positions; only those are ranked. No group is
    ever gathered in one task. Runs jobs while the plan is built.
    """
    present = counted.filter(F.col(value).isNotNull())
    session = counted.sparkSession
    n_ranges = ranges
    if n_ranges is None:
        present = freeze(present, "counts")
        n_ranges = max(
            int(session.conf.get("spark.sql.shuffle.partitions")), math.ceil(present.count() / ROWS_A_RANGE)
        )
    spread = present.repartitionByRange(n_ranges, F.col(group), F.col(value)).withColumn(
        "_part", F.spark_partition_id()
    )
    frozen = freeze(spread)

    totals = frozen.groupBy(group, "_part").agg(F.sum(count).alias("_size"))
    by_part = Window.partitionBy(group).orderBy("_part")
    offsets = (
        totals.withColumn("_end", F.sum("_size").over(by_part))
        .withColumn("_total", F.sum("_size").over(Window.partitionBy(group)))
        .withColumn("_start", F.col("_end") - F.col("_size"))
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    wanted = [f(position(p)) for p in probabilities for f in (F.floor, F.ceil)]
    holds = F.lit(False)
    for index in wanted:
        holds = holds | ((index >= F.col("_start")) & (index < F.col("_end")))
    needed = offsets.filter(holds).select(group, "_part", "_start", "_total")

    inside = Window.partitionBy(group, "_part").orderBy(value)
    placed = (
        frozen.join(needed, [group, "_part"])
        .withColumn("_last", F.col("_start") + F.sum(count).over(inside))
        .withColumn("_first", F.col("_last") - F.col(count))
    )

    def at(index: Column) -> Column:
        return F.max(F.when((index >= F.col("_first")) & (index < F.col("_last")), F.col(value)))

    picks = []
    for i, p in enumerate(probabilities):
        picks += [at(F.floor(position(p))).alias(f"_lo{i}"), at(F.ceil(position(p))).alias(f"_hi{i}")]
    found = placed.groupBy(group).agg(F.max("_total").alias("n_scores"), *picks)
    result = [F.col(group), F.col("n_scores")]
    for i, (p, name) in enumerate(zip(probabilities, names)):
        fraction = F.lit(float(p)) * (F.col("n_scores") - 1)
        fraction = fraction - F.floor(fraction)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        result.append((low + (high - low) * fraction).alias(name))
    return found.select(*result)


def approximate_quantiles(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float], names: Sequence[str],
    accuracy: int = 10000,
) -> DataFrame:
    """One-pass quantile sketch per group, for when exact values are not needed."""
    sketch = F.percentile_approx(value, list(probabilities), accuracy)
    out = df.groupBy(group).agg(F.count(value).alias("n_scores"), sketch.alias("_q"))
    return out.select(
        group, "n_scores", *[F.col("_q")[i].alias(name) for i, name in enumerate(names)]
    )
