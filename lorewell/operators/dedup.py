"""Last value per key and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import RANK_CUTOFFS, RANK_METRICS, TEXT_METRICS, rank_metric_name
from .ranking import top_per_group


def latest_per_period(
    df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str],
    granularity: str = "hour", period: str | None = None,
) -> DataFrame:
    """Keep the latest row of each key and period of `ts`.

    The rank-1 filter is applied before the shuffle as well, so a key that
    holds a large share of the log sends one row per task and period.
    `period` keeps the truncated time under that name.
    """
    bucket = period or "_period"
    order = [F.col(ts).desc(), *[F.col(c).desc() for c in tie_break]]
    kept = top_per_group(
        df.withColumn(bucket, F.date_trunc(granularity, F.col(ts))), [*keys, bucket], order, 1, "_rn"
    ).drop("_rn")
    return kept if period else kept.drop(bucket)


def rating_names() -> Column:
    """Sorted, comma-separated names of the ratings an assessment row carries."""
    fields = [("text_assessment", m) for m in TEXT_METRICS]
    fields += [
        ("retrieval_assessment", rank_metric_name(m, k)) for k in RANK_CUTOFFS for m in RANK_METRICS
    ]
    names = []
    for log, name in sorted(fields, key=lambda f: f[1]):
        rating = f"{log}.ratings.{name}"
        present = F.col(f"{rating}.bool_value").isNotNull() | F.col(f"{rating}.double_value").isNotNull()
        names.append(F.when(present, F.lit(name)))
    return F.concat_ws(",", *names)


def dedup_assessments(assessments: DataFrame, granularity: str = "hour") -> DataFrame:
    """Latest assessment per request, step, source, rated metrics and hour.

    The metric names belong to the key: without them a latency row would
    replace the token-count row of the same step.
    """
    keyed = assessments.withColumn("_source", F.col("source.type")).withColumn(
        "_rated", rating_names()
    )
    # A hash of the whole row orders rows that share the time stamp.
    keyed = keyed.withColumn("_tie", F.xxhash64(*[F.col(c) for c in assessments.columns]))
    kept = latest_per_period(
        keyed, ["request_id", "step_id", "_source", "_rated"], "ts", ["_tie"], granularity
    )
    return kept.select(*assessments.columns)
