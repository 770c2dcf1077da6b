"""Wide-to-long rank metrics and side-by-side versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import RANK_CUTOFFS, RANK_METRICS, rank_metric_name


def rank_scores_long(
    df: DataFrame, keys: Sequence[str], ratings: str = "ratings",
    cutoffs: Sequence[int] = RANK_CUTOFFS,
) -> DataFrame:
    """One row per cutoff with recall, precision and NDCG; all-null rows go.

    One pass with `inline` instead of one scan per cutoff.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                *[
                    F.col(f"{ratings}.{rank_metric_name(m, k)}.double_value").alias(
                        f"retrieval_{m}_at_k_score"
                    )
                    for m in RANK_METRICS
                ],
            )
            for k in cutoffs
        ]
    )
    scores = [F.col(f"retrieval_{m}_at_k_score") for m in RANK_METRICS]
    return df.select(*keys, F.inline(rows)).filter(F.coalesce(*scores).isNotNull())


def pivot_versions(
    df: DataFrame, keys: Sequence[str], version: str, versions: Sequence[str],
    value: str, order: Column,
) -> DataFrame:
    """One column per version with the value that comes first in `order`."""
    return df.groupBy(*keys).pivot(version, list(versions)).agg(F.min_by(F.col(value), order))
