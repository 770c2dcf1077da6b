"""Re-ranking retrieved chunks for diversity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def pick_diverse(scores: np.ndarray, vectors: np.ndarray, k: int, balance: float) -> list[int]:
    """Greedy maximal marginal relevance; earlier candidates win ties."""
    similarity = vectors @ vectors.T
    chosen: list[int] = []
    closest = np.full(len(scores), -np.inf)
    while len(chosen) < min(k, len(scores)):
        penalty = np.where(np.isinf(closest), 0.0, closest)
        gain = balance * scores - (1 - balance) * penalty
        gain[chosen] = -np.inf
        best = int(np.argmax(gain))
        chosen.append(best)
        closest = np.maximum(closest, similarity[best])
    return chosen


def mmr_rerank(
    candidates: DataFrame, k: int, balance: float = 0.5,
    query_id: str = "query_id", chunk_id: str = "chunk_id",
    score: str = "score", rank: str = "rank", vector: str = "embedding",
) -> DataFrame:
    """Keep `k` of each query's candidates, trading score for diversity.

    `candidates` are the fetch-limited rows of `nearest`, with their vectors,
    so a query has a fixed small number of them. `balance` 1 keeps the order.
    """

    @F.pandas_udf("array<int>")
    def picks(scores: pd.Series, vectors: pd.Series) -> pd.Series:
        return pd.Series(
            [
                pick_diverse(np.asarray(s, float), np.stack([np.asarray(v, float) for v in m]), k, balance)
                for s, m in zip(scores, vectors)
            ],
            dtype=object,
        )

    entry = F.struct(
        F.col(rank).alias("r"), F.col(chunk_id).alias("id"), F.col(score).alias("s"), F.col(vector).alias("v")
    )
    per_query = candidates.groupBy(query_id).agg(F.array_sort(F.collect_list(entry)).alias("c"))
    picked = per_query.select(query_id, "c", picks(F.col("c.s"), F.col("c.v")).alias("p"))
    rows = picked.select(query_id, "c", F.posexplode("p").alias("pos", "at"))
    return rows.select(
        query_id,
        F.col("c")[F.col("at")]["id"].alias(chunk_id),
        F.col("c")[F.col("at")]["s"].alias(score),
        (F.col("pos") + 1).alias(rank),
    )
