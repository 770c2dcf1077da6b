"""First k rows per group, and top examples of a log join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import freeze
from .joins import BROADCAST_BYTES, measured_bytes


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "row_num",
) -> DataFrame:
    """First `k` rows of each group in `order`, with their rank.

    Spark turns the rank filter into a group limit that runs before the
    shuffle, so a task sends at most `k` rows of any group.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_joined(
    left: DataFrame,
    right: DataFrame,
    key: str,
    group: str,
    left_order: Sequence[Column],
    right_order: Sequence[Column],
    k: int,
    n_groups: int | None = None,
    rank: str = "row_num",
) -> DataFrame:
    """First `k` rows per `group` of `left JOIN right`, without the full join.

    `group` is a right-hand column. Rows are ordered by the left columns, then
    by the key, then by the right columns. The left side is cut to `k` rows per
    key and ranked against the distinct (key, group) pairs, all narrow. A
    repeated pair can only push rows out, so these winners hold every left row
    of the result; only they look up the wide right rows. With at most
    `n_groups` groups there are `k * n_groups` winners, and they are broadcast;
    otherwise they are stored and measured first.
    """
    few_left = top_per_group(left, [key], left_order, k, "_l").drop("_l")
    pairs = right.select(key, group).distinct()
    by_left = [*left_order, F.col(key).asc()]
    winners = top_per_group(few_left.join(pairs, key), [group], by_left, k, "_w").drop("_w")
    if n_groups is None:
        winners = freeze(winners, "winners")
    if n_groups is not None or measured_bytes(winners) <= BROADCAST_BYTES:
        winners = F.broadcast(winners)
    matched = right.join(winners, [key, group])
    return top_per_group(matched, [group], [*by_left, *right_order], k, rank)
