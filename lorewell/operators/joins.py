"""Equi-joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Items the frequent-keys sketch follows for each key it may have to report; its
# error is then an eighth of the share that makes a key hot.
ITEMS_A_KEY = 8
# A key is never called hot below this share, which bounds the list of hot keys.
LEAST_SHARE = 0.001

# Measured size up to which a list is broadcast.
BROADCAST_BYTES = 64 << 20


def task_share(df: DataFrame) -> float:
    """The share of all rows one shuffle task holds when keys are spread evenly."""
    return max(LEAST_SHARE, 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, key: str, min_share: float | None = None) -> list:
    """Keys holding at least `min_share` of all rows (runs one key-only job).

    By default the share of a shuffle task. A mergeable frequent-items sketch
    finds the keys in one pass without a shuffle of them; it reports as many
    keys as can reach the share.
    """
    share = task_share(df) if min_share is None else min_share
    most = math.ceil(1 / share)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {most}, {max(64, ITEMS_A_KEY * most)})").alias("top"),
    ).first()
    floor = max(2, row["n"] * share)
    return [t["item"] for t in row["top"] or [] if t["item"] is not None and t["count"] >= floor]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    salts: int | None = None,
    min_share: float | None = None,
    hot: Sequence | None = None,
    right_hot: Sequence = (),
) -> DataFrame:
    """Join on `key`, spreading hot keys over `salts` tasks (default: all shuffle tasks, 64 at most).

    Rows of a key that is hot on the left are dealt to the salts, and the right
    rows of that key are repeated, once per salt; `right_hot` keys of an inner
    join the other way round. Every other row is joined as usual. `how` is
    inner, left or left_semi.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salted join cannot do {how!r}")
    if right_hot and how != "inner":
        raise ValueError("only an inner join can repeat left rows")
    if hot is None:
        hot = hot_keys(left, key, min_share)
    if salts is None:
        salts = max(2, min(64, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    right_hot = [k for k in right_hot if k not in set(hot)]
    if not hot and not right_hot:
        return left.join(right, key, how)
    dealt_left = _repeat(_deal(left, key, hot, salts, "_n_left"), key, right_hot, salts)
    dealt_right = _repeat(_deal(right, key, right_hot, salts, "_n_right"), key, hot, salts)
    joined = dealt_left.join(dealt_right, [key, "_salt"], how).drop("_salt")
    for n in ("_n_left", "_n_right"):
        if n in joined.columns:
            joined = joined.withColumn(n, F.explode(F.array_repeat(F.lit(0), F.col(n)))).drop(n)
    return joined


def _deal(df: DataFrame, key: str, keys: Sequence, salts: int, count: str) -> DataFrame:
    """`df` with `_salt`: 0, but for rows of `keys`, which are dealt to all salts.

    Equal rows would get equal salts from a hash, and a random salt would change
    when a task is retried. So equal rows of these keys are counted first, and
    each salt gets an equal part of the `count`, repeated after the join.
    """
    if not keys:
        return df.withColumn("_salt", F.lit(0))
    is_hot = F.coalesce(F.col(key).isin(list(keys)), F.lit(False))
    counted = df.filter(is_hot).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(count))
    shift = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.least(F.col(count), F.lit(salts)).cast("int") - 1)))
    n_parts = F.least(F.col(count), F.lit(salts))
    share = F.floor(F.col(count) * (F.col("_part") + 1) / n_parts) - F.floor(F.col(count) * F.col("_part") / n_parts)
    dealt = parts.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.pmod(shift + F.col("_part"), F.lit(salts)).cast("int").alias("_salt"), share.cast("int").alias(count),
    )
    others = df.filter(~is_hot).withColumns({"_salt": F.lit(0), count: F.lit(1)})
    return others.unionByName(dealt)


def _repeat(df: DataFrame, key: str, keys: Sequence, salts: int) -> DataFrame:
    """`df` with the rows of `keys` once per salt."""
    if not keys:
        return df
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn("_salt", F.explode(F.when(F.col(key).isin(list(keys)), every).otherwise(F.array("_salt"))))


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of a frame (runs a job); nested ones by their text form."""
    width = F.lit(16)
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            width = width + F.lit(8)
        else:
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def lookup_join(small: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """Inner join of a narrow list of keys with a wide table: key, list, table columns.

    Measures the list. Up to BROADCAST_BYTES it is broadcast, so the wide rows
    are not shuffled and frequent keys do no harm; a larger list is joined by
    shuffle, with the hot keys of either side dealt out. `small` should be stored
    or cheap, as it is read more than once.
    """
    order = [key, *[c for c in small.columns if c != key], *[c for c in large.columns if c != key]]
    if measured_bytes(small) <= BROADCAST_BYTES:
        return large.join(F.broadcast(small), key).select(*order)
    return salted_join(small, large, key, right_hot=hot_keys(large, key)).select(*order)


def assessments_with_requests(
    assessments: DataFrame,
    requests: DataFrame,
    request_columns: dict[str, Column] | None = None,
    salted: bool = True,
) -> DataFrame:
    """Inner join of assessment rows with request rows on the request id.

    The key is the request id alone: an id logged under several versions
    repeats its assessments once per version.
    """
    wanted = request_columns or {"rag_version": F.col("trace.app_version_id")}
    narrow = requests.select(
        F.col("request.request_id").alias("request_id"),
        *[c.alias(name) for name, c in wanted.items()],
    )
    if salted:
        frequent = hot_keys(narrow, "request_id")
        return salted_join(assessments, narrow, "request_id", right_hot=frequent)
    return assessments.join(narrow, "request_id")
