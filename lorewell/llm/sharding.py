"""Sharding by a two-pass external shuffle, with built-in expressions only.

Pass one scatters records uniformly into buckets that fit in memory, by a seeded
hash of their position, and writes them. Pass two gathers each bucket, gives its
records the places of a Fisher-Yates permutation (the built-in `shuffle` of their
numbers) and lays the buckets one after the other; shards are equal ranges of the
resulting positions, so their row counts differ by at most one.

Positions are fixed by the first write and permutations by a second, small one,
so a retried task repeats them. Equal rows are separate records and scatter like
any others, so no key or group of copies can make a bucket large. Null texts
count as empty; an empty table gives empty shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import column, free_name, freeze

BUCKET_BYTES = 8 << 20
ROW_BYTES = 16
SEED = 42
BUCKETS_A_GROUP = 4096
# Buckets share tasks beyond this number of them.
MOST_PARTITIONS = 100_000


def record_size(text_col: str) -> Column:
    """UTF-8 bytes of the text plus a fixed part."""
    return (F.coalesce(F.octet_length(column(text_col)), F.lit(0)) + ROW_BYTES).cast("long")


def _starts(counts: DataFrame) -> DataFrame:
    """(bucket, n, start): running totals in two steps, so no task sees all buckets."""
    grouped = counts.withColumn("group", F.floor(F.col("bucket") / BUCKETS_A_GROUP))
    before = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("group").agg(F.sum("n").alias("total"))
    ahead = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("group", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("offset"))
    inner = grouped.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return inner.join(offsets, "group").select("bucket", "n", (F.col("inner") + F.col("offset")).alias("start"))


def shard(
    docs: DataFrame, n_shards: int, text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """`docs` in random order as `shard` (int, from 0) and `slot` (long, gapless from 0)."""
    shard_name, slot_name = free_name("shard", docs.columns), free_name("slot", docs.columns)
    total = docs.agg(F.sum(record_size(text_col))).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    record = F.struct(*[column(c) for c in docs.columns])
    # A position is drawn once, when the scattered records are written.
    placed = docs.select(F.monotonically_increasing_id().alias("place"), record.alias("record"))
    scattered = freeze(
        placed.select(F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(n_buckets)).alias("bucket"), "place", "record"),
        "scatter",
    )
    counts = freeze(scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    n_rows = counts.agg(F.sum("n")).first()[0] or 0
    places = F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), seed)
    permutations = freeze(
        _starts(counts).repartition("bucket").sortWithinPartitions("bucket").select("bucket", "start", places.alias("places")),
        "permutations",
    )
    # Records stay rows all the way; only a bucket's permutation is one value.
    gathered = scattered.repartition(min(n_buckets, MOST_PARTITIONS), "bucket")
    number = F.row_number().over(Window.partitionBy("bucket").orderBy("place")) - 1
    laid = gathered.withColumn("number", number).join(permutations, "bucket").select(
        "record", (F.col("start") + F.get("places", F.col("number"))).alias("at")
    )
    shard_no = F.expr(f"at * {n_shards} div {max(n_rows, 1)}")
    first = F.expr(f"(shard_no * {n_rows} + {n_shards - 1}) div {n_shards}")
    return (
        laid.withColumn("shard_no", shard_no)
        .withColumn("slot_no", F.col("at") - first)
        .select("record.*", F.col("shard_no").cast("int").alias(shard_name), F.col("slot_no").cast("long").alias(slot_name))
    )


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot") -> None:
    """Write one folder per shard. A bucket lies in one or two shards, so tasks
    write few files and no shard is gathered in one task."""
    sharded.sortWithinPartitions(column(shard_col), column(slot_col)).write.partitionBy(shard_col).parquet(path)
