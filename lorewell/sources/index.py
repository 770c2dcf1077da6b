"""Incremental update of a chunk index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.joins import BROADCAST_BYTES, measured_bytes
from .scratch import freeze
from .tables import path_exists


def index_delta(current: DataFrame, wanted: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys to add to and to retire from `current` so that it holds `wanted`.

    Both sides are reduced to their distinct keys first, and one join marks
    which side a key is missing on.
    """
    have = current.select(key).distinct().withColumn("_have", F.lit(True))
    want = wanted.select(key).distinct().withColumn("_want", F.lit(True))
    both = have.join(want, key, "full_outer")
    action = F.when(F.col("_have").isNull(), F.lit("add")).when(F.col("_want").isNull(), F.lit("retire"))
    return both.select(key, action.alias("action")).filter(F.col("action").isNotNull())


def sync_index(current: DataFrame, wanted: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The index after the update: kept rows stay as they are, new rows come in.

    Only keys are compared by shuffle. While the difference is short it is
    broadcast, and the wide rows of neither side move.
    """
    delta = freeze(index_delta(current, wanted, key), "delta")
    def keys(action: str) -> DataFrame:
        found = delta.filter(F.col("action") == action).select(key)
        return F.broadcast(found) if measured_bytes(found) <= BROADCAST_BYTES else found

    kept = current.join(keys("retire"), key, "left_anti")
    added = wanted.join(keys("add"), key, "left_semi").dropDuplicates([key])
    return kept.unionByName(added.select(*current.columns))


class IndexStore:
    """A chunk index kept as batches of added rows and of retired keys.

    An update writes only its difference; rows that stay are not touched. One
    appended commit row makes both halves of a batch visible together, so a
    failed update leaves no trace and is simply repeated. One writer at a time.
    """

    COMMIT = T.StructType([T.StructField("batch", T.LongType()), T.StructField("base", T.LongType())])

    def __init__(self, spark: SparkSession, root: str, key: str = "chunk_id"):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def _last(self) -> tuple[int, int]:
        """The newest batch and the batch the table starts from; zeros when empty."""
        path = f"{self.root}/commits"
        if not path_exists(self.spark, path):
            return 0, 0
        commits = self.spark.read.schema(self.COMMIT).parquet(path)
        row = commits.agg(F.max("batch").alias("batch"), F.max_by("base", "batch").alias("base")).first()
        return row["batch"] or 0, row["base"] or 0

    def _batches(self, kind: str) -> DataFrame:
        last, base = self._last()
        rows = self.spark.read.parquet(f"{self.root}/{kind}")
        return rows.withColumn("batch", F.col("batch").cast("long")).filter(F.col("batch").between(base, last))

    def read(self, with_batch: bool = False) -> DataFrame:
        """The current rows: those added after their key was last retired."""
        gone = self._batches("retired").groupBy(self.key).agg(F.max("batch").alias("_gone"))
        rows = self._batches("added").join(gone, self.key, "left")
        rows = rows.filter(F.col("_gone").isNull() | (F.col("batch") > F.col("_gone"))).drop("_gone")
        return rows if with_batch else rows.drop("batch")

    def sync(self, wanted: DataFrame) -> None:
        """Make the index hold one row for every key of `wanted`."""
        last, base = self._last()
        if not last:
            nothing = wanted.limit(0)
            self._write(wanted.dropDuplicates([self.key]), nothing.select(self.key), 1, 1)
            return
        delta = freeze(index_delta(self.read(), wanted, self.key), "delta")
        new = wanted.join(delta.filter("action = 'add'").select(self.key), self.key, "left_semi")
        self._write(new.dropDuplicates([self.key]), delta.filter("action = 'retire'").select(self.key), last + 1, base)

    def compact(self) -> None:
        """Write the current rows as one batch; reads start from it."""
        last, _ = self._last()
        rows = self.read()
        self._write(rows, rows.limit(0).select(self.key), last + 1, last + 1)

    def _write(self, added: DataFrame, retired: DataFrame, batch: int, base: int) -> None:
        added.write.mode("overwrite").parquet(f"{self.root}/added/batch={batch}")
        retired.write.mode("overwrite").parquet(f"{self.root}/retired/batch={batch}")
        row = self.spark.createDataFrame([(batch, base)], self.COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
