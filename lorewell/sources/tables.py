"""Tables: scans, sinks, templates, views, versioned overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import EVAL_DATASET

EMBEDDED_COLUMNS = ("chunk_id", "doc_uri", "text", "embedding")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder when `name` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def spread_small(scan: DataFrame) -> DataFrame:
    """Spread a table of few files over all cores before CPU-heavy work.

    `scan` is a plain table read. Tables with at least as many splits as the
    cluster has cores, so all large ones, are returned as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def write_table(df: DataFrame, name: str, mode: str) -> None:
    if "/" in name:
        df.write.mode(mode).parquet(name)
    else:
        df.write.mode(mode).format("parquet").saveAsTable(name)


def write_run(df: DataFrame, name: str, run: str, mode: str) -> None:
    """Write one run's rows into a log partitioned by `run`.

    `overwrite` replaces the whole log. `append` keeps other runs and replaces
    the rows of an earlier attempt of the same run, so a retry adds no duplicates.
    """
    kind = "dynamic" if mode == "append" else "static"
    rows = df.withColumn("run", F.lit(run))
    writer = rows.write.option("partitionOverwriteMode", kind)
    if "/" in name:
        writer.mode("overwrite").partitionBy("run").parquet(name)
    elif mode == "append" and df.sparkSession.catalog.tableExists(name):
        writer.insertInto(name, overwrite=True)
    else:
        writer.mode("overwrite").format("parquet").partitionBy("run").saveAsTable(name)


def write_template(spark: SparkSession, name: str, schema: T.StructType = EVAL_DATASET) -> None:
    """An empty table that shows users the expected columns."""
    write_table(spark.createDataFrame([], schema), name, "overwrite")


def write_embeddings(
    df: DataFrame, path: str,
    chunk_id: str = "chunk_id", doc_uri: str = "doc_uri",
    text: str = "text", embedding: str = "embedding",
) -> None:
    """Write the four columns of an embedded-chunk table, one folder per corpus version."""
    sources = (chunk_id, doc_uri, text, embedding)
    df.select(
        *[F.col(s).alias(t) for s, t in zip(sources, EMBEDDED_COLUMNS)]
    ).write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


class VersionedTable:
    """A table that can be replaced by a query over itself.

    Each write goes to a new folder; a row appended to a pointer table then
    makes it current. Readers of the old version are not disturbed, and a
    failed write leaves the old version in place. One writer at a time.
    """

    POINTER = T.StructType([T.StructField("version", T.LongType())])

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pointer = f"{self.root}/pointer"

    def version(self) -> int:
        """Current version, 0 when nothing was written."""
        if not path_exists(self.spark, self.pointer):
            return 0
        rows = self.spark.read.schema(self.POINTER).parquet(self.pointer)
        return rows.agg(F.max("version")).first()[0] or 0

    def path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def read(self) -> DataFrame:
        version = self.version()
        if not version:
            raise ValueError(f"{self.root} holds no version yet")
        return self.spark.read.parquet(self.path(version))

    def overwrite(self, df: DataFrame) -> int:
        """Write `df`, which may read the current version, as the next one."""
        version = self.version() + 1
        df.write.mode("overwrite").parquet(self.path(version))
        self.spark.createDataFrame([(version,)], self.POINTER).coalesce(1).write.mode(
            "append"
        ).parquet(self.pointer)
        return version


class VersionedPartitions:
    """A partitioned table of which single partitions can be replaced by a query
    over themselves.

    A write puts the new contents of some partitions into a new folder. One
    append to a pointer table then makes all of them current together and notes
    `mark`, the position in the source up to which the table is complete. One
    writer at a time.
    """

    POINTER = T.StructType(
        [
            T.StructField("part", T.StringType()),
            T.StructField("version", T.LongType()),
            T.StructField("mark", T.LongType()),
        ]
    )

    def __init__(self, spark: SparkSession, root: str, column: str, schema: T.StructType):
        self.spark, self.column, self.schema = spark, column, schema
        self.data, self.pointer = f"{root.rstrip('/')}/data", f"{root.rstrip('/')}/pointer"

    def _pointers(self) -> DataFrame:
        if not path_exists(self.spark, self.pointer):
            return self.spark.createDataFrame([], self.POINTER)
        return self.spark.read.schema(self.POINTER).parquet(self.pointer)

    def mark(self) -> int | None:
        return self._pointers().agg(F.max("mark")).first()[0]

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """Current rows of all or of the given partitions, in one scan.

        The list of partitions is read first; it is as long as their number.
        """
        current = self._pointers().filter(F.col("part").isNotNull())
        if parts is not None:
            current = current.filter(F.col("part").isin(parts))
        latest = current.groupBy("part").agg(F.max("version").alias("v")).collect()
        if not latest:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.data}/version={r['v']}/{self.column}={r['part']}" for r in latest]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(self, df: DataFrame, mark: int) -> None:
        """Make `df` the contents of every partition it has rows for.

        Rebalancing gathers a partition's rows into few files and still splits
        a partition that holds most of them.
        """
        version = (self._pointers().agg(F.max("version")).first()[0] or 0) + 1
        path = f"{self.data}/version={version}"
        df.hint("rebalance", self.column).write.mode("overwrite").partitionBy(self.column).parquet(path)
        kind = T.StructType([*self.schema.fields, T.StructField(self.column, T.StringType())])
        written = self.spark.read.schema(kind).parquet(path).select(F.col(self.column).alias("part"))
        row = written.distinct().select(
            "part", F.lit(version).cast("long").alias("version"), F.lit(mark).cast("long").alias("mark")
        )
        row.coalesce(1).write.mode("append").parquet(self.pointer)


class WriteModes:
    """Append to or replace evaluation logs, by the dataset version last used."""

    STATE = T.StructType(
        [
            T.StructField("experiment", T.StringType()),
            T.StructField("dataset_version", T.LongType()),
            T.StructField("seq", T.LongType()),
        ]
    )

    def __init__(self, spark: SparkSession, root: str):
        self.table = VersionedTable(spark, root)
        self.spark = spark

    def _state(self) -> DataFrame:
        return self.table.read() if self.table.version() else self.spark.createDataFrame([], self.STATE)

    def peek(self, experiment: str, dataset_version: int) -> str:
        """`append` for the dataset version committed last, `overwrite` for a new one."""
        last = self._state().filter(F.col("experiment") == experiment).agg(F.max_by("dataset_version", "seq")).first()
        return "append" if last[0] == dataset_version else "overwrite"

    def commit(self, experiment: str, dataset_version: int) -> None:
        """Record the dataset version; call it once its logs are written."""
        state = self._state()
        last = state.filter(F.col("experiment") == experiment).agg(F.max("seq")).first()[0]
        row = self.spark.createDataFrame([(experiment, dataset_version, (last or 0) + 1)], self.STATE)
        self.table.overwrite(state.filter(F.col("experiment") != experiment).unionByName(row))
