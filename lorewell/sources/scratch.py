"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20

_local_folder: list[str] = []
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder; on a
    cluster, executors could not see it, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="lorewell-"))
    return _local_folder[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, below the shared folder."""
    path = f"{shared_folder(spark)}/lorewell/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at its end every scratch path that was made inside.

    Results that read such paths have to be written before the scope ends.
    """
    first = len(_made)
    try:
        yield
    finally:
        made = _made[first:]
        del _made[first:]
        for path in made:
            jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def freeze(df: DataFrame, label: str = "frozen", **options) -> DataFrame:
    """Write `df` once, with the writer's `options`, and read it back (runs a job).

    Cuts lineage, survives lost executors, and fixes values that a second
    evaluation could change, such as partition numbers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze_python(df: DataFrame, label: str, **options) -> DataFrame:
    """`freeze` for plans that send texts or vectors to Python: batches stay small.

    A batch lies in the executor's off-heap memory and in the worker at once,
    and both allocate up to twice its size.
    """
    conf = df.sparkSession.conf
    before = conf.get(BATCH_SETTING)
    conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        return freeze(df, label, **options)
    finally:
        conf.set(BATCH_SETTING, before)
