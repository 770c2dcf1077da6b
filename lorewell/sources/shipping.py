"""Give executors the package, whose functions run in their Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to all present and future executors, once per application.

    The archive is handed to Spark's own file distribution, which serves it from
    the driver as long as the application runs. Clusters that have the package
    installed on every node do not need this.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix=f"{package.name}-"))
    stage = folder / "stage"
    shutil.copytree(package, stage / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", stage))
    _shipped.add(context.applicationId)
