"""Python code of this package for the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application.

    Spark's file server hands the archive to every executor, so it need not be installed there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
