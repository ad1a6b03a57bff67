"""Tables of the corpus and intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that ``spark.checkpoint.dir`` names."""
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet in the shared folder and read it again.

    Cuts the lineage: what follows reads files that every executor reaches, so a lost
    executor costs only the tasks that ran on it.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
