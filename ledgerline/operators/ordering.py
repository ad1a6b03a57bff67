"""Order as a result (SRT-1 .. SRT-4): global positions without a window over all rows.

Rows are range-partitioned and sorted; the sorted ranges are written once, so each range is
a file and a row's place in its file is known to the reader.  One count per file,
summed in file order, gives the places: the only window runs over one row per range.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_path
from .columns import unused_name


def part_number(file_name: Column) -> Column:
    """Number of a part file, by which Spark's output is ordered (null for other names)."""
    return F.regexp_extract(file_name, r"^part-(\d+)", 1).try_cast("long")


def running_starts(sizes: DataFrame, n: str, order: list, out: str) -> DataFrame:
    """Sum of ``n`` over the rows before, in the given order; one row per file or block comes in."""
    before = F.sum(n).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn(out, F.coalesce(before, F.lit(0).cast("long"))).drop(n)


def with_position(df: DataFrame, *order, out: str = "position") -> DataFrame:
    """Number the rows from 1 in the given order (ties: any order among them, but fixed).

    Without an order ``df`` is taken as it stands, sorted by its own plan.  The column ``out``
    must not exist in ``df``.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"ordered-{uuid.uuid4().hex}")
    (df.orderBy(*order) if order else df).write.parquet(path)
    file, row, start = (unused_name(c, df.columns) for c in ("__file", "__row", "__start"))
    rows = spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(row))
    sizes = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    starts = running_starts(sizes, "n", [part_number(F.col(file)), file], start)
    return rows.join(starts, file).select(*[rows[f"`{c}`"] for c in df.columns], (F.col(start) + F.col(row) + 1).alias(out))
