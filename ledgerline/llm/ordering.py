"""Places in a global order without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged
from .textarrays import fresh_name


def with_place(df: DataFrame, out: str, *order) -> DataFrame:
    """Number the rows from 0 in the given order.

    Ranges of the order are sorted apart, and numbered as ``in_own_order`` does.
    """
    return in_own_order(df.repartitionByRange(*order).sortWithinPartitions(*order), out)


def in_own_order(df: DataFrame, out: str) -> DataFrame:
    """Number the rows from 0 in the order of the partitions and of the rows in each.

    A running id holds the partition and the row in it, and one count per partition gives the
    places.  The numbered rows are written once, so they stay as they are whatever is
    recomputed later.
    """
    mark = fresh_name("__id", df.columns)
    rows = staged(df.withColumn(mark, F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned(mark, 33)
    sizes = rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("p", before.alias("b"))  # one row per range
    place = (F.col("b") + F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))).alias(out)
    return rows.join(F.broadcast(sizes), part == F.col("p")).select(*[rows[c] for c in df.columns], place)
