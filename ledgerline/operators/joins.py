"""Dimension joins.

A plain equi-join: Spark broadcasts a side whose size it knows to be small, and adaptive
execution decides again from the bytes really written, splitting skewed partitions
otherwise.  Nothing runs when the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys that matches null with null, keeping one copy of the keys."""
    bb = b.withColumnsRenamed({k: "__b_" + k for k in keys})
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(bb["__b_" + k]) for k in keys])
    return a.join(bb, cond, how).drop(*["__b_" + k for k in keys])
