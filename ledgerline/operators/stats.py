"""Exact median of the distinct values per group (AGG-6), without a hot group in one task.

``F.median`` keeps every value of a group in one aggregation buffer, so one
group holding a third of the data would land in a single task.  Here:

1. values are made distinct per group (hash-partitioned on group *and* value,
   so a hot group spreads over all tasks);
2. groups of at most ``max_rows`` distinct values are ranked directly with a
   window (a bounded task each);
3. larger groups are narrowed first: approximate split points per group
   (``percentile_approx`` -- a mergeable sketch, partial-aggregated) cut the
   group into buckets, exact bucket counts say which bucket(s) hold the middle
   rank(s), and the search repeats inside them until the slice holding the
   middle is small; only that slice is ranked.

The result is exact: ranks come from exact counts; the sketch only chooses
where to cut.  np.median of the distinct values = mean of the two middle ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import join_null_safe

#: distinct values of one group that a task may rank
MAX_ROWS_PER_TASK = 2_000_000
SPLITS = 256


def distinct_median(df: DataFrame, keys: list[str], value: str, out: str = "median",
                    max_rows: int = MAX_ROWS_PER_TASK, splits: int = SPLITS,
                    low: str | None = None, high: str | None = None) -> DataFrame:
    """Median of the distinct values per group; ``low`` / ``high`` also name their minimum and maximum.

    One job runs when the plan is built: the size of the largest group, which decides
    whether groups have to be narrowed before they are ranked.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    d = df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v")).distinct()
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx"))
    ends = [F.col(c).alias(name) for c, name in (("__mn", low), ("__mx", high)) if name]
    if (n.agg(F.max("__n")).first()[0] or 0) <= max_rows:
        w = Window.partitionBy(*keys)
        r = d.select("*", F.row_number().over(w.orderBy("__v")).alias("__r"), F.count(F.lit(1)).over(w).alias("__n"),
                     F.min("__v").over(w).alias("__mn"), F.max("__v").over(w).alias("__mx"))
        middle = r.where((F.col("__r") == F.floor((F.col("__n") - 1) / 2) + 1) | (F.col("__r") == F.floor(F.col("__n") / 2) + 1))
        return middle.groupBy(*keys, "__mn", "__mx").agg(((F.min("__v") + F.max("__v")) / 2.0).alias(out)) \
                     .select(*keys, out, *ends)

    d, n = materialize(d), materialize(n)  # reread by every round: written once
    state = n.select(*keys,
                     (F.floor((F.col("__n") - 1) / 2) + 1).alias("__klo"),
                     (F.floor(F.col("__n") / 2) + 1).alias("__khi"),
                     F.lit(None).cast("double").alias("__lo"), F.lit(None).cast("double").alias("__hi"),
                     F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__cnt"))
    left = state.where(F.col("__cnt") > max_rows).agg(F.sum("__cnt")).first()[0]
    while left:
        state = materialize(_narrow(d, state, keys, max_rows, splits))
        now = state.where(F.col("__cnt") > max_rows).agg(F.sum("__cnt")).first()[0]
        if now and now >= left:
            raise RuntimeError("a group's slice of distinct values no longer gets smaller")
        left = now

    cand = _in_range(d, state, keys)
    w = Window.partitionBy(*keys).orderBy("__v")
    ranked = cand.withColumn("__r", F.row_number().over(w) + F.col("__below"))
    picked = ranked.where((F.col("__r") == F.col("__klo")) | (F.col("__r") == F.col("__khi")))
    picked = picked.groupBy(*keys).agg(((F.min("__v") + F.max("__v")) / 2.0).alias(out))
    return join_null_safe(picked, n.select(*keys, *ends), keys) if ends else picked


def _in_range(d: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``d`` inside their group's current [lo, hi] slice, with the group's state."""
    s = state.select(*[F.col(k).alias("__s_" + k) for k in keys],
                     "__klo", "__khi", "__lo", "__hi", "__below", "__cnt")
    cond = reduce(lambda a, b: a & b, [d[k].eqNullSafe(s["__s_" + k]) for k in keys], F.lit(True))
    j = d.join(s, cond)
    j = j.where((F.col("__lo").isNull() | (F.col("__v") >= F.col("__lo")))
                & (F.col("__hi").isNull() | (F.col("__v") <= F.col("__hi"))))
    return j.drop(*["__s_" + k for k in keys])


def _narrow(d, state, keys, max_rows, splits):
    big = state.where(F.col("__cnt") > max_rows)
    small = state.where(F.col("__cnt") <= max_rows)
    cand = _in_range(d, big, keys)
    probs = [i / splits for i in range(1, splits)]
    acc = max(10 * splits, 1000)
    sk = cand.groupBy(*keys).agg(F.percentile_approx("__v", probs, acc).alias("__sp"))
    skr = materialize(sk.select(*[F.col(k).alias("__t_" + k) for k in keys], "__sp"))
    cond = reduce(lambda a, b: a & b, [cand[k].eqNullSafe(skr["__t_" + k]) for k in keys], F.lit(True))
    b = cand.join(skr, cond).withColumn(
        "__b", F.size(F.filter("__sp", lambda x: x < F.col("__v"))))
    bc = b.groupBy(*keys, "__b", "__klo", "__khi", "__below").agg(
        F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__bmin"), F.max("__v").alias("__bmax"))
    w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    bc = bc.withColumn("__cum", F.sum("__c").over(w)).withColumn("__before", F.col("__cum") - F.col("__c"))
    has_lo = (F.col("__below") + F.col("__before") < F.col("__klo")) & (F.col("__klo") <= F.col("__below") + F.col("__cum"))
    has_hi = (F.col("__below") + F.col("__before") < F.col("__khi")) & (F.col("__khi") <= F.col("__below") + F.col("__cum"))
    new = bc.groupBy(*keys, "__klo", "__khi", "__below").agg(
        F.min(F.when(has_lo, F.col("__bmin"))).alias("__lo"),
        F.max(F.when(has_hi, F.col("__bmax"))).alias("__hi"),
        F.min(F.when(has_lo, F.col("__before"))).alias("__skip"),
        F.max(F.when(has_hi, F.col("__cum"))).alias("__through"))
    new = new.select(*keys, "__klo", "__khi", "__lo", "__hi",
                     (F.col("__below") + F.col("__skip")).alias("__below"),
                     (F.col("__through") - F.col("__skip")).alias("__cnt"))
    return small.unionByName(new)
