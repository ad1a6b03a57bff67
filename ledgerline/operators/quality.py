"""Consistency checks of a levelled extract (CMP-10 .. CMP-14, AGG-2 .. AGG-4, AGG-11).

The input carries pre-made levels in one code column: null = grand total,
text = group, digits = single code (see ``code_kind``).  Every check is a lazy
DataFrame whose rows are the failures; an empty DataFrame means "passed".

Scale notes
* Level sums are one pass of conditional sums (partial + final hash aggregate):
  a hot period or region only ever ships one partial row per task.
* Group reconciliation aggregates codes *before* joining the code->group map,
  so the join sees one row per (code, region, period), not raw rows.
* The map is a dimension: a plain join, which Spark broadcasts when it is small.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pct_deviation, round_half_away, units, units_deviate, units_deviation
from ..functions.text import CODE, GROUP, TOTAL, code_kind  # noqa: F401


def _sums(metrics, when: Column | None = None, prefix: str = "") -> list[Column]:
    if when is None:
        return [F.sum(m).alias(prefix + m) for m in metrics]
    return [F.sum(F.when(when, F.col(m))).alias(prefix + m) for m in metrics]


def with_level(df: DataFrame, code_col: str, level_col: str = "level") -> DataFrame:
    return df.withColumn(level_col, code_kind(code_col))


ROLLUP_KEYS = ("region_name", "partition_dt")


def level_rollup(df: DataFrame, metrics: list[str], code_col: str = "mcc",
                 keys: list[str] = ROLLUP_KEYS) -> DataFrame:
    """Sums per (level, code, keys): the one aggregate of the raw extract that every level
    check reads.  Built the same way by each check, so a query running several
    checks shuffles the extract once and reuses that exchange.  The level is a
    function of the code, so it is derived after the aggregate: the code test runs
    once per group, not once per row.  Level and keys also name the group's row count, which
    keeps filters on them (a level, a join's null test) above the aggregate: pushed below
    it, they would make each check read the extract on its own."""
    r = df.groupBy(code_col, *keys).agg(F.count(F.lit(1)).alias("__rows"), *_sums(metrics))
    here = F.col("__rows") > 0
    return r.select(F.when(here, code_kind(code_col)).alias("level"),
                    *[F.when(here, F.col(c)).alias(c) for c in (code_col, *keys)], *metrics)


def _rollup_keys(keys) -> list[str]:
    return list(ROLLUP_KEYS) + [k for k in keys if k not in ROLLUP_KEYS]


def level_totals(df: DataFrame, metrics: list[str], code_col: str = "mcc",
                 keys: list[str] = ("partition_dt",)) -> DataFrame:
    """AGG-2: sum of every metric per level, all levels in one scan."""
    r = level_rollup(df, metrics, code_col, _rollup_keys(keys))
    return r.groupBy(*keys, "level").agg(*_sums(metrics))


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str],
                    name: str = "metric", value: str = "value") -> DataFrame:
    """RSH-1: metric columns to (metric, value) rows, null values dropped (T-SQL UNPIVOT)."""
    return df.unpivot(list(ids), list(metrics), name, value).where(F.col(value).isNotNull())


def reconcile_levels(df: DataFrame, metrics: list[str], a: str = TOTAL, b: str = GROUP,
                     tol: float = 5.0, code_col: str = "mcc",
                     keys: list[str] = ("partition_dt",), period: str | None = None,
                     period_col: str = "partition_dt") -> DataFrame:
    """CMP-10: per metric, the sum over level ``a`` against the sum over level ``b``.

    Rows: keys, metric, value_a, value_b, deviation = round((a-b)/a*100, 2);
    kept where |deviation| >= tol.  ``period`` restricts to one reporting period
    (partition pruning on a partitioned history); None checks every period at once.
    """
    if period is not None:
        df = df.where(F.col(period_col) == period)
    r = level_rollup(df, metrics, code_col, _rollup_keys(keys))
    lv = F.col("level")
    wide = r.groupBy(*keys).agg(*_sums(metrics, lv == a, "a__"), *_sums(metrics, lv == b, "b__"))
    long = wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col("a__" + m).alias("value_a"),
                 F.col("b__" + m).alias("value_b")) for m in metrics])))
    # UNPIVOT drops nulls on each side before the metric join
    long = long.where(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())
    long = long.withColumn("deviation", pct_deviation("value_a", "value_b"))
    return long.where(F.abs("deviation") >= tol)


def rollup_metrics(df: DataFrame, keys: list[str], metrics: list[str], top: int | None = None) -> DataFrame:
    """AGG-3: sums of the metrics by keys.  ``top`` keeps the first n rows by the keys
    (TOP-2); off by default, since the reference's silent cut loses groups (D-7)."""
    out = df.groupBy(*keys).agg(*_sums(metrics))
    return out.orderBy(*keys).limit(top) if top else out


def map_codes(rollup: DataFrame, mapping: DataFrame, metrics: list[str], code_col: str = "mcc",
              map_code: str = "mcc_code", map_group: str = "mcc_group",
              keys: list[str] = ("region_name", "partition_dt")) -> DataFrame:
    """AGG-4 / JON-3: code roll-up -> group roll-up through a code->group map (left join).

    Codes absent from the map fall into a null group, as the reference's left join does.
    """
    m = mapping.select(F.col(map_code).alias("__code"), F.col(map_group).alias(map_group))
    joined = rollup.join(m, rollup[code_col] == F.col("__code"), "left")
    return rollup_metrics(joined, [map_group, *keys], metrics)


def _level_rollups(df, metrics, code_col, keys):
    agg = level_rollup(df, metrics, code_col, keys)
    groups = agg.where(F.col("level") == GROUP).drop("level")
    codes = agg.where(F.col("level") == CODE).drop("level")
    return groups, codes


def unequal_groups(df: DataFrame, mapping: DataFrame, metrics: list[str], code_col: str = "mcc",
                   map_code: str = "mcc_code", map_group: str = "mcc_group",
                   keys: list[str] = ("region_name", "partition_dt")) -> DataFrame:
    """SET-2: group roll-up rows with no identical row in the mapped code roll-up (EXCEPT)."""
    groups, codes = _level_rollups(df, metrics, code_col, keys)
    mapped = map_codes(codes, mapping, metrics, code_col, map_code, map_group, keys)
    cols = [code_col, *keys, *metrics]
    return groups.select(*cols).subtract(mapped.withColumnRenamed(map_group, code_col).select(*cols))


def reconcile_groups(df: DataFrame, mapping: DataFrame, metrics: list[str], tol: float = 1.0,
                     code_col: str = "mcc", map_code: str = "mcc_code",
                     map_group: str = "mcc_group",
                     keys: list[str] = ("region_name", "partition_dt")) -> DataFrame:
    """CMP-11: text groups against their codes rolled up through the map.

    One row per (group, keys) where any metric deviates by more than ``tol`` %;
    columns ``dev_<metric>`` hold round((group - codes)/group*100, 2), null when
    the group sum is 0.  Each metric is compared with itself (decision D-6).
    """
    groups, codes = _level_rollups(df, metrics, code_col, keys)
    mapped = map_codes(codes, mapping, metrics, code_col, map_code, map_group, keys)
    g = groups.select(code_col, *keys, *[F.col(m).alias("g__" + m) for m in metrics])
    c = mapped.select(F.col(map_group).alias(code_col), *keys, *[F.col(m).alias("c__" + m) for m in metrics])
    j = g.join(c, [code_col, *keys], "inner")
    # one expression for all metrics: eighteen copies of it would not fit into one generated method
    pairs = F.array(*[F.struct(F.col("g__" + m).cast("decimal(38,6)").alias("g"),
                               F.col("c__" + m).cast("decimal(38,6)").alias("c")) for m in metrics])
    out = j.select(code_col, *keys, F.transform(pairs, lambda x: pct_deviation(x["g"], x["c"])).alias("__dev"))
    out = out.select(code_col, *keys, *[F.col("__dev")[i].alias("dev_" + m) for i, m in enumerate(metrics)])
    bad = reduce(or_, [F.abs(F.col("dev_" + m)) > tol for m in metrics])
    return out.where(bad)


def check_bound(df: DataFrame, value: str, limit: str, open_class=2000001,
                period_col: str = "partition_dt") -> DataFrame:
    """CMP-12: rows whose mean lies above its class limit; the open top class is exempt."""
    return df.where((F.col(value) > F.col(limit)) & F.col(period_col).like("%-%")
                    & (F.col(limit) != open_class))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once a row, whatever reads them.

    A filter on a plain computed column is pushed below it with the whole expression in each place
    that names the column; a generated column stays where it is.  (The outer form: for
    the plain one Spark tests the array's size first and so builds it twice.)
    """
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _deviating(df: DataFrame, tol: float) -> DataFrame:
    """Rows whose amounts ``__a`` and ``__b`` (in units) deviate, with the deviation, worked out for them only."""
    off = df.where(units_deviate(F.col("__a"), F.col("__b"), tol))
    return off.withColumn("deviation", units_deviation(F.col("__a"), F.col("__b"))).drop("__a", "__b")


def check_weighted_total(df: DataFrame, terms: list[tuple[str, str]], weight: str, total: str,
                         tol: float = 1.0, period_col: str = "partition_dt") -> DataFrame:
    """CMP-13: sum over sources of avg x weight x ratio against weight x total average.

    Adds ``source_total`` (rounded to 2 places, as the reference's NUMERIC(19,2)),
    ``all_total`` and ``deviation``; keeps rows off by more than ``tol`` %.  With decimal
    inputs every product and sum is exact, and each is worked out once a row.
    """
    w = F.col(weight)
    src = reduce(lambda acc, t: acc + t,
                 [F.col(avg) * w * F.col(ratio) for avg, ratio in terms])
    sums = _once(df.where(F.col(period_col).like("%-%")), source_total=round_half_away(src.cast("decimal(38,6)"), 2),
                 all_total=(w * F.col(total)).cast("decimal(38,6)"))
    return _deviating(_once(sums, __a=units("source_total"), __b=units("all_total")), tol)


def check_product(df: DataFrame, a: str, b: str, total: str, tol: float = 1.0,
                  period_col: str = "partition_dt") -> DataFrame:
    """CMP-14: ``a * b`` against a stated total; keeps rows off by more than ``tol`` %."""
    rows = _once(df.where(F.col(period_col).like("%-%")), __a=units(total), __b=units(F.col(a) * F.col(b)))
    return _deviating(rows, tol)


def check_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """AGG-11 / FLT-14: one row per check with its failing-row count and a failed flag."""
    parts = [c.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("check"), "n_rows")
             for name, c in checks.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("failed", F.col("n_rows") > 0)


def failed_check_count(summary: DataFrame) -> DataFrame:
    """AGG-11: how many checks failed (the procedure's counter), from ``check_summary``."""
    return summary.agg(F.count_if(F.col("failed")).alias("failed_checks"))
