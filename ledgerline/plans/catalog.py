"""Registered queries over the driver's tables, each with its DuckDB oracle text.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Column names match between the two; decimals leave as double and timestamps
as text so that both engines hash the same values.

The oracle texts state the reference's rules in DuckDB's own terms (integer arithmetic on
cents, its number texts, its rounding, literal tables of report lines); they use no code
of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import pct_deviation
from ..operators import quality as Q
from . import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Decimals -> double, timestamps -> text: the types both engines hand over alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n"


# Rules in DuckDB: the level of a code, and a deviation in whole hundredths of a percent,
# rounded half away from zero by integer division of exact amounts.
_LEVEL = "CASE WHEN mcc IS NULL THEN 'total' WHEN TRY_CAST(mcc AS DOUBLE) IS NOT NULL THEN 'code' ELSE 'group' END"


def _cents(x, scale=2):
    return f"CAST(CAST({x} AS DECIMAL(38,{scale})) * {10 ** scale} AS HUGEINT)"


def _dev_sql(a, b, scale=2):
    """(a - b) / a * 100 rounded to hundredths, of amounts with ``scale`` places; null where a is 0."""
    x, y = _cents(a, scale), _cents(b, scale)
    return (f"(CASE WHEN {x} <> 0 THEN (CASE WHEN ({x} >= {y}) = ({x} > 0) THEN 1 ELSE -1 END) * CAST("
            f"(2 * abs({x} - {y}) * 10000 + abs({x})) // (2 * abs({x})) AS DOUBLE) / 100 END)")


def _off_sql(a, b, percent, scale=2):
    """|a - b| is more than ``percent`` of |a|."""
    x, y = _cents(a, scale), _cents(b, scale)
    return f"({x} <> 0 AND abs({x} - {y}) * 100 > abs({x}) * {percent})"


_LV = ("lv", I.LV_SQL)
_MAP = ("mcc_map", I.CODE_MAP_SQL)
_M = I.LV_METRICS


# ------------------------------------------------------------ level checks
def _out(x, metric):
    """A metric as both engines hand it over: amounts as double, counts as bigint."""
    return f"CAST({x} AS {'DOUBLE' if metric.startswith('trans_amount') else 'BIGINT'}) AS {metric}"


def _sum_list():
    return ", ".join(_out(f"sum({m})", m) for m in _M)


@register("level_totals", _with(_LV) + f"""
SELECT partition_dt, {_LEVEL} AS level, {_sum_list()}
FROM lv GROUP BY ALL""")
def level_totals(spark, sf):
    return comparable(Q.level_totals(I.level_table(spark, sf), _M))


def _reconcile_sql(a, b, tol, where="true"):
    sums = ", ".join(f"sum(CASE WHEN {_LEVEL} = '{a}' THEN {m} END) AS a__{m}, "
                     f"sum(CASE WHEN {_LEVEL} = '{b}' THEN {m} END) AS b__{m}" for m in _M)
    unions = "\nUNION ALL ".join(
        f"SELECT partition_dt, '{m}' AS metric, CAST(a__{m} AS DECIMAL(38,2)) AS value_a, CAST(b__{m} AS DECIMAL(38,2)) AS value_b FROM w"
        for m in _M)
    return _with(_LV, ("w", f"SELECT partition_dt, {sums} FROM lv WHERE {where} GROUP BY partition_dt"),
                 ("l", unions), ("x", f"SELECT *, {_dev_sql('value_a', 'value_b')} AS deviation FROM l")) + f"""
SELECT partition_dt, metric, CAST(value_a AS DOUBLE) AS value_a, CAST(value_b AS DOUBLE) AS value_b, deviation
FROM x WHERE value_a IS NOT NULL AND value_b IS NOT NULL AND abs(deviation) >= {tol}"""


@register("reconcile_total_group", _reconcile_sql("total", "group", 5.0))
def reconcile_total_group(spark, sf):
    return comparable(Q.reconcile_levels(I.level_table(spark, sf), _M, "total", "group", tol=5.0))


@register("reconcile_total_code", _reconcile_sql("total", "code", 5.0))
def reconcile_total_code(spark, sf):
    return comparable(Q.reconcile_levels(I.level_table(spark, sf), _M, "total", "code", tol=5.0))


# FLT-4: the reference checks the period that the newest file reports; one period here.
PERIOD = "1996-03-01"


@register("reconcile_period", _reconcile_sql("total", "group", 5.0, f"partition_dt = '{PERIOD}'"))
def reconcile_period(spark, sf):
    return comparable(Q.reconcile_levels(I.level_table(spark, sf), _M, "total", "group", tol=5.0, period=PERIOD))


@register("deviation_ties", """
SELECT l_orderkey, l_linenumber, CAST((CAST(l_quantity AS INTEGER) + 1) // 2 AS DOUBLE) / 100 AS deviation FROM lineitem""")
def deviation_ties(spark, sf):
    t = I.tie_input(spark, sf)
    return comparable(t.select("l_orderkey", "l_linenumber", pct_deviation("a", "b").alias("deviation")))


# ------------------------------------------------------------ group checks
def _kind(level):
    return f"{_LEVEL} = '{level}'"


def _rollups_sql():
    sums = ", ".join(f"sum({m}) AS {m}" for m in _M)
    msum = ", ".join(f"sum({m}) AS {m}" for m in _M)
    return (("agg", f"SELECT {_LEVEL} AS lvl, mcc, region_name, partition_dt, {sums} "
                    f"FROM lv WHERE NOT {_kind('total')} GROUP BY ALL"),
            ("g", "SELECT mcc, region_name, partition_dt, " + ", ".join(_M) + " FROM agg WHERE lvl = 'group'"),
            ("c", f"SELECT mcc_group, region_name, partition_dt, {msum} FROM "
                  "(SELECT * FROM agg WHERE lvl = 'code') t LEFT JOIN mcc_map ON t.mcc = mcc_map.mcc_code "
                  "GROUP BY ALL"))


@register("rollup_metrics", _with(_LV) + f"""
SELECT mcc, region_name, partition_dt, {_sum_list()} FROM lv WHERE {_kind('group')} GROUP BY ALL""")
def rollup_metrics(spark, sf):
    r = Q.level_rollup(I.level_table(spark, sf), _M)
    return comparable(r.where(F.col("level") == "group").drop("level"))


@register("map_codes", _with(_LV, _MAP) + f"""
SELECT mcc_group, region_name, partition_dt, {_sum_list()}
FROM (SELECT mcc, region_name, partition_dt, {", ".join(f"sum({m}) AS {m}" for m in _M)}
      FROM lv WHERE {_kind('code')} GROUP BY ALL) t
LEFT JOIN mcc_map ON t.mcc = mcc_map.mcc_code GROUP BY ALL""")
def map_codes(spark, sf):
    codes = Q.level_rollup(I.level_table(spark, sf), _M).where(F.col("level") == "code").drop("level")
    return comparable(Q.map_codes(codes, I.code_map(spark, sf), _M))


_GROUP_DEVS = ", ".join(f"{_dev_sql('g.' + m, 'c.' + m)} AS dev_{m}" for m in _M)


@register("reconcile_groups", _with(_LV, _MAP, *_rollups_sql(), ("d", f"""
SELECT g.mcc, g.region_name, g.partition_dt, {_GROUP_DEVS}
FROM g JOIN c ON g.mcc = c.mcc_group AND g.region_name = c.region_name AND g.partition_dt = c.partition_dt""")) + f"""
SELECT * FROM d WHERE {" OR ".join(f"abs(dev_{m}) > 1.0" for m in _M)}""")
def reconcile_groups(spark, sf):
    return comparable(Q.reconcile_groups(I.level_table(spark, sf), I.code_map(spark, sf), _M, tol=1.0))


@register("unequal_groups", _with(_LV, _MAP, *_rollups_sql()) + f"""
SELECT mcc, region_name, partition_dt, {", ".join(_out(m, m) for m in _M)} FROM (
  SELECT mcc, region_name, partition_dt, {", ".join(_M)} FROM g
  EXCEPT
  SELECT mcc_group, region_name, partition_dt, {", ".join(_M)} FROM c)""")
def unequal_groups(spark, sf):
    return comparable(Q.unequal_groups(I.level_table(spark, sf), I.code_map(spark, sf), _M))


# ------------------------------------------------------------ row checks
@register("check_bound", _with(("o", I.BOUND_SQL)) + """
SELECT * FROM o WHERE o_totalprice > income_limit AND partition_dt LIKE '%-%' AND income_limit != 2000001""")
def check_bound(spark, sf):
    return comparable(Q.check_bound(I.bound_input(spark, sf), "o_totalprice", "income_limit"))


_TERMS = [(f"avg_{x}_rur", f"{x}_ratio") for x in I.INCOME_SHARES]


def _weighted_sql():
    src = " + ".join(f"{a} * client_cnt_in_cluster * {r}" for a, r in _TERMS)
    plain = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for t in _TERMS for c in t)
    return _with(("w", I.WEIGHTED_SQL),
                 ("x", f"SELECT *, CAST({src} AS DECIMAL(38,2)) AS source_total, client_cnt_in_cluster * avg_all_rur AS all_total FROM w")) + f"""
SELECT l_orderkey, l_linenumber, client_cnt_in_cluster, {plain}, CAST(avg_all_rur AS DOUBLE) AS avg_all_rur, partition_dt,
       CAST(source_total AS DOUBLE) AS source_total, CAST(all_total AS DOUBLE) AS all_total,
       {_dev_sql('source_total', 'all_total')} AS deviation FROM x
WHERE source_total <> 0 AND {_off_sql('source_total', 'all_total', 1)} AND partition_dt LIKE '%-%'"""


@register("check_weighted_total", _weighted_sql())
def check_weighted_total(spark, sf):
    return comparable(Q.check_weighted_total(I.weighted_input(spark, sf), _TERMS, "client_cnt_in_cluster", "avg_all_rur"))


def _product_sql(a, b, total):
    cols = ["cnt_inn", "avg_income", "SUM_income", "all_avg_cheque", "all_trans_cnt", "all_trans_amount"]
    return _with(("p", I.PRODUCT_SQL)) + f"""
SELECT l_orderkey, l_linenumber, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)}, partition_dt,
       {_dev_sql(total, f'{a} * {b}', 4)} AS deviation FROM p
WHERE partition_dt LIKE '%-%' AND {_off_sql(total, f'{a} * {b}', 1, 4)}"""


@register("check_product", _product_sql("cnt_inn", "avg_income", "SUM_income"))
def check_product(spark, sf):
    return comparable(Q.check_product(I.product_input(spark, sf), "cnt_inn", "avg_income", "SUM_income"))


@register("check_turnover", _product_sql("all_avg_cheque", "all_trans_cnt", "all_trans_amount"))
def check_turnover(spark, sf):
    return comparable(Q.check_product(I.product_input(spark, sf), "all_avg_cheque", "all_trans_cnt", "all_trans_amount"))


_SUMMARY_OF = ["reconcile_total_group", "reconcile_total_code", "reconcile_groups",
               "check_bound", "check_weighted_total", "check_product", "check_turnover"]


@register("check_summary", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS check_name, count(*) AS n_rows, count(*) > 0 AS failed FROM ({ORACLE[n]}) t_{i}"
    for i, n in enumerate(_SUMMARY_OF)))
def check_summary(spark, sf):
    return _summary(spark, sf).withColumnRenamed("check", "check_name")


def _summary(spark, sf):
    return Q.check_summary({n: QUERIES[n](spark, sf) for n in _SUMMARY_OF})


@register("failed_check_count", f"SELECT CAST(count(*) FILTER (WHERE failed) AS BIGINT) AS failed_checks FROM ({ORACLE['check_summary']})")
def failed_check_count(spark, sf):
    return Q.failed_check_count(_summary(spark, sf))


@register("rollup_top", _with(_LV) + f"""
SELECT region_name, partition_dt, {_sum_list()} FROM lv WHERE mcc IS NOT NULL
GROUP BY region_name, partition_dt ORDER BY region_name, partition_dt LIMIT 10""")
def rollup_top(spark, sf):
    """TOP-2: the first ten groups in key order (the cut is the operator)."""
    lv = I.level_table(spark, sf).where(F.col("mcc").isNotNull())
    return comparable(Q.rollup_metrics(lv, ["region_name", "partition_dt"], _M, top=10))


# ------------------------------------------------------------ columns and text rows
from ..operators.columns import rename_positional as _rename  # noqa: E402


@register("rename_positional", "SELECT r_regionkey AS id, r_name AS name FROM region")
def rename_positional(spark, sf):
    return _rename(I.table(spark, sf, "region").select("r_regionkey", "r_name"), ["id", "name"])


@register("parse_upload_lines", """
SELECT s_suppkey AS num, 'a;b ' || s_name AS name, CAST(CAST(s_acctbal AS DECIMAL(19,2)) AS DOUBLE) AS amount FROM supplier""")
def parse_upload_lines(spark, sf):
    """SRC-6: quoted ``;`` lines with a fixed layout, from text rows built of suppliers."""
    from ..sources.files import parse_delimited
    s = I.table(spark, sf, "supplier")
    line = F.concat(F.col("s_suppkey").cast("string"), F.lit(';"a;b '), F.col("s_name"), F.lit('";'),
                    F.col("s_acctbal").cast("decimal(19,2)").cast("string"))
    return comparable(parse_delimited(s.select(line.alias("line")), "line", "num bigint, name string, amount decimal(19,2)"))


@register("parse_headerless_lines", "SELECT CAST(p_partkey AS VARCHAR) AS a, p_brand AS b FROM part")
def parse_headerless_lines(spark, sf):
    """SRC-8: lines that end in the separator; the empty last column is dropped."""
    from ..sources.files import parse_headerless
    p = I.table(spark, sf, "part")
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(";"), F.col("p_brand"), F.lit(";"))
    return parse_headerless(p.select(line.alias("line")), "line", ["a", "b"])


@register("parse_page_records", """
SELECT event_id // 50 AS page, CAST(event_id AS DOUBLE) AS "DIM_369", event_type AS "VL", false AS failed
FROM events WHERE event_id // 50 % 11 <> 3
UNION ALL SELECT DISTINCT event_id // 50, NULL, NULL, true FROM events WHERE event_id // 50 % 11 = 3""")
def parse_page_records(spark, sf):
    """SRC-1: pages as JSON arrays of records, every eleventh cut off in the middle."""
    from ..sources.pages import page_records
    e = I.table(spark, sf, "events").select((F.expr("event_id div 50")).alias("page"), F.to_json(F.struct(
        F.col("event_id").cast("double").alias("DIM_369"), F.col("event_type").alias("VL"))).alias("j"))
    pages = e.groupBy("page").agg(F.array_join(F.collect_list("j"), ",").alias("body"))
    body = F.concat(F.lit("["), F.col("body"), F.when(F.col("page") % 11 == 3, F.lit("")).otherwise(F.lit("]")))
    return page_records(pages.select("page", body.alias("text")), "text").select("page", "DIM_369", "VL", "failed")


@register("parse_name_tree", "SELECT CAST(n_nationkey AS DOUBLE) AS id, lower(n_name) AS name FROM nation")
def parse_name_tree(spark, sf):
    """SRC-2: name trees as JSON text, one per region; names lower-cased."""
    from ..sources.pages import name_tree
    n = I.table(spark, sf, "nation")
    trees = n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(
        F.col("n_nationkey").cast("double").alias("id"), F.col("n_name").alias("name")))).alias("text"))
    return name_tree(trees, "text", "n_regionkey")


# ------------------------------------------------------------ incremental load
from ..operators import increment as INC  # noqa: E402


@register("new_periods", _with(("u", I.UPLOAD_SQL)) + """
SELECT DISTINCT partition_dt FROM u WHERE partition_dt IS NOT NULL
  AND partition_dt NOT IN (SELECT partition_dt FROM u WHERE o_orderdate < '2001-01-01' AND partition_dt IS NOT NULL)""")
def new_periods(spark, sf):
    up = I.upload(spark, sf)
    return INC.new_periods(up, I.history(up))


@register("period_frequency", _with(("u", I.UPLOAD_SQL), ("p", """
SELECT DISTINCT partition_dt FROM u UNION ALL
SELECT DISTINCT partition_dt FROM u WHERE o_orderdate < '2001-01-01'""")) + """
SELECT partition_dt, count(partition_dt) OVER (PARTITION BY partition_dt) AS freq FROM p""")
def period_frequency(spark, sf):
    up = I.upload(spark, sf)
    return INC.period_frequency(INC.stacked_periods(up, I.history(up)))


@register("append_preview", _with(("u", I.UPLOAD_SQL)) + f"""
SELECT {I.UPLOAD_OUT} FROM u WHERE partition_dt IN (
  SELECT partition_dt FROM u WHERE partition_dt IS NOT NULL
  EXCEPT SELECT partition_dt FROM u WHERE o_orderdate < '2001-01-01')""")
def append_preview(spark, sf):
    up = I.upload(spark, sf)
    return comparable(INC.rows_to_append(up, I.history(up)))


_CAT = f"""SELECT title, try_strptime(substr(title, -12, 8), '%Y%m%d')::DATE AS file_date,
  CASE WHEN instr(title, 'fl_trans') > 0 THEN 'fl_trans' WHEN instr(title, 'fl_blago') > 0 THEN 'fl_blago'
       WHEN instr(title, 'ul_') > 0 THEN 'ul' END AS kind FROM f WHERE title LIKE '%.csv'"""
_ACT = "strftime(date_trunc('month', file_date - INTERVAL 1 MONTH), '%Y-%m-%d')"


@register("latest_file", _with(("f", I.TITLES_SQL), ("c", _CAT)) + f"""
SELECT title, file_date, kind, {_ACT} AS actdate FROM c ORDER BY file_date DESC, title DESC LIMIT 1""")
def latest_file(spark, sf):
    return INC.latest_file(I.titles(spark, sf))


@register("reporting_period", _with(("f", I.TITLES_SQL), ("c", _CAT)) + f"""
SELECT kind, title, file_date, {_ACT} AS actdate FROM (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY file_date DESC, title DESC) AS rn FROM c) WHERE rn = 1""")
def reporting_period(spark, sf):
    return INC.latest_file(I.titles(spark, sf), by=["kind"])


@register("route_kind", _with(("f", I.TITLES_SQL)) + """
SELECT CASE WHEN instr(title, 'fl_trans') > 0 THEN 'fl_trans' WHEN instr(title, 'fl_blago') > 0 THEN 'fl_blago'
            WHEN instr(title, 'ul_') > 0 THEN 'ul' END AS kind,
       title LIKE '%.csv' AS is_csv, count(*) AS n_files
FROM f GROUP BY ALL""")
def route_kind(spark, sf):
    from ..functions.text import route_by_name
    t = I.titles(spark, sf)
    return (t.groupBy(route_by_name("title", INC.KIND_RULES).alias("kind"),
                      F.col("title").like("%.csv").alias("is_csv"))
             .agg(F.count(F.lit(1)).alias("n_files")))


# ------------------------------------------------------------ indicators
from ..functions.text import clean_value  # noqa: E402
from ..operators import indicators as IND  # noqa: E402
from ..operators.ordering import with_position  # noqa: E402
from ..sources.pages import json_field as _json_field  # noqa: E402

_DIGITS = "TRY_CAST(translate(replace(VL, ',', '.'), ' %', '') AS DOUBLE)"
_PLAIN = f"CASE WHEN VL = '-' THEN NULL ELSE {_DIGITS} END"
_SCALED = f"CASE WHEN VL = '-' THEN 0.0 WHEN contains(VL, '%') THEN {_DIGITS} ELSE {_DIGITS} / 1000.0 END"


@register("clean_value_plain", _with(("v", I.VALUE_TEXT_SQL)) + f"SELECT event_id, VL, {_PLAIN} AS val FROM v")
def clean_value_plain(spark, sf):
    v = I.value_text(spark, sf)
    return v.select("event_id", "VL", clean_value("VL", "plain").alias("val"))


@register("clean_value_scaled", _with(("v", I.VALUE_TEXT_SQL)) + f"SELECT event_id, VL, {_SCALED} AS val FROM v")
def clean_value_scaled(spark, sf):
    v = I.value_text(spark, sf)
    return v.select("event_id", "VL", clean_value("VL", "scaled").alias("val"))


@register("decode_dimension", _with(("d", "SELECT n_nationkey AS id, lower(n_name) AS name FROM nation")) + """
SELECT c_custkey, coalesce(d.name, CAST(c_nationkey + 5 AS VARCHAR)) AS nation
FROM customer LEFT JOIN d ON c_nationkey + 5 = d.id""")
def decode_dimension(spark, sf):
    # shifted ids: the five last ones have no name and stay
    c = I.table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 5).alias("c_nationkey"))
    n = I.table(spark, sf, "nation") \
         .select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("name"))
    return IND.decode_dimension(c, "c_nationkey", n, "nation").select("c_custkey", "nation")


@register("min_by_keys", """
SELECT event_type, user_id, CAST(ts AS DATE) AS day, min(value) AS min_value
FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL""")
def min_by_keys(spark, sf):
    e = I.table(spark, sf, "events").select("event_type", "user_id", F.col("ts").cast("date").alias("day"), "value")
    return IND.min_by_keys(e, ["event_type", "user_id", "day"], "value", "min_value")


_EXPORT_ORDER = "ordinal, DIM_2 NULLS LAST, DIM_3, DIM_4, DIM_5 NULLS LAST, TRY_CAST(date AS DATE) NULLS LAST"


def _indicators_sql():
    spec = " UNION ALL ".join(
        f"SELECT {float(i)} AS ind_id, '{flag}' AS flag_col, '{mode}' AS mode, '{label}' AS label, {n} AS ordinal"
        for n, (i, flag, mode, label) in enumerate(IND.INDICATOR_SPEC))
    digits = _DIGITS
    return _with(("pg", I.PAGES_SQL), ("spec", spec), ("cat", I.CATEGORIES_SQL), ("sl", I.SLICES_SQL), ("f", f"""
SELECT label AS DIM_1, ordinal, coalesce(cat.name, CAST(DIM_1295 AS VARCHAR)) AS DIM_2,
       coalesce(sl.name, CAST(DIM_369 AS VARCHAR)) AS DIM_5, DT AS date,
       CASE WHEN mode = 'scaled' THEN
         (CASE WHEN VL = '-' THEN 0.0 WHEN contains(VL, '%') THEN {digits} ELSE {digits} / 1000.0 END)
       ELSE (CASE WHEN VL = '-' THEN NULL ELSE {digits} END) END AS val
FROM pg JOIN spec ON DIM_1743 = ind_id
LEFT JOIN cat ON DIM_1295 = cat.id LEFT JOIN sl ON DIM_369 = sl.id
WHERE DIM_1293 = 2.0 AND DIM_1297 = 22.0
  AND (CASE WHEN flag_col = 'DIM_1294' THEN DIM_1294 ELSE DIM_1296 END) = 1.0"""), ("m", """
SELECT DIM_1, DIM_2, 'null' AS DIM_3, 'ед.' AS DIM_4, DIM_5, date, min(val) AS val, ordinal
FROM f WHERE DIM_5 IS NOT NULL AND DIM_1 IS NOT NULL AND ordinal IS NOT NULL AND DIM_2 IS NOT NULL
  AND date IS NOT NULL
GROUP BY DIM_1, DIM_2, DIM_5, date, ordinal"""))


def _build_indicators(spark, sf):
    return IND.build_indicators(I.indicator_pages(spark, sf), I.categories(spark, sf), I.slices(spark, sf),
                                IND.spec_frame(spark))


@register("build_indicators", _indicators_sql() + "SELECT * FROM m")
def build_indicators(spark, sf):
    return _build_indicators(spark, sf)


@register("indicator_export", _indicators_sql() + f"""
SELECT row_number() OVER (ORDER BY {_EXPORT_ORDER}) AS position, DIM_1, DIM_2, DIM_3, DIM_4, DIM_5, strftime(TRY_CAST(date AS DATE), '%m.%d.%Y') AS date,
       replace(CAST(val AS VARCHAR), '.', ',') AS val FROM m""")
def indicator_export(spark, sf):
    return with_position(IND.indicator_export(_build_indicators(spark, sf)))


@register("failed_pages", """
WITH p AS (SELECT event_type, event_id // 100 AS page, max(CAST(value > 300 AS INTEGER)) AS bad, count(value) AS rec
           FROM events GROUP BY ALL),
g AS (SELECT event_type, count(*) AS n, sum(bad) AS bad, sum(rec) AS rec FROM p GROUP BY ALL),
x AS (SELECT event_type, max(event_id // 100) + 3 AS expected FROM events GROUP BY ALL UNION ALL SELECT 'none', 4)
SELECT x.event_type, coalesce(n, 0) AS n_pages, CAST(coalesce(bad, 0) AS BIGINT) AS failed_pages,
       CAST(greatest(expected - coalesce(n, 0), 0) AS BIGINT) AS missing_pages, CAST(coalesce(rec, 0) AS BIGINT) AS records
FROM x LEFT JOIN g USING (event_type)""")
def failed_pages(spark, sf):
    """The service states two pages more than there are, and one indicator has none."""
    e = I.table(spark, sf, "events").select("event_type", F.expr("event_id div 100").alias("page"),
                                            (F.col("value") > 300).alias("bad"), "value")
    stated = e.groupBy("event_type").agg((F.max("page") + 3).alias("n_expected"))
    stated = stated.unionAll(spark.createDataFrame([("none", 4)], "event_type string, n_expected bigint"))
    return IND.failed_pages(e, "event_type", "page", "bad", "value", stated)


@register("drop_null_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       o_orderpriority FROM orders""")
def drop_null_columns(spark, sf):
    o = I.table(spark, sf, "orders").withColumn("o_note", F.lit(None).cast("string"))
    return comparable(IND.drop_null_columns(o))


@register("json_field", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(spark, sf):
    e = I.table(spark, sf, "events")
    return e.select("event_id", _json_field("props", "k").alias("k"))


# ------------------------------------------------------------ cells
from ..functions.geometry import close_ring, first_loop, ring_centroid  # noqa: E402
from ..operators import cells as C  # noqa: E402
from ..operators.stats import distinct_median as _distinct_median  # noqa: E402

_OKEYS = ["o_orderpriority", "o_orderstatus"]
_OMETRICS = ["o_totalprice", "cust"]


def _edges_sql(steps=5):
    lower = ["mn"] + [f"mn + (md - mn) / {float(steps)} * {i}" for i in range(1, steps)] + ["md"]
    upper = [f"md + (mx - md) / {float(steps)} * {i}" for i in range(1, steps)] + ["mx"]
    return "[" + ", ".join(lower + upper) + "]"


def _colored_sql(cells_sql, keys, metrics, idcols):
    k = ", ".join(keys)
    long = " UNION ALL ".join(f"SELECT {k}, '{m}' AS metric, {m} AS v FROM cells" for m in metrics)
    joins = " ".join(f"LEFT JOIN e e_{m} ON " + " AND ".join(f"cells.{x} = e_{m}.{x}" for x in keys)
                     + f" AND e_{m}.metric = '{m}'" for m in metrics)
    cols = ", ".join(f"CASE WHEN cells.{m} IS NULL OR isnan(cells.{m}) THEN NULL "
                     f"ELSE len(list_filter(e_{m}.edges, lambda x: x < cells.{m})) END AS COLOR_{m}" for m in metrics)
    return _with(("cells", cells_sql), ("long", long), ("st", f"""
SELECT {k}, metric, min(v) AS mn, max(v) AS mx, median(DISTINCT v) AS md
FROM long WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL"""), ("e", f"SELECT *, {_edges_sql()} AS edges FROM st"),
                 ("colored", f"SELECT {', '.join('cells.' + c for c in idcols)}, {cols} FROM cells {joins} "
                            f"WHERE {' AND '.join(f'cells.{x} IS NOT NULL' for x in keys)}"))


_ORDER_COLORED = _colored_sql(I.ORDER_CELLS_SQL, _OKEYS, _OMETRICS,
                              ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "cust"])


@register("distinct_median", """
SELECT o_orderpriority, o_orderstatus, median(DISTINCT o_totalprice) AS median FROM orders GROUP BY ALL""")
def distinct_median(spark, sf):
    return _distinct_median(I.table(spark, sf, "orders"), _OKEYS, "o_totalprice")


@register("color_scale", _ORDER_COLORED + "SELECT * FROM colored")
def color_scale(spark, sf):
    return C.color_scale(I.order_cells(spark, sf), _OKEYS, _OMETRICS)


_EVEN = "CAST(round_even({} * 100, 0) / 100 AS VARCHAR)"


@register("color_summary", _ORDER_COLORED + f"""
SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderstatus, Bin) AS position, * FROM (
SELECT o_orderpriority, o_orderstatus, COLOR_o_totalprice AS Bin,
       '[' || {_EVEN.format('min(o_totalprice)')} || '; ' || {_EVEN.format('max(o_totalprice)')} || ']' AS Range,
       count(o_totalprice) AS Count
FROM colored WHERE COLOR_o_totalprice IS NOT NULL GROUP BY ALL)""")
def color_summary(spark, sf):
    colored = C.color_scale(I.order_cells(spark, sf), _OKEYS, _OMETRICS)
    return with_position(C.slice_summary(colored, _OKEYS, "o_totalprice"))


# eighths: every other value is a tie at two places
_EIGHTHS = _colored_sql("SELECT l_returnflag, l_quantity / 8 + l_linenumber AS v FROM lineitem", ["l_returnflag"], ["v"],
                        ["l_returnflag", "v"])


@register("color_summary_ties", _EIGHTHS + f"""
SELECT l_returnflag, COLOR_v AS Bin, '[' || {_EVEN.format('min(v)')} || '; ' || {_EVEN.format('max(v)')} || ']' AS Range,
       count(v) AS Count FROM colored WHERE COLOR_v IS NOT NULL GROUP BY ALL""")
def color_summary_ties(spark, sf):
    li = I.table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_quantity") / 8 + F.col("l_linenumber")).alias("v"))
    return C.slice_summary(C.color_scale(li, ["l_returnflag"], ["v"]), ["l_returnflag"], "v")


@register("size_class", """
WITH c AS (SELECT p_partkey, p_type, length(p_type) - length(replace(p_type, 'M', '')) AS n_letters FROM part),
r AS (SELECT n_letters, dense_rank() OVER (ORDER BY n_letters) AS rk FROM (SELECT DISTINCT n_letters FROM c))
SELECT p_partkey, p_type, n_letters,
       CASE rk WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Big' ELSE 'Other' END AS size
FROM c JOIN r USING (n_letters)""")
def size_class(spark, sf):
    p = I.table(spark, sf, "part").select("p_partkey", "p_type")
    out = C.size_class(p.withColumn("n_letters", C.letter_count("p_type", "M")), "p_type", letter="M")
    return out.select("p_partkey", "p_type", "n_letters", "size")


@register("merge_cells", _with(("t3", I.CELL3_SQL), ("t5r", I.CELL5_SQL), ("t5", """
SELECT CELL_ID, (SELECT min(REGION_ID) FROM t3) AS REGION_ID, INDUSTRY_ID, INDUSTRY_NAME,
       (SELECT min(ANALYTIC_DATE) FROM t3) AS ANALYTIC_DATE, area, acctbal, n FROM t5r"""),
    ("k", "SELECT " + ", ".join(I.CELL_KEYS) + " FROM t3 UNION SELECT " + ", ".join(I.CELL_KEYS) + " FROM t5")) + f"""
SELECT {", ".join("k." + c for c in I.CELL_KEYS)}, CAST(t3.acctbal AS DOUBLE) AS acctbal_x, t3.n AS n_x,
       CAST(t5.acctbal AS DOUBLE) AS acctbal_y, t5.n AS n_y
FROM k LEFT JOIN t3 ON {" AND ".join(f"k.{c} IS NOT DISTINCT FROM t3.{c}" for c in I.CELL_KEYS)}
LEFT JOIN t5 ON {" AND ".join(f"k.{c} IS NOT DISTINCT FROM t5.{c}" for c in I.CELL_KEYS)}""")
def merge_cells(spark, sf):
    t3 = I.cell_table_3(spark, sf)
    t5 = C.with_scalars_from(I.cell_table_5(spark, sf), t3, ["REGION_ID", "ANALYTIC_DATE"])
    return comparable(C.merge_cells(t3, t5.select(*I.CELL_KEYS, "acctbal", "n"), I.CELL_KEYS))


@register("merge_cells_hot", _with(("a", I.HOT_A_SQL), ("b", I.HOT_B_SQL),
    ("k", "SELECT " + ", ".join(I.CELL_KEYS) + " FROM a UNION SELECT " + ", ".join(I.CELL_KEYS) + " FROM b")) + f"""
SELECT {", ".join("k." + c for c in I.CELL_KEYS)}, o_orderkey, a.total AS total_x, s_suppkey, b.total AS total_y
FROM k LEFT JOIN a ON {" AND ".join(f"k.{c} IS NOT DISTINCT FROM a.{c}" for c in I.CELL_KEYS)}
LEFT JOIN b ON {" AND ".join(f"k.{c} IS NOT DISTINCT FROM b.{c}" for c in I.CELL_KEYS)}""")
def merge_cells_hot(spark, sf):
    """JON-5 with a third of both tables on one key, all of whose parts are null."""
    return C.merge_cells(*I.hot_cells(spark, sf), I.CELL_KEYS)


# т.4: three keys; a null bin is a group of its own, shown as 'None'; other nulls as '-'
_T4_KEYS = ["size", "INDUSTRY_NAME", "SPENDING_BIN"]
_T4_SQL = f"""WITH c AS ({I.CELL4_SQL}),
n AS (SELECT *, len(CELL_ID) - len(replace(CELL_ID, 'f', '')) AS k FROM c),
r AS (SELECT k, dense_rank() OVER (ORDER BY k) AS rk FROM (SELECT DISTINCT k FROM n))
SELECT c_custkey, CELL_ID, INDUSTRY_NAME, coalesce(SPENDING_BIN, 'None') AS SPENDING_BIN, area, spend, visits,
       CASE rk WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Big' ELSE 'Other' END AS size
FROM n JOIN r USING (k)"""
_T4_COLORED = _colored_sql(_T4_SQL, _T4_KEYS, ["spend", "visits"],
                           ["c_custkey", "CELL_ID", "INDUSTRY_NAME", "SPENDING_BIN", "area", "spend", "visits", "size"])


def _colored_t4(spark, sf):
    t4 = C.drop_columns_like(I.cell_table_4(spark, sf), "color_id", "COLOR_ID")
    t4 = C.size_class(t4.withColumn("SPENDING_BIN", F.coalesce("SPENDING_BIN", F.lit("None"))), "CELL_ID")
    return C.color_scale(t4, _T4_KEYS, ["spend", "visits"])


@register("color_spending", _T4_COLORED + "SELECT * FROM colored")
def color_spending(spark, sf):
    return _colored_t4(spark, sf)


@register("slice_filter", _T4_COLORED + "SELECT * FROM colored WHERE size = 'Small' AND SPENDING_BIN = 'mid'")
def slice_filter(spark, sf):
    return C.slice_filter(_colored_t4(spark, sf), size="Small", SPENDING_BIN="mid")


@register("colored_union", _T4_COLORED + """,
u AS (SELECT c_custkey AS id, size, SPENDING_BIN, COLOR_spend, COLOR_visits, CAST(NULL AS INTEGER) AS COLOR_c_acctbal FROM colored
      UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL, s_nationkey FROM supplier)
SELECT CAST(id AS VARCHAR) AS id, coalesce(size, '-') AS size, coalesce(SPENDING_BIN, 'None') AS SPENDING_BIN,
       coalesce(CAST(COLOR_spend AS VARCHAR), '-') AS COLOR_spend, coalesce(CAST(COLOR_visits AS VARCHAR), '-') AS COLOR_visits,
       coalesce(CAST(COLOR_c_acctbal AS VARCHAR), '-') AS COLOR_c_acctbal FROM u""")
def colored_union(spark, sf):
    """SET-5 + NUL-1: coloured tables with differing columns under each other, nulls as text."""
    t4 = _colored_t4(spark, sf).select(F.col("c_custkey").alias("id"), "size", "SPENDING_BIN", "COLOR_spend", "COLOR_visits")
    other = I.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("COLOR_c_acctbal"))
    return C.display_fill(t4.unionByName(other, allowMissingColumns=True), cols={"SPENDING_BIN": "None"})


@register("filter_values", """
SELECT row_number() OVER (ORDER BY column_name, value) AS position, * FROM (
SELECT DISTINCT 'p_brand' AS column_name, CAST(p_brand AS VARCHAR) AS value FROM part
UNION SELECT DISTINCT 'p_type', CAST(p_type AS VARCHAR) FROM part
UNION SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part)""")
def filter_values(spark, sf):
    return with_position(C.filter_values(I.table(spark, sf, "part"), ["p_brand", "p_type", "p_size"]))


@register("mixed_union", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment
FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier""")
def mixed_union(spark, sf):
    c = I.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                               F.col("c_nationkey").alias("nationkey"),
                                               F.col("c_acctbal").alias("acctbal"),
                                               F.col("c_mktsegment").alias("mktsegment"))
    s = I.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                               F.col("s_nationkey").alias("nationkey"),
                                               F.col("s_acctbal").alias("acctbal"))
    return c.unionByName(s, allowMissingColumns=True)


def _coords(ring_col):
    return [F.transform(ring_col, lambda v: v["lat"]).alias("lats"),
            F.transform(ring_col, lambda v: v["lng"]).alias("lngs")]


@register("ring_close", _with(("r", I.RINGS_SQL)) + """
SELECT s_suppkey, list_transform(ring || [ring[1]], lambda v: v.lat) AS lats,
       list_transform(ring || [ring[1]], lambda v: v.lng) AS lngs FROM r""")
def ring_close(spark, sf):
    r = I.supplier_rings(spark, sf)
    return r.select("s_suppkey", *_coords(close_ring("ring")))


@register("first_loop", _with(("r", I.RINGS_SQL)) + """
SELECT s_suppkey, list_transform(ring, lambda v: v.lat) AS lats, list_transform(ring, lambda v: v.lng) AS lngs FROM r""")
def first_loop_q(spark, sf):
    """ARR-2: two polygons of one outline each; the first loop of the first is the outline."""
    r = I.supplier_rings(spark, sf)
    loops = F.array(F.array("ring"), F.array(F.reverse("ring")))
    return r.select("s_suppkey", first_loop(loops).alias("ring")).select("s_suppkey", *_coords("ring"))


@register("view_centre", _with(("r", I.RINGS_SQL)) + """
SELECT s_nationkey, round(avg(v.lat), 6) AS lat, round(avg(v.lng), 6) AS lng
FROM (SELECT s_nationkey, unnest(ring || [ring[1]]) AS v FROM r) GROUP BY ALL""")
def view_centre(spark, sf):
    r = I.supplier_rings(spark, sf).select("s_nationkey", F.explode(close_ring("ring")).alias("v"))
    c = C.mean_centre(r.select("s_nationkey", "v.lat", "v.lng"), ["s_nationkey"])
    return c.select("s_nationkey", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


# A hexagon's centre is the point it was drawn around; of every four outlines one is a line
# between its first and fourth vertex (its middle is that point too) and one a point (itself).
@register("ring_centroid", """
SELECT s_suppkey, CAST(55 + s_suppkey % 97 * 0.01 + CASE WHEN s_suppkey % 4 = 1 THEN 0.002 ELSE 0 END AS DOUBLE) AS lat,
       CAST(37 + s_nationkey * 0.01 AS DOUBLE) AS lng FROM supplier""")
def ring_centroid_q(spark, sf):
    r = I.supplier_rings(spark, sf)
    kind = F.col("s_suppkey") % 4
    ring = F.when(kind == 1, F.slice("ring", 1, 1)).when(kind == 2, F.array(F.col("ring")[0], F.col("ring")[3])).otherwise(F.col("ring"))
    r = r.select("s_suppkey", ring_centroid(close_ring(ring)).alias("c"))
    return r.select("s_suppkey", F.round("c.lat", 9).alias("lat"), F.round("c.lng", 9).alias("lng"))


_SUPP_CELLS = "SELECT s_suppkey, n_regionkey, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@register("hex_layer", _colored_sql(_SUPP_CELLS, ["n_regionkey"], ["s_acctbal"], ["s_suppkey", "n_regionkey", "s_acctbal"])
          [:-1] + ",\n" + f"r AS ({I.RINGS_SQL})\n" + f"""
SELECT s_suppkey, COLOR_s_acctbal AS bin,
       ([{", ".join(repr(c) for c in C.COLOR_NAMES)}])[COLOR_s_acctbal + 1] AS color_name,
       COLOR_s_acctbal + 1 AS width,
       list_transform(ring || [ring[1]], lambda v: v.lat) AS lats,
       list_transform(ring || [ring[1]], lambda v: v.lng) AS lngs
FROM colored JOIN r USING (s_suppkey) WHERE COLOR_s_acctbal IS NOT NULL""")
def hex_layer(spark, sf):
    s = I.table(spark, sf, "supplier")
    n = I.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    cells = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "n_regionkey", "s_acctbal")
    colored = C.color_scale(cells, ["n_regionkey"], ["s_acctbal"])
    layer = C.hex_layer(colored, I.supplier_rings(spark, sf).select("s_suppkey", "ring"), "s_suppkey",
                        "COLOR_s_acctbal")
    return layer.select("s_suppkey", "bin", "color_name", "width", *_coords(F.col("ring")))


# ------------------------------------------------------------ XML reports
from ..operators import reports as REP  # noqa: E402


# The value columns of each kind in header order (code after remapping, element),
# without the codes that the kind leaves out.
_FULL_LINES = [
    (1099, "Актив"), (1100, "ВнеОбА"), (1110, "НематАкт"), (1120, "РезИсслед"), (1150, "ОснСр"), (1170, "ФинВлож"),
    (1200, "ОбА"), (1210, "Запасы"), (1240, "ФинВлож"), (1250, "ДенежнСр"), (1299, "Пассив"), (1300, "КапРез"),
    (1310, "УставКапитал"), (1370, "НераспПриб"), (1400, "ДолгосрОбяз"), (1410, "ЗаемСредств"), (1430, "ОценОбяз"),
    (1450, "ПрочОбяз"), (1500, "КраткосрОбяз"), (1510, "ЗаемСредств"), (1520, "КредитЗадолж"), (1530, "ДоходБудущ"),
    (1540, "ОценОбяз"), (1550, "ПрочОбяз"), (2110, "Выруч"), (2120, "СебестПрод"), (2330, "ПроцУпл"),
    (2340, "ПрочДоход"), (2350, "ПрочРасход"), (2400, "ЧистПрибУб")]
_SIMPLE_LINES = [
    (1099, "Актив"), (1151, "ОснСрНезаверш"), (1210, "Запасы"), (1250, "ДенежнСр"), (1299, "Пассив"),
    (1301, "МатВнеАкт"), (1302, "НеМатФинАкт"), (1411, "ЗаемСредствКред"), (1520, "КредитЗадолж"), (2110, "Выруч"),
    (2330, "ПроцУпл"), (2340, "ПрочДоход"), (2350, "ПрочРасход"), (2400, "ЧистПрибУб")]
_KIND_SQL = {  # id prefix, label, orders, lines, slot of a line item, slots
    "full": ("NO_BUHOT_", "Полная", "o_orderstatus <> 'P'", _FULL_LINES, "l_linenumber + 7 * (l_orderkey % 3)", I.FULL_SLOTS),
    "simplified": ("NO_BOUPR_", "Упрощённая", "o_orderstatus = 'P'", _SIMPLE_LINES, "l_linenumber", I.SIMPLE_SLOTS)}
# files that are whole and have the prefix of their kind
_READABLE = "o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0"
_THREE, _TWO = ["СумОтч", "СумПрдщ", "СумПрдшв"], ["СумОтч", "СумПред"]

# line items as the files state them, numbered in document order within a line number
_ITEMS = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY q, p, t) - 1 AS rep
FROM (SELECT l_orderkey, l_linenumber, {I.MONEY_SQL.format('l_quantity')} AS q,
             {I.MONEY_SQL.format('l_extendedprice')} AS p, {I.MONEY_SQL.format('l_tax')} AS t FROM lineitem)"""


def _report_sql(kind, of="o_orderkey", readable=_READABLE):
    prefix, label, orders, lines, slot, slots = _KIND_SQL[kind]
    by_line = {(code, element): k for k, (_, element, code) in slots.items()}
    used = sorted(slots)
    pivot = ", ".join(f"max(CASE WHEN slot = {k} THEN {c} END) AS {c}{k}" for k in used for c in "qpt")
    total = I.MONEY_SQL.format("o_totalprice")
    seen, cols = {}, []
    for code, element in lines:
        for n, attr in enumerate(_THREE if code < 2000 else _TWO):
            repeat = seen[element] = seen.get(element, -1) + 1
            name = f"{element}__{attr}" if repeat == 0 else f"{element}_{repeat}__{attr}"
            if (code, element) in by_line:
                value = f"CASE WHEN doc = 0 THEN li.{'qpt'[n]}{by_line[code, element]} END"
            elif code == 1099 and n == 0:
                value = total
            elif code in (1299, 2110) and n == 0:
                value = f"CASE WHEN doc = 0 THEN {total} END"
            elif code == 2110:
                value = "CASE WHEN doc = 0 THEN CAST(o_custkey AS VARCHAR) END"
            else:
                value = "CAST(NULL AS VARCHAR)"
            cols.append(f'{value} AS "{name}"')
    return f"""SELECT '{prefix}' || CAST({of} AS VARCHAR) AS "ИдФайл__xml", '{label}' AS "КНД__Тип",
       strftime(o_orderdate, '%Y') AS "КНД_1__ОтчетГод", strftime(o_orderdate, '%d%m%Y') AS "ДатаДок__ГГГГММДД",
       '6201' AS "СвНП__ОКВЭД2", lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS "НПЮЛ__ИННЮЛ",
       'Org, ' || CAST(o_custkey AS VARCHAR) AS "НПЮЛ_1__НаимОрг", {", ".join(cols)}
FROM orders CROSS JOIN (VALUES (0), (1)) d(doc)
LEFT JOIN (SELECT l_orderkey, {pivot} FROM (SELECT *, {slot} AS slot FROM ({_ITEMS}) WHERE rep = 0) GROUP BY l_orderkey) li
  ON li.l_orderkey = o_orderkey
WHERE {orders} AND {readable} AND (doc = 0 OR o_orderkey % 10 = 0)"""


def _parsed_reports(spark, sf, lines, kinds=(REP.FULL, REP.SIMPLE)):
    return REP.parse_reports(I.report_files(spark, sf), dictionary=lines, kinds=kinds)


@register("flatten_reports", _report_sql("full"))
def flatten_reports(spark, sf):
    return REP.flatten_reports(_parsed_reports(spark, sf, I.REPORT_DICTIONARY, (REP.FULL,)), I.REPORT_DICTIONARY, REP.FULL)


@register("fuse_reports", f"({_report_sql('full')})\nUNION ALL BY NAME\n({_report_sql('simplified')})")
def fuse_reports(spark, sf):
    lines = REP.dictionary_lines(I.report_dictionary(spark))
    return REP.flatten_fused(_parsed_reports(spark, sf, lines), lines)


def _long_sql():
    prefix, _, orders, _, slot, slots = _KIND_SQL["full"]
    code = f"CASE {slot} " + " ".join(f"WHEN {k} THEN {c}" for k, (_, _, c) in slots.items()) + " END"
    elem = f"CASE {slot} " + " ".join(f"WHEN {k} THEN '{e}'" for k, (_, e, _) in slots.items()) + " END"
    fid = f"'{prefix}' || CAST(o_orderkey AS VARCHAR)"
    total, of = I.MONEY_SQL.format("o_totalprice"), f"FROM orders WHERE {orders} AND {_READABLE}"
    return f"""
SELECT {fid} AS file_id, 0 AS doc_no, 1099 AS code, 'Актив' AS element, 0 AS rep, 'СумОтч' AS attr, {total} AS value {of}
UNION ALL SELECT {fid}, 1, 1099, 'Актив', 0, 'СумОтч', {total} {of} AND o_orderkey % 10 = 0
UNION ALL SELECT {fid}, 0, 1299, 'Пассив', 0, 'СумОтч', {total} {of}
UNION ALL SELECT {fid}, 0, 2110, 'Выруч', 0, 'СумОтч', {total} {of}
UNION ALL SELECT {fid}, 0, 2110, 'Выруч', 0, 'СумПред', CAST(o_custkey AS VARCHAR) {of}
UNION ALL SELECT {fid}, 0, {code}, {elem}, rep, CASE a.n WHEN 1 THEN 'СумОтч' WHEN 3 THEN 'СумПрдшв'
                 ELSE CASE WHEN {code} < 2000 THEN 'СумПрдщ' ELSE 'СумПред' END END,
                 CASE a.n WHEN 1 THEN q WHEN 2 THEN p ELSE t END
FROM ({_ITEMS}) JOIN orders ON l_orderkey = o_orderkey CROSS JOIN (VALUES (1), (2), (3)) a(n)
WHERE {orders} AND {_READABLE} AND (a.n < 3 OR {code} < 2000)"""


def _full_long(spark, sf):
    lines = REP.dictionary_lines(I.report_dictionary(spark))
    return REP.xml_to_long(_parsed_reports(spark, sf, lines, (REP.FULL,)), lines, REP.FULL)


@register("xml_to_long", _long_sql())
def xml_to_long(spark, sf):
    return _full_long(spark, sf)


# RSH-3: the long form of the first occurrences back to one row per document
_WIDE_KEYS = [f"{c}_{a}" for c, _ in _FULL_LINES for a in (_THREE if c < 2000 else _TWO)]


@register("long_to_wide", _with(("l", _long_sql())) + "SELECT file_id, doc_no, " + ", ".join(
    f"max(CASE WHEN CAST(code AS VARCHAR) || '_' || attr = '{k}' THEN value END) AS \"{k}\"" for k in _WIDE_KEYS)
    + " FROM l WHERE rep = 0 GROUP BY file_id, doc_no")
def long_to_wide(spark, sf):
    long = _full_long(spark, sf).where(F.col("rep") == 0) \
        .withColumn("key", F.concat_ws("_", F.col("code").cast("string"), "attr"))
    return REP.long_to_wide(long, ["file_id", "doc_no"], "key", "value", _WIDE_KEYS)


def _part_dictionary(spark, sf):
    """Report dictionary read off the part table: code = size*100 + 1000, element = smallest type."""
    p = I.table(spark, sf, "part")
    return p.groupBy("p_size").agg(F.min("p_type").alias("element")) \
            .select((F.col("p_size") * 100 + 1000).alias("code"), "element")


# The identifying columns, the remapped codes and the codes that each kind leaves out.
_ID_COLUMNS = [("ИдФайл", "xml"), ("КНД", "Тип"), ("КНД", "ОтчетГод"), ("ДатаДок", "ГГГГММДД"), ("СвНП", "ОКВЭД2"),
               ("НПЮЛ", "ИННЮЛ"), ("НПЮЛ", "НаимОрг")]
_LEFT_OUT = {
    "full": "1151, 1171, 1231, 1301, 1302, 1411, 1451, 1511, 1551, 2121, 2416",
    "simplified": "1110, 1120, 1130, 1140, 1150, 1160, 1170, 1180, 1190, 1100, 1220, 1230, 1240, 1260, 1200, 1310, 1320, "
                  "1340, 1350, 1360, 1370, 1300, 1410, 1420, 1430, 1450, 1400, 1510, 1530, 1540, 1550, 1500, 2120, 2130, "
                  "2210, 2220, 2230, 2310, 2320, 2360, 2410, 2411, 2412, 2460, 2510, 2520, 2530, 2540, 2900, 2910"}


def _header_sql(kind):
    ids = " UNION ALL ".join(f"SELECT {i} AS pos, '{n}' AS element, '{a}' AS attr, CAST(NULL AS INTEGER) AS code"
                             for i, (n, a) in enumerate(_ID_COLUMNS))
    attrs = ", ".join([f"({i}, '{a}', true)" for i, a in enumerate(_THREE)] + [f"({i}, '{a}', false)" for i, a in enumerate(_TWO)])
    return _with(
        ("d0", "SELECT p_size * 100 + 1000 AS code, min(p_type) AS element FROM part GROUP BY p_size"),
        ("d", "SELECT CASE code WHEN 1600 THEN 1099 WHEN 1700 THEN 1299 WHEN 13001 THEN 1301 WHEN 13002 THEN 1302 "
              "ELSE code END AS code, element FROM d0"),
        ("f", f"SELECT * FROM d WHERE code NOT IN ({_LEFT_OUT[kind]})"),
        ("l", f"SELECT code, element, a.attr_pos, a.attr FROM f JOIN (VALUES {attrs}) a(attr_pos, attr, bal) "
              "ON (f.code < 2000) = a.bal"),
        ("h", f"""{ids} UNION ALL
SELECT CAST(row_number() OVER (ORDER BY code, element, attr_pos) + {len(_ID_COLUMNS) - 1} AS INTEGER),
       element, attr, code FROM l"""),
        ("n", """SELECT *, CASE WHEN row_number() OVER (PARTITION BY element ORDER BY pos) = 1 THEN element
     ELSE element || '_' || CAST(row_number() OVER (PARTITION BY element ORDER BY pos) - 1 AS VARCHAR) END AS name
FROM h""")) + "SELECT pos, name, attr, code, element, name || '__' || attr AS \"column\" FROM n"


@register("report_header", _header_sql("full"))
def report_header(spark, sf):
    return REP.report_header(_part_dictionary(spark, sf), REP.FULL)


@register("dedupe_names", _header_sql("simplified"))
def dedupe_names(spark, sf):
    return REP.report_header(_part_dictionary(spark, sf), REP.SIMPLE)


@register("style_map", _ORDER_COLORED + f"""
SELECT o_orderkey, COLOR_o_totalprice AS bin,
       ([{", ".join(repr(c) for c in C.COLOR_NAMES)}])[COLOR_o_totalprice + 1] AS color_name,
       COLOR_o_totalprice + 1 AS width
FROM colored WHERE COLOR_o_totalprice IS NOT NULL""")
def style_map(spark, sf):
    colored = C.color_scale(I.order_cells(spark, sf), _OKEYS, _OMETRICS)
    return (colored.where(F.col("COLOR_o_totalprice").isNotNull())
                   .select("o_orderkey", F.col("COLOR_o_totalprice").alias("bin"),
                           *C.style_columns("COLOR_o_totalprice")))


@register("report_status", """
SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'unroutable' WHEN o_orderstatus = 'P' THEN 'simplified' ELSE 'full' END AS kind,
       count(*) AS files, count(*) FILTER (WHERE o_orderkey % 97 = 0) AS broken,
       CAST(sum(CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS documents
FROM orders GROUP BY ALL""")
def report_status(spark, sf):
    st = REP.report_status(I.report_files(spark, sf))
    return st.groupBy("kind").agg(F.count(F.lit(1)).alias("files"),
                                  F.sum(F.col("broken").cast("long")).alias("broken"),
                                  F.sum(F.col("documents").cast("long")).alias("documents"))


from . import landed  # noqa: E402, F401  (queries over files that they write)
