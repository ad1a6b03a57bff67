"""Inputs derived by Spark from the driver's tables.

Each builder reads whole tables and returns a lazy DataFrame shaped like one of
the reference's inputs.  The matching DuckDB text (``*_SQL``) builds the same
rows for the oracle.  Where a rule below uses ``%`` it decides a value of every
row (a group, a kind, a planted error); it never selects a subset of rows.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import month_period
from ..session import setting

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- level table
# LV: one extract with three pre-made levels and the 18 metrics of the transactions upload:
# mcc null = grand total, mcc 'G<n>' = text group, mcc '<p_size>' = numeric code.
# Planted: group G3 states its first amount 1.5 times too high, and code 7 its second one
# nine times too high, so that every level check has something to find.
# The metrics of the upload, in its column order.
PLACES = ["on_terr", "other_terr", "other_region", "other_countries", "onl_rf", "onl_other"]
LV_METRICS = ([f"trans_amount_{p}" for p in PLACES] + [f"count_trans_{p}" for p in PLACES]
              + [f"client_cnt_{p}" for p in PLACES])
DEC = "decimal(19,2)"


def level_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    price, count = F.col("l_extendedprice").cast(DEC), F.col("l_quantity").cast("bigint")
    metrics = ([(price * F.lit(i + 1)).cast(DEC) for i in range(6)] + [count + F.lit(i).cast("bigint") for i in range(6)]
               + [(F.col("l_linenumber") + F.lit(i)).cast("bigint") for i in range(6)])
    base = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_size").alias("size"), F.col("p_size").cast("string").alias("code"),
        F.concat(F.lit("G"), (F.col("p_size") % 6).cast("string")).alias("grp"),
        F.col("l_returnflag").alias("region_name"), month_period("l_shipdate").alias("partition_dt"),
        *[m.alias(n) for n, m in zip(LV_METRICS, metrics)])
    first, second, *rest = [F.col(m) for m in LV_METRICS]
    high = F.when(F.col("grp") == "G3", (first * F.lit(1.5).cast("decimal(2,1)")).cast(DEC)).otherwise(first)
    wrong = F.when(F.col("size") == 7, (second * 9).cast(DEC)).otherwise(second)
    # one scan, one join: each input row yields its three level rows
    return base.select("region_name", "partition_dt", F.inline(F.array(
        F.struct(F.lit(None).cast("string").alias("mcc"), first, second, *rest),
        F.struct(F.col("grp").alias("mcc"), high.alias(LV_METRICS[0]), second, *rest),
        F.struct(F.col("code").alias("mcc"), first, wrong.alias(LV_METRICS[1]), *rest),
    ))).select("mcc", "region_name", "partition_dt", *LV_METRICS)


def _lv_sql() -> str:
    names = ([f"CAST(CAST(l_extendedprice AS DECIMAL(19,2)) * {i + 1} AS DECIMAL(19,2)) AS trans_amount_{p}" for i, p in enumerate(PLACES)]
             + [f"CAST(l_quantity AS BIGINT) + {i} AS count_trans_{p}" for i, p in enumerate(PLACES)]
             + [f"CAST(l_linenumber + {i} AS BIGINT) AS client_cnt_{p}" for i, p in enumerate(PLACES)])
    rest = ", ".join(LV_METRICS[2:])
    return f"""
WITH base AS (
  SELECT p_size, CAST(p_size AS VARCHAR) AS code, 'G' || CAST(p_size % 6 AS VARCHAR) AS grp,
         l_returnflag AS region_name, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS partition_dt,
         {", ".join(names)}
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(NULL AS VARCHAR) AS mcc, region_name, partition_dt, {", ".join(LV_METRICS)} FROM base
UNION ALL
SELECT grp, region_name, partition_dt,
       CASE WHEN grp = 'G3' THEN CAST(trans_amount_on_terr * 1.5 AS DECIMAL(19,2)) ELSE trans_amount_on_terr END,
       trans_amount_other_terr, {rest} FROM base
UNION ALL
SELECT code, region_name, partition_dt, trans_amount_on_terr,
       CASE WHEN p_size = 7 THEN CAST(trans_amount_other_terr * 9 AS DECIMAL(19,2)) ELSE trans_amount_other_terr END,
       {rest} FROM base
"""


LV_SQL = _lv_sql()


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MccGroup: numeric code -> text group, from part sizes."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_size").cast("string").alias("mcc_code"),
                       F.concat(F.lit("G"), (F.col("p_size") % 6).cast("string")).alias("mcc_group")).distinct()


CODE_MAP_SQL = """
SELECT DISTINCT CAST(p_size AS VARCHAR) AS mcc_code, 'G' || CAST(p_size % 6 AS VARCHAR) AS mcc_group FROM part
"""


# ---------------------------------------------------------------- row checks
def _limit_expr():
    first = F.left(F.col("o_orderpriority"), F.lit(1))
    return F.when(first == "5", F.lit(2000001)).otherwise(first.cast("int") * 100000)


def bound_input(spark, sf_dir):
    """Orders with a class limit from their priority ('5-LOW' is the open top class)."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority", "o_totalprice",
                    _limit_expr().alias("income_limit"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("partition_dt"))


BOUND_SQL = """
SELECT o_orderkey, o_orderpriority, o_totalprice,
       CASE WHEN left(o_orderpriority, 1) = '5' THEN 2000001 ELSE CAST(left(o_orderpriority, 1) AS INTEGER) * 100000 END
         AS income_limit,
       strftime(o_orderdate, '%Y-%m-%d') AS partition_dt
FROM orders"""


# The seven income sources that the total-income check weighs, with the share
# given to each in the derived input.
INCOME_SHARES = {"salary": "0.4000", "pension": "0.2000", "stipend": "0.1000", "dividend": "0.1000",
                 "unemployment": "0.1000", "pregnancy": "0.0500", "additional_payment": "0.0500"}


def weighted_input(spark, sf_dir):
    """Line items as income clusters in decimals: seven source averages and shares, and a stated
    average that is their weighted mean, 2 % too high on every 7th order."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(DEC)
    cols = []
    for i, (s, share) in enumerate(INCOME_SHARES.items()):
        cols += [(price + F.lit(i)).cast(DEC).alias(f"avg_{s}_rur"), F.lit(share).cast("decimal(5,4)").alias(f"{s}_ratio")]
    shares = [Decimal(x) for x in INCOME_SHARES.values()]
    # the weighted mean of price, price + 1, ...
    mean = price * F.lit(sum(shares)) + F.lit(sum(i * x for i, x in enumerate(shares)))
    stated = F.when(F.col("l_orderkey") % 7 == 0, mean * F.lit("1.02").cast("decimal(3,2)")).otherwise(mean).cast(DEC)
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("client_cnt_in_cluster"), *cols,
                     stated.alias("avg_all_rur"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("partition_dt"))


def _weighted_sql():
    price = "CAST(l_extendedprice AS DECIMAL(19,2))"
    cols = ", ".join(f"CAST({price} + {i} AS DECIMAL(19,2)) AS avg_{s}_rur, CAST({r} AS DECIMAL(5,4)) AS {s}_ratio"
                     for i, (s, r) in enumerate(INCOME_SHARES.items()))
    mean = " + ".join(f"({price} + {i}) * CAST({r} AS DECIMAL(5,4))" for i, r in enumerate(INCOME_SHARES.values()))
    return f"""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS client_cnt_in_cluster, {cols},
       CAST(CASE WHEN l_orderkey % 7 = 0 THEN ({mean}) * CAST(1.02 AS DECIMAL(3,2)) ELSE {mean} END AS DECIMAL(19,2)) AS avg_all_rur,
       strftime(l_shipdate, '%Y-%m-%d') AS partition_dt
FROM lineitem"""


WEIGHTED_SQL = _weighted_sql()


def product_input(spark, sf_dir):
    """Line items as company rows in decimals: count x mean income against the stated income
    (2 % off on every 7th order) and mean cheque x count against the stated turnover (5 % off on
    every 5th)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                                                  "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    n, price, cheque = F.col("l_quantity").cast("decimal(20,0)"), F.col("p_retailprice").cast(DEC), F.col("l_extendedprice").cast(DEC)
    income, turnover = n * price, cheque * F.col("l_linenumber")
    return j.select("l_orderkey", "l_linenumber", n.alias("cnt_inn"), price.alias("avg_income"),
                    F.when(F.col("l_orderkey") % 7 == 0, income * F.lit("1.02").cast("decimal(3,2)")).otherwise(income)
                     .cast(DEC).alias("SUM_income"),
                    cheque.alias("all_avg_cheque"), F.col("l_linenumber").cast(DEC).alias("all_trans_cnt"),
                    F.when(F.col("l_orderkey") % 5 == 0, turnover * F.lit("0.95").cast("decimal(3,2)")).otherwise(turnover)
                     .cast(DEC).alias("all_trans_amount"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("partition_dt"))


PRODUCT_SQL = """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(20,0)) AS cnt_inn, CAST(p_retailprice AS DECIMAL(19,2)) AS avg_income,
       CAST(CASE WHEN l_orderkey % 7 = 0 THEN CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(19,2)) * CAST(1.02 AS DECIMAL(3,2))
            ELSE CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(19,2)) END AS DECIMAL(19,2)) AS SUM_income,
       CAST(l_extendedprice AS DECIMAL(19,2)) AS all_avg_cheque, CAST(l_linenumber AS DECIMAL(19,2)) AS all_trans_cnt,
       CAST(CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_extendedprice AS DECIMAL(19,2)) * l_linenumber * CAST(0.95 AS DECIMAL(3,2))
            ELSE CAST(l_extendedprice AS DECIMAL(19,2)) * l_linenumber END AS DECIMAL(19,2)) AS all_trans_amount,
       strftime(l_shipdate, '%Y-%m-%d') AS partition_dt
FROM lineitem JOIN part ON l_partkey = p_partkey"""


# Deviations that end in exactly half a hundredth of a percent, on amounts up to 10 ** 18:
# b = a less quantity times a 20,000th of a, so the deviation is quantity * 0.005 %.
def tie_input(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"))
    step = F.element_at(F.array(*[F.lit(f"{10 ** (2 * i + 1)}.05").cast("decimal(20,2)") for i in range(7)]), F.col("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber", "q", (step * 20000).cast("decimal(28,2)").alias("a"),
                     (step * 20000 - step * F.col("q")).cast("decimal(28,2)").alias("b"))


# ---------------------------------------------------------------- incremental load
# Upload = orders with a monthly period; history = what was loaded before 2001.
HISTORY_BEFORE = "2001-01-01"


def upload(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumn("partition_dt", month_period("o_orderdate"))


def history(up):
    return up.where(F.col("o_orderdate") < F.lit(HISTORY_BEFORE).cast("timestamp"))


UPLOAD_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS partition_dt
FROM orders"""

UPLOAD_OUT = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, "
              "o_orderpriority, partition_dt")


# Uploads in the three real layouts: one row an order, each column by its type and place.
def _layout(ddl: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ", 1)) for c in ddl.split(", ")]


def layout_rows(spark, sf_dir, ddl: str):
    o = table(spark, sf_dir, "orders")

    def value(i, name, kind):
        if name == "partition_dt":
            return month_period("o_orderdate")
        if kind == "string":
            return F.concat(F.lit(f'{name}; "'), F.col("o_orderpriority"), F.lit('"'))
        if kind == "decimal(5,4)":
            return ((F.col("o_orderkey") + i) % 10000).cast("decimal(5,0)") * F.lit("0.0001").cast("decimal(4,4)")
        if kind == DEC:
            return F.col("o_totalprice").cast(DEC) + i
        return (F.col("o_custkey") + i) if kind in ("bigint", "decimal(20,0)") else (F.col("o_orderkey") + i) % 100

    return o.select(*[value(i, n, k).cast(k).alias(n) for i, (n, k) in enumerate(_layout(ddl))])


def layout_sql(ddl: str) -> str:
    def value(i, name, kind):
        if name == "partition_dt":
            return "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')"
        if kind == "string":
            return f"""'{name}; "' || o_orderpriority || '"'"""
        if kind == "decimal(5,4)":
            return f"CAST((o_orderkey + {i}) % 10000 AS DOUBLE) / 10000"
        if kind == DEC:
            return f"CAST(CAST(o_totalprice AS DECIMAL(19,2)) + {i} AS DOUBLE)"
        if kind == "decimal(20,0)":
            return f"CAST(o_custkey + {i} AS DOUBLE)"
        return f"CAST(o_custkey + {i} AS BIGINT)" if kind == "bigint" else f"(o_orderkey + {i}) % 100"

    return "SELECT " + ", ".join(f'{value(i, n, k)} AS "{n}"' for i, (n, k) in enumerate(_layout(ddl))) + " FROM orders"


# File names as the landing folder would list them: kind by order key, date from the order,
# '.txt' for pending orders (not an upload).
def titles(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kind = (F.when(F.col("o_orderkey") % 3 == 0, "fl_trans_")
             .when(F.col("o_orderkey") % 3 == 1, "fl_blago_").otherwise("ul_"))
    ext = F.when(F.col("o_orderstatus") == "P", ".txt").otherwise(".csv")
    return o.select(F.concat(kind, F.date_format("o_orderdate", "yyyyMMdd"), ext).alias("title"))


TITLES_SQL = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'fl_trans_' WHEN 1 THEN 'fl_blago_' ELSE 'ul_' END
       || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderstatus = 'P' THEN '.txt' ELSE '.csv' END AS title
FROM orders"""


# ---------------------------------------------------------------- indicators
def _vl(cents_col, kind_col):
    ip = F.expr(f"{cents_col} div 100").cast("string")
    # five decimals: a scaled value has eight of them
    fp = F.concat(F.lpad((F.col(cents_col) % 100).cast("string"), 2, "0"), F.lpad((F.col(cents_col) % 997).cast("string"), 3, "0"))
    txt = F.concat(ip, F.lit(","), fp)
    return (F.when(F.col(kind_col) == 0, F.lit("-"))
             .when(F.col(kind_col) == 1, F.concat(txt, F.lit("%")))
             .when(F.col(kind_col) == 2, F.concat(F.lit("1 "), F.lpad(ip, 3, "0"), F.lit(","), fp))
             .when(F.col(kind_col) == 3, F.lit(None).cast("string"))
             .otherwise(txt))


def value_text(spark, sf_dir):
    """Indicator value text from events.value: '-', 'x,yyyyy%', '1 xxx,yyyyy', null or 'x,yyyyy' by event id."""
    e = table(spark, sf_dir, "events")
    return (e.select("event_id", F.round(F.col("value") * 100).cast("long").alias("__c"),
                     (F.col("event_id") % 10).alias("__k"))
             .select("event_id", _vl("__c", "__k").alias("VL")))


_FIVE = "lpad(CAST(c % 100 AS VARCHAR), 2, '0') || lpad(CAST(c % 997 AS VARCHAR), 3, '0')"
_VL_SQL = f"""CASE event_id % 10 WHEN 0 THEN '-'
   WHEN 1 THEN CAST(c // 100 AS VARCHAR) || ',' || {_FIVE} || '%'
   WHEN 2 THEN '1 ' || lpad(CAST(c // 100 AS VARCHAR), 3, '0') || ',' || {_FIVE}
   WHEN 3 THEN NULL
   ELSE CAST(c // 100 AS VARCHAR) || ',' || {_FIVE} END"""

VALUE_TEXT_SQL = f"""
SELECT event_id, {_VL_SQL} AS VL FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)"""


def _indicator_id():
    return (F.when(F.col("event_type") == "view", 50.0).when(F.col("event_type") == "click", 9950.0)
             .when(F.col("event_type") == "purchase", 53.0).when(F.col("event_type") == "signup", 51.0)
             .otherwise(999.0))


def indicator_pages(spark, sf_dir):
    """Events as API page rows: indicator by event type, flags by user, slice = user % 30,
    category = event % 6 (5 has no name), date = day of the event, value text as above."""
    e, ind = table(spark, sf_dir, "events"), _indicator_id()
    return e.withColumn("__c", F.round(F.col("value") * 100).cast("long")) \
        .withColumn("__k", F.col("event_id") % 10).select(
        F.when(F.col("event_id") % 9 == 0, 1.0).otherwise(2.0).alias("DIM_1293"),
        ind.alias("DIM_1743"),
        F.when(F.col("user_id") % 2 == 0, 1.0).otherwise(0.0).alias("DIM_1294"),
        F.when(F.col("user_id") % 3 == 0, 0.0).otherwise(1.0).alias("DIM_1296"),
        F.lit(22.0).alias("DIM_1297"),
        (F.col("user_id") % 30).cast("double").alias("DIM_369"),
        (F.col("event_id") % 6).cast("double").alias("DIM_1295"),
        F.date_format("ts", "yyyy-MM-dd").alias("DT"),
        _vl("__c", "__k").alias("VL"))


PAGES_SQL = f"""
SELECT CASE WHEN event_id % 9 = 0 THEN 1.0 ELSE 2.0 END AS DIM_1293,
       CASE event_type WHEN 'view' THEN 50.0 WHEN 'click' THEN 9950.0 WHEN 'purchase' THEN 53.0
                       WHEN 'signup' THEN 51.0 ELSE 999.0 END AS DIM_1743,
       CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.0 END AS DIM_1294,
       CASE WHEN user_id % 3 = 0 THEN 0.0 ELSE 1.0 END AS DIM_1296,
       22.0 AS DIM_1297, CAST(user_id % 30 AS DOUBLE) AS DIM_369, CAST(event_id % 6 AS DOUBLE) AS DIM_1295,
       strftime(ts, '%Y-%m-%d') AS DT, {_VL_SQL} AS VL
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)"""


def spoiled_pages(spark, sf_dir):
    """The page rows with text that is no number on slice 7, category 2, and blank text on slice 8."""
    p = indicator_pages(spark, sf_dir)
    vl = (F.when((F.col("DIM_369") == 7) & (F.col("DIM_1295") == 2), "н/д").when(F.col("DIM_369") == 8, " ").otherwise(F.col("VL")))
    return p.withColumn("VL", vl)


SPOILED_SQL = f"""
SELECT * REPLACE (CASE WHEN DIM_369 = 7 AND DIM_1295 = 2 THEN 'н/д' WHEN DIM_369 = 8 THEN ' ' ELSE VL END AS VL) FROM ({PAGES_SQL})"""


PAGE_RECORDS = 1000


def page_bodies(spark, sf_dir):
    """API pages as JSON text, one row each: the records of an indicator (by event type) in the same
    thousand of event ids; page 3 of every 11 is cut off before its end."""
    e = table(spark, sf_dir, "events")
    record = F.to_json(F.struct(F.col("event_id").cast("double").alias("DIM_369"), F.col("event_type").alias("VL")))
    pages = (e.select(_indicator_id().cast("int").alias("indicator"), F.expr(f"event_id div {PAGE_RECORDS}").alias("page"), record.alias("j"))
              .groupBy("indicator", "page").agg(F.array_join(F.collect_list("j"), ",").alias("body")))
    end = F.when(F.col("page") % 11 == 3, F.lit("")).otherwise(F.lit("]"))
    return pages.select("indicator", "page", F.concat(F.lit("["), F.col("body"), end).alias("text"))


def categories(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("double").alias("id"), F.lower("r_name").alias("name"))


def slices(spark, sf_dir):
    """Name tree with the ids 0..24 of all nations: slices 25..29 of the data stay undecoded."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("double").alias("id"), F.lower("n_name").alias("name"))


CATEGORIES_SQL = "SELECT CAST(r_regionkey AS DOUBLE) AS id, lower(r_name) AS name FROM region"
SLICES_SQL = "SELECT CAST(n_nationkey AS DOUBLE) AS id, lower(n_name) AS name FROM nation"


# ---------------------------------------------------------------- cells
def order_cells(spark, sf_dir):
    """Orders as cells: group = priority x status, metrics = total price and customer number."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice",
                    F.col("o_custkey").cast("double").alias("cust"))


ORDER_CELLS_SQL = """
SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, CAST(o_custkey AS DOUBLE) AS cust FROM orders"""

# The five market segments of the customer table, in order.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _cell_id(nationkey):
    return F.concat(F.lit("8a"), F.lpad(F.col(nationkey).cast("string"), 2, "0"),
                    F.repeat(F.lit("f"), (F.col(nationkey) % 3 + 1).cast("int")))


def _cell_id_sql(nationkey):
    return f"'8a' || lpad(CAST({nationkey} AS VARCHAR), 2, '0') || repeat('f', CAST({nationkey} % 3 + 1 AS INTEGER))"


CELL_KEYS = ["CELL_ID", "REGION_ID", "INDUSTRY_ID", "INDUSTRY_NAME", "ANALYTIC_DATE", "area"]


def cell_table_3(spark, sf_dir):
    """т.3 from customers: one row per (cell = nation, segment) with balance and count."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return (j.groupBy(_cell_id("c_nationkey").alias("CELL_ID"), F.col("n_regionkey").alias("REGION_ID"),
                      F.left("c_mktsegment", F.lit(2)).alias("INDUSTRY_ID"),
                      F.col("c_mktsegment").alias("INDUSTRY_NAME"),
                      F.to_date(F.lit("2024-01-01")).alias("ANALYTIC_DATE"), F.lower("n_name").alias("area"))
             .agg(F.sum(F.col("c_acctbal").cast(DEC)).alias("acctbal"), F.count(F.lit(1)).alias("n")))


def cell_table_5(spark, sf_dir):
    """т.5 from suppliers (segment by supplier number); no region or date of its own."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    seg = F.element_at(F.array(*[F.lit(x) for x in SEGMENTS]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return (j.groupBy(_cell_id("s_nationkey").alias("CELL_ID"), F.left(seg, F.lit(2)).alias("INDUSTRY_ID"),
                      seg.alias("INDUSTRY_NAME"), F.lower("n_name").alias("area"))
             .agg(F.sum(F.col("s_acctbal").cast(DEC)).alias("acctbal"), F.count(F.lit(1)).alias("n")))


CELL3_SQL = f"""
SELECT {_cell_id_sql('c_nationkey')} AS CELL_ID, n_regionkey AS REGION_ID, left(c_mktsegment, 2) AS INDUSTRY_ID,
       c_mktsegment AS INDUSTRY_NAME, DATE '2024-01-01' AS ANALYTIC_DATE, lower(n_name) AS area,
       sum(CAST(c_acctbal AS DECIMAL(19,2))) AS acctbal, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""

_SEG_SQL = "(['" + "', '".join(SEGMENTS) + "'])[CAST(s_suppkey % 5 + 1 AS INTEGER)]"

CELL5_SQL = f"""
SELECT {_cell_id_sql('s_nationkey')} AS CELL_ID, left({_SEG_SQL}, 2) AS INDUSTRY_ID, {_SEG_SQL} AS INDUSTRY_NAME,
       lower(n_name) AS area, sum(CAST(s_acctbal AS DECIMAL(19,2))) AS acctbal, count(*) AS n
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""


# т.4: cells by spending bin (null for the largest accounts), with two metrics and a column to drop
def cell_table_4(spark, sf_dir):
    """т.4 from customers: cell = nation, industry = segment, spending bin = account balance class."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    bin_ = F.when(F.col("c_acctbal") < 0, "low").when(F.col("c_acctbal") < 5000, "mid").when(F.col("c_acctbal") < 9000, "high")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", _cell_id("c_nationkey").alias("CELL_ID"), F.col("c_mktsegment").alias("INDUSTRY_NAME"),
        bin_.alias("SPENDING_BIN"), F.lower("n_name").alias("area"), F.col("c_acctbal").alias("spend"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey").cast("double")).alias("visits"),
        F.lit("x").alias("COLOR_ID_old"))


CELL4_SQL = f"""
SELECT c_custkey, {_cell_id_sql('c_nationkey')} AS CELL_ID, c_mktsegment AS INDUSTRY_NAME,
       CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' WHEN c_acctbal < 9000 THEN 'high' END AS SPENDING_BIN,
       lower(n_name) AS area, c_acctbal AS spend, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS DOUBLE) END AS visits
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


# Two cell tables with a third of their rows on one key whose parts are all null
def hot_cells(spark, sf_dir):
    """(orders as cells, suppliers as cells): the other keys meet partly."""
    def keyed(df, number, cell):
        other = number % 3 != 0
        return [F.when(other, F.concat(F.lit("c"), cell.cast("string"))).alias("CELL_ID"), F.when(other, number % 5).alias("REGION_ID"),
                F.lit(None).cast("string").alias("INDUSTRY_ID"), F.when(other, F.lit("x")).alias("INDUSTRY_NAME"),
                F.lit(None).cast("date").alias("ANALYTIC_DATE"), F.lit(None).cast("string").alias("area")]

    o, s = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    a = o.select(*keyed(o, F.col("o_orderkey"), F.col("o_orderkey") % 1999), "o_orderkey", F.col("o_totalprice").alias("total"))
    b = s.select(*keyed(s, F.col("s_suppkey"), F.col("s_suppkey") * 2), "s_suppkey", F.col("s_acctbal").alias("total"))
    return a, b


def _hot_sql(src, number, cell, cols):
    return f"""SELECT CASE WHEN {number} % 3 <> 0 THEN 'c' || CAST({cell} AS VARCHAR) END AS CELL_ID,
       CASE WHEN {number} % 3 <> 0 THEN {number} % 5 END AS REGION_ID, CAST(NULL AS VARCHAR) AS INDUSTRY_ID,
       CASE WHEN {number} % 3 <> 0 THEN 'x' END AS INDUSTRY_NAME, CAST(NULL AS DATE) AS ANALYTIC_DATE, CAST(NULL AS VARCHAR) AS area, {cols} FROM {src}"""


HOT_A_SQL = _hot_sql("orders", "o_orderkey", "o_orderkey % 1999", "o_orderkey, o_totalprice AS total")
HOT_B_SQL = _hot_sql("supplier", "s_suppkey", "s_suppkey * 2", "s_suppkey, s_acctbal AS total")


# Hexagon vertex offsets (lat, lng) in thousandths of a degree.
HEX_OFFSETS = [(2, 0), (1, 2), (-1, 2), (-2, 0), (-1, -2), (1, -2)]


def supplier_rings(spark, sf_dir):
    """Open hexagon outline per supplier: centre from supplier and nation numbers."""
    s = table(spark, sf_dir, "supplier")
    clat = F.lit(55.0) + (F.col("s_suppkey") % 97).cast("double") * F.lit(0.01)
    clng = F.lit(37.0) + F.col("s_nationkey").cast("double") * F.lit(0.01)
    ring = F.array(*[F.struct((clat + F.lit(dy * 0.001)).alias("lat"), (clng + F.lit(dx * 0.001)).alias("lng"))
                     for dy, dx in HEX_OFFSETS])
    return s.select("s_suppkey", "s_nationkey", ring.alias("ring"))


def _ring_sql():
    clat = "(55.0::DOUBLE + CAST(s_suppkey % 97 AS DOUBLE) * 0.01::DOUBLE)"
    clng = "(37.0::DOUBLE + CAST(s_nationkey AS DOUBLE) * 0.01::DOUBLE)"
    vs = ", ".join(f"{{'lat': {clat} + {dy * 0.001!r}::DOUBLE, 'lng': {clng} + {dx * 0.001!r}::DOUBLE}}"
                   for dy, dx in HEX_OFFSETS)
    return f"SELECT s_suppkey, s_nationkey, [{vs}] AS ring FROM supplier"


RINGS_SQL = _ring_sql()


# ---------------------------------------------------------------- report XML
# The code dictionary used by the report queries (its file is not part of
# the reference); 1600/1700/13001/13002 are remapped by the report job itself.
REPORT_DICTIONARY = [
    (1600, "Актив"), (1100, "ВнеОбА"), (1110, "НематАкт"), (1120, "РезИсслед"), (1150, "ОснСр"),
    (1151, "ОснСрНезаверш"), (1170, "ФинВлож"), (1200, "ОбА"), (1210, "Запасы"), (1240, "ФинВлож"),
    (1250, "ДенежнСр"), (1700, "Пассив"), (1300, "КапРез"), (1310, "УставКапитал"), (1370, "НераспПриб"),
    (1400, "ДолгосрОбяз"), (1410, "ЗаемСредств"), (1411, "ЗаемСредствКред"), (1430, "ОценОбяз"),
    (1450, "ПрочОбяз"), (1500, "КраткосрОбяз"), (1510, "ЗаемСредств"), (1520, "КредитЗадолж"),
    (1530, "ДоходБудущ"), (1540, "ОценОбяз"), (1550, "ПрочОбяз"), (2110, "Выруч"), (2120, "СебестПрод"),
    (2330, "ПроцУпл"), (2340, "ПрочДоход"), (2350, "ПрочРасход"), (2400, "ЧистПрибУб"),
    (13001, "МатВнеАкт"), (13002, "НеМатФинАкт"),
]
# Which report line a line item becomes, (section, element, code).  A full
# report's line items take slots line number + 7 * (order key % 3), a simplified one's the
# line number.
FULL_SLOTS = {1: ("ВнеОбА", "НематАкт", 1110), 2: ("ВнеОбА", "РезИсслед", 1120), 3: ("ВнеОбА", "ОснСр", 1150),
              4: ("ВнеОбА", "ФинВлож", 1170), 5: ("ОбА", "Запасы", 1210), 6: ("ОбА", "ФинВлож", 1240),
              7: ("ОбА", "ДенежнСр", 1250), 8: ("КапРез", "УставКапитал", 1310), 9: ("КапРез", "НераспПриб", 1370),
              10: ("ДолгосрОбяз", "ЗаемСредств", 1410), 11: ("ДолгосрОбяз", "ОценОбяз", 1430),
              12: ("ДолгосрОбяз", "ПрочОбяз", 1450), 13: ("КраткосрОбяз", "ЗаемСредств", 1510),
              14: ("КраткосрОбяз", "КредитЗадолж", 1520), 15: ("КраткосрОбяз", "ОценОбяз", 1540),
              16: ("КраткосрОбяз", "ПрочОбяз", 1550), 17: ("КраткосрОбяз", "ДоходБудущ", 1530),
              18: ("ФинРез", "СебестПрод", 2120), 19: ("ФинРез", "ПрочДоход", 2340), 20: ("ФинРез", "ПрочРасход", 2350),
              21: ("ФинРез", "ЧистПрибУб", 2400)}
SIMPLE_SLOTS = {1: ("Актив", "МатВнеАкт", 1301), 2: ("Актив", "НеМатФинАкт", 1302), 3: ("Актив", "Запасы", 1210),
                4: ("Актив", "ДенежнСр", 1250), 5: ("Пассив", "КредитЗадолж", 1520), 6: ("ФинРез", "ПроцУпл", 2330),
                7: ("ФинРез", "ЧистПрибУб", 2400)}
# Every 10th order files a second document (asset total only); every 97th file is cut off,
# every 89th has a foreign id prefix, every 83rd a long comment before its root that names
# another id.


def money_text(c):
    """Amount as fixed two-place text ("17.00"), the way the XML files state sums."""
    return F.col(c).cast("decimal(38,2)").cast("string")


MONEY_SQL = "CAST(CAST({} AS DECIMAL(38,2)) AS VARCHAR)"


def report_dictionary(spark):
    return spark.createDataFrame(REPORT_DICTIONARY, "code int, element string")


def _section(slots: dict, name: str, offset):
    """XML of the line items of one section, which come sorted; line items of other sections give nothing."""
    tags = F.array(*[F.lit(slots[k][1] if k in slots and slots[k][0] == name else None).cast("string") for k in range(max(slots) + 1)])
    second = "СумПред" if name == "ФинРез" else "СумПрдщ"

    def tag(x):
        return F.get(tags, x["ln"] + offset)

    def line(x):
        third = F.lit('"/>') if name == "ФинРез" else F.concat(F.lit('" СумПрдшв="'), x["t"], F.lit('"/>'))
        return F.concat(F.lit("<"), tag(x), F.lit(' СумОтч="'), x["q"], F.lit(f'" {second}="'), x["p"], third)

    return F.array_join(F.transform(F.filter("lines", lambda x: tag(x).isNotNull()), line), "")


def _orders_with_lines(spark, sf_dir, n, deal=None):
    """Orders with their line items as a sorted list, in ``n`` tasks.

    Orders and line items are dealt to as many tasks as are asked for, so that adaptive execution does not
    merge the narrow inputs into a few tasks that then build and parse all the text: by order number, or by the
    columns that ``deal`` (name -> SQL of the order number ``{0}``) gives, which are kept.
    """
    def dealt(df, key, prefix=""):
        return df.select("*", *[F.expr(sql.format(key)).cast("bigint").alias(prefix + name) for name, sql in (deal or {}).items()])

    by, l_by = list(deal or {}), ["__l_" + name for name in deal or {}]
    li = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"),
               "l_orderkey", "__l_")
    grouped = li.repartition(n, *(l_by or ["l_orderkey"])).groupBy(*l_by, "l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("l_linenumber").alias("ln"), money_text("l_quantity").alias("q"),
        money_text("l_extendedprice").alias("p"), money_text("l_tax").alias("t")))).alias("lines"))
    o = dealt(table(spark, sf_dir, "orders"), "o_orderkey").repartition(n, *(by or ["o_orderkey"]))
    same = reduce(and_, [F.col(x) == F.col(y) for x, y in zip([*by, "o_orderkey"], [*l_by, "l_orderkey"])])
    return o.join(grouped, same, "left") \
            .withColumn("lines", F.coalesce("lines", F.array().cast("array<struct<ln:int,q:string,p:string,t:string>>")))


def _document_text():
    """The documents that an order files, as XML text: pending orders a simplified report, others a
    full one; line items become lines of every section (quantity, price, tax as the three
    periods, or quantity and price in the results)."""
    key, simple = F.col("o_orderkey"), F.col("o_orderstatus") == "P"
    total, cust = money_text("o_totalprice"), F.col("o_custkey").cast("string")
    offset = (key % 3 * 7).cast("int")

    def full(name):
        return _section(FULL_SLOTS, name, offset)

    def short(name):
        return _section(SIMPLE_SLOTS, name, F.lit(0))

    sales = F.concat(F.lit('<Выруч СумОтч="'), total, F.lit('" СумПред="'), cust, F.lit('"/>'))
    asset = F.concat(F.lit('<Актив СумОтч="'), total, F.lit('">'))
    liability = F.concat(F.lit('<Пассив СумОтч="'), total, F.lit('">'))
    full_body = F.concat(
        F.lit("<Баланс>"), asset, F.lit("<ВнеОбА>"), full("ВнеОбА"), F.lit("</ВнеОбА><ОбА>"), full("ОбА"),
        F.lit("</ОбА></Актив>"), liability, F.lit("<КапРез>"), full("КапРез"), F.lit("</КапРез><ДолгосрОбяз>"),
        full("ДолгосрОбяз"), F.lit("</ДолгосрОбяз><КраткосрОбяз>"), full("КраткосрОбяз"),
        F.lit("</КраткосрОбяз></Пассив></Баланс><ФинРез>"), sales, full("ФинРез"), F.lit("</ФинРез>"))
    short_body = F.concat(F.lit("<Баланс>"), asset, short("Актив"), F.lit("</Актив>"), liability, short("Пассив"),
                          F.lit("</Пассив></Баланс><ФинРез>"), sales, short("ФинРез"), F.lit("</ФинРез>"))
    head = F.concat(
        F.lit('<Документ КНД="'), F.when(simple, F.lit("0710096")).otherwise(F.lit("0710099")),
        F.lit('" ОтчетГод="'), F.date_format("o_orderdate", "yyyy"), F.lit('" ДатаДок="'),
        F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit('"><СвНП ОКВЭД2="62.01"><НПЮЛ ИННЮЛ="'), F.lpad(cust, 10, "0"),
        F.lit('" НаимОрг="Org; '), cust, F.lit('"/></СвНП>'))
    again = F.when(key % 10 == 0, F.concat(head, F.lit("<Баланс>"), asset, F.lit("</Актив></Баланс></Документ>"))).otherwise("")
    return F.concat(head, F.when(simple, short_body).otherwise(full_body), F.lit("</Документ>"), again)


def _documents(spark, sf_dir):
    """Each order's documents (``_document_text``), with its number and whether it files a simplified report."""
    j = _orders_with_lines(spark, sf_dir, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return j.select("o_orderkey", (F.col("o_orderstatus") == "P").alias("simple"), _document_text().alias("documents"))


def report_files(spark, sf_dir):
    """One XML report per order (``_documents``): some broken, of a foreign kind, or with a long comment."""
    key = F.col("o_orderkey")
    prefix = F.when(key % 89 == 0, F.lit("NO_USN_")).when(F.col("simple"), F.lit("NO_BOUPR_")).otherwise(F.lit("NO_BUHOT_"))
    comment = F.when(key % 83 == 0, F.concat(F.lit('<!-- ИдФайл="NO_OTHER_0" '), F.repeat(F.lit("long "), 1500), F.lit("-->"))).otherwise("")
    xml = F.concat(comment, F.lit('<Файл ИдФайл="'), prefix, key.cast("string"), F.lit('">'), F.col("documents"),
                   F.when(key % 97 == 0, F.lit("<Докум")).otherwise(F.lit("</Файл>")))
    return _documents(spark, sf_dir).select(F.concat(F.lit("report_"), key.cast("string"), F.lit(".xml")).alias("file_name"), xml.alias("content"))


PACK_SQL = "CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 8 END"


#: order keys of which one file of a pack holds the documents, and orders that a writing task takes, about
PACK_KEYS, PACK_TASK_ORDERS = 50_000, 100_000


def write_report_packs(spark, sf_dir, path, keys=PACK_KEYS):
    """The documents of all orders in few files, by kind and pack number; one pack of each kind holds half
    of the documents, and a comment before its root names another id.

    A pack is a gzip file for every ``keys`` order keys, each a whole XML file with the pack's id, and files are
    dealt to tasks by the number of orders, so neither a file nor a task grows with the table.  Orders and
    line items are dealt by file before they meet, and a file's text is made by the task that writes it: it
    is never shuffled.
    """
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, sf_dir, "orders").count() // PACK_TASK_ORDERS))
    deal = {"slice": f"coalesce({{0}} div {keys}, 0)", "number": PACK_SQL.replace("o_orderkey", "{0}")}
    j = _orders_with_lines(spark, sf_dir, n, deal)
    kind = F.when(F.col("o_orderstatus") == "P", F.lit("NO_BOUPR_")).otherwise(F.lit("NO_BUHOT_"))
    pack = F.concat(kind, F.col("number").cast("string"))
    in_file = Window.partitionBy("pack", *deal).orderBy("o_orderkey")
    rows = j.withColumn("pack", F.concat(pack, F.lit("-"), F.col("slice").cast("string"))).select(
        "*", F.lag(F.lit(1)).over(in_file).isNull().alias("top"), F.lead(F.lit(1)).over(in_file).isNull().alias("end"))
    comment = F.when(F.col("number") == 0, F.lit('<!-- <Файл ИдФайл="NO_OTHER_0"> > -->\n')).otherwise("")
    top = F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?>\n'), comment, F.lit('<Файл ИдФайл="'), pack, F.lit('">\n'))
    text = F.concat(F.when(F.col("top"), F.coalesce(top, F.lit("\n"))).otherwise(""), F.coalesce(_document_text(), F.lit("")),
                    F.when(F.col("end"), F.lit("\n</Файл>")).otherwise(""))
    # the join's keys hold the order number besides the columns that both sides are dealt by already
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        rows.select("pack", text.alias("documents")).write.option("compression", "gzip").partitionBy("pack").text(path)
