"""Files written and read back: order, headers, encodings, blocks, statistics, large reports."""
from __future__ import annotations

import datetime as dt
import glob
import gzip
import math
import os
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.operators import indicators as IND
from ledgerline.operators import ordering as O
from ledgerline.operators import reports as REP
from ledgerline.plans import catalog as CAT
from ledgerline.plans import inputs as I
from ledgerline.plans import landed as LANDED
from ledgerline.sinks import writers as W
from ledgerline.sources import files as FILES
from tests.conftest import rows
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


def fresh(name):
    return tempfile.mkdtemp(prefix="ledgerline-landed-") + "/" + name


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ order
def test_positions_follow_the_order_over_ranges(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x").alias("__file"), F.lit(1).alias("__row"))
    got = O.with_position(df, "v", out="pos")
    assert got.columns == ["v", "__file", "__row", "pos"]
    assert all(r["pos"] == r["v"] + 1 for r in got.collect()) and got.count() == 5000
    assert plan_of(got).split("== Initial Plan ==")[0].count("Window [sum(n#") == 1  # over the ranges' counts


def test_positions_of_nulls_ties_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (2, 3), (None, 4)], "k int, v int")
    got = {r["v"]: r["position"] for r in O.with_position(df, F.col("k").desc_nulls_last(), "v").collect()}
    assert got == {2: 1, 3: 2, 1: 3, 4: 4}
    assert O.with_position(df.limit(0), "k").collect() == []


def test_lines_are_numbered_over_blocks_and_parts(spark):
    path = fresh("lines")
    spark.range(0, 3000, 1, 5).select(F.format_string("line %05d", "id")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")  # several blocks a file, several files a task
    try:
        got = FILES.read_lines(spark, path)
        assert sorted((r["line_no"], r["line"]) for r in got.collect()) == [(i, f"line {i:05d}") for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ------------------------------------------------------------------ SNK-1, SNK-2, SRC-8
def test_parts_make_the_one_file(spark):
    """Concatenated in part order the parts are the file: header first, body in order, quotes doubled."""
    df = spark.range(0, 200, 1, 6).select(F.format_string("%03d", "id").alias("a"), F.when(F.col("id") == 7, 'x,"й"')
                                          .when(F.col("id") == 8, " padded ").when(F.col("id") == 9, "").alias("b"))
    path = fresh("file")
    W.write_indicator_csv(df.orderBy(F.desc("a")), path)
    text = b"".join(open(p, "rb").read() for p in sorted(glob.glob(path + "/part-*"))).decode("cp1251")
    body = {7: '007,"x,""й"""', 8: "008, padded ", 9: "009,"}
    assert text.split("\n") == ["a,b"] + [body.get(i, f"{i:03d},") for i in range(199, -1, -1)] + [""]


def test_two_header_lines_and_back(spark):
    df = spark.createDataFrame([("NO_1", "1", None, "a;b"), ("NO_2", None, None, 'q"')],
                               "`ИдФайл__xml` string, `Актив__СумОтч` string, `Актив_1__СумПрдщ` string, `Орг__Имя` string")
    path = fresh("report")
    W.write_report_csv(df, path, closing=True, header=[["ИдФайл", "Актив", "Актив", "Орг"], ["xml", "СумОтч", "СумПрдщ", "Имя"]])
    lines = sorted((r["line_no"], r["line"]) for r in FILES.read_lines(spark, path).collect())
    assert [x for _, x in lines][:2] == ["ИдФайл;Актив;Актив;Орг;", "xml;СумОтч;СумПрдщ;Имя;"]
    back = FILES.read_two_line_header(spark, path)
    assert back.columns == df.columns and rows(back) == rows(df)
    W.write_report_csv(df, path)  # the columns' own names
    assert FILES.read_two_line_header(spark, path).columns == df.columns
    assert plan_of(back).count("FileScan csv") == 1


def test_header_of_one_plain_file_and_no_header(spark):
    path = fresh("t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("A;A;B\nx;y;\n1;2;3\nx;y;z\n")
    t = FILES.read_two_line_header(spark, path)
    assert t.columns == ["A__x", "A_1__y", "B"] and rows(t) == [("1", "2", "3"), ("x", "y", "z")]
    with open(path, "w") as f:
        f.write("A;B\nx\n")
    with pytest.raises(ValueError):
        FILES.read_two_line_header(spark, path)


# ------------------------------------------------------------------ D-3
def test_values_are_counted_beside_the_plan(spark):
    pages = spark.createDataFrame(
        [(2.0, 50.0, 1.0, 0.0, 22.0, 1.0, 1.0, "2024-01-01", v) for v in ("1,5", "-", None, " ", "n/a", "7 %", "1e", "12")]
        + [(1.0, 50.0, 1.0, 0.0, 22.0, 1.0, 1.0, "2024-01-01", "n/a")], "DIM_1293 double, DIM_1743 double, DIM_1294 double, "
        "DIM_1296 double, DIM_1297 double, DIM_369 double, DIM_1295 double, DT string, VL string")
    names = spark.createDataFrame([(1.0, "one")], "id double, name string")
    counts = Observation("values")
    ind = IND.build_indicators(pages, names, names, IND.spec_frame(spark), counts)
    assert [r["val"] for r in ind.collect()] == [1.5]
    got = {r["ordinal"]: (r["good"], r["empty"], r["unreadable"]) for r in IND.value_counts(spark, counts, {0: "a", 1: "b"}).collect()}
    assert got == {0: (3, 3, 2), 1: (0, 0, 0)}
    observed = IND.build_indicators(I.indicator_pages(spark, SF), names, names, IND.spec_frame(spark), Observation("v2"))
    plan = plan_of(observed)
    assert plan.count("CollectMetrics") == 1 and plan.count("FileScan parquet") == 1


# ------------------------------------------------------------------ PRJ-7
def test_columns_without_values_by_footers_or_by_a_scan(spark, monkeypatch):
    path = fresh("t")
    df = spark.range(20).select("id", F.lit(None).cast("string").alias("none"), F.when(F.col("id") == 3, 1.5).alias("one"),
                                F.array("id").alias("arr"), F.lit(None).cast("array<int>").alias("no_arr"), F.lit(None).cast("date").alias("a.b"))
    df.write.parquet(path)
    settings = {k: spark.conf.get(k, None) for k in IND.FOOTER_CONF}
    assert IND.drop_null_file_columns(spark, path).columns == ["id", "one", "arr"]
    counts = IND.footer_counts(spark, path, ["id", "none", "one"])
    assert "PushedAggregation: [COUNT(id), COUNT(none), COUNT(one)]" in plan_of(counts)
    assert {k: spark.conf.get(k, None) for k in IND.FOOTER_CONF} == settings
    bare = fresh("bare")  # files without statistics
    df.write.option("parquet.column.statistics.enabled", "false").parquet(bare)
    assert IND.drop_null_file_columns(spark, bare).columns == ["id", "one", "arr"]


# ------------------------------------------------------------------ FLT-4: only the period's files
def test_static_and_dynamic_period_pruning(spark):
    checked = LANDED.history_period(spark, SF)
    assert f"= {CAT.PERIOD})" in plan_of(checked).split("PartitionFilters:")[1].split("]")[0]
    actual = LANDED.history_actual(spark, SF)
    plan = plan_of(actual)
    assert "dynamicpruning" in plan.lower()
    read = actual._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" in read.lower()


def test_outputs_of_a_folder_are_listed(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-in-")
    spark.range(3).write.csv(root + "/fl_trans_20240101.csv")
    with open(root + "/ul_20240201.csv", "w") as f:
        f.write("x\n")
    assert rows(FILES.list_outputs(spark, root)) == [("fl_trans_20240101.csv",), ("ul_20240201.csv",)]


# ------------------------------------------------------------------ SRC-3: files of many documents
def _pack(name, docs, prolog="", end="</Файл>"):
    return f'{prolog}<Файл ИдФайл="{name}">' + "".join(docs) + end


def _doc(year):
    return (f'<Документ КНД="0710099" ОтчетГод="{year}" ДатаДок="01.02.{year}"><СвНП ОКВЭД2="62.01"><НПЮЛ ИННЮЛ="1" НаимОрг="О&gt;"/></СвНП>'
            f'<Баланс><Актив СумОтч="{year}.00"/></Баланс></Документ>')


def test_documents_are_cut_out_of_files(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-xml-")
    files = {"a.xml": _pack("NO_BUHOT_a", [_doc(y) for y in range(2000, 2050)], '<?xml version="1.0" encoding="UTF-8"?>\n<!-- <Файл ИдФайл="NO_X"> -->\n'),
             "b.xml": _pack("NO_BUHOT_b", [_doc(1990), _doc(1991)], "\n  "),
             "cut.xml": _pack("NO_BUHOT_c", [_doc(1980), "<Документ КНД="], end=""),
             "foreign.xml": _pack("NO_USN_d", [_doc(1970)]), "empty.xml": _pack("NO_BUHOT_e", [])}
    for name, text in files.items():
        with open(f"{root}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    lines = I.REPORT_DICTIONARY
    docs = FILES.read_report_documents(spark, root, REP.document_schema(lines))
    parsed = REP.route_documents(docs, FILES.read_report_heads(spark, root))
    assert rows(parsed.select("file_name", "doc_no")) == [("a.xml", i) for i in range(50)] + [("b.xml", 0), ("b.xml", 1), ("cut.xml", 0)]
    wide = REP.flatten_reports(parsed, lines, REP.FULL)
    got = sorted((r["ИдФайл__xml"], r["КНД_1__ОтчетГод"], r["Актив__СумОтч"], r["НПЮЛ_1__НаимОрг"]) for r in wide.collect())
    assert got == sorted([("NO_BUHOT_a", str(y), f"{y}.00", "О>") for y in range(2000, 2050)]
                         + [("NO_BUHOT_b", str(y), f"{y}.00", "О>") for y in (1990, 1991)] + [("NO_BUHOT_c", "1980", "1980.00", "О>")])
    by_order = parsed.where("file_name = 'a.xml'").select("doc_no", F.col("doc.`_ОтчетГод`").alias("y")).collect()
    assert all(int(r["y"]) == 2000 + r["doc_no"] for r in by_order)


def test_charset_of_large_files(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-xml-")
    with open(f"{root}/w.xml", "wb") as f:
        f.write(_pack("NO_BUHOT_w", [_doc(2001)], '<?xml version="1.0" encoding="windows-1251"?>').encode("cp1251"))
    docs = FILES.read_report_documents(spark, root, REP.document_schema(I.REPORT_DICTIONARY), "windows-1251")
    parsed = REP.route_documents(docs, FILES.read_report_heads(spark, root, "windows-1251"))
    assert parsed.select("report.`_ИдФайл`").first()[0] == "NO_BUHOT_w"
    with pytest.raises(Exception, match="declares the charset"):
        FILES.read_report_heads(spark, root).collect()


def test_no_task_reads_a_pack_as_one_row(spark):
    """The half of all documents that one file holds comes as rows of the size of a document."""
    path = fresh("packs")
    I.write_report_packs(spark, SF, path)
    largest = max(os.path.getsize(f) for f in glob.glob(path + "/*/part-*"))
    heads = FILES.read_report_heads(spark, path).agg(F.max(F.length("head"))).first()[0]
    docs = FILES.read_report_documents(spark, path, REP.document_schema(I.REPORT_DICTIONARY))
    longest = docs.agg(F.max(F.length(F.to_json("doc")))).first()[0]
    assert heads < 300 and longest < largest / 20


# ------------------------------------------------------------------ sessions without Java's charsets
@pytest.mark.parametrize("name", ["indicator_file", "indicator_value_counts"])
def test_cp1251_needs_no_session_setting(spark, name):
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)
    assert got["status"] == "ok", got


def test_packs_are_cut_into_files_of_bounded_size(spark):
    """Smaller slices of the order keys give more and smaller files, and the same report rows."""
    lines, got = I.REPORT_DICTIONARY, []
    for keys in (I.PACK_KEYS, 200):
        path = fresh("packs")
        I.write_report_packs(spark, SF, path, keys)
        docs = FILES.read_report_documents(spark, path, REP.document_schema(lines))
        wide = REP.flatten_fused(REP.route_documents(docs, FILES.read_report_heads(spark, path)), lines)
        got.append((max(os.path.getsize(f) for f in glob.glob(path + "/*/part-*")), rows(wide)))
    assert got[1][0] * 2 < got[0][0] and got[1][1] == got[0][1] and got[0][1]


def shuffled(spark):
    """Bytes that the session has written for shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_packs_take_less_disk_than_their_text(spark, monkeypatch):
    """The packs are compressed, and neither their text nor the documents cut out of them are shuffled, also
    where no side of a join is small enough for Spark to broadcast it unasked."""
    path, key = fresh("packs"), "spark.sql.autoBroadcastJoinThreshold"
    monkeypatch.setattr(LANDED, "folder", lambda spark, name: path)
    before, wrote = spark.conf.get(key), shuffled(spark)
    spark.conf.set(key, "-1")
    try:
        df = LANDED.report_packs(spark, SF)
        df.write.format("noop").mode("overwrite").save()
        assert "SortMergeJoin" not in plan_of(df)
    finally:
        spark.conf.set(key, before)
    files = glob.glob(path + "/*/part-*")
    text = sum(len(gzip.open(f).read() if f.endswith(".gz") else open(f, "rb").read()) for f in files)
    assert sum(map(os.path.getsize, files)) + shuffled(spark) - wrote < text / 2


def test_packs_of_odd_orders(spark):
    """Negative, repeated and absent order keys, orders without lines, lines without an order, absent values."""
    sf = tempfile.mkdtemp(prefix="ledgerline-odd-")
    day = dt.datetime(1997, 5, 6)
    orders = [(k, 5, "P" if k % 3 else "O", 10.5 + k, day, "1-URGENT") for k in range(-20, 40)]
    orders += [(4, 6, "O", 1.0, day, "x"), (4, 6, "O", 1.0, day, "x"), (None, 7, "P", 2.0, day, "x"), (None, 7, "O", 2.0, day, "x"),
               (70_000, 8, None, 3.0, day, "x"), (16, 9, "O", None, day, "x"), (-16, 9, "O", None, day, "x"), (100_008, 9, "O", None, day, "x")]
    lines = [(k, n, 2.0, 100.25 * n, 0.05) for k in [*range(-20, 30), 70_000, 999, None] for n in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").coalesce(1).write.parquet(sf + "/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double"
                          ).coalesce(1).write.parquet(sf + "/lineitem.parquet")
    wide = LANDED.report_packs(spark, sf)
    price = F.coalesce(F.col("`Актив__СумОтч`"), F.lit("none"))
    got = sorted((r[0], r[1], r[2]) for r in wide.select("`ИдФайл__xml`", "`НПЮЛ__ИННЮЛ`", price).collect())

    def pack(k, status):
        return f"NO_{'BOUPR' if status == 'P' else 'BUHOT'}_{0 if k % 2 == 0 else math.fmod(k, 8):.0f}"

    whole = [(pack(k, s), f"{c:010d}", f"{t:.2f}") for k, c, s, t, *_ in orders if k is not None and t is not None
             for _ in range(1 + (k % 10 == 0))]
    assert got == sorted(whole)
    paid = F.col("`Запасы__СумОтч`")
    assert wide.where(paid.isNotNull()).count() > 10
