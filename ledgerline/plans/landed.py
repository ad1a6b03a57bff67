"""Registered queries that write files into the shared folder and read them back.

Each runs a sink and the source that takes its files in, over whole tables; the oracle text
states what has to stand in the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import cells as C
from ..operators import increment as INC
from ..operators import indicators as IND
from ..operators import quality as Q
from ..operators import reports as REP
from ..session import checkpoint_path
from ..sinks import writers as W
from ..sources import files as FILES
from ..sources import pages as PAGES
from . import catalog as CAT
from . import inputs as I
from .catalog import comparable, register

RUN_DATE = "20240301"


def folder(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------ SNK-1: the indicator file, line by line
def _field(x):
    return f"CASE WHEN contains({x}, ',') OR contains({x}, '\"') THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE coalesce({x}, '') END"


@register("indicator_file", CAT._indicators_sql() + f"""
SELECT CAST(0 AS BIGINT) AS line_no, '{",".join(IND.OUT_COLS)}' AS line
UNION ALL
SELECT row_number() OVER (ORDER BY {CAT._EXPORT_ORDER}) AS line_no, {" || ',' || ".join(_field(c) for c in (
    "DIM_1", "DIM_2", "DIM_3", "DIM_4", "DIM_5", "strftime(TRY_CAST(date AS DATE), '%m.%d.%Y')",
    "replace(CAST(val AS VARCHAR), '.', ',')"))} AS line FROM m""")
def indicator_file(spark, sf):
    """SNK-1 / SRT-1: the dated cp1251 file and its lines with their numbers."""
    path = W.dated(folder(spark, "indicators"), "indicators", RUN_DATE)
    W.write_indicator_csv(IND.indicator_export(CAT._build_indicators(spark, sf)), path)
    return FILES.read_lines(spark, path, "windows-1251")


# ------------------------------------------------------------ SNK-2, SNK-3, SRC-8: two header lines
@register("report_files_fused", CAT.ORACLE["fuse_reports"])
def report_files_fused(spark, sf):
    """Full and simplified reports in dated files of two header lines, read back and fused by name."""
    lines = REP.dictionary_lines(I.report_dictionary(spark))
    parsed = CAT._parsed_reports(spark, sf, lines)
    kinds = (REP.FULL, REP.SIMPLE)
    paths = W.write_wide_reports({k: REP.flatten_reports(parsed, lines, k) for k in kinds}, folder(spark, "reports"), RUN_DATE,
                                 headers={k: REP.header_lines(lines, k) for k in kinds})
    return REP.fuse_reports(*[FILES.read_two_line_header(spark, paths[k]) for k in kinds])


# ------------------------------------------------------------ D-3: values counted beside the plan
_STATE = f"""CASE WHEN VL IS NULL OR trim(VL) = '' OR VL = '-' THEN 'empty' WHEN {CAT._DIGITS} IS NOT NULL THEN 'good' ELSE 'unreadable' END"""
_SPEC_SQL = " UNION ALL ".join(f"SELECT {n} AS ordinal, {float(i)} AS id, '{flag}' AS flag_col, '{label}' AS label"
                               for n, (i, flag, _, label) in enumerate(IND.INDICATOR_SPEC))


@register("indicator_value_counts", f"""
WITH pg AS ({I.SPOILED_SQL}), spec AS ({_SPEC_SQL}),
v AS (SELECT ordinal, {_STATE} AS state FROM pg JOIN spec ON DIM_1743 = id
      WHERE DIM_1293 = 2 AND DIM_1297 = 22 AND (CASE WHEN flag_col = 'DIM_1294' THEN DIM_1294 ELSE DIM_1296 END) = 1)
SELECT spec.ordinal, label AS DIM_1, count(*) FILTER (WHERE state = 'good') AS good, count(*) FILTER (WHERE state = 'empty') AS empty,
       count(*) FILTER (WHERE state = 'unreadable') AS unreadable
FROM spec LEFT JOIN v ON v.ordinal = spec.ordinal GROUP BY ALL""")
def indicator_value_counts(spark, sf):
    """Good, empty and unreadable values of each indicator, observed while its file is written."""
    counts = Observation("values")
    ind = IND.build_indicators(I.spoiled_pages(spark, sf), I.categories(spark, sf), I.slices(spark, sf), IND.spec_frame(spark), counts)
    W.write_indicator_csv(IND.indicator_export(ind), W.dated(folder(spark, "indicators"), "indicators", RUN_DATE))
    return IND.value_counts(spark, counts, {n: label for n, (_, _, _, label) in enumerate(IND.INDICATOR_SPEC)})


# ------------------------------------------------------------ SRC-1, AGG-9: landed pages, some cut off, some absent
_PAGE_ID = "CAST(CASE event_type WHEN 'view' THEN 50 WHEN 'click' THEN 9950 WHEN 'purchase' THEN 53 WHEN 'signup' THEN 51 ELSE 999 END AS INTEGER)"


@register("landed_pages", f"""
WITH e AS (SELECT {_PAGE_ID} AS indicator, event_id // {I.PAGE_RECORDS} AS page FROM events),
p AS (SELECT indicator, page, page % 11 = 3 AS cut, count(*) AS n FROM e GROUP BY ALL),
g AS (SELECT indicator, count(*) AS n_pages, count(*) FILTER (WHERE cut) AS failed, sum(n) FILTER (WHERE NOT cut) AS rec,
             max(page) + 3 AS expected FROM p GROUP BY 1 UNION ALL SELECT -1, 0, 0, 0, 4)
SELECT indicator, CAST(n_pages AS BIGINT) AS n_pages, CAST(failed AS BIGINT) AS failed_pages,
       CAST(expected - n_pages AS BIGINT) AS missing_pages, CAST(coalesce(rec, 0) AS BIGINT) AS records FROM g""")
def landed_pages(spark, sf):
    """Pages written as JSON files and read back: landed, unreadable and missing ones of each
    indicator.  The service states two pages more than there are, and four of an indicator that has none."""
    path = folder(spark, "pages")
    bodies = I.page_bodies(spark, sf)
    bodies.write.partitionBy("indicator", "page").text(path)
    stated = bodies.groupBy("indicator").agg((F.max("page") + 3).alias("n_expected"))
    stated = stated.unionAll(spark.createDataFrame([(-1, 4)], "indicator int, n_expected bigint"))
    pages = PAGES.read_pages(spark, path, glob="*.txt")
    return IND.failed_pages(pages, "indicator", "page", F.col(PAGES.CORRUPT).isNotNull(), "VL", stated)


# ------------------------------------------------------------ PRJ-7: columns without values, by the footers
@register("drop_null_file_columns", CAT.ORACLE["drop_null_columns"])
def drop_null_file_columns(spark, sf):
    """Orders written with an empty column; the files' statistics say which one it is."""
    path = folder(spark, "orders")
    I.table(spark, sf, "orders").withColumn("o_note", F.lit(None).cast("string")).write.parquet(path)
    return comparable(IND.drop_null_file_columns(spark, path))


# ------------------------------------------------------------ SRC-3: files of many documents
@register("report_packs", f"({CAT._report_sql('full', I.PACK_SQL, 'true')})\nUNION ALL BY NAME\n({CAT._report_sql('simplified', I.PACK_SQL, 'true')})")
def report_packs(spark, sf):
    """All reports in a few large files, cut into documents by the reader; the file's id joined by file."""
    path = folder(spark, "packs")
    I.write_report_packs(spark, sf, path)
    lines = REP.dictionary_lines(I.report_dictionary(spark))
    documents = FILES.read_report_documents(spark, path, REP.document_schema(lines))
    return REP.flatten_fused(REP.route_documents(documents, FILES.read_report_heads(spark, path)), lines)


# ------------------------------------------------------------ SRC-6, SRC-7, CMP-9: the newest upload of a folder, by its layout
def _newest_upload(spark, sf, kind):
    """Two dated uploads of a kind and a note in one folder; the newest is picked and read by its layout."""
    root = folder(spark, "uploads")
    rows = I.layout_rows(spark, sf, FILES.LAYOUTS[kind])
    name = "ul" if kind == "ul" else kind
    for date, part in (("20240201", rows.where(F.col("partition_dt") < "1997-01-01")), (RUN_DATE, rows)):
        part.write.option("header", True).option("sep", ";").option("quote", '"').option("escape", '"').csv(f"{root}/{name}_{date}.csv")
    spark.range(1).select(F.lit("read me")).write.text(f"{root}/{name}_20990101.txt")
    pick = INC.latest_file(FILES.list_outputs(spark, root)).first()
    return comparable(FILES.read_upload(spark, f"{root}/{pick['title']}", pick["kind"]))


@register("upload_fl_trans", I.layout_sql(FILES.FL_TRANS_DDL))
def upload_fl_trans(spark, sf):
    return _newest_upload(spark, sf, "fl_trans")


@register("upload_fl_blago", I.layout_sql(FILES.FL_BLAGO_DDL))
def upload_fl_blago(spark, sf):
    return _newest_upload(spark, sf, "fl_blago")


@register("upload_ul", I.layout_sql(FILES.UL_DDL))
def upload_ul(spark, sf):
    return _newest_upload(spark, sf, "ul")


# ------------------------------------------------------------ FLT-4, JON-8: a history by period
@register("history_period", CAT.ORACLE["reconcile_period"])
def history_period(spark, sf):
    """The level check of one period over a history in period folders: the others are not read."""
    path, levels = folder(spark, "levels"), I.level_table(spark, sf)
    INC.write_history(levels, path)
    return comparable(Q.reconcile_levels(INC.read_history(spark, path, levels.schema), I.LV_METRICS, "total", "group", tol=5.0,
                                         period=CAT.PERIOD))


@register("history_actual", CAT._with(("f", I.TITLES_SQL), ("c", CAT._CAT), ("u", I.UPLOAD_SQL), ("a", f"""
SELECT {CAT._ACT} AS actdate FROM c ORDER BY file_date DESC, title DESC LIMIT 1""")) + """
SELECT partition_dt, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(19,2))) AS DOUBLE) AS total
FROM u WHERE partition_dt = (SELECT actdate FROM a) GROUP BY ALL""")
def history_actual(spark, sf):
    """The period that the newest file reports, out of the history: its folder is found while the query runs."""
    path, up = folder(spark, "history"), I.upload(spark, sf)
    INC.write_history(up, path)
    actual = INC.latest_file(I.titles(spark, sf)).select(F.col("actdate").alias("partition_dt"))
    rows = INC.read_history(spark, path, up.schema).join(actual, "partition_dt")
    return comparable(rows.groupBy("partition_dt", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(I.DEC)).alias("total")))


@register("listed_new_periods", CAT.ORACLE["new_periods"])
def listed_new_periods(spark, sf):
    """Periods of the upload that the history's folder does not list."""
    path, up = folder(spark, "history"), I.upload(spark, sf)
    INC.write_history(I.history(up), path)
    return INC.new_periods(up, INC.listed_periods(spark, path))


@register("append_history", CAT._with(("u", I.UPLOAD_SQL)) + f"SELECT {I.UPLOAD_OUT} FROM u")
def append_history(spark, sf):
    """CMP-16 / SNK-4: a history that is older than its entries, the upload appended, and appended again."""
    path, up = folder(spark, "history"), I.upload(spark, sf)
    INC.write_history(I.history(up), path)
    for _ in range(2):
        INC.append_new(spark, up, path)
    return comparable(INC.read_history(spark, path, up.schema))


# ------------------------------------------------------------ SRC-2, SRC-4, SRC-5: trees, dictionary and cell tables as files
@register("dimension_files", CAT.ORACLE["parse_name_tree"])
def dimension_files(spark, sf):
    """Name trees as JSON files, one for each region."""
    path, n = folder(spark, "trees"), I.table(spark, sf, "nation")
    trees = n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(
        F.col("n_nationkey").cast("double").alias("id"), F.col("n_name").alias("name")))).alias("text"))
    trees.write.partitionBy("n_regionkey").text(path)
    return PAGES.read_dimension(spark, path)


@register("dictionary_file", CAT.ORACLE["report_header"])
def dictionary_file(spark, sf):
    """The code dictionary as a file of ``code;element`` lines, and the header that follows from it."""
    path = folder(spark, "dictionary")
    CAT._part_dictionary(spark, sf).write.option("sep", ";").csv(path)
    return REP.report_header(FILES.read_code_dictionary(spark, path), REP.FULL)


@register("cell_table_files", CAT.ORACLE["merge_cells"])
def cell_table_files(spark, sf):
    """One cell table as Parquet, the other as CSV with a header, merged."""
    a, b = folder(spark, "cells"), folder(spark, "cells")
    t3, t5 = I.cell_table_3(spark, sf), I.cell_table_5(spark, sf)
    t3.write.parquet(a)
    t5.write.option("header", True).option("sep", ";").csv(b)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t5.schema)
    t3, t5 = FILES.read_table(spark, a), FILES.read_table(spark, b, "csv", ddl)
    t5 = C.with_scalars_from(t5, t3, ["REGION_ID", "ANALYTIC_DATE"])
    return comparable(C.merge_cells(t3, t5.select(*I.CELL_KEYS, "acctbal", "n"), I.CELL_KEYS))


# ------------------------------------------------------------ SRC-8: lines that end in the separator
@register("headerless_file", CAT.ORACLE["parse_headerless_lines"])
def headerless_file(spark, sf):
    """A text table without header, every line ending in the separator, as a file."""
    path, p = folder(spark, "headerless"), I.table(spark, sf, "part")
    p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(";"), F.col("p_brand"), F.lit(";"))).write.text(path)
    return FILES.read_headerless(spark, path).toDF("a", "b")
