"""End-to-end runs of the reference's entry points, on hand-made files."""
from __future__ import annotations

import glob
import os
import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerline.operators import increment as INC
from ledgerline.operators import indicators as IND
from ledgerline.operators import quality as Q
from ledgerline.sinks.writers import write_indicator_csv, write_report_csv, write_wide_reports
from ledgerline.sources.files import (FL_TRANS_DDL, FL_TRANS_METRICS, list_files, read_headerless,
                                      read_two_line_header, read_upload)

HEADER = ";".join(c.split()[0] for c in FL_TRANS_DDL.split(", "))


def _row(mcc, region, amount, period, count="10"):
    amounts = ";".join([amount] * 6)
    counts = ";".join([count] * 6)
    return f'{mcc};"{region}";ao;dist;M;1;2;3;{amounts};{counts};{counts};{period}'


def test_load_procedure_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="ledgerline-job-")
    land = os.path.join(root, "in")
    os.makedirs(land)
    lines = [HEADER,
             _row("", "Moscow; centre", "100.00", "2022-02-01", "20"),  # grand total (empty mcc = null)
             _row("Food", "Moscow; centre", "60.00", "2022-02-01"), _row("Cars", "Moscow; centre", "40.00", "2022-02-01"),
             _row("5411", "Moscow; centre", "60.00", "2022-02-01"), _row("5511", "Moscow; centre", "30.00", "2022-02-01")]
    with open(os.path.join(land, "fl_trans_20220315.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(land, "old_fl_trans_20210101.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + "\n")
    with open(os.path.join(land, "readme.txt"), "w") as f:
        f.write("x")

    files = list_files(spark, land)
    pick = INC.latest_file(files).first()
    assert pick["title"] == "fl_trans_20220315.csv" and pick["kind"] == "fl_trans" and pick["actdate"] == "2022-02-01"

    up = read_upload(spark, os.path.join(land, pick["title"]), pick["kind"])
    assert up.count() == 5 and up.where("mcc is null").count() == 1
    assert up.first()["region_name"] == "Moscow; centre"                  # quoted separator kept
    mcc_map = spark.createDataFrame([("5411", "Food"), ("5511", "Cars")], "mcc_code string, mcc_group string")
    checks = {
        "total_vs_groups": Q.reconcile_levels(up, FL_TRANS_METRICS, "total", "group", period=pick["actdate"]),
        "total_vs_codes": Q.reconcile_levels(up, FL_TRANS_METRICS, "total", "code", period=pick["actdate"]),
        "groups_vs_codes": Q.reconcile_groups(up, mcc_map, FL_TRANS_METRICS),
    }
    summary = {r["check"]: r["n_rows"] for r in Q.check_summary(checks).collect()}
    # codes sum to 90 of 100 (10 % off: 6 amount metrics); Cars 40 vs 30 (25 %)
    assert summary == {"total_vs_groups": 0, "total_vs_codes": 6, "groups_vs_codes": 1}
    bad = checks["groups_vs_codes"].first()
    assert bad["mcc"] == "Cars" and bad["dev_trans_amount_on_terr"] == 25.0 and bad["dev_count_trans_on_terr"] == 0.0

    hist = os.path.join(root, "history")
    assert INC.append_new(spark, up, hist)["n_periods"] == 1
    assert INC.append_new(spark, up, hist)["status"] == "no new periods"
    h = INC.read_history(spark, hist, up.schema)
    assert h.count() == 5 and h.agg(F.sum("trans_amount_on_terr")).first()[0] == D("290.00")


def test_indicator_sink_cp1251_and_headerless(spark):
    ind = spark.createDataFrame([("количество ИП", "торговля", "null", "ед.", "москва", "2021-03-05", 1.5, 0)],
                                "DIM_1 string, DIM_2 string, DIM_3 string, DIM_4 string, DIM_5 string, date string, "
                                "val double, ordinal int")
    out = tempfile.mkdtemp(prefix="ledgerline-out-") + "/indicators"
    write_indicator_csv(IND.indicator_export(ind), out)
    text = b"".join(open(p, "rb").read() for p in sorted(glob.glob(out + "/part-*"))).decode("cp1251")
    assert text.splitlines() == ["DIM_1,DIM_2,DIM_3,DIM_4,DIM_5,date,val",
                                 'количество ИП,торговля,null,ед.,москва,03.05.2021,"1,5"']

    rep = spark.createDataFrame([("NO_BUHOT_1", "1", None)], "`ИдФайл__xml` string, `Актив__СумОтч` string, x string")
    paths = write_wide_reports({"full": rep}, tempfile.mkdtemp(prefix="ledgerline-out-"), "20240101")
    assert paths["full"].endswith("/reports_full_20240101")
    back = read_two_line_header(spark, paths["full"])
    assert back.columns == ["ИдФайл__xml", "Актив__СумОтч", "x"] and back.first()["Актив__СумОтч"] == "1"

    raw = tempfile.mkdtemp(prefix="ledgerline-raw-") + "/t.csv"
    with open(raw, "w") as f:
        f.write("a;b;\n1;2;\n")
    hl = read_headerless(spark, raw)
    assert len(hl.columns) == 2 and hl.count() == 2
    write_report_csv(hl, raw + ".out")


def test_cell_tables_and_listing(spark):
    from ledgerline.sources.files import read_table
    root = tempfile.mkdtemp(prefix="ledgerline-cells-")
    with open(os.path.join(root, "t3.csv"), "w", encoding="utf-8") as f:
        f.write("CELL_ID;REGION_ID;INDUSTRY_NAME;area;m1\n8a1ff;77;Retail;north;1.5\n8a2f;77;Retail;;\n")
    t3 = read_table(spark, os.path.join(root, "t3.csv"), "csv", "CELL_ID string, REGION_ID int, INDUSTRY_NAME string, area string, m1 double")
    assert t3.columns == ["CELL_ID", "REGION_ID", "INDUSTRY_NAME", "area", "m1"] and t3.count() == 2
    t3.write.parquet(os.path.join(root, "t3.parquet"))
    assert read_table(spark, os.path.join(root, "t3.parquet")).count() == 2
    names = sorted(r["title"] for r in list_files(spark, os.path.join(root, "*.csv")).collect())
    assert names == ["t3.csv"]
