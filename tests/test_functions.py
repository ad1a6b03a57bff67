from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions.dates import date_in_name, export_date, previous_month_start
from ledgerline.functions.numbers import decimal_comma, deviates, pct_deviation, plain_text, round_half_away, round_half_even
from ledgerline.functions.text import clean_value, code_kind, route_by_name, route_by_prefix


def test_clean_value_modes(spark):
    df = spark.createDataFrame([("1 234,5",), ("12%",), ("-",), (None,), ("abc",), ("0,5",)], "VL string")
    got = df.select("VL", clean_value("VL", "plain").alias("p"), clean_value("VL", "scaled").alias("s")).collect()
    m = {r["VL"]: (r["p"], r["s"]) for r in got}
    assert m["1 234,5"] == (1234.5, 1.2345)
    assert m["12%"] == (12.0, 12.0)          # percentages are not scaled
    assert m["-"] == (None, 0.0)             # D-1: plain -> null, scaled -> 0
    assert m[None] == (None, None)
    assert m["abc"] == (None, None)          # D-3: bad text -> null, no failure
    assert m["0,5"] == (0.5, 0.0005)


def test_code_kind(spark):
    df = spark.createDataFrame([(None,), ("5411",), ("1e5",), (" 42 ",), ("Food",), ("1d",), ("-",)], "mcc string")
    got = {r["mcc"]: r["k"] for r in df.select("mcc", code_kind("mcc").alias("k")).collect()}
    assert got == {None: "total", "5411": "code", "1e5": "code", " 42 ": "code", "Food": "group",
                   "1d": "group", "-": "group"}


def test_pct_deviation_and_rounding(spark):
    df = spark.createDataFrame([(100.0, 95.0), (0.0, 5.0), (None, 1.0), (3.0, 2.0), (-1.0, -1.0)], "a double, b double")
    got = [r[0] for r in df.select(pct_deviation("a", "b").cast("double")).collect()]
    assert got == [5.0, None, None, 33.33, 0.0]
    r = spark.createDataFrame([(1.005,), (-2.675,), (2.5,), (0.0,)], "x double") \
             .select(round_half_away("x", 2).alias("r")).collect()
    assert [x["r"] for x in r] == [1.01, -2.68, 2.5, 0.0]      # by the number's decimal text, half away


def test_money_is_exact(spark):
    from decimal import ROUND_HALF_UP, Decimal as D
    pairs = [("1000.00", "999.65"), ("-1000.00", "-999.65"), ("95000000000000000.00", "95000000000000000.00"),
             ("99999999999999999.99", "99999999999999999.00"), ("3.00", "2.00"), ("0.01", "99999999.99"), ("0.00", "1.00"),
             ("-2.00", "2.00"), ("20000.00", "19999.00"), (None, "1.00")]
    df = spark.createDataFrame([(a and D(a), D(b)) for a, b in pairs], "a decimal(29,2), b decimal(29,2)")

    def want(a, b):
        if a is None or not D(a):
            return None
        from fractions import Fraction
        q = (Fraction(a) - Fraction(b)) / Fraction(a) * 10_000
        n = int(abs(q) + Fraction(1, 2))
        return D(n if q >= 0 else -n).scaleb(-2)

    assert [r[0] for r in df.select(pct_deviation("a", "b")).collect()] == [want(a, b) for a, b in pairs]
    tie = spark.createDataFrame([(D("100.00"), D("99.00")), (D("100.00"), D("98.99"))], "a decimal(19,2), b decimal(19,2)")
    assert [r[0] for r in tie.select(deviates("a", "b", 1.0)).collect()] == [False, True]
    money = spark.createDataFrame([(D("1.005"),), (D("-2.675"),)], "x decimal(10,3)").select(round_half_away("x")).collect()
    assert [r[0] for r in money] == [D("1.005").quantize(D("0.01"), ROUND_HALF_UP), D("-2.68")]


def test_half_even_as_numpy(spark):
    import numpy as np
    xs = [0.125, 0.375, 2.675, -0.125, 1.005, 7.0, 1e15 + 0.125]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(round_half_even("x")).collect()]
    assert got == [float(np.round(x, 2)) for x in xs]


def test_text_and_dates(spark):
    df = spark.createDataFrame([("fl_trans_20220315.csv",), ("ul_2022031.csv",), ("x.txt",)], "t string")
    got = df.select("t", date_in_name("t").alias("d"), previous_month_start(date_in_name("t")).alias("p"),
                    route_by_name("t", [("fl_trans", "fl_trans"), ("ul_", "ul")]).alias("k")).collect()
    m = {r["t"]: (r["d"], r["p"], r["k"]) for r in got}
    assert m["fl_trans_20220315.csv"] == (dt.date(2022, 3, 15), dt.date(2022, 2, 1), "fl_trans")
    assert m["ul_2022031.csv"][0] is None and m["ul_2022031.csv"][2] == "ul"
    assert m["x.txt"] == (None, None, None)
    d = spark.createDataFrame([(dt.date(2021, 3, 31),)], "d date")
    assert d.select(export_date("d")).first()[0] == "03.31.2021"   # D-4: month.day.year
    ids = spark.createDataFrame([("NO_BUHOT_1",), ("NO_BOUPR_2",), ("NO_OTHER",)], "i string")
    k = [r[0] for r in ids.select(route_by_prefix("i", {"NO_BUHOT": "full", "NO_BOUPR": "simplified"})).collect()]
    assert k == ["full", "simplified", None]


def test_plain_text(spark):
    xs = [12.0, 0.00655, 1234.5, 1e-05, 1.2345678, 5e-07, 0.0005, 1e16, 1.5e22, 123456789012345.6, 0.0, -0.25, 9007199254740993.0,
          0.1 + 0.2, 1e-4, 12345678.9]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(plain_text("x")).collect()]
    assert got == [repr(x) for x in xs]                        # all digits, as the reference writes them
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(plain_text("x")).first()[0] is None
    assert df.select(decimal_comma(F.lit(1234.5))).first()[0] == "1234,5"
