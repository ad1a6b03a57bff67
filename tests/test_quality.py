from __future__ import annotations

from decimal import Decimal as D

import pytest

from ledgerline.operators import quality as Q
from ledgerline.sources.files import FL_BLAGO_TERMS
from tests.conftest import rows

SCHEMA = "mcc string, region_name string, partition_dt string, amt decimal(19,2), cnt bigint"
P = "2022-02-01"


@pytest.fixture()
def extract(spark):
    # total = 100 / 10; groups Food 60 / 6 and Cars 40 / 4; codes 5411 (Food) 50/5, 5412 (Food) 10/1,
    # 5511 (Cars) 38/4 (amount 5 % off), 9999 unmapped 2/0
    data = [
        (None, "R1", P, D("100.00"), 10),
        ("Food", "R1", P, D("60.00"), 6), ("Cars", "R1", P, D("40.00"), 4),
        ("5411", "R1", P, D("50.00"), 5), ("5412", "R1", P, D("10.00"), 1),
        ("5511", "R1", P, D("38.00"), 4), ("9999", "R1", P, D("2.00"), 0),
        # another period, all consistent
        (None, "R1", "2022-01-01", D("10.00"), 1), ("Food", "R1", "2022-01-01", D("10.00"), 1),
        ("5411", "R1", "2022-01-01", D("10.00"), 1),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture()
def mcc_map(spark):
    return spark.createDataFrame([("5411", "Food"), ("5412", "Food"), ("5511", "Cars")], "mcc_code string, mcc_group string")


def test_level_totals(extract):
    got = rows(Q.level_totals(extract, ["amt", "cnt"]), "partition_dt", "level", "amt", "cnt")
    assert (P, "code", D("100.00"), 10) in got and (P, "group", D("100.00"), 10) in got


def test_reconcile_levels_finds_nothing_when_equal(extract):
    assert Q.reconcile_levels(extract, ["amt", "cnt"], "total", "group").count() == 0
    assert Q.reconcile_levels(extract, ["amt", "cnt"], "total", "code", tol=5.0).count() == 0


def test_reconcile_levels_threshold_and_period(spark, extract):
    bad = extract.union(spark.createDataFrame([("Misc", "R1", P, D("6.00"), 0)], SCHEMA))
    got = rows(Q.reconcile_levels(bad, ["amt", "cnt"], "total", "group", tol=5.0, period=P),
               "metric", "deviation")
    assert got == [("amt", -6.0)]
    # period=None checks every period at once; 2022-01 is clean
    assert Q.reconcile_levels(bad, ["amt", "cnt"], "total", "group", tol=5.0).count() == 1


def test_reconcile_groups(extract, mcc_map):
    got = Q.reconcile_groups(extract, mcc_map, ["amt", "cnt"], tol=1.0).collect()
    assert len(got) == 1
    r = got[0]
    assert r["mcc"] == "Cars" and r["dev_amt"] == 5.0 and r["dev_cnt"] == 0.0
    # the unmapped code rolls into a null group that matches no text group
    mapped = Q.map_codes(Q.rollup_metrics(extract.where("mcc rlike '^[0-9]+$'"), ["mcc", "region_name", "partition_dt"],
                                          ["amt", "cnt"]), mcc_map, ["amt", "cnt"])
    assert any(r["mcc_group"] is None and r["amt"] == D("2.00") for r in mapped.collect())


def test_unequal_groups_is_except(extract, mcc_map):
    got = rows(Q.unequal_groups(extract, mcc_map, ["amt", "cnt"]), "mcc", "partition_dt")
    assert got == [("Cars", P)]


def test_reconcile_with_itself_is_empty(spark, mcc_map):
    # property: a table whose levels are built from the same rows passes every check
    base = [("5411", "R1", P, D("3.10"), 3), ("5412", "R2", P, D("7.25"), 1), ("5511", "R1", P, D("1.00"), 9)]
    groups = {"5411": "Food", "5412": "Food", "5511": "Cars"}
    data = base + [(groups[c], r, p, a, n) for c, r, p, a, n in base] + [(None, r, p, a, n) for c, r, p, a, n in base]
    df = spark.createDataFrame(data, SCHEMA)
    assert Q.reconcile_groups(df, mcc_map, ["amt", "cnt"]).count() == 0
    assert Q.reconcile_levels(df, ["amt", "cnt"], "total", "group", tol=0.0001).count() == 0
    assert Q.unequal_groups(df, mcc_map, ["amt", "cnt"]).count() == 0


def test_zero_group_sum_gives_null_deviation(spark, mcc_map):
    data = [("Food", "R1", P, D("0.00"), 1), ("5411", "R1", P, D("3.00"), 1)]
    got = Q.reconcile_groups(spark.createDataFrame(data, SCHEMA), mcc_map, ["amt", "cnt"]).collect()
    assert got == []  # NULLIF: dev_amt is null, dev_cnt is 0 -> not reported


def test_check_bound_open_class(spark):
    df = spark.createDataFrame([(5000.0, 4000, "2022-01-01"), (9e9, 2000001, "2022-01-01"), (5000.0, 4000, "20220101"),
                                (100.0, 4000, "2022-01-01")], "avg_all_rur double, income_group int, partition_dt string")
    assert Q.check_bound(df, "avg_all_rur", "income_group").count() == 1


def test_check_weighted_total(spark):
    cols = ["client_cnt_in_cluster"] + [c for t in FL_BLAGO_TERMS for c in t] + ["avg_all_rur", "partition_dt"]
    ok = [10] + [x for _ in FL_BLAGO_TERMS for x in (D("100.00"), D("0.1000"))] + [D("70.00"), "2022-01-01"]
    off = [10] + [x for _ in FL_BLAGO_TERMS for x in (D("100.00"), D("0.1000"))] + [D("75.00"), "2022-01-01"]
    zero = [0] + [x for _ in FL_BLAGO_TERMS for x in (D("100.00"), D("0.1000"))] + [D("75.00"), "2022-01-01"]
    ddl = ", ".join([f"{cols[0]} int"] + [f"{c} decimal(19,2)" if c.startswith("avg") else f"{c} decimal(5,4)"
                                         for c in cols[1:-2]] + ["avg_all_rur decimal(19,2)", "partition_dt string"])
    df = spark.createDataFrame([ok, off, zero], ddl)
    got = Q.check_weighted_total(df, FL_BLAGO_TERMS, "client_cnt_in_cluster", "avg_all_rur").collect()
    assert len(got) == 1 and got[0]["deviation"] == D("-7.14") and got[0]["source_total"] == 700.0


def test_check_product(spark):
    df = spark.createDataFrame([(D("10"), D("5.00"), D("50.00"), "2022-01-01"), (D("10"), D("5.00"), D("52.00"), "2022-01-01"),
                                (D("10"), D("5.00"), D("0.00"), "2022-01-01")],
                               "cnt_inn decimal(20,0), avg_income decimal(19,2), SUM_income decimal(19,2), partition_dt string")
    got = Q.check_product(df, "cnt_inn", "avg_income", "SUM_income").collect()
    # 52 vs 50: 3.85 %; zero total: null deviation, not reported (D-17)
    assert [r["deviation"] for r in got] == [D("3.85")]


def test_rows_around_the_tolerance(spark):
    """Every pair around the tolerance, small, large, negative, zero and null: as plain decimals decide."""
    pairs = [(None, D("1.00")), (D("1.00"), None), (D("0.00"), D("1.00")), (D("0.01"), D("0.01")), (D("0.01"), D("0.02"))]
    for a in [D("100.00"), D("-100.00"), D("12345678901234567.00"), D("0.10"), D("39999999999999999.99")]:
        for off in ["0", "0.0099", "0.01", "0.0100000000000000001", "0.0101", "-0.01", "-0.011", "0.5"]:
            b = (a * (1 - D(off))).quantize(D("0.01"))
            pairs += [(a, b), (a, b + D("0.01")), (a, b - D("0.01"))]
    df = spark.createDataFrame([(i, a, b, D("1"), "2022-01-01") for i, (a, b) in enumerate(pairs)],
                               "id int, a decimal(19,2), b decimal(19,2), one decimal(5,0), partition_dt string")
    want = [i for i, (a, b) in enumerate(pairs) if a and b is not None and abs(a - b) * 100 > abs(a)]
    assert 20 < len(want) < len(pairs) - 20
    assert sorted(r["id"] for r in Q.check_product(df, "b", "one", "a").collect()) == want
    got = Q.check_weighted_total(df, [("a", "one")], "one", "b").collect()
    assert sorted(r["id"] for r in got) == want


def test_terms_that_cancel(spark):
    """Large terms of both signs leave a small sum, which doubles could not hold."""
    big = D("99999999999999999.99")
    df = spark.createDataFrame([(i, big, -big + D(i), D("1"), D("100.00"), "2022-01-01") for i in range(95, 106)],
                               "id int, x decimal(19,2), y decimal(19,2), one decimal(5,0), b decimal(19,2), partition_dt string")
    got = Q.check_weighted_total(df, [("x", "one"), ("y", "one")], "one", "b").collect()
    assert sorted(r["id"] for r in got) == [i for i in range(95, 106) if abs(i - 100) * 100 > i]


def test_check_summary(spark, extract, mcc_map):
    s = Q.check_summary({"groups": Q.reconcile_groups(extract, mcc_map, ["amt", "cnt"]),
                         "levels": Q.reconcile_levels(extract, ["amt", "cnt"])})
    assert rows(s, "check", "n_rows", "failed") == [("groups", 1, True), ("levels", 0, False)]


def test_rollup_top_is_optional(extract):
    full = Q.rollup_metrics(extract, ["mcc"], ["amt"])
    assert full.count() == 7
    assert [r["mcc"] for r in Q.rollup_metrics(extract, ["mcc"], ["amt"], top=2).collect()] == [None, "5411"]


def test_failed_check_count(spark, extract, mcc_map):
    s = Q.check_summary({"groups": Q.reconcile_groups(extract, mcc_map, ["amt", "cnt"]),
                         "levels": Q.reconcile_levels(extract, ["amt", "cnt"]),
                         "bound": Q.check_bound(extract.withColumn("lim", extract["cnt"]), "amt", "lim")})
    assert Q.failed_check_count(s).first()["failed_checks"] == 2
