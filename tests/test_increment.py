from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import increment as INC
from ledgerline.session import create_once
from tests.conftest import rows

commit = INC._commit


def test_latest_file_and_period(spark):
    files = spark.createDataFrame([("fl_trans_20220315.csv",), ("ul_20220415.csv",), ("fl_blago_20220415.csv",),
                                   ("notes_20991231.txt",), ("bad_2022.csv",)], "title string")
    r = INC.latest_file(files).first()
    # newest date wins; a tie goes to the larger title; non-csv names are ignored
    assert (r["title"], r["file_date"], r["kind"], r["actdate"]) == ("ul_20220415.csv", dt.date(2022, 4, 15), "ul",
                                                                     "2022-03-01")
    per_kind = rows(INC.latest_file(files, by=["kind"]), "kind", "title")
    assert per_kind == [(None, "bad_2022.csv"), ("fl_blago", "fl_blago_20220415.csv"),
                        ("fl_trans", "fl_trans_20220315.csv"), ("ul", "ul_20220415.csv")]


def test_new_periods_nulls_and_frequency(spark):
    up = spark.createDataFrame([("2022-01-01",), ("2022-02-01",), ("2022-02-01",), (None,)], "partition_dt string")
    hist = spark.createDataFrame([("2022-01-01",), (None,)], "partition_dt string")
    # a null in the history would empty NOT IN; nulls are never new periods
    assert rows(INC.new_periods(up, hist)) == [("2022-02-01",)]
    f = rows(INC.period_frequency(INC.stacked_periods(up, hist)).where("partition_dt is not null"))
    assert f == [("2022-01-01", 2), ("2022-01-01", 2), ("2022-02-01", 1)]  # a window, not an aggregate


def test_append_new_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    up = spark.createDataFrame([(1, "2022-01-01"), (2, "2022-02-01")], "v int, partition_dt string")
    s1 = INC.append_new(spark, up, path)
    assert s1 == {"status": "appended", "n_periods": 2}
    s2 = INC.append_new(spark, up, path)
    assert s2["status"] == "no new periods"
    up2 = spark.createDataFrame([(3, "2022-02-01"), (4, "2022-03-01")], "v int, partition_dt string")
    assert INC.append_new(spark, up2, path)["n_periods"] == 1
    assert rows(INC.read_history(spark, path, up.schema), "v", "partition_dt") == [(1, "2022-01-01"), (2, "2022-02-01"),
                                                                  (4, "2022-03-01")]


def _rows(spark, path, up):
    return rows(INC.read_history(spark, path, up.schema), "v", "partition_dt")


def test_load_that_died_is_not_read_and_repeated_whole(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    up = spark.createDataFrame([(i, "2022-01-01") for i in range(10)], "v int, partition_dt string")

    def dies(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # the rows are written, the entry is not
        m.setattr(INC, "_commit", lambda s, h, version, *rest: dies() if version else commit(s, h, version, *rest))
        with pytest.raises(RuntimeError):
            INC.append_new(spark, up, path)
    assert INC.read_history(spark, path, up.schema) is None
    assert INC.append_new(spark, up, path) == {"status": "appended", "n_periods": 1}
    assert _rows(spark, path, up) == [(i, "2022-01-01") for i in range(10)]


def test_interleaved_appends_keep_every_row_once(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    first = spark.createDataFrame([(1, "2022-01-01"), (2, "2022-02-01")], "v int, partition_dt string")
    second = spark.createDataFrame([(20, "2022-02-01"), (30, "2022-03-01"), (31, "2022-03-01")], "v int, partition_dt string")
    third = spark.createDataFrame([(5, "2022-05-01")], "v int, partition_dt string")
    met = []

    def meets(s, h, version, *rest):
        """The second and third run come in whole between the first one's rows and its entry."""
        if version and not met:
            met.append(version)
            assert INC.append_new(spark, second, path)["n_periods"] == 2
            assert INC.append_new(spark, third, path)["n_periods"] == 1
        return commit(s, h, version, *rest)

    monkeypatch.setattr(INC, "_commit", meets)
    assert INC.append_new(spark, first, path) == {"status": "appended", "n_periods": 1}
    assert _rows(spark, path, first) == [(1, "2022-01-01"), (5, "2022-05-01"), (20, "2022-02-01"), (30, "2022-03-01"), (31, "2022-03-01")]
    assert [e["version"] for e in INC.commit_entries(spark, path)] == [0, 1, 2, 3]
    assert INC.commit_entries(spark, path)[-1]["lost"] == ["2022-02-01"]
    assert INC.append_new(spark, first, path)["status"] == "no new periods"


def test_entry_is_created_once(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-once-") + "/log/1.json"
    assert create_once(spark, path, "first") and not create_once(spark, path, "second")
    assert open(path).read() == "first" and [f for f in os.listdir(os.path.dirname(path)) if not f.endswith(".crc")] == ["1.json"]


def test_periods_from_the_listing(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    df = spark.createDataFrame([(1, "2022-01-01"), (2, "a b+c/d:é"), (3, None), (4, "2022-01-01")], "v int, partition_dt string")
    INC.write_history(df, path)
    assert rows(INC.listed_periods(spark, path)) == [("2022-01-01",), ("a b+c/d:é",)]
    assert "parquet" not in INC.listed_periods(spark, path)._jdf.queryExecution().executedPlan().toString().lower().replace("*.parquet", "")


def test_period_filters_prune_base_and_loads(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    df = spark.createDataFrame([(i, f"2022-0{i % 3 + 1}-01") for i in range(30)], "v int, partition_dt string")
    INC.write_history(df, path)
    INC.append_new(spark, spark.createDataFrame([(99, "2022-07-01"), (98, "2022-08-01")], "v int, partition_dt string"), path)
    one = INC.read_history(spark, path, df.schema).where("partition_dt = '2022-02-01'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(partition_dt") == 2
    assert {f.split("partition_dt=")[1][:10] for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"2022-02-01"}
    assert one.count() == 10 and INC.read_history(spark, path, df.schema).count() == 32


def test_history_older_than_its_entries(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    old = spark.createDataFrame([(1, "2022-01-01")], "v int, partition_dt string")
    old.write.partitionBy("partition_dt").parquet(path)
    up = spark.createDataFrame([(7, "2022-01-01"), (2, "2022-02-01")], "v int, partition_dt string")
    assert INC.append_new(spark, up, path)["n_periods"] == 1
    assert _rows(spark, path, up) == [(1, "2022-01-01"), (2, "2022-02-01")]


def test_read_error_is_not_an_empty_history(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    up = spark.createDataFrame([(1, "2022-01-01")], "v int, partition_dt string")
    INC.append_new(spark, up, path)

    class Reader:
        def schema(self, _):
            return self

        def parquet(self, _):
            raise OSError("storage timeout")

    class Session:
        read = Reader()

    with pytest.raises(OSError):
        INC.read_history(Session(), path, up.schema)
    assert INC.read_history(spark, path + "-none", up.schema) is None


def test_append_blocked_by_failed_check(spark):
    path = tempfile.mkdtemp(prefix="ledgerline-hist-") + "/history"
    up = spark.createDataFrame([(1, "2022-01-01")], "v int, partition_dt string")
    checks = spark.createDataFrame([("c", 1, True)], "check string, n_rows long, failed boolean")
    assert INC.append_new(spark, up, path, checks=checks, on_fail="block")["status"] == "blocked"
    # D-5: the reference's gate is always open
    assert INC.append_new(spark, up, path, checks=checks)["status"] == "appended"
