"""Every registered query against its DuckDB text on the small tables (the driver runs sf0.01)."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(q for q in entry.queries() if not q.startswith("op") and q != "pipeline"))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql().get(name), SF, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["partition_dt", "metric", "value_a", "value_b", "deviation"]
