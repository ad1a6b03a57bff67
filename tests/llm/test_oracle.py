"""The corpus queries that SQL can express, against their DuckDB text."""
from __future__ import annotations

import pytest

from ledgerline.llm import queries as Q
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_matches_oracle(spark, name):
    r = compare(spark, name, Q.QUERIES[name], Q.ORACLE[name], SF, duck(SF))
    assert r["status"] == "ok", r
