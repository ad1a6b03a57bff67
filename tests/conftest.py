from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # the tests that count executions need all of them: beyond 1,000, the default, the oldest are forgotten
    s = get_session("local[4]", app="ledgerline-tests", shuffle_partitions=8, extra={"spark.sql.ui.retainedExecutions": "5000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: [(v is not None, v if v is not None else 0) for v in t])
