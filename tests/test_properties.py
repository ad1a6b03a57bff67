"""Property tests: operators against small plain-Python models of the reference rules."""
from __future__ import annotations

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions.text import clean_value
from ledgerline.operators.stats import distinct_median

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _plain_model(vl):
    if vl is None or vl == "-":
        return None
    try:
        return float(vl.replace(" ", "").replace(",", ".").replace("%", ""))
    except ValueError:
        return None


def _scaled_model(vl):
    if vl is None:
        return None
    if vl == "-":
        return 0.0
    v = _plain_model(vl)
    return v if (v is None or "%" in vl) else v / 1000.0


texts = st.one_of(
    st.none(), st.just("-"),
    st.builds(lambda i, f, pct, sp: (f"{i // 1000} {i % 1000:03d}" if sp and i >= 1000 else str(i))
              + f",{f:02d}" + ("%" if pct else ""),
              st.integers(0, 999_999), st.integers(0, 99), st.booleans(), st.booleans()))


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=30))
def test_clean_value_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "VL string")
    got = df.select("VL", clean_value("VL", "plain").alias("p"), clean_value("VL", "scaled").alias("s")).collect()
    for r in got:
        assert r["p"] == _plain_model(r["VL"]) and r["s"] == _scaled_model(r["VL"])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-50, 50)), min_size=1, max_size=80),
       st.sampled_from([2_000_000, 5]))
def test_distinct_median_matches_numpy(spark, pairs, max_rows):
    df = spark.createDataFrame([(g, float(v) / 2) for g, v in pairs], "g string, v double")
    got = {r["g"]: r["median"] for r in distinct_median(df, ["g"], "v", max_rows=max_rows, splits=4).collect()}
    want = {g: float(np.median(np.unique([float(v) / 2 for gg, v in pairs if gg == g]))) for g in {p[0] for p in pairs}}
    assert got == want
