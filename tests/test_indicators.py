from __future__ import annotations

import json
import os
import tempfile

import pytest

from ledgerline.operators import indicators as IND
from ledgerline.sources.pages import read_dimension, read_pages
from tests.conftest import rows


def _rec(ind, flag_1294=1.0, flag_1296=1.0, slice_id=1.0, cat=10.0, dt="2021-03-05", vl="1 234,5", d1293=2.0, d1297=22.0):
    return {"DIM_1293": d1293, "DIM_1743": ind, "DIM_1294": flag_1294, "DIM_1296": flag_1296, "DIM_1297": d1297,
            "DIM_369": slice_id, "DIM_1295": cat, "DT": dt, "VL": vl}


@pytest.fixture(scope="module")
def landing():
    root = tempfile.mkdtemp(prefix="ledgerline-pages-")
    pages = {
        50: {1: [_rec(50.0), _rec(50.0, vl="1 000"), _rec(50.0, flag_1294=0.0), _rec(50.0, d1293=1.0),
                 _rec(50.0, slice_id=None), _rec(50.0, cat=99.0, vl="7")],
             2: [_rec(50.0, vl="-"), _rec(50.0, dt="2021-04-01", vl="12%")], 4: "not json at all"},
        51: {1: [_rec(51.0, flag_1296=1.0, vl="2 000"), _rec(51.0, vl="5%"), _rec(51.0, dt="2021-04-01", vl="-")]},
    }
    for ind, ps in pages.items():
        os.makedirs(f"{root}/pages/indicator={ind}")
        for n, body in ps.items():
            with open(f"{root}/pages/indicator={ind}/page_{n}.json", "w") as f:
                f.write(body if isinstance(body, str) else json.dumps(body))
    dims = f"{root}/dims"
    os.makedirs(dims)
    with open(f"{dims}/categories.json", "w") as f:
        json.dump([{"id": 10.0, "name": "Retail"}, {"id": 10.0, "name": "RETAIL TRADE"}, {"id": 11.0, "name": "X"}], f)
    with open(f"{dims}/slices.json", "w") as f:
        json.dump([{"id": 1.0, "name": "Moscow"}], f)
    return root


def test_read_pages_and_failed_pages(spark, landing):
    p = read_pages(spark, f"{landing}/pages")
    assert "indicator" in p.columns and "page" in p.columns
    got = rows(IND.failed_pages(p, "indicator", "page", p["_corrupt_record"].isNotNull(), "DIM_1743"))
    # indicator 50: pages 1, 2, 4 landed, page 4 broken, page 3 missing; 8 + 3 records read
    assert got == [(50, 3, 1, 1, 8), (51, 1, 0, 0, 3)]


def test_dimension_keeps_last_duplicate(spark, landing):
    d = read_dimension(spark, f"{landing}/dims/categories.json")
    assert rows(d) == [(10.0, "retail trade"), (11.0, "x")]


def test_build_indicators(spark, landing):
    pages = read_pages(spark, f"{landing}/pages").where("_corrupt_record is null")
    cats = read_dimension(spark, f"{landing}/dims/categories.json")
    sl = read_dimension(spark, f"{landing}/dims/slices.json")
    out = IND.build_indicators(pages, cats, sl, IND.spec_frame(spark))
    got = rows(out, "ordinal", "DIM_2", "DIM_5", "date", "val")
    assert got == [
        (0, "99.0", "moscow", "2021-03-05", 7.0),              # unmatched id stays, as text
        (0, "retail trade", "moscow", "2021-03-05", 1000.0),   # min over duplicates of a key
        (0, "retail trade", "moscow", "2021-04-01", 12.0),
        (3, "retail trade", "moscow", "2021-03-05", 2.0),      # scaled: 2 000 / 1000 < 5 %
        (3, "retail trade", "moscow", "2021-04-01", 0.0),      # scaled '-' -> 0 (D-1)
    ]
    assert set(r["DIM_3"] for r in out.collect()) == {"null"}
    exp = IND.indicator_export(out).collect()
    assert exp[0]["date"] == "03.05.2021" and exp[0]["val"] == "7,0"


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    assert IND.drop_null_columns(df).columns == ["a", "c"]


def test_min_by_keys_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 0.0)], "k string, v double")
    assert rows(IND.min_by_keys(df, ["k"], "v")) == [("a", 1.0)]
