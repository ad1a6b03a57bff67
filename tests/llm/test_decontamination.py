"""Winnowed decontamination against a brute-force window search."""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination as D
from ledgerline.llm.textarrays import ALPHANUMERIC, Words
from tests.llm.fixtures import CLASHING, clashing, documents, odd_texts, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p:p + n]), set()).add(str(i))
    sizes = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p:p + n])]
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, prose(10, 40, 30)), (2, prose(11, 13)), (3, "Short: item, five words here"), (4, ""), (5, None), (6, "..."),
         (10, prose(10, 40, 30)), (11, "solo"), (12, prose(12, 12))]


@pytest.fixture(scope="module")
def planted():
    base = [(100 + i, prose(50 + i, 200, 40)) for i in range(20)]
    a, b = prose(10, 40, 30).split(), prose(11, 13)
    base += [(200, prose(60, 100) + " " + b.upper() + "! " + prose(61, 100)), (201, prose(62, 900) + " " + " ".join(a[5:18])),
             (202, " ".join(a[5:17])), (203, "x short ITEM five-words here y solo"), (204, prose(12, 12)),
             (205, " ".join(a) + " . " + " ".join(a)), (206, "solo")]
    return base


@pytest.mark.parametrize("block", [200_000, 7, 2])  # broadcast; joined, short items broadcast; all joined
def test_matches_brute_force(spark, planted, block):
    docs = planted + odd_texts()
    got = D.scan(documents(spark, docs), items_table(spark, ITEMS), block_windows=block)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute(docs, ITEMS)


def test_hits_are_the_shared_words(spark):
    got = D.scan(documents(spark, [(1, "a b c " + prose(11, 13) + " d")]), items_table(spark, ITEMS)).first()
    assert [tuple(h) for h in got["hits"]] == [(3, 16)] and got["items"] == ["2"]


def test_large_benchmark_stays_off_the_driver(spark, monkeypatch):
    """20,000 windows and a passage in a third of the documents: joined, with only single numbers collected."""
    items = [(i, prose(5_000 + i, 32, 3000)) for i in range(1000)]
    shared = items[7][1]
    docs = [(i, prose(90_000 + i, 50, 3000) + (" " + shared if i % 3 == 0 else "")) for i in range(120)] + [(500, None), (501, "")]
    frame, collected = type(spark.range(0)), []
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (lambda r: (collected.append(len(r)), r)[1])(plain(self)))
    got = D.scan(documents(spark, docs), items_table(spark, items), block_windows=1_000)
    assert sum(collected) <= 20
    monkeypatch.undo()
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute(docs, items)


@pytest.mark.parametrize("block", [200_000, 2])
def test_columns_and_clean_documents_stay(spark, planted, block):
    docs = clashing(documents(spark, planted + odd_texts())).withColumn("row", F.lit("mine")).withColumn("hits", F.lit(3))
    kept = D.decontaminated(docs, items_table(spark, ITEMS), block_windows=block)
    assert kept.schema == docs.schema
    bad = [r[0] for r in brute(planted, ITEMS) if r[-1]]
    rows = kept.collect()
    assert len(rows) == docs.count() - len(bad) and not {r["doc_id"] for r in rows} & set(bad)
    assert all(r[c] == f"{c}-kept" for r in rows for c in CLASHING)


def test_empty_tables(spark, planted):
    none = documents(spark, [(1, "x")]).limit(0)
    assert D.scan(none, items_table(spark, ITEMS)).count() == 0
    got = D.scan(documents(spark, planted), items_table(spark, ITEMS).limit(0))
    assert got.where("contaminated or n_hit > 0").count() == 0 and got.count() == len(planted)


def test_word_hashes_do_not_depend_on_the_slice():
    t = prose(5, 3000)
    raw = np.frombuffer(("pad " + t).encode(), np.uint8)
    a = Words(raw, np.array([0, len(raw)]), ALPHANUMERIC)
    b = Words(raw[4:], np.array([0, len(raw) - 4]), ALPHANUMERIC)
    assert (a.hash[1:] == b.hash).all() and a.text(1, 4) == " ".join(t.split()[:3]).encode()
