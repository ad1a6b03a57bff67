"""Line dedup: lines, filters and results against a plain version."""
from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import linededup as L
from ledgerline.llm.textarrays import U64, mix, utf8
from tests.llm.fixtures import CLASHING, clashing, documents, odd_texts, prose

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_version(docs, least_chars=20, least_docs=3):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    keeper = {k: max((i for i in h if i is not None), default=None) for k, h in holders.items() if len(h) >= least_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept").collect()), key=order)


def order(r):
    return tuple("" if v is None else str(v) for v in r)


def corpus():
    r = random.Random(3)
    shared = [f"shared line number {i} of many documents" for i in range(30)] + ["ÄÖÜ ßßßßß ééééé 漢字漢字漢字", "short one"]
    docs = list(odd_texts())
    for i in range(20, 200):
        lines = [prose(1000 + i, r.randrange(12)) if r.random() < 0.5 else r.choice(shared) for _ in range(r.randrange(9))]
        lines = [x.upper() if r.random() < 0.2 else r.choice(["", "  ", "\t", "\x0b"]) + x + r.choice(["", " ", "\r"]) for x in lines]
        docs.append((i, "\n".join(lines)))
    hot = "this line stands in a third of all documents"
    docs += [(300 + i, f"{hot}\nown text of document {i} here\n{hot} \n") for i in range(100)]
    docs += [(500, "\n\n"), (501, shared[0]), (501, shared[0] + "\nmore of this one"), (502, "\n".join(shared)), (None, hot)]
    docs += [(600 + i, f"line of exactly two documents\n{'x' * 19}\n{'y' * 20}") for i in range(2)] + [(602, "y" * 20 + "\n" + "x" * 19)]
    docs.append((700, "\n".join(shared * 400)))  # very long, every line a repeat
    return docs


def test_equals_plain_version(spark):
    docs = corpus()
    got = result(L.dedup_lines(documents(spark, docs)))
    assert got == sorted(plain_version(docs), key=order)
    assert sum(r[2] for r in got) > 300


def test_small_filter_changes_no_result(spark):
    """With hardly any bits every line is a suspect; the exact step decides."""
    docs = corpus()
    got = result(L.dedup_lines(documents(spark, docs), filter_bytes=1))
    assert got == sorted(plain_version(docs), key=order)


@pytest.mark.parametrize("chars, least", [(1, 2), (5, 4)])
def test_other_parameters(spark, chars, least):
    docs = corpus()
    got = result(L.dedup_lines(documents(spark, docs), min_chars=chars, min_documents=least))
    assert got == sorted(plain_version(docs, chars, least), key=order)


def test_joined_instead_of_broadcast(spark):
    docs = corpus()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = result(L.dedup_lines(documents(spark, docs)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(plain_version(docs), key=order)


def test_clashing_columns_and_empty_table(spark):
    docs = clashing(documents(spark, corpus())).withColumn("lines", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("at", F.lit(2))
    made = L.dedup_lines(docs)
    assert made.columns[:-1] == docs.columns and made.columns[-1] != "lines"
    assert made.where("lines = 'mine' and row = 1 and at = 2 and " + " and ".join(f"{c} = '{c}-kept'" for c in CLASHING)).count() == docs.count()
    assert L.dedup_lines(docs.limit(0)).collect() == []


def test_filters():
    """Nothing seen twice is missed, whatever the blocks; few others pass."""
    r = np.random.default_rng(1)
    hashes = mix(r.integers(0, 1 << 62, 40_000).astype(U64)) >> U64(4)  # all in the first of 16 parts
    twice, marked = hashes[:5_000], hashes[5_000:5_100]
    blocks = [(hashes[5_100:20_000], marked), (hashes[20_000:], marked[:0]), (twice, marked[:0]), (twice[::-1], marked[:0])]
    bits = L.twice_seen(blocks, 1 << 30)
    f = L.TwiceSeen(4, {0: np.packbits(bits, bitorder="little").tobytes()})
    assert f.has(hashes[:5_100]).all() and f.has(hashes[5_100:]).mean() < 0.02
    assert not f.has(hashes | (U64(5) << U64(60))).any()  # a part without a filter
    assert len(L.twice_seen(blocks, 1024)) == 1024 and len(L.twice_seen([], 1024)) == 0


def test_lines_of_odd_texts():
    texts = [None, "", "\n", "a\n", "\na", "  spaced out line of some length \n\n x", "é" * 19 + "\n" + "é" * 20]
    raw, off = utf8(pa.array(texts))
    lines = L.Lines(raw, off)
    assert np.diff(lines.first).tolist() == [len((t or "").split("\n")) for t in texts]
    whole = [raw[a:b].tobytes().decode() for a, b in zip(lines.begin, lines.stop)]
    assert whole == [x for t in texts for x in (t or "").split("\n")]
    assert [lines.bytes[a:b].tobytes().decode() for a, b in zip(lines.start, lines.end)] == ["spaced out line of some length", "é" * 20]
