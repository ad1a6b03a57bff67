"""Archives: round trip, revisits, merged order."""
from __future__ import annotations

import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import warc as W
from ledgerline.llm.tables import scratch
from tests.llm.fixtures import clashing

LONG = "<p>" + "copy " * 40 + "</p>"
PAGES = [(1, "http://b.example/x", LONG), (2, "https://www.a.example/y/?Q=1#f", LONG), (3, None, None), (4, "http://b.example/x", ""),
         (5, "http://a.example/é", "É" * 60), (6, "x", "short"), (7, "x", "short"), (8, "http://b.example/x", LONG),
         (9, "http://[bad", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" * 9), (10, "http://c.example", "line\nbreak\r\n\r\n" * 20),
         (11, "two\r\nlines", "É" * 50), (12, "http://b.example/x", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" * 9)]


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def want(rows):
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        same = [q for q, _, g in rows if (g or "").encode() == raw and q is not None]
        first = min(same, default=None)
        revisit = len(raw) >= 100 and p is not None and p != first
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("size", [8 << 20, 2000])
def test_round_trip(spark, size):
    got = W.archive(clashing(table(spark, PAGES)), archive_bytes=size)
    assert sorted((tuple(r) for r in got.select(*COLS).collect()), key=str) == want(PAGES)
    rows = sorted(got.collect(), key=lambda r: r["position"])
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in rows]
    assert keys == sorted(keys) and [r["position"] for r in rows] == list(range(len(PAGES)))


def test_ranges_are_bounded_and_ties_are_cut(spark):
    """A hot URL and one capture repeated a thousand times are dealt over ranges, in one order."""
    rows = [(i, "http://hot.example/", f"page {i}") for i in range(600)] + [(7, "http://hot.example/", "again")] * 1000
    rows += [(2000 + i, f"http://h{i % 50}.example/{i}", "x" * (i * 7)) for i in range(600)]  # some larger than an archive
    runs = W.staged(_runs(spark, rows, 3000), "warc-runs")
    merged = W.merged_index(runs, range_captures=100)
    numbered = merged.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    got = [tuple(r[c] for c in W.HISTORY) for r in sorted(numbered, key=lambda r: r["at"])]
    assert got == sorted(got) and len(got) == 2200 and len({r["archive"] for r in numbered}) > 20
    sizes = Counter(r["task"] for r in numbered)
    assert len(sizes) >= 15 and max(sizes.values()) < 400


def _runs(spark, rows, archive_bytes):
    path = scratch(spark, "warc")
    W.write_archives(table(spark, rows), path, archive_bytes)
    return W.captures(spark, path)


def test_payloads_come_back_byte_for_byte(spark):
    path = scratch(spark, "warc")
    W.write_archives(table(spark, PAGES), path, 1500)
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    assert len(files) > 1
    bodies = {}
    for f in files:
        for h, _, block in W.parse(gzip.decompress(bytes(f["content"]))):
            bodies[int(h["WARC-Record-ID"][10:-1])] = (h["WARC-Type"], block)
    types = {r[0]: r[3] for r in want(PAGES)}
    assert bodies == {p: (types[p], (h or "").encode() if types[p] == "response" else b"") for p, _, h in PAGES}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = PAGES + PAGES[:2] + [(None, "n", LONG), (None, None, None)]
    got = W.archive(table(spark, rows)).select(*COLS).collect()
    assert sorted((tuple(r) for r in got), key=str) == want(rows)
    assert W.archive(table(spark, PAGES).limit(0)).count() == 0


def test_damaged_archive_fails():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, _, b in W.parse(good * 2)] == [b"abc"] * 2
    for bad in (good[:-1], b"x" + good, good.replace(b"3", b"2")):
        with pytest.raises(ValueError):
            list(W.parse(bad))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    r = random.Random(k)
    runs = [sorted((r.randrange(50), i) for _ in range(r.randrange(20))) for i in range(k)]
    merged = list(W.LoserTree(runs, lambda row: row[0]))
    assert merged == sorted(sum(runs, []), key=lambda row: row[0])


def test_url_key():
    assert W.url_key("HTTPS://www.Example.org:8080/A/b/?x=1#frag") == "org,example)/a/b?x=1"
    assert W.url_key("http://example.org") == W.url_key("http://example.org/") == "org,example)/"
    assert W.url_key(None) == ")/" and W.url_key("http://[bad") == "http://[bad"
