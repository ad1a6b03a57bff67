"""Merkle fingerprints against a plain tree."""
from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle as M
from tests.llm.fixtures import clashing, documents, odd_texts, prose


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(text):
    leaves = [sha(p) for p in text.replace(". ", ".\n").split("\n")]
    return sha("".join(sections(leaves))) + ":" + ".".join(h[:12] for h in leaves)


def sections(leaves):
    out, run = [], []
    for k, h in enumerate(leaves):
        run.append(h)
        if h[0] in "01" or k == len(leaves) - 1:
            out.append(sha("".join(run)))
            run = []
    return out


def dice(a, b):
    a, b = (set(x.split(":")[1].split(".")) for x in (a, b))
    return 2 * len(a & b) / (len(a) + len(b))


def lines(seed, n):
    return "\n".join(prose(seed * 100 + i, 6) + (". " + prose(seed * 77 + i, 4) if i % 3 else "") for i in range(n))


DOCS = [(i, lines(i, 1 + i * 7 % 40)) for i in range(60)] + [(100, "É\U0001f600x. y\n\nz"), (101, None), (102, "")]


@pytest.mark.parametrize("range_bytes", [8 << 20, 1000])
def test_matches_a_plain_tree(spark, range_bytes):
    got = {r["doc_id"]: r for r in M.fingerprints(documents(spark, DOCS), range_bytes=range_bytes).collect()}
    order = sorted(((i, t or "") for i, t in DOCS), reverse=True)
    assert len(got) == len(order)
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        third = len(t) // 3
        new = t[:len(t) - third] + nxt[:third]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(new))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain(t), plain(new))
        assert abs(r["near_edited"] - dice(plain(t), plain(new))) < 1e-12 and abs(r["near_next"] - dice(plain(t), plain(nxt))) < 1e-12


def located(spark, old, new):
    """Places of changed and lost sections and paragraphs between two lists of paragraphs, and the numbers of both."""
    df = spark.createDataFrame([("\n".join(old), "\n".join(new))], "a string, b string")
    df = M.worked_out(df, pa=M.paragraph_hashes(F.col("a")), pb=M.paragraph_hashes(F.col("b")))
    df = M.worked_out(df, sa=M.section_hashes(F.col("pa")), sb=M.section_hashes(F.col("pb")))
    for out, x, y in (("s", "sb", "sa"), ("p", "pb", "pa"), ("ls", "sa", "sb"), ("lp", "pa", "pb")):
        df = M.changes(df, x, y, out)
    r = df.first()
    assert r["sa"] == sections([sha(x) for x in old]) and r["sb"] == sections([sha(x) for x in new])
    return r


LINES = [f"line {i}" for i in range(60)]


@pytest.mark.parametrize("at", [0, 1, 17, 30, 59, 60])
def test_an_inserted_paragraph_is_one_section_and_one_paragraph(spark, at):
    r = located(spark, LINES, LINES[:at] + ["put in"] + LINES[at:])
    assert r["p"] == [at] and len(r["s"]) == 1 and r["lp"] == [] and len(r["ls"]) <= 1
    assert len(r["sa"]) > 4


def test_changed_deleted_and_several_edits(spark):
    r = located(spark, LINES, LINES[:17] + ["changed"] + LINES[18:])
    assert (r["p"], r["lp"]) == ([17], [17]) and len(r["s"]) in (1, 2)
    r = located(spark, LINES, LINES[:17] + LINES[18:])
    assert (r["p"], r["lp"]) == ([], [17])
    r = located(spark, LINES, ["first"] + LINES[:40] + ["in between"] + LINES[40:] + ["last"])
    assert r["p"] == [0, 41, 62] and len(r["s"]) <= 4 < len(r["sb"])  # what lies between is not reported
    r = located(spark, LINES, LINES)
    assert (r["s"], r["p"], r["ls"], r["lp"]) == ([], [], [], [])
    r = located(spark, ["x"] * 9, ["x"] * 12)
    assert r["p"] == [9, 10, 11] and r["lp"] == []  # more copies of a paragraph are put in


@pytest.mark.parametrize("range_bytes", [8 << 20, 50_000])
def test_odd_texts(spark, range_bytes):
    got = M.fingerprints(clashing(documents(spark, odd_texts())), range_bytes=range_bytes).collect()
    assert len(got) == len(odd_texts())
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}) == 1
    assert {r["n_chars"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert M.fingerprints(documents(spark, []).limit(0)).count() == 0
    one = M.fingerprints(documents(spark, [(1, "abcabc")])).first()
    assert one["edited_sha256"] == sha("abcaab") and one["near_next"] == 1


def test_only_dataframe_functions(spark):
    plan = M.fingerprints(documents(spark, DOCS), range_bytes=1000)._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def test_an_id_with_many_texts_fills_several_ranges(spark):
    """Half of the rows have one id: they are dealt over ranges, and the ring stays whole."""
    rows = [(7, f"text {i} " + "x" * 100) for i in range(300)] + [(i, f"own {i} " + "y" * 100) for i in range(300) if i != 7] + [(None, "none")]
    df = documents(spark, rows).select("doc_id", "text")
    got = M.next_texts(df, range_bytes=2000).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    marks = {r["text"]: r["m"] for r in df.select("text", F.xxhash64("text").alias("m")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), marks[r[1]]))
    follows = {t: order[(k + 1) % len(order)][1] for k, (_, t) in enumerate(order)}
    assert len(got) == len(rows) and all(r["next"] == follows[r["text"]] for r in got)
    plan = M.next_texts(df, range_bytes=2000).withColumn("p", F.spark_partition_id()).where("doc_id = 7")
    assert plan.select("p").distinct().count() > 2
