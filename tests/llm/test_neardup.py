"""Near-duplicates against all pairs on full shingle sets."""
from __future__ import annotations

import re

import pytest

from ledgerline.llm import components as C
from ledgerline.llm import neardup as N
from tests.llm.fixtures import clashing, documents, odd_texts, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups: dict = {}
    for a in range(len(docs)):
        groups.setdefault(find(a), []).append(docs[a][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((docs[a][0], len(sets[a]), least[find(a)], docs[a][0] == least[find(a)]) for a in range(len(docs))), key=str)


def edited(text, seed, n):
    import random
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(9999)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    docs = [(i, prose(1000 + i, 80 + i % 50, 5000)) for i in range(60)]
    base = prose(7, 150, 5000)
    docs += [(100 + i, edited(base, i, 1 + i % 5)) for i in range(40)]  # a group in which not all pairs are similar
    docs += [(200 + i, base) for i in range(10)]
    chain = base = prose(8, 200, 5000)
    for i in range(12):  # each similar to its neighbours only
        chain = edited(chain, 70 + i, 5)
        docs.append((300 - i, chain))
    passage = prose(9, 60, 5000)  # a passage that many share
    docs += [(400 + i, prose(2000 + i, 40, 5000) + " " + passage) for i in range(30)]
    return docs


def test_matches_all_pairs(spark, corpus):
    docs = corpus + odd_texts()
    got = N.near_duplicates(documents(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


def test_small_blocks_give_the_same(spark, corpus, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_NODES", 4)
    got = N.near_duplicates(documents(spark, corpus)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(corpus)


def test_one_document_of_each_group_stays(spark, corpus):
    docs = corpus + odd_texts()
    table = clashing(documents(spark, docs))
    kept = N.deduplicated(table)
    assert kept.schema == table.schema
    want = {r[:3] for r in brute(docs) if r[3] and r[1]}  # the repeated row once
    bare = [d for d, t in docs if not shingles(t)]
    ids = [r["doc_id"] for r in kept.collect()]
    lonely_null = 1  # the text of a null id that is like no other
    assert sorted(ids, key=str) == sorted([w[0] for w in want if w[0] is not None] + bare + [None] * lonely_null, key=str)


def test_empty_table(spark):
    none = documents(spark, [(1, "x")]).limit(0)
    assert N.near_duplicates(none).count() == 0 and N.deduplicated(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (501, 500), (500, 501)]
    got = {r["node"]: r["label"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500, 501: 500}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_set_survives_where_ids_are_repeated_or_null(spark):
    a, b = prose(901, 200), prose(902, 200)
    rows = [(7, a), (7, a + " changed"), (None, b), (None, b + " changed"), (3, None)]
    kept = [r["text"] for r in N.deduplicated(documents(spark, rows)).collect()]
    assert len(kept) == 3 and sum(t in (a, a + " changed") for t in kept) == 1 and sum(t in (b, b + " changed") for t in kept) == 1


def passage_corpus(n, own=40, shared=60):
    """Texts that share a passage and are alike far below the threshold, and a few real pairs among them."""
    passage = prose(9, shared, 5000)
    docs = [(i, prose(20_000 + i, own, 50_000) + " " + passage) for i in range(n)]
    return docs + [(n + i, docs[i * 7][1] + f" and{i} more{i}") for i in range(5)]


def test_hot_lists_are_posted_anew(spark, monkeypatch):
    """All links are found, and copies of a node do not grow with the texts that share a passage."""
    monkeypatch.setattr(N, "BLOCK_NODES", 16)
    monkeypatch.setattr(N, "HOT_NODES", 32)
    copies, blocks = [], N._in_blocks

    def counted(named, lists):
        rows = blocks(named, lists)
        copies.append((rows.count(), lists.agg({"n": "max"}).first()[0] or 0))
        return rows

    monkeypatch.setattr(N, "_in_blocks", counted)
    per_node = []
    for n in (150, 600):
        copies.clear()
        docs = passage_corpus(n)
        got = N.near_duplicates(documents(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)
        assert len(copies) == 2 and max(most for _, most in copies) <= 32
        per_node.append(sum(rows for rows, _ in copies) / n)
    assert per_node[1] < 1.5 * per_node[0] + 1


def test_a_passage_of_most_of_a_text(spark, monkeypatch):
    """The passage is in the finer prefixes too; blocks still find every link."""
    monkeypatch.setattr(N, "BLOCK_NODES", 8)
    monkeypatch.setattr(N, "HOT_NODES", 8)
    docs = passage_corpus(60, own=14, shared=66)
    got = N.near_duplicates(documents(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    lists = spark.createDataFrame([(1, 3, 10), (2, 3, 3_000_000)], "key long, n long, size long")
    named = spark.createDataFrame([(k, i, i) for k in (1, 2) for i in range(3)], "key long, node long, label long")
    monkeypatch.setattr(N, "BLOCK_BYTES", 8_000_000)
    rows = N._in_blocks(named, lists)
    assert {r["key"]: r["n"] for r in rows.groupBy("key").agg({"q": "max"}).withColumnRenamed("max(q)", "n").collect()} == {1: 0, 2: 2}


@pytest.mark.parametrize("sf", ["0.001"])
def test_matches_all_pairs_on_the_documents(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()]
    got = N.near_duplicates(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)
