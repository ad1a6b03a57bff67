"""The pipeline, stage by stage, against brute force; entry points of the subpackage."""
from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from ledgerline.llm import language, mixing
from ledgerline.llm import queries as Q
from ledgerline.llm.tables import read, staged
from tests.llm import test_decontamination as D
from tests.llm import test_mixing as M
from tests.llm import test_neardup as N
from tests.llm.fixtures import clashing, documents, odd_texts

SF = "/root/testdata/sf0.001"


def brute(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text", "source").collect()]
    said = {r["doc_id"]: r for r in language.identify(read(spark, sf_dir, "documents")).collect()}
    rows = [r for r in rows if said[r[0]]["lang_pred"] != "und" and said[r[0]]["score"] > P.MIN_LANGUAGE_SCORE]
    kept = {r[0] for r in N.brute([r[:2] for r in rows]) if r[3] or r[1] == 0}
    rows = [r for r in rows if r[0] in kept]
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    bad = {r[0] for r in D.brute([r[:2] for r in rows], items) if r[-1]}
    rows = [r for r in rows if r[0] not in bad]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += M.size(t)
    targets, out = M.plain_targets(sizes), []
    for s in sizes:
        whole, rest = divmod(targets[s], sizes[s])
        done = 0
        for d, t in sorted(((d, t) for d, t, x in rows if x == s), key=lambda r: _key(r[0])):
            times = int(whole) + (2 * done + M.size(t) <= 2 * rest)
            done += M.size(t)
            out += [(d, t)] * times
    tok, start, index = Tokenizer.from_file(Q.tokenizer_file("word_bpe_49k.json")), 0, []
    for d, t in sorted(out):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        index.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return index


def _key(doc_id):
    import hashlib
    return hashlib.md5(f"{mixing.SEED}|{doc_id}".encode()).hexdigest()


def test_run_matches_brute_force(spark):
    got = sorted(tuple(r) for r in P.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute(spark, SF)


def test_stages_keep_the_columns_of_documents(spark):
    docs = staged(clashing(documents(spark, odd_texts() + [(100 + i, f"the cat sat on mat {i}") for i in range(20)])), "odd")
    for _, stage in P.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema == docs.schema
        docs = staged(after, "odd")
    assert docs.count() and P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_stages_on_an_empty_table(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = defaultdict(list)
    for q in entry.queries():
        if q.startswith("op"):
            names[q.split("_")[0]].append(q)
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and all(len(v) == 1 for v in names.values())
    assert entry.queries()["pipeline"] is P.run and set(Q.ORACLE) <= set(Q.QUERIES)
