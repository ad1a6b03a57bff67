"""Mixing: water level, targets and repetitions against a plain calculation."""
from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from ledgerline.llm import mixing as M
from tests.llm.fixtures import clashing, documents, odd_texts, prose


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, clamped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in clamped]
        rest = goal - sum(2 * sizes[s] for s in clamped)
        level = rest / sum(w[s] for s in free) if free else 0
        more = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in clamped else level * w[s] for s in names}
        clamped |= more


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus():
    docs = [(i, prose(i, 5 + i * 37 % 90)) for i in range(300)]
    sources = {i: ["hot", "b", "a", None, "\U0001f600", "z"][min(i % 11, 5)] if i % 3 else "hot" for i in range(300)}
    return docs, sources


def test_plan(spark):
    docs, sources = corpus()
    got = M.mix(documents(spark, docs, sources=sources)).collect()
    own = {i: size(t) for i, t in docs}
    sizes = Counter()
    for i, n in own.items():
        sizes[sources[i]] += n
    want = plain_targets(sizes)
    taken, most = Counter(), defaultdict(int)
    for r in got:
        s = sources[r["doc_id"]]
        assert r["size"] == own[r["doc_id"]] and r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(r["size"], 1) == 0
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in want)
    # the extra repetition goes to the first documents in the seeded order
    for s in want:
        whole, rest = divmod(want[s], sizes[s])
        done = 0
        for r in sorted((r for r in got if sources[r["doc_id"]] == s), key=lambda r: hashlib.md5(f"mix-1|{r['doc_id']}".encode()).hexdigest()):
            extra = 2 * done + r["size"] <= 2 * rest
            assert r["taken"] == r["size"] * (whole + extra)
            done += r["size"]


def test_reruns_agree_whatever_the_partitions(spark):
    docs, sources = corpus()
    d = documents(spark, docs, sources=sources)
    assert sorted(map(str, M.mix(d).collect())) == sorted(map(str, M.mix(d.repartition(7)).collect()))


def test_mixed_repeats_whole_rows(spark):
    docs, sources = corpus()
    d = clashing(documents(spark, docs + odd_texts(), sources=sources))
    kept = M.mixed(d)
    assert kept.schema == d.schema
    want = Counter()
    for r in M.mix(d).collect():
        if r["size"]:
            want[r["doc_id"], r["size"]] += r["taken"] // r["size"]
    got = Counter((r["doc_id"], size(r["text"])) for r in kept.collect())
    assert {k: v for k, v in got.items() if k[1]} == {k: v for k, v in want.items() if v}


def test_odd_tables(spark):
    d = documents(spark, odd_texts())
    assert M.mix(d).count() == len(odd_texts()) and M.mix(d.limit(0)).count() == 0 and M.mixed(d.limit(0)).count() == 0
    bare = M.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in bare] == [(0, 0.0, 0)] * 2


def test_only_dataframe_functions(spark):
    plan = M.mix(documents(spark, corpus()[0]))._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan
