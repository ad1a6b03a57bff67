"""Nearest labelled examples: exact against brute force, held-out accuracy, odd inputs."""
from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as X
from ledgerline.llm.textarrays import U64
from tests.llm.fixtures import clashing, documents, odd_texts, prose

SF = "/root/testdata/sf0.01"


def random_index(n, words, seed, block):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = sorted(r.sample(range(words), r.randrange(0, 6)))
        rows.append({"doc_id": i, "toxic": r.randrange(2), "words": w, "counts": [r.randrange(1, 4) for _ in w]})
    df = [(k * 7 + 3, 1 + sum(k in x["words"] for x in rows)) for k in range(words)]
    return X.Index(df, rows, n, nearest=10, block=block), [x for x in rows if x["words"]]


def test_nearest_is_exact():
    for seed, block in ((1, 4), (2, 16), (3, 1000)):
        index, rows = random_index(400, 30, seed, block)
        dense = np.zeros((len(rows), 30))
        for e, x in enumerate(rows):
            at, v = index.vector(np.array(x["words"]), np.array(x["counts"]))
            dense[e, at] = v
        r = random.Random(seed + 10)
        for _ in range(60):
            w = np.array(sorted(r.sample(range(30), r.randrange(1, 5))))
            c = np.array([r.randrange(1, 4) for _ in w])
            _, q = index.vector(w, c)
            cosine = dense[:, w] @ q
            want = [e for e in np.lexsort((np.arange(len(rows)), -np.round(cosine, 12))) if cosine[e] > 0][:10]
            best, got = index.nearest(w, c, 10)
            assert best.tolist() == want and np.allclose(got, cosine[want])


def test_curve_does_not_fall():
    index, _ = random_index(50, 10, 5, 8)
    r = np.random.default_rng(1)
    votes = r.random(2000)
    index.calibrate(votes, (r.random(2000) < votes ** 2).astype(float))
    assert (np.diff(index.curve[1]) >= 0).all() and abs(np.interp(0.5, *index.curve) - 0.25) < 0.1


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = X.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    said = [r for r in held if r["predicted"]]
    assert sum(truth[r["doc_id"]] for r in said) / len(said) > 0.8
    assert not [r for r in said if not r["evidence"]]


def planted():
    r = random.Random(4)
    docs = [(i, prose(i, 60, 300) + (" vile nasty" * r.randrange(1, 3) if i % 5 == 0 else "")) for i in range(400)]
    return docs, [(i, int(i % 5 == 0)) for i in range(300)]


def test_planted_words_are_found(spark):
    docs, labels = planted()
    got = {r["doc_id"]: r for r in X.score(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i, _ in docs)
    assert all(e["toxic"] == 1 for e in got[395]["evidence"])


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = planted()
    d = documents(spark, docs)
    held = {r["doc_id"] for r in X.score(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect() if r["held_out"]}
    flipped = [(i, 1 - y if i in held else y) for i, y in labels]
    a, b = (sorted((r["doc_id"], r["score"]) for r in X.score(d, spark.createDataFrame(x, "doc_id long, toxic int")).collect())
            for x in (labels, flipped))
    assert a == b


def test_odd_inputs(spark):
    docs, labels = planted()
    d = clashing(documents(spark, [(1000 + (i or 0), t) if i is not None else (i, t) for i, t in odd_texts()] + docs))
    lab = spark.createDataFrame([*labels, (None, 1), (1002, None), (1003, 1), (0, 0), (0, 1)], "doc_id long, toxic int")
    got = X.score(d, lab).collect()
    assert len(got) == len(docs) + len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert X.score(d.limit(0), lab).count() == 0
    assert {r["score"] for r in X.score(d, lab.limit(0)).collect()} == {0.0}


def test_vocabulary_places():
    doc, word, n = X.word_counts(__import__("pyarrow").array(["a b a", None, "c", "b"]))
    assert doc.tolist() == [0, 0, 2, 3] and sorted(n[:2].tolist()) == [1, 2]
    places = np.sort(np.array(word[doc == 3], dtype=U64))
    d2, w2, n2 = X.word_counts(__import__("pyarrow").array(["a b a", None, "c", "b"]), places)
    assert (d2.tolist(), w2.tolist(), n2.tolist()) == ([0, 3], [0, 0], [1, 1])


def test_nearest_is_exact_in_groups():
    r = random.Random(6)
    rows = []
    for i in range(300):
        lot = range(300 * (i % 3), 300 * (i % 3) + 400)
        w = sorted(r.sample(lot[:20], r.randrange(1, 8)) + r.sample(lot[20:], r.randrange(1, 6)))
        rows.append({"doc_id": i, "toxic": i % 2, "words": w, "counts": [r.randrange(1, 4) for _ in w]})
    df = [(k * 7 + 3, 1 + sum(k in x["words"] for x in rows)) for k in range(1000)]
    index = X.Index(df, rows, 300, nearest=10, block=8, weights=[1 + k % 3 for k in range(1000)], groups=3).arranged()
    assert [len(matrix) > 0 for _, _, _, matrix in index.dense] == [True] * 3 and len(index.posted)
    dense = np.zeros((300, 1000))
    for e, x in enumerate(rows):
        at, v = index.vector(np.array(x["words"]), np.array(x["counts"]))
        dense[e, at] = v
    queries = [index.vector(np.array(x["words"]), np.array(x["counts"])) for x in rows[:70]]
    for (w, q), (best, got) in zip(queries, index.nearest_of(queries, 10)):
        cosine = dense[:, w] @ q
        want = [e for e in np.lexsort((np.arange(300), -np.round(cosine, 12))) if cosine[e] > 0][:10]
        assert best.tolist() == want and np.allclose(got, cosine[want])
    # blocks of the other groups are skipped
    assert 0 < index.scored < index.wanted / 2 and index.wanted == 70 * (len(index.edges) - 1)


def test_cosines_are_of_the_full_text(spark):
    docs, labels = planted()
    more = [(9001, "vile " + " ".join(f"unseen{k}" for k in range(100))), (9002, prose(77, 60, 300)), (9003, "vile")]
    got = {r["doc_id"]: r for r in X.score(documents(spark, docs + more), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    bare, among = (max(e["cosine"] for e in got[i]["evidence"]) for i in (9003, 9001))
    assert among < bare - 0.01
    # a text without any telling word is searched too
    assert len(got[9002]["evidence"]) == 5 and not got[9002]["predicted"] and got[9003]["predicted"]


def test_most_examples_may_be_toxic(spark):
    r = random.Random(8)
    docs = [(i, prose(i, 60, 300) + (" vile nasty" * r.randrange(1, 3) if i % 5 < 3 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 < 3)) for i in range(300)], "doc_id long, toxic int")
    got = X.score(documents(spark, docs), labels).collect()
    assert all(x["predicted"] == int(x["doc_id"] % 5 < 3) for x in got)


def test_sample_is_bounded_in_rows_and_bytes(spark):
    """One id in half of all rows is one example; the texts together stay within the bytes."""
    docs = spark.range(0, 30_000, 1, 8).select("id", F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"))
    hot = spark.range(0, 30_000, 1, 8).select(F.lit(7).cast("long").alias("id"), F.concat(F.lit("other "), F.col("id").cast("string")).alias("text"))
    d = docs.unionAll(hot).withColumnRenamed("id", "doc_id")
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("toxic"))
    for most in (500, 2_000):
        rows = X.sample(d, labels, most)
        n, ids = rows.count(), rows.select("doc_id").distinct().count()
        assert n == ids and abs(n - most) < 0.15 * most
    assert X.sample(d, labels.where("doc_id < 100"), 2_000).where("doc_id = 7").count() == 1
    rows = X.sample(d, labels, 2_000)
    kept = X.within_bytes(rows, 5_000).agg(F.sum(F.octet_length("text"))).first()[0]
    assert 5_000 <= kept < 5_030 and X.within_bytes(rows, 1).count() == 1 and X.within_bytes(rows).count() == rows.count()


def test_query_equals_brute_force(spark):
    """Sample, weights, neighbours, votes, curve and score worked out plainly with numpy for every document."""
    docs, labels = planted()
    docs = docs + [(900, None), (901, ""), (902, "vile vile words nobody else has"), (903, docs[5][1])]
    got = {r["doc_id"]: r for r in X.score(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    truth = {i: y for i, y in labels if not held(i)}
    texts = {i: re.findall(r"[0-9a-z]+", (t or "").lower()) for i, t in docs}
    ids = sorted(truth)
    n, toxic = len(ids), sum(truth.values())
    words = sorted({w for i in ids for w in texts[i]})
    at = {w: k for k, w in enumerate(words)}
    df = np.array([sum(w in set(texts[i]) for i in ids) for w in words], float)
    tw = np.array([sum(w in set(texts[i]) for i in ids if truth[i]) for w in words], float)
    a, b, c, d = tw + .5, df - tw + .5, toxic - tw + .5, n - toxic - (df - tw) + .5
    tell = np.maximum(abs(np.log(a * d / (b * c))) - 2 * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d), 0.1)
    weight, unseen = (np.log(n / df) + 1) * tell, (np.log(n) + 1) * tell.min()

    def vector(tokens):
        v, rest = np.zeros(len(words)), 0.0
        for w in set(tokens):
            x = 1 + math.log(tokens.count(w))
            if w in at:
                v[at[w]] = x * weight[at[w]]
            else:
                rest += (x * unseen) ** 2
        return v / math.sqrt((v * v).sum() + rest) if tokens else v

    base = np.stack([vector(texts[i]) for i in ids])
    y = np.array([truth[i] for i in ids], float)
    prior = toxic / n  # no example is without words

    def vote(v, but=None):
        cos = base @ v
        best = [e for e in np.lexsort((np.arange(n), -np.round(cos, 12))) if cos[e] > 0 and e != but][:25]
        w = 1 / (0.1 + 1 - np.minimum(cos[best], 1))
        return ((w * y[best]).sum() + 2 / 1.1 * prior) / (w.sum() + 2 / 1.1), best

    left_out = np.array([vote(base[e], e)[0] for e in range(n)])
    index = X.Index([], [], 0)
    index.calibrate(left_out, y)  # the curve itself has its own test
    for i, t in docs:
        if not texts[i]:
            assert abs(got[i]["score"] - prior) < 1e-9 and not got[i]["evidence"]
            continue
        v, best = vote(vector(texts[i]))
        assert abs(got[i]["score"] - (0.5 * v + 0.5 * np.interp(v, *index.curve))) < 1e-6
        assert [e["doc_id"] for e in got[i]["evidence"]] == [ids[e] for e in best[:5]]
