"""Weak labels: recovered accuracies, agreement with gold labels that were never read, odd inputs."""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import quality as Q
from ledgerline.llm.textarrays import U64, mix
from tests.llm.fixtures import clashing, documents, odd_texts, prose

SF = "/root/testdata/sf0.01"


def test_em_recovers_accuracies():
    r = np.random.default_rng(3)
    truth = r.random(20_000) < 0.7
    right = np.array([0.95, 0.85, 0.75, 0.9, 0.65])
    votes = np.where(r.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[r.random((20_000, 5)) < 0.3] = -1
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.LabelModel(rows, counts.astype(float))
    assert abs(model.share - 0.7) < 0.03 and np.abs(model.accuracies() - right[:, None]).max() < 0.06
    place = {tuple(v): p for v, p in zip(rows.tolist(), model.posterior)}
    assert np.mean([(place[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth)]) > 0.9


def test_agreement_with_gold_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = {r["doc_id"]: r for r in Q.classify(docs).collect()}
    assert len(got) == docs.count()
    pairs = [(truth[d], got[d]["kept"]) for d in truth]
    good = [k for y, k in pairs if y]
    bad = [k for y, k in pairs if not y]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.3


def test_votes():
    names = [f.__name__[1:] for f in Q.LABELLERS]
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" + "." * (i % 8 == 7) for i in range(80))
    texts = pa.array([None, plain, "AB## CD$$ " * 30, "same line here\n" * 10])
    votes = [dict(zip(names, r.tolist())) for r in Q.votes_of(texts)]
    assert set(votes[0].values()) == {-2}
    assert set(votes[1].values()) <= {1, -1, -2}
    assert (votes[2]["few_marks"], votes[2]["few_capitals"], votes[2]["varied_words"]) == (0, 0, 0) and votes[3]["varied_lines"] == 0


def test_statistics():
    s = {k: v.tolist() for k, v in Q.statistics(pa.array(["Ab é!\nAb x.", None, "\n\na a\n"])).items()}
    assert (s["chars"], s["letters"], s["capitals"]) == ([11, 0, 6], [6, 0, 2], [2, 0, 0])
    assert (s["words"], s["own_words"], s["lines"], s["own_lines"]) == ([4, 0, 2], [3, 0, 1], [2, 0, 1], [2, 0, 1])
    assert (s["marks"], s["stops"]) == ([1, 0, 0], [2, 0, 0])


def test_odd_inputs(spark):
    docs = clashing(documents(spark, odd_texts()))
    got = Q.classify(docs).collect()
    assert len(got) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["kept"] for r in got if r["doc_id"] in (1, 2))
    assert Q.classify(docs.limit(0)).count() == 0


def test_sample_is_a_bound_and_keeps_the_common_text(spark):
    """Half of all rows are one text, a tenth another: the sample keeps its size and stands for all rows."""
    own = spark.range(0, 30_000, 1, 8).select(F.concat(F.lit("own text "), F.col("id").cast("string")).alias("text"))
    docs = own.unionAll(spark.range(0, 30_000, 1, 8).select(F.lit("one text").alias("text"))) \
              .unionAll(spark.range(0, 6_000, 1, 8).select(F.lit(None).cast("string").alias("text")))
    for most in (1_000, 10_000):
        rows = Q.sample_texts(docs, most).collect()
        weight = {r["text"]: r["weight"] for r in rows}
        assert len(weight) == len(rows) and abs(len(rows) - most) < 0.1 * most
        assert weight["one text"] == 30_000 and weight[""] == 6_000
        assert abs(sum(weight.values()) - 66_000) < 0.1 * 66_000
    assert {r["weight"] for r in Q.sample_texts(own, 50_000).collect()} == {1.0}


# ------------------------------------------------------------------ the whole query, plainly
def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def plain_votes(t):
    words = re.findall(r"[^ \t-\r]+", lower(t))
    lines = re.findall(r"[^\n]+", lower(t))
    letters = sum("A" <= c <= "Z" or "a" <= c <= "z" or ord(c) >= 0xC0 for c in t)
    capitals = sum("A" <= c <= "Z" for c in t)
    marks = sum(c in "#$%&*+/<=>@[\\]^_`{|}~!" for c in t)
    stops = sum(c in ".!?" for c in t)
    repeats = sum(a == b for a, b in zip(words, words[1:]))

    def vote(good, bad, short):
        return -2 if short else 0 if bad else 1 if good else -1

    share, mean, pause = len(set(words)) / max(len(words), 1), letters / max(len(words), 1), len(words) / max(stops, 1)
    return (vote(False, marks > 0.04 * len(t), len(t) < 10), vote(False, capitals > 0.4 * letters, letters < 10),
            vote(False, len(set(lines)) < 0.7 * len(lines), len(lines) < 4), vote(share > 0.3, share < 0.15, len(words) < 20),
            vote(False, repeats > 0.2 * len(words), len(words) < 5), vote(False, mean < 2 or mean > 14, not words),
            vote(False, letters < 0.6 * len(t), len(words) < 5), vote(2 <= pause <= 40 and stops > 0, pause > 120, len(words) < 8),
            vote(marks < 0.01 * len(t) and capitals < 0.15 * letters, False, not t))


def plain_posteriors(patterns):
    """EM over pattern counts with plain loops; posterior of each pattern."""
    share, k = 0.8, len(next(iter(patterns)))
    chance = {1: [{1: 0.7, 0: 0.02, -1: 0.28} for _ in range(k)], 0: [{1: 0.5, 0: 0.4, -1: 0.1} for _ in range(k)]}
    for _ in range(200):
        post = {}
        for p in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(chance[1][j][v] / chance[0][j][v]) for j, v in enumerate(p) if v != -2)
            post[p] = 1 / (1 + math.exp(-max(-500, min(500, odds))))
        total = sum(patterns.values())
        share = max(0.01, min(0.99, sum(n * post[p] for p, n in patterns.items()) / total))
        for c in (1, 0):
            w = {p: n * (post[p] if c else 1 - post[p]) for p, n in patterns.items()}
            for j in range(k):
                spoke = sum(x for p, x in w.items() if p[j] != -2)
                for v in (1, 0, -1):
                    chance[c][j][v] = (sum(x for p, x in w.items() if p[j] == v) + 1) / (spoke + 3)
        for j in range(k):
            chance[0][j][0] = max(chance[0][j][0], min(Q.BETTER * chance[1][j][0], 0.9))
            chance[1][j][1] = max(chance[1][j][1], chance[0][j][1])
            for c in (1, 0):
                s = sum(chance[c][j].values())
                chance[c][j] = {v: x / s for v, x in chance[c][j].items()}
    return post


def plain_shapes(t):
    raw = [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in t.encode()]
    row = np.zeros(Q.DIMENSIONS)
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        row[int(mix(np.array([a | b << 8 | c << 16], dtype=U64))[0]) % (Q.DIMENSIONS - 20)] += 1
    row = np.sqrt(row / max(row.sum(), 1))
    words = re.findall(r"[^ \t-\r]+", lower(t))
    share = min(math.log1p(max(len(set(words)), 1)) / math.log1p(max(len(words), 1)), 1.0)
    row[Q.DIMENSIONS - 20 + int(min(math.log2(len(raw) + 1), 15.9) // 2)] = 1
    row[Q.DIMENSIONS - 12 + int(share * 11.99)] = 1
    return row


def test_query_equals_brute_force(spark):
    """Votes, EM, training and scores of every row, with plain loops."""
    texts = [t for _, t in odd_texts() if t is None or len(t) < 5000]
    texts += [prose(i, 30 + i, 200) + "." for i in range(40)] + ["AB## CD$$ " * (5 + i) for i in range(15)] + ["spam spam " * 30] * 7
    texts += ["\n".join(["same line here"] * 6) + f"\n{i}" for i in range(10)] + ["È un té. " * 12]
    got = Q.classify(documents(spark, list(enumerate(texts)))).collect()
    plain = [t or "" for t in texts]
    votes = [plain_votes(t) for t in plain]
    post = plain_posteriors(Counter(votes))
    x, y = np.stack([plain_shapes(t) for t in plain]), np.array([post[v] for v in votes])
    w, b, vw, vb = np.zeros(Q.DIMENSIONS), 0.0, np.zeros(Q.DIMENSIONS), 0.0
    for _ in range(Q.EPOCHS):
        gap = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        vw, vb = 0.9 * vw - (gap @ x / len(y) + 1e-5 * w), 0.9 * vb - gap.mean()
        w, b = w + vw, b + vb
    want = np.where([t == "" for t in plain], 0.0, 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))))
    assert len(got) == len(texts) and len(set(votes)) > 5
    for r in got:
        assert abs(r["score"] - want[r["doc_id"]]) < 2e-3 and r["kept"] == (r["score"] >= 0.5)
