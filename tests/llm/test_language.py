"""Language profiles against a plain count, held-out accuracy, odd inputs."""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerline.llm import language as L
from ledgerline.llm.textarrays import U64, mix
from tests.llm.fixtures import clashing, documents, odd_texts

SF = "/root/testdata/sf0.001"


def grams(text):
    """Plain n-gram count: letters lowered, everything else a border."""
    chars = [0] + [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 0 for c in text] + [0]
    out = Counter()
    for i in range(1, len(chars) - 1):
        a, b, c = chars[i - 1:i + 2]
        if b:
            out[b] += 1
            out[a | b << 21 | 1 << 42] += 1
            out[a | b << 21 | c << 42 | 1 << 63] += 1
            if not c:
                out[b | 1 << 42] += 1
    hashed = Counter()
    for g, n in out.items():
        hashed[int(mix(np.array([g], dtype=U64))[0] & L._GRAM)] += n
    return hashed


def plain_distance(text, profile):
    ranked = sorted(grams(text).items(), key=lambda kv: (-kv[1], kv[0]))[:L.TOP]
    place = {g: i for i, (g, _) in enumerate(ranked)}
    return sum(abs(i - profile[g]) if g in profile else L.TOP for g, i in place.items())


TEXTS = ["The cat, the hat.", "", None, "Über straße ÉTÉ", "123 !?", "a", "aa aa ab"]


def test_counts_match_a_plain_count():
    doc, gram, n = L.gram_counts(pa.array(TEXTS))
    for i, t in enumerate(TEXTS):
        assert dict(zip(gram[doc == i].tolist(), n[doc == i].tolist())) == grams(t or "")


def test_distances_match_the_definition():
    rows = [{"lang": k, "gram": g, "rank": r} for k, t in (("x", "the cat sat on the mat"), ("y", "der hut und das tier"))
            for r, (g, _) in enumerate(sorted(grams(t).items(), key=lambda kv: (-kv[1], kv[0]))[:L.TOP])]
    profiles = L.Profiles(rows)
    far, _ = profiles.distances(pa.array(TEXTS))
    for k, lang in enumerate(profiles.langs):
        own = {r["gram"]: r["rank"] for r in rows if r["lang"] == lang}
        assert far[:, k].tolist() == [plain_distance(t or "", own) for t in TEXTS]


def test_profiles_count_all_training_texts(spark):
    docs = documents(spark, [(1, "the cat"), (2, "the hat"), (3, "der hut"), (4, "the the")], {3: "de", 4: None})
    got = {(r["lang"], r["rank"]): r["gram"] for r in L.learn_profiles(docs).collect()}
    for lang, texts in (("en", ["the cat", "the hat"]), ("de", ["der hut"])):
        total = sum((grams(t) for t in texts), Counter())
        want = sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:L.TOP]
        assert [got[lang, i] for i in range(len(want))] == [g for g, _ in want]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = L.identify(docs).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_odd_texts(spark):
    docs = clashing(documents(spark, odd_texts(), {4: None, 6: "fr"}))
    got = L.identify(docs).collect()
    assert len(got) == len(odd_texts())
    und = sorted(str(r["doc_id"]) for r in got if r["lang_pred"] == "und")
    assert und == ["1", "11", "2", "3", "None"] and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = L.recognised(docs)
    assert kept.schema == docs.schema and kept.count() == len(odd_texts()) - len(und)
    none = docs.limit(0)
    assert L.identify(none).count() == 0 and L.recognised(none).count() == 0
    untaught = L.identify(docs.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
