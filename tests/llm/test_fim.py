"""Fill in the middle: cuts, forms and outputs against a plain version, and exact restoring."""
from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fim
from tests.llm.fixtures import CLASHING, clashing, documents, odd_texts

MARKED = [(100 + i, t) for i, t in enumerate(["<", "<P", "a<P>b", "<S>", "x<M>", "<<<>>>", "P><S", "<P<S<M" * 9, "\xff\x80ÿ"])]


def plain_version(doc_id, text, seed=1, units=list, plain=10, spm=20):
    text = text or ""
    u = units(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not u or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return (doc_id, len(u), "plain", None, None, text)
    if h[3] % 100 < spm:
        return (doc_id, len(u), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, len(u), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def columns(df):
    return [tuple(r) for r in df.select("doc_id", "fim.n", "fim.form", "fim.prefix_units", "fim.middle_units", "fim.output").collect()]


def key(r):
    return tuple("" if v is None else str(v) for v in r)


def many():
    r = random.Random(5)
    alphabet = "ab <>PSM\n\té𝄞ß\x00漢"
    return [(1000 + i, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))) for i in range(400)]


def test_equals_plain_version(spark):
    texts = odd_texts() + MARKED + many()
    got = columns(fim.fill_in_middle(documents(spark, texts)))
    assert sorted(got, key=key) == sorted((plain_version(*t) for t in texts), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit, units", [("word", lambda t: re.findall(r"[^ \t-\r]+[ \t-\r]*|[ \t-\r]+", t)),
                                         ("line", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t))])
def test_other_units(spark, unit, units):
    texts = [(i, t.replace("\x1f", "").replace("\x0b", "")) for i, t in many()]
    got = columns(fim.fill_in_middle(documents(spark, texts), unit=unit, seed=7, plain_percent=30, spm_percent=50))
    want = [plain_version(i, t, 7, units, 30, 50) for i, t in texts]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_restores_every_text(spark):
    texts = odd_texts() + MARKED + many()
    made = fim.fill_in_middle(documents(spark, texts))
    back = made.select(fim.restored(F.col("fim.form"), F.col("fim.output")).eqNullSafe(F.coalesce("text", F.lit(""))).alias("same"))
    assert [r.same for r in back.collect()] == [True] * len(texts)


def test_clashing_columns_and_empty_table(spark):
    docs = clashing(documents(spark, odd_texts())).withColumn("fim", F.lit("mine"))
    made = fim.fill_in_middle(docs)
    assert made.columns[:-1] == docs.columns and made.columns[-1] != "fim"
    assert {r.fim for r in made.select("fim").distinct().collect()} == {"mine"}
    assert made.where(" and ".join(f"{c} = '{c}-kept'" for c in CLASHING)).count() == docs.count()
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_one_narrow_stage(spark):
    plan = fim.fill_in_middle(documents(spark, [(1, "a")]).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_slices_of_any_offset():
    """A slice of a longer array: offsets do not start at zero."""
    texts = pa.array(["skipped", None, "héllo", "", "x" * 9]).slice(1)
    draws = [pa.array([3, 5, 9, 12], pa.int64()), pa.array([4, 1, 8, 2], pa.int64())] + [pa.array([0] * 4, pa.int64())] * 2
    n, form, first, middle, output = fim.arrange(texts, draws, fim.UNITS["char"], 10, 0)
    assert n.to_pylist() == [0, 5, 0, 9] and form.to_pylist() == ["plain", "psm", "plain", "psm"]
    assert (first.to_pylist()[1], middle.to_pylist()[1], output.to_pylist()[1]) == (1, 4, "<P>h<S><M>éllo")
