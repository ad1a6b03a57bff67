"""Vector codes: against a plain version with whole numbers, block by block and end to end."""
from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import veccodes as V
from tests.llm.fixtures import CLASHING, clashing

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def plain_version(rows, positions=16, entries=64, rounds=2):
    """Codes and codebooks of (id, vector) with Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // positions))
    most = 1 << 62
    whole = []
    for r in kept:
        v = [max(-most, min(most, math.floor(256 * x) if abs(x) < 1e300 else (most if x > 0 else -most))) for x in r[1]]
        v += [0] * (positions * width - len(v))
        whole.append([v[p * width:(p + 1) * width] for p in range(positions)])
    books = [[whole[i][p] for i in range(min(entries, len(kept)))] for p in range(positions)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(positions):
            members = {}
            for w in whole:
                members.setdefault(best(w[p], books[p])[1], []).append(w[p])
            for k, m in members.items():
                books[p][k] = [sum(c) // len(m) for c in zip(*m)]
    out = []
    for r, w in zip(kept, whole):
        found = [best(w[p], books[p]) for p in range(positions)]
        out.append((r[0], "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), (1 << 63) - 1), r[2]))
    return out, books


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def order(r):
    return tuple("" if v is None else str(v) for v in r)


def check(spark, rows, **kw):
    df = table(spark, rows)
    books = V.learned(df, **kw)
    got = sorted((tuple(r) for r in V.encoded(df, books).select("vec_id", "coded.code", "coded.error", "label").collect()), key=order)
    want, plain = plain_version(rows, **kw)
    assert books.entries.tolist() == plain
    assert got == sorted(want, key=order)


def vectors(n, size, seed=1):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 0.3) for _ in range(size)], r.choice([None, 1, 2, 3])) for i in range(n)]


def odd_rows():
    """Nulls, non-finite components, equal ids, equal rows, no id, other lengths; a third of all are equal."""
    rows = vectors(150, 32, 2)
    rows += [(1000, None, 1), (1001, [None] * 32, 1), (1002, [0.1] * 31 + [math.nan], 2), (1003, [math.inf] + [0.0] * 31, 2),
             (1004, [0.1] * 31 + [None], None), (3, [0.25] * 32, 1), (3, [0.25] * 32, 1), (3, [-0.25] * 32, None),
             (None, [0.5] * 32, None), (None, None, None), (1005, [], 1), (1006, [0.5] * 7, 1), (1007, [-0.001953125] * 32, 3)]
    return rows + [(2000 + i, [0.125] * 32, 4) for i in range(80)]


@pytest.mark.parametrize("salted", [False, True])
def test_equals_plain_version(spark, salted, monkeypatch):
    if salted:
        monkeypatch.setattr(V, "RESIDENT", 10)
        monkeypatch.setattr(V, "BLOCK_BYTES", 16)
    check(spark, odd_rows())


def test_other_parameters(spark):
    check(spark, vectors(90, 30), positions=4, entries=9, rounds=4)
    check(spark, vectors(40, 8), positions=8, entries=300, rounds=1)
    check(spark, vectors(40, 8), positions=8, entries=5, rounds=0)


def test_fewer_vectors_than_entries_and_huge_components(spark):
    check(spark, vectors(5, 16))
    check(spark, [(i, [x * 10.0 ** (3 * i) for x in v], None) for i, v, _ in vectors(12, 16, 4)], entries=4)
    check(spark, [(1, [1e308] * 16, 1), (2, [-1e308] * 16, 1), (3, [0.0] * 16, 1), (4, [3e16] * 16, 2)], entries=2)


def test_only_changed_parts_migrate(spark):
    """Members that keep their entry are not in the second shuffle; together they are all parts."""
    df = table(spark, vectors(400, 32)).select(F.col("embedding").alias("vector"))
    first, n = V.first_codebooks(table(spark, vectors(400, 32)), "vec_id", "embedding", 16, 64)
    sc = spark.sparkContext
    members = V.at_owners(V.placed(df, sc.broadcast(first), n))
    books = sc.broadcast(V.updated(members, sc.broadcast(first)))
    seen = V.staged(V.compared(members, books), "compared-parts")
    parts = {r["moved"]: r["n"] for r in seen.groupBy("moved").agg(F.sum(F.length("parts") / F.col("bytes") / 2).cast("long").alias("n")).collect()}
    assert parts[True] + parts[False] == 400 * 16 and 0 < parts[True] < parts[False]
    files = members.select("position", "entry", "salt", F.input_file_name().alias("file")).distinct()
    owners = files.groupBy("position", "entry", "salt").agg(F.count(F.lit(1)).alias("n"))
    assert owners.agg(F.max("n")).first()[0] == 1


def test_blocks_round_trip():
    r = np.random.default_rng(1)
    parts = np.concatenate([r.integers(-100, 100, (500, 3)), r.integers(-40_000, 40_000, (50, 3)), [[1 << 62, -(1 << 62), 5]]])
    n = len(parts)
    position, entry, salt = r.integers(0, 4, n), r.integers(0, 3, n), r.integers(0, 2, n)
    batch = V.to_blocks(parts, position, entry, salt, r.integers(0, 2, n).astype(bool), 3)
    back = np.column_stack([c.reshape(n, -1) for c in V.from_blocks(batch, 3)])
    want = np.column_stack([parts, position, entry, salt])
    assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, want.tolist()))


def test_label_errors(spark):
    rows = [(i, None if i % 3 == 0 else i % 3, i) for i in range(30)] + [(99, 7, (1 << 63) - 1), (98, 7, 5)]
    df = spark.createDataFrame(rows, "vec_id long, label int, error long")
    got = {r["label"]: r["label_error"] for r in V.with_label_error(df).collect()}
    assert got == {None: 135, 1: 145, 2: 155, 7: (1 << 63) - 1} and V.with_label_error(df).count() == 32


def test_clashing_columns_and_empty_table(spark):
    df = clashing(table(spark, odd_rows()).drop("label")).withColumn("coded", F.lit("mine")).withColumn("entry", F.lit(1))
    made = V.encoded(df, V.learned(df))
    assert made.columns[:-1] == df.columns and made.columns[-1] != "coded"
    assert made.where("coded = 'mine' and entry = 1 and " + " and ".join(f"{c} = '{c}-kept'" for c in CLASHING)).count() == made.count() > 0
    none = df.limit(0)
    assert V.encoded(none, V.learned(none)).collect() == []
    unusable = table(spark, [(1, None, 1), (2, [None], 1)])
    assert V.encoded(unusable, V.learned(unusable)).collect() == []


def test_floats_and_slices():
    got = V.whole_parts(pa.array([[9.0], [0.1, -0.1], [0.00390625, -1e-30]], pa.list_(pa.float32())).slice(1), 2, 1)
    assert got.tolist() == [[[25], [-26]], [[1], [-1]]]
