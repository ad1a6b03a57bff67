"""Small document tables for the corpus operators."""
from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: columns that operators also use inside or return
CLASHING = ["found", "score", "n_words", "part", "key", "label", "node", "size", "place", "out", "f", "s", "kept"]


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def documents(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or {}).get(i, "en"), (sources or {}).get(i, f"s{(i or 0) % 3}"), len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def odd_texts():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, strange characters."""
    long = prose(1, 60_000)
    base = prose(2, 120)
    return [(1, None), (2, ""), (3, " \t\n\x0b "), (4, base), (5, base), (5, base), (6, base + " tail"), (7, "one two"),
            (8, long), (None, prose(3, 80)), (None, None), (9, "É́ ß ǅ     x 123 <|endoftext|>y"), (10, "a" * 70_000),
            (11, "...!!! ###"), (12, prose(4, 13)), (13, "ONE Two\x1fthree"),
            (14, "nul\x00inside a\x00 word\x00 \x00 here Ünd <|endoftext|> it's 3rd")]


def clashing(df):
    for c in CLASHING:
        df = df.selectExpr("*", f"'{c}-kept' AS {c}")
    return df
