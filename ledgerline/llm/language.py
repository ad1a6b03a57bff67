"""Language identification by rank-order profiles.

A text's letter n-grams (1 to 3 letters, word borders included) are counted and its
``top`` most frequent ones ranked.  Each language has such a ranking, made of the counts
over all its training texts.  A document goes to the language with the least
out-of-place distance: the sum over its n-grams of how far each stands from its place
in the language's ranking, ``top`` for those missing there.

Counting runs inside the tasks over whole texts; a task sends one count per language and
n-gram, so a hot language ships no more rows than any other.  The profiles (``top`` rows
per language) are the only thing broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every
text when nothing was learned; ties go to the first language in code point order; rows
with null language (or null id, when held out by id) teach nothing; repeated rows each
count and keep their row; extra columns pass through untouched.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import map_arrow
from .textarrays import U64, annotate, fresh_name, member, mix, slices, utf8

TOP = 300
UNDETERMINED = "und"
FOUND = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

_DOC_BITS, _GRAM_BITS = 14, 24
_GRAM = U64((1 << _GRAM_BITS) - 1)
_MOST = (1 << (64 - _DOC_BITS - _GRAM_BITS)) - 1
_SLICE = 1 << 18


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for everything else."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    try:
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        seen = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        return points, seen[offsets]
    except UnicodeDecodeError:  # bytes that are no UTF-8: every bad byte is one non-letter
        texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        return points, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, count) of every n-gram of every text, by text and n-gram."""
    points, offsets = _code_points(*utf8(texts))
    n = len(offsets) - 1
    # a border before each text and after the last
    where = np.arange(len(points)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    chars = np.zeros(len(points) + n + 1, dtype=U64)
    chars[where] = _letters()[points]
    doc = np.zeros(len(chars), dtype=U64)
    doc[where] = np.repeat(np.arange(n), np.diff(offsets)).astype(U64)
    a, b, c = chars[:-2], chars[1:-1], chars[2:]
    here = doc[1:-1]
    keys = []
    s21, s42 = U64(21), U64(42)
    for gram, ok, owner in ((b, b != 0, here),
                            (a | b << s21 | U64(1) << s42, b != 0, here),
                            (b | c << s21 | U64(1) << s42, (b != 0) & (c == 0), here),
                            (a | b << s21 | c << s42 | U64(1) << U64(63), b != 0, here)):
        at = np.flatnonzero(ok)
        keys.append(owner[at] << U64(_GRAM_BITS) | mix(gram[at]) & _GRAM)
    keys = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    return (keys >> U64(_GRAM_BITS)).astype(np.int64), (keys & _GRAM).astype(np.int64), counts


def _parts(batch, text):
    for part in slices(batch, text, _SLICE):
        for at in range(0, part.num_rows, 1 << _DOC_BITS):
            yield part.slice(at, 1 << _DOC_BITS)


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """The ``top`` n-grams of each language with their rank from 0: lang, gram, rank."""

    def count(batches):
        names: list[str] = []
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def add(k, grams, counts):
            if k in total:
                grams, counts = np.concatenate([total[k][0], grams]), np.concatenate([total[k][1], counts])
            u, at = np.unique(grams, return_inverse=True)
            total[k] = u, np.bincount(at, counts).astype(np.int64)

        for batch in batches:
            for part in _parts(batch, "text"):
                langs = part.column(0).to_pylist()
                names += [x for x in dict.fromkeys(langs) if x not in names]
                own = np.array([names.index(x) for x in langs])
                doc, gram, n = gram_counts(part.column(1))
                for k in np.unique(own):
                    mine = own[doc] == k
                    add(int(k), gram[mine], n[mine])
        for k, (gram, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([names[k]] * len(gram), pa.string()), pa.array(gram, pa.int64()),
                                              pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    taught = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = map_arrow(taught, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("rank", place).where(F.col("rank") < top).select("lang", "gram", "rank")


class Profiles:
    """The rankings of all languages as one lookup table."""

    def __init__(self, rows: list, top: int = TOP):
        self.top = top
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.array([r["gram"] for r in rows], dtype=np.int64))
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, dtype=np.int32)
        for r in rows:
            self.ranks[np.searchsorted(self.grams, r["gram"]), self.langs.index(r["lang"])] = r["rank"]

    def distances(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of each text to each language, and the ranked n-grams of each text."""
        doc, gram, n = gram_counts(texts)
        order = np.sort(doc.astype(U64) << U64(64 - _DOC_BITS)
                        | (_MOST - np.minimum(n, _MOST)).astype(U64) << U64(_GRAM_BITS) | gram.astype(U64))
        doc = (order >> U64(64 - _DOC_BITS)).astype(np.int64)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        rank = np.arange(len(doc)) - first[doc]
        doc, gram, rank = doc[rank < self.top], (order & _GRAM).astype(np.int64)[rank < self.top], rank[rank < self.top]
        at = member(gram, self.grams)
        size = np.bincount(doc, minlength=len(texts))
        out = np.zeros((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            there = np.where(at >= 0, self.ranks[at, k], -1)
            off = np.where(there >= 0, np.abs(there - rank), self.top)
            out[:, k] = np.bincount(doc, off, minlength=len(texts))
        return out, size

    def predict(self, texts: pa.Array) -> list[pa.Array]:
        if not self.langs:
            return [pa.array([UNDETERMINED] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))]
        far, size = self.distances(texts)
        best = far.argmin(axis=1)
        score = 1 - far[np.arange(len(far)), best] / np.maximum(size * self.top, 1)
        lang = [self.langs[b] if s else UNDETERMINED for b, s in zip(best.tolist(), size.tolist())]
        return [pa.array(lang, pa.string()), pa.array(np.where(size > 0, np.clip(score, 0, 1), 0.0))]


def annotated(docs: DataFrame, profiles: DataFrame, out: str, text: str = "text", top: int = TOP) -> DataFrame:
    """``docs`` with the struct column ``out``: lang, score (1: in place, 0: nothing shared)."""
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(profiles.collect(), top))

    def kernel(texts):
        made = [shared.value.predict(p.column(0)) for p in _parts(pa.RecordBatch.from_arrays([texts], names=["t"]), "t")]
        return [pa.concat_arrays(c) for c in zip(*made)]

    return annotate(docs, text, kernel, FOUND, out)


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text leaves no remainder by 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Learn from the rows that are not held out; predict every row."""
    profiles = learn_profiles(docs.where(~held_out(F.col(doc_id))), text, lang, top)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    p = annotated(d, profiles, "found", "text", top)
    return p.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                    F.col("found")["lang"].alias("lang_pred"), F.col("found")["score"].alias("score"))


def recognised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               min_score: float = 0.0, top: int = TOP) -> DataFrame:
    """The documents that have a language (score above ``min_score``), with their columns as they were."""
    profiles = learn_profiles(docs.where(~held_out(F.col(doc_id))), text, lang, top)
    out = fresh_name("__language", docs.columns)
    p = annotated(docs, profiles, out, text, top)
    return p.where((p[out]["lang"] != UNDETERMINED) & (p[out]["score"] > min_score)).select(*[p[c] for c in docs.columns])
