"""Benchmark decontamination by winnowing.

Every ``k``-word gram of a text has a hash; of each window of ``w`` consecutive gram
hashes the minimum is kept as a fingerprint.  Two texts that share ``k + w - 1`` = 13
words in a row share such a window and therefore its minimum, so joining fingerprints
finds every shared span of 13 or more words.  A hit is extended to the 13-word windows
around it, and the windows' words are compared exactly.

A benchmark of at most ``BLOCK_WINDOWS`` windows is broadcast, and the documents stream past it
map-side, whole, without a shuffle.  A larger one is joined: documents' fingerprints (one for
each run of windows that keeps the same minimum) meet the benchmark's in a plain join, only the
windows around hits are looked up again, and those are joined with the benchmark's windows by
their words.  Texts are known by their SHA-256 there, so copies are looked up once; the
benchmark's side of each join has a fingerprint or window once an item, and Spark splits
what a passage in a third of the documents brings on the other side.  Nothing of a large
benchmark reaches the driver.

Defined cases: null and empty texts have no words, no hits and are not contaminated;
items without words match nothing; an item of fewer than 13 words is one window of its
own length; repeated items and repeated document rows each keep their row and ids;
null ids are kept (a null ``item_id`` names no item, its windows still hit); extra
columns are ignored by ``scan`` and kept by ``decontaminated``; a very long text is a slice of
its own and taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import map_arrow
from .tables import staged
from .textarrays import ALPHANUMERIC, U64, Words, annotate, fresh_name, member, mix, ngrams, run_starts, slices, utf8

WINDOW_WORDS = 13
GRAM_WORDS = 5
#: windows of a benchmark that is broadcast (about 200 bytes each in a worker)
BLOCK_WINDOWS = 200_000

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()),
                                                    T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``n`` values, by doubling."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def window_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``n`` consecutive words of one text."""
    pos, _ = run_starts(words.first, n)
    return pos, ngrams(words.hash, n)[pos]


def gram_minima(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and least gram hash of every window."""
    pos, _ = run_starts(words.first, window)
    if not len(pos):
        return pos, np.zeros(0, dtype=U64)
    least = _sliding(ngrams(words.hash, gram), window - gram + 1, np.minimum)
    return pos, least[pos]


def item_windows(items: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """Windows of the benchmark: length, hash, fingerprint, words and item."""
    schema = "n int, hash long, fingerprint long, words binary, item string"

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(*utf8(part.column(1)), ALPHANUMERIC)
                ids = part.column(0).to_pylist()
                rows = []
                for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                    if b - a:
                        n = min(window, int(b - a))
                        own = Words(w.bytes[w.start[a]:w.end[b - 1]], np.array([0, w.end[b - 1] - w.start[a]]), ALPHANUMERIC)
                        pos, h = window_hashes(own, n)
                        mins = gram_minima(own, n, gram)[1] if n == window else np.zeros(len(pos), dtype=U64)
                        rows += [(n, x, m, own.text(p, p + n), ids[i]) for p, x, m in
                                 zip(pos.tolist(), h.astype(np.int64).tolist(), mins.astype(np.int64).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5,
                                                    (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string()))],
                    names=["n", "hash", "fingerprint", "words", "item"])

    return map_arrow(items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")), run, schema)


class Block:
    """Lookup tables of one block of benchmark windows."""

    def __init__(self, rows: list, window: int, gram: int):
        self.window, self.gram = window, gram
        by: dict = {}
        for r in rows:
            by.setdefault(r["n"], {}).setdefault((r["hash"], bytes(r["words"])), set()).add(r["item"])
        self.hashes, self.entries = {}, {}
        for n, found in by.items():
            order = sorted(found, key=lambda k: k[0] & 0xFFFFFFFFFFFFFFFF)
            h = np.array([k[0] for k in order], dtype=np.int64).astype(U64)
            self.hashes[n], first = np.unique(h, return_index=True)
            ends = np.append(first[1:], len(order))
            self.entries[n] = [[(order[j][1], sorted(x for x in found[order[j]] if x is not None)) for j in range(a, b)]
                               for a, b in zip(first, ends)]
        marks = np.array([r["fingerprint"] for r in rows if r["n"] == window], dtype=np.int64).astype(U64)
        self.marks = np.unique(marks)
        self.sieve = np.zeros(1 << 20, dtype=bool)  # first look: the low bits of the fingerprints
        self.sieve[(self.marks & U64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Window length, start positions and index of the equal benchmark hash."""
        for n, known in self.hashes.items():
            if n == self.window:
                starts = self._near_fingerprints(w)
            else:
                starts, _ = run_starts(w.first, n)
            if len(starts):
                h = np.zeros(len(starts), dtype=U64)
                for j in range(n):
                    h = h * U64(0x9E3779B97F4A7C15) + w.hash[starts + j]
                at = member(mix(h + U64(n)), known)
                yield n, starts[at >= 0], at[at >= 0]

    def _near_fingerprints(self, w: Words) -> np.ndarray:
        """Starts of the windows that carry a fingerprint the benchmark has too."""
        pos, least = gram_minima(w, self.window, self.gram)
        if not len(pos):
            return pos
        # consecutive windows mostly keep the same gram: one fingerprint per run
        new = np.ones(len(least), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (pos[1:] != pos[:-1] + 1)
        kept = least[new]
        shared = self.sieve[(kept & U64((1 << 20) - 1)).astype(np.int64)]
        shared[shared] = member(kept[shared], self.marks) >= 0
        return pos[shared[np.cumsum(new) - 1]]

    def find(self, texts: pa.Array) -> list[pa.Array]:
        w = Words(*utf8(texts), ALPHANUMERIC)
        hits: dict[int, list] = {}
        items: dict[int, set] = {}
        for n, starts, at in self.candidates(w):
            doc = np.searchsorted(w.first, starts, "right") - 1
            for s, k, d in zip(starts.tolist(), at.tolist(), doc.tolist()):
                words = w.text(s, s + n)
                for known, names in self.entries[n][k]:
                    if known == words:
                        hits.setdefault(d, []).append((s - int(w.first[d]), s - int(w.first[d]) + n))
                        items.setdefault(d, set()).update(names)
        rows = range(len(texts))
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return [pa.array(w.counts(), pa.int64()),
                pa.array([[{"first": a, "end": b} for a, b in united(hits.get(i, ()))] for i in rows], span),
                pa.array([sorted(items.get(i, ())) for i in rows], pa.list_(pa.string()))]


def united(spans) -> list[tuple[int, int]]:
    """Overlapping and touching [first, end) ranges as disjoint ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _digest(text) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def document_marks(texts: DataFrame, window: int, gram: int, lengths: list[int]) -> DataFrame:
    """(row, n, mark, first, end): the fingerprints of texts (row, text) and the starts of the windows that
    keep each; for the ``lengths`` below ``window``, the hash and start of every window."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(*utf8(part.column(1)), ALPHANUMERIC)
                pos, least = gram_minima(w, window, gram)
                new = np.ones(len(pos), dtype=bool)
                new[1:] = (least[1:] != least[:-1]) | (pos[1:] != pos[:-1] + 1)
                first = np.flatnonzero(new)
                found = [(window, least[first], pos[first], pos[np.append(first[1:], len(pos)) - 1] + 1)] if len(pos) else []
                for n in lengths:
                    at, h = window_hashes(w, n)
                    found.append((n, h, at, at + 1))
                for n, mark, start, end in found:
                    doc = np.searchsorted(w.first, start, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(doc)), pa.array(np.full(len(doc), n), pa.int32()), pa.array(mark.astype(np.int64)),
                         pa.array(start - w.first[doc], pa.int32()), pa.array(end - w.first[doc], pa.int32())],
                        names=["row", "n", "mark", "first", "end"])

    return map_arrow(texts, run, "row binary, n int, mark long, first int, end int")


def wanted_windows(texts: DataFrame) -> DataFrame:
    """(row, n, at, hash, words) of the windows whose starts are wanted: texts (row, text, spans of n, first, end)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(*utf8(part.column(1)), ALPHANUMERIC)
                rows = []
                for i, spans in enumerate(part.column(2).to_pylist()):
                    base = int(w.first[i])
                    for n, at in sorted({(s["n"], p) for s in spans for p in range(s["first"], s["end"])}):
                        own = w.hash[base + at:base + at + n]
                        rows.append((i, n, at, int(ngrams(own, n).astype(np.int64)[0]), w.text(base + at, base + at + n)))
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())], names=["row", "n", "at", "hash", "words"])

    return map_arrow(texts, run, "row binary, n int, at int, hash long, words binary")


def joined_hits(docs: DataFrame, windows: DataFrame, text: str, window: int, gram: int, lengths: list[int]) -> DataFrame:
    """(row, hits, items) of the texts that hold a window of the benchmark, by joins of fingerprints and of windows."""
    texts = docs.select(_digest(docs[text]).alias("row"), docs[text].alias("text"))
    known = windows.select("n", F.when(F.col("n") == window, F.col("fingerprint")).otherwise(F.col("hash")).alias("mark")).distinct()
    met = document_marks(texts, window, gram, lengths).join(known, ["n", "mark"], "left_semi")
    spans = staged(met.groupBy("row").agg(F.collect_set(F.struct("n", "first", "end")).alias("spans")), "benchmark-spans")
    near = texts.join(spans, "row").select("row", "text", "spans")
    hits = wanted_windows(near).join(windows.select("n", "hash", "words", "item"), ["n", "hash", "words"])
    span = F.struct(F.col("at").alias("first"), (F.col("at") + F.col("n")).alias("end"))
    found = hits.groupBy("row").agg(_merged(F.collect_set(span)).alias("hits"), F.array_sort(F.collect_set("item")).alias("items"))
    return staged(found, "benchmark-hits")


def _counted(texts: pa.Array) -> list[pa.Array]:
    return [pa.array(Words(*utf8(texts), ALPHANUMERIC).counts(), pa.int64())]


def annotated(docs: DataFrame, items: DataFrame, out: str, text: str = "text", item_id: str = "item_id",
              item_text: str = "text", window: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
              block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, hits (disjoint word ranges), items."""
    sc = docs.sparkSession.sparkContext
    windows = staged(item_windows(items, item_id, item_text, window, gram).distinct(), "benchmark-windows")

    def beside(windows, name):
        shared = sc.broadcast(Block(windows.collect(), window, gram))  # block_windows rows at most
        return annotate(docs, text, lambda texts: shared.value.find(texts), FOUND, name)

    if windows.count() <= block_windows:
        return beside(windows, out)
    short = windows.where(F.col("n") < window)
    lengths = [] if short.count() <= block_windows else sorted(r["n"] for r in short.select("n").distinct().collect())
    hits = joined_hits(docs, windows if lengths else windows.where(F.col("n") == window), text, window, gram, lengths)
    own = fresh_name("__own", docs.columns)
    if lengths:
        n_words = T.StructType(FOUND.fields[:1])
        rows = annotate(docs, text, _counted, n_words, own)
        held = F.array().cast(FOUND["hits"].dataType), F.array().cast(FOUND["items"].dataType)
    else:  # the items of less than a window are few: they are looked up map-side
        rows = beside(short, own)
        held = F.col(own)["hits"], F.col(own)["items"]
    names = {c: fresh_name(f"__{c}", rows.columns) for c in hits.columns}
    hits = hits.toDF(*names.values())
    met = rows.join(hits, _digest(rows[text]) == F.col(names["row"]), "left")
    more = F.coalesce(names["hits"], F.array()), F.coalesce(names["items"], F.array())
    return met.select(*docs.columns, F.struct(
        F.col(own)["n_words"].alias("n_words"), _merged(F.concat(held[0], more[0])).alias("hits"),
        F.array_sort(F.array_distinct(F.concat(held[1], more[1]))).alias("items")).alias(out))


def _merged(spans):
    """Disjoint ranges of an array of ranges (sorted, then folded)."""
    zero = F.array().cast("array<struct<first:int,end:int>>")

    def put(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        joins = F.coalesce(last["end"] >= s["first"], F.lit(False))
        longer = F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))) \
                .otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), zero, put)


def _n_hit(found):
    return F.aggregate(found["hits"], F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["first"]).cast("long"))


def scan(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: word and hit counts, hit spans, item ids, verdict.

    A document is contaminated if at least one word and at least a twentieth of its
    words lie in shared windows.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    f = annotated(d, items, "found", text="text", **options)
    found = F.col("found")
    f = f.select("doc_id", found["n_words"].alias("n_words"), _n_hit(found).alias("n_hit"),
                 F.size(found["items"]).cast("long").alias("n_items"),
                 F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
                 found["hits"].alias("hits"), found["items"].alias("items"))
    return f.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    out = fresh_name("__found", docs.columns)
    f = annotated(docs, items, out, text=text, **options)
    n_hit = _n_hit(F.col(out))
    bad = (n_hit > 0) & (20 * n_hit >= F.col(out)["n_words"])
    return f.where(~bad).select(*[f[c] for c in docs.columns])
