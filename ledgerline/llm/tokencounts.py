"""Token counts by a map-side two-tier lookup.

First tier: a compact hash table of the lengths (in tokens) of frequent pre-tokens,
broadcast.  Every task summarises the pre-tokens of its part in bounded memory and sends
only its ``PER_TASK`` most frequent ones; the best ``FREQUENT`` of all make the table, so
no pre-token is shuffled and the table has a fixed size (2.6 MB).  Second tier: each worker
encodes what the table lacks with the library and keeps the lengths.  What is in the table
only changes the speed: both tiers hold exact lengths.

Defined cases: null texts are empty (0 bytes, 0 tokens); repeated rows each keep their
row; null ids are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import PreTokens, Slots, count, shared_vocabulary, slots
from .shipping import map_arrow
from .textarrays import PRETOKENS, Words, slices, utf8

FREQUENT = 65_536
PER_TASK = 4_096
#: slots of the frequent table
TABLE_BITS = 18
LONGEST = 64
#: distinct pre-tokens a task counts before it drops those seen least
COUNTED = 200_000


def frequent_pretokens(docs: DataFrame, text: str = "text", most: int = FREQUENT, per_task: int = PER_TASK) -> DataFrame:
    """(word, n): the pre-tokens found most often by the tasks' summaries."""

    def summarise(batches):
        seen: Counter = Counter()
        for batch in batches:
            for piece in slices(batch, "text"):
                w = PreTokens(*utf8(piece.column(0)))
                _, first, n = np.unique(w.hash, return_index=True, return_counts=True)
                often = n > max(1, len(w.hash) // 50_000)  # once in a slice is not frequent
                for at, k in zip(first[often].tolist(), n[often].tolist()):
                    seen[w.bytes[w.start[at]:w.end[at]].tobytes()] += k
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        best = [(w, n) for w, n in seen.most_common(per_task) if len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()),
                                          pa.array([n for _, n in best], pa.int64())], names=["word", "n"])

    found = map_arrow(docs.select(F.col(text).alias("text")), summarise, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)


def length_table(words: list[bytes], lengths: list[int]) -> Slots:
    """The compact hash table: hash and 16-bit length of each pre-token; of two in one slot the first stays."""
    table = Slots(0, TABLE_BITS)
    if words:
        hashes = Words(*utf8(pa.array([b" ".join(words[::-1])], pa.large_binary())), PRETOKENS).hash
        table.put(hashes, np.array(lengths[::-1], dtype=np.int64), None)
    return table


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048,
                 most: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and whether it has more than ``limit`` tokens."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    spec = shared_vocabulary(docs.sparkSession, vocabulary)

    def lengths(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            n = [len(i) for i in slots(spec.value, "lengths")[0].ids(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32())], names=["word", "n"])

    rows = map_arrow(frequent_pretokens(d, "text", most).select("word"), lengths, "word binary, n int").collect()
    table = docs.sparkSession.sparkContext.broadcast(length_table([bytes(r["word"]) for r in rows], [r["n"] for r in rows]))

    def run(batches):
        encoder, cache = slots(spec.value, "lengths")
        for batch in batches:
            for piece in slices(batch, "text"):
                raw, off = utf8(piece.column(1))
                w = PreTokens(raw, off)
                n = np.diff(np.concatenate([[0], np.cumsum(count(w, encoder, cache, table.value))])[w.first])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
