"""Token-id files: ORC in ascending document order.

Documents are dealt out by ranges of their id, sorted, encoded and written as ORC.  ORC
keeps the ids of a stripe as run-length encoded integers; its row indexes and the Bloom
filter on ``doc_id`` let a reader skip files, stripes and row groups by metadata, and
stripes are read in parallel.  Each row holds its file's number and the ids that stand
before it in the file; one total per file turns that into the place in the whole corpus.

Defined cases: null texts are empty; every document has at least the end id; null ids
come first; rows of one id follow each other in the order of their text's hash, so reruns
agree; an empty table gives no rows; extra columns are not written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pretokens import WIDTH, PreTokens, encode, shared_vocabulary, slots
from .shipping import map_arrow
from .textarrays import slices, utf8

END = 1
SCHEMA = "doc_id {}, part int, part_start long, n_tokens long, ids array<int>"
ORC_OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
               "orc.row.index.stride": "2000", "compression": "zstd"}


def _encoded(docs: DataFrame, vocabulary, end: int) -> DataFrame:

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        encoder, cache = slots(vocabulary.value, "ids", WIDTH)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 18):
                w = PreTokens(*utf8(piece.column(1)))
                ids, counts = encode(w, encoder, cache)
                own = np.concatenate([[0], np.cumsum(counts)])[w.first]  # ids before each text
                ends = own[1:] + np.arange(1, len(own))
                n = np.diff(np.concatenate([[0], ends]))
                values = np.full(int(ends[-1]), end, dtype=np.int32)
                inside = np.ones(len(values), dtype=bool)
                inside[ends - 1] = False
                values[inside] = ids.astype(np.int32)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"])
                before += int(ends[-1])

    return map_arrow(docs, run, SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))


def write_tokens(docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                 end: int = END) -> None:
    """Encode every whole text with the tokenizer file ``vocabulary`` and write ORC files to ``path``."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    h = F.xxhash64("text")
    ordered = d.repartitionByRange("doc_id", h).sortWithinPartitions("doc_id", h)
    w = _encoded(ordered, shared_vocabulary(docs.sparkSession, vocabulary), end).write
    for k, v in ORC_OPTIONS.items():
        w = w.option(k, v)
    w.orc(path)


def read_tokens(spark: SparkSession, path: str, doc_id_type: str = "bigint") -> DataFrame:
    """The written rows; a filter on ``doc_id`` prunes by row index and Bloom filter."""
    return spark.read.schema(SCHEMA.format(doc_id_type)).orc(path)


def file_starts(tokens: DataFrame) -> DataFrame:
    """(part, file_start): ids in the files before each file.  One row per file."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("file_start"))


def token_index(tokens: DataFrame) -> DataFrame:
    """Per document out of the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(3)
            raw = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip([0, *ends[:-1]], ends)]
            n = np.diff(np.array([0, *ends], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(n), pa.array(crc, pa.int64())],
                                             names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(
        tokens.select("doc_id", "part", "part_start", "ids"), run, f"doc_id {kind}, part int, part_start long, n_tokens long, ids_crc32 long")
    # one row per file of about the advisory partition size: 16 bytes for every 64 MB of text
    return rows.join(F.broadcast(file_starts(tokens)), "part").select(
        "doc_id", (F.col("file_start") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
