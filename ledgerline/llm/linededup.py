"""Lines that many documents hold are kept in one document only.

Two Bloom filters tell which lines can be repeats: one of the line hashes seen once, one of
those seen twice.

1. Every task hashes the long lines of its part (once a document) and sends 8 bytes for each
   distinct hash, marked if the task met it in two documents; lines do not move.  A line
   that stands in a third of all documents is one hash a task.
2. The hash space is cut into parts, their number in proportion to the documents.  The
   owner of a part runs its hashes through the once-seen filter; what is in there already,
   or came marked, goes into the twice-seen filter, which is all that leaves the owner.
3. The twice-seen filters of all parts are broadcast.  They never take more than
   ``FILTER_BYTES``: with more repeats than that holds, a filter has fewer bits a key and lets
   more lines pass, which costs shuffle and changes no result.
4. Only lines that the twice-seen filter has (*suspects*) are shuffled, as whole keys: a key
   is confirmed by its exact documents, and keeps its lines in the largest id.
5. Documents without a suspect are finished where they are read.  The others meet their line
   numbers to drop by a plain join (Spark broadcasts them when their files are small)
   and are joined again from the lines that stay.

Defined cases: a null text counts as empty, and an empty text is one empty line; documents
are told apart by id: rows of equal id are one document, so they all keep a line or all
lose it, and rows without an id are one document, which keeps no line that a document with
an id has; a line is dropped wherever it stands in a document, however often; a text may
lose all lines and is then empty; an empty table gives an empty one; all columns pass
through, whatever their names.  Texts are whole: a slice holds about a quarter megabyte of
text, or one longer text, and some twenty times that while it is worked on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import map_arrow, ship
from .tables import staged
from .textarrays import U64, Words, fresh_name, mix, slices, utf8

MIN_CHARS = 20
MIN_DOCUMENTS = 3
#: all twice-seen filters together, at most
FILTER_BYTES = 64 << 20
BITS_PER_KEY = 16
PROBES = 4
#: documents for each part of the hash space
PART_DOCUMENTS = 4096
LEAST_PART_BITS = 4
#: hashes a task holds before it sends them
HELD = 1 << 20
#: hashes an owner compares at once
STEP = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class Lines(Words):
    """The lines of a slice of texts and the keys of those that are long enough.

    ``begin``/``stop``: bytes of every line; ``first``: text i has lines first[i]..first[i+1];
    ``long``: which lines have a key of at least ``min_chars`` code points; ``start``/``end``/
    ``hash``: the keys of those.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, min_chars: int = MIN_CHARS):
        breaks = np.flatnonzero(raw == 10)
        self.raw, self.bytes = raw, _LOWER[raw]
        self.begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        self.stop = np.sort(np.concatenate([breaks, offsets[1:]]))
        self.first = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
        solid = np.flatnonzero(~_BLANK[raw])
        low, high = np.searchsorted(solid, self.begin), np.searchsorted(solid, self.stop)
        some = np.flatnonzero(high > low)
        start, end = solid[low[some]], solid[high[some] - 1] + 1
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        enough = chars[end] - chars[start] >= min_chars
        self.long, self.start, self.end = some[enough], start[enough], end[enough]
        self.hash = self._hashes()

    def text_of(self, lines: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, lines, "right") - 1


# ------------------------------------------------------------------ Bloom filters


def _positions(hashes: np.ndarray, bits) -> list[np.ndarray]:
    """The bits of each hash in a filter of ``bits`` bits (a power of two; may differ by hash)."""
    a = mix(hashes)
    b = mix(a ^ U64(0xA5A5A5A5A5A5A5A5)) | U64(1)
    mask = np.asarray(bits, dtype=U64) - U64(1)
    return [((a + U64(j) * b) & mask).astype(np.int64) for j in range(PROBES)]


def filter_bits(keys: int, most: int) -> int:
    """Bits of a filter for so many keys: a power of two of at least 64 and at most ``most``."""
    return max(64, min(1 << max(keys * BITS_PER_KEY - 1, 1).bit_length(), 1 << (max(most, 64).bit_length() - 1)))


def twice_seen(blocks: list[tuple[np.ndarray, np.ndarray]], most_bits: int) -> np.ndarray:
    """The twice-seen filter of one part, as bits, from what the tasks sent: (met once, met more often)."""
    total = sum(len(a) + len(b) for a, b in blocks)
    bits = filter_bits(total, 1 << 62)
    once = np.zeros(bits, dtype=bool)
    repeats = [b for _, b in blocks]
    queue = np.concatenate([np.concatenate([a, b]) for a, b in blocks]) if blocks else np.zeros(0, U64)
    for at in range(0, len(queue), STEP):
        step, n = np.unique(queue[at:at + STEP], return_counts=True)
        where = _positions(step, bits)
        known = np.logical_and.reduce([once[p] for p in where])
        repeats.append(step[known | (n > 1)])
        for p in where:
            once[p] = True
    repeats = np.unique(np.concatenate(repeats)) if repeats else np.zeros(0, U64)
    twice = np.zeros(filter_bits(len(repeats), most_bits) if len(repeats) else 0, dtype=bool)
    if len(repeats):
        for p in _positions(repeats, len(twice)):
            twice[p] = True
    return twice


class TwiceSeen:
    """The twice-seen filters of all parts in one array."""

    def __init__(self, part_bits: int, filters: dict[int, bytes]):
        n = 1 << part_bits
        self.shift = U64(64 - part_bits)
        self.bits = np.zeros(n, dtype=np.int64)
        self.base = np.zeros(n, dtype=np.int64)
        at, held = 0, []
        for part in sorted(filters):
            self.base[part], self.bits[part] = at, 8 * len(filters[part])
            held.append(np.frombuffer(filters[part], np.uint8))
            at += self.bits[part]
        self.held = np.concatenate(held) if held else np.zeros(0, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        part = (hashes >> self.shift).astype(np.int64)
        out = self.bits[part] > 0
        some = np.flatnonzero(out)
        part = part[some]
        for p in _positions(hashes[some], self.bits[part]):
            p += self.base[part]
            out[some] &= (self.held[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
        return out


# ------------------------------------------------------------------ steps


def line_hashes(docs: DataFrame, part_bits: int, text: str, min_chars: int) -> DataFrame:
    """(part, once, more): hashes of the long lines that a task met in one and in several documents."""
    shift = U64(64 - part_bits)

    def sent(found):
        hashes, n = np.unique(np.concatenate(found), return_counts=True)
        part = (hashes >> shift).astype(np.int64)
        parts, at = np.unique(part, return_index=True)
        once, more = [], []
        for a, b in zip(at, [*at[1:], len(hashes)]):
            h, several = hashes[a:b], n[a:b] > 1
            once.append(h[~several].tobytes())
            more.append(h[several].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
                                          names=["part", "once", "more"])

    def run(batches):
        found, held = [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                lines = Lines(*utf8(piece.column(0)), min_chars)
                owner = lines.text_of(lines.long)
                order = np.lexsort((lines.hash, owner))
                h, o = lines.hash[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                found.append(h[new])
                held += len(found[-1])
                if held >= HELD:
                    yield sent(found)
                    found, held = [], 0
        if held:
            yield sent(found)

    return map_arrow(docs.select(F.col(text).alias("text")), run, "part long, once binary, more binary")


def repeat_filter(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, filter_bytes: int = FILTER_BYTES) -> TwiceSeen:
    """The broadcastable twice-seen filter of the long lines of ``docs``."""
    part_bits = max((docs.count() // PART_DOCUMENTS).bit_length(), LEAST_PART_BITS)
    most_bits = 8 * filter_bytes >> part_bits
    sent = line_hashes(docs, part_bits, text, min_chars)

    def own(table: pa.Table) -> pa.Table:
        blocks = [(np.frombuffer(a, U64), np.frombuffer(b, U64))
                  for a, b in zip(table.column("once").to_pylist(), table.column("more").to_pylist())]
        bits = np.packbits(twice_seen(blocks, most_bits), bitorder="little").tobytes()
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    ship(docs.sparkSession)
    filters = sent.groupBy("part").applyInArrow(own, "part long, bits binary").where("length(bits) > 0")
    return TwiceSeen(part_bits, {r["part"]: bytes(r["bits"]) for r in filters.collect()})


def suspects(docs: DataFrame, repeats, min_chars: int) -> DataFrame:
    """(doc_id, row, at, key) of every line that the filter has; from (doc_id, text, row)."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                lines = Lines(*utf8(piece.column(1)), min_chars)
                hit = np.flatnonzero(repeats.value.has(lines.hash))
                line = lines.long[hit]
                owner = lines.text_of(line)
                keys = [lines.bytes[s:e].tobytes() for s, e in zip(lines.start[hit], lines.end[hit])]
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(take), piece.column(2).take(take), pa.array(line - lines.first[owner], pa.int32()),
                     pa.array(keys, pa.binary()).cast(pa.string(), safe=False)], names=["doc_id", "row", "at", "key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, f"doc_id {kind}, row binary, at int, key string")


def lines_to_drop(found: DataFrame, min_documents: int) -> DataFrame:
    """(doc_id, row, dropped): line numbers that go, for each text that loses any; from the suspects."""
    holders = found.select("key", "doc_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    repeated = staged(holders.where(F.col("n") >= min_documents).select("key", "keeper"), "repeated-lines")
    lost = found.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("dropped"))


def without_lines(texts: pa.Array, dropped: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The texts without the numbered lines, and how many went."""
    raw, off = utf8(texts)
    lines = Lines(raw, off)
    n = np.diff(lines.first)
    gone = dropped.fill_null([]) if dropped.null_count else dropped
    per = np.diff(gone.offsets.to_numpy())
    stays = np.ones(len(lines.begin), dtype=bool)
    stays[gone.flatten().to_numpy() + np.repeat(lines.first[:-1], per)] = False
    kept = np.flatnonzero(stays)
    owner = lines.text_of(kept)
    opens = np.ones(len(kept), dtype=bool)  # the first line that stays brings no line break
    opens[1:] = owner[1:] != owner[:-1]
    begin, stop = lines.begin[kept] - ~opens, lines.stop[kept]
    edge = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, stop, -1)
    size = np.bincount(owner, weights=stop - begin, minlength=len(n)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    out = pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(raw[np.cumsum(edge[:-1]) > 0]))
    return out, pa.array(per, pa.int64())


FIELDS = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                       T.StructField("kept", T.StringType())])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_documents: int = MIN_DOCUMENTS, filter_bytes: int = FILTER_BYTES, out: str = "lines") -> DataFrame:
    """``docs`` with one more struct column (the last; ``out`` where no column has that name).

    Its fields: ``n_lines`` of the text, ``n_dropped`` of them, ``kept``: the lines that stay,
    joined by a line break.
    """
    spark = docs.sparkSession
    repeats = spark.sparkContext.broadcast(repeat_filter(docs, text, min_chars, filter_bytes))
    # a row is known by its id and the SHA-256 of its text: equal ones lose the same lines
    row = F.unhex(F.sha2(F.coalesce(docs[text], F.lit("")), 256))
    known = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), row.alias("row"))
    found = staged(suspects(known, repeats, min_chars), "suspected-lines")
    drops = staged(lines_to_drop(found, min_documents), "dropped-lines")

    out = fresh_name(out, docs.columns)
    probe, mark = (fresh_name(c, docs.columns) for c in ("__probe", "__row"))
    at, columns = docs.columns.index(text), docs.columns

    def probed(batches):
        for batch in batches:
            for piece in slices(batch, batch.schema.names[at]):
                lines = Lines(*utf8(piece.column(at)), min_chars)
                some = np.zeros(piece.num_rows, dtype=bool)
                some[lines.text_of(lines.long[repeats.value.has(lines.hash)])] = True
                made = pa.StructArray.from_arrays([pa.array(some), pa.array(np.diff(lines.first))], names=["some", "n_lines"])
                yield pa.RecordBatch.from_arrays([*piece.columns, made], names=[*piece.schema.names, probe])

    schema = T.StructType([*docs.schema.fields, T.StructField(probe, T.StructType([
        T.StructField("some", T.BooleanType()), T.StructField("n_lines", T.LongType())]))])
    marked = map_arrow(docs, probed, schema)
    whole = marked.where(~F.col(f"{probe}.some")).select(*columns, F.struct(
        F.col(f"{probe}.n_lines").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"),
        F.coalesce(F.col(text), F.lit("")).alias("kept")).alias(out))

    some = marked.where(f"{probe}.some").withColumn(mark, F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    drops = drops.toDF(*(fresh_name(c, some.columns) for c in ("__id", "__drop_row", "__dropped")))
    key, digest, dropped = drops.columns
    met = some.join(drops, F.col(doc_id).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(digest)), "left")
    met = met.select(*columns, probe, dropped)

    def cut(batches):
        for batch in batches:
            for piece in slices(batch, batch.schema.names[at]):
                *cols, seen, gone = piece.columns
                kept, n = without_lines(cols[at], gone)
                made = pa.StructArray.from_arrays([seen.field("n_lines"), n, kept], names=[f.name for f in FIELDS])
                yield pa.RecordBatch.from_arrays([*cols, made], names=[*columns, out])

    return whole.unionAll(map_arrow(met, cut, T.StructType([*docs.schema.fields, T.StructField(out, FIELDS)])))
