"""Vector codes: product quantisation with member-resident Lloyd rounds.

A vector is cut into equal consecutive parts and each part is replaced by the index of the
nearest entry of its position's codebook.  The codebooks are learned on every part:

* After the first assignment each part moves once, to the owner of its entry: rows are
  partitioned by (position, entry, salt).  A row is a block of up to ``BLOCK_BYTES`` of parts
  of one owner, so nothing is handled part by part.  The salt splits an entry that holds
  many parts (a third of all vectors may be equal) into owners of about ``RESIDENT`` parts.
* Owners update their entry from the members that reside with them: partial sums by owner,
  added up by (position, entry).  What reaches the driver is the codebooks.
* In the next round the members are compared with the new codebooks where they are.  Members
  that keep their entry are written by the task that holds them; only those that
  change entry go through the next shuffle, to their new owner.
* The final codebooks (64 vectors' worth of integers) are broadcast, and every vector is
  encoded where it is read: no shuffle, and no id has to travel with the parts.

Sums, distances and divisions are whole numbers and exact at any size: single or double
precision is used only where every intermediate stays below its exact range, else Python's
integers.  So the codebooks do not depend on partitioning, salts or retried tasks.

Defined cases: vectors that are null or hold null or non-finite components are dropped;
shorter vectors count as filled with zeros to the longest one's length, and that to the next
multiple of the number of positions; components beyond 2^62 / 256 count as that; fewer
vectors than entries make that many entries; equal ids are ordered by their vectors
and each row is kept; rows without an id come last in the order; errors beyond a long count
as its maximum; an empty table gives no rows; all other columns pass through, whatever their
names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import map_arrow
from .tables import staged
from .textarrays import fresh_name, utf8

POSITIONS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: parts an owner holds, about
RESIDENT = 1 << 20
#: bytes of parts in a row
BLOCK_BYTES = 4096
#: vectors or blocks worked on at once
STEP = 4096
_LIMIT = 2.0**62
_MOST = (1 << 63) - 1

BLOCK = "position int, entry int, salt long, bytes int, parts binary, moved boolean"


# ------------------------------------------------------------------ whole-number arithmetic


def whole_parts(vectors: pa.Array, positions: int, width: int) -> np.ndarray:
    """floor(256 x) of every component as (rows, positions, width); missing components are 0."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = vectors.offsets.to_numpy()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    n, size = len(vectors), positions * width
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(flat * SCALE), -_LIMIT, _LIMIT).astype(np.int64)
    lengths = np.diff(offsets)
    if (lengths == size).all():
        return whole.reshape(n, positions, width)
    out = np.zeros((n, size), dtype=np.int64)
    row = np.repeat(np.arange(n), lengths)
    out[row, np.arange(len(whole)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = whole
    return out.reshape(n, positions, width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower) and the squared distance, exactly."""
    if not len(parts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = max(abs(int(x)) for x in (parts.min(), parts.max(), book.min(), book.max()))
    reach = 4 * parts.shape[1] * most * most
    if reach < 1 << 53:
        kind = np.float32 if reach < 1 << 24 else np.float64
        x, e = parts.astype(kind), book.astype(kind)
        d = (e * e).sum(axis=1) - 2 * (x @ e.T)
        at = d.argmin(axis=1)
        return at, (d[np.arange(len(x)), at] + (x * x).sum(axis=1)).astype(np.int64)
    x = parts.astype(object)
    d = np.stack([((x - e) ** 2).sum(axis=1) for e in book.astype(object)], axis=1)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


@dataclass(frozen=True)
class Codebooks:
    """``entries``: (positions, entries, width) whole numbers."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


# ------------------------------------------------------------------ blocks of parts


def to_blocks(parts, position, entry, salt, moved, entries: int) -> pa.RecordBatch:
    """Parts with the same owner as rows of at most ``BLOCK_BYTES``, in the least integer type."""
    salts, salt_at = np.unique(salt, return_inverse=True)
    key = ((salt_at.astype(np.int64) * (int(position.max(initial=0)) + 1) + position) * entries + entry) * 2 + moved
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    ends = np.append(starts[1:], len(order))
    low, high = parts.min(axis=1)[order], parts.max(axis=1)[order]
    cols = {c: [] for c in ("at", "bytes", "parts")}
    for a, b in zip(starts, ends):
        l, h = np.minimum.reduce(low[a:b]), np.maximum.reduce(high[a:b])
        size = next(s for s in (1, 2, 4, 8) if -(1 << 8 * s - 1) <= l and h < 1 << 8 * s - 1)
        step = max(1, BLOCK_BYTES // (size * parts.shape[1]))
        for at in range(a, b, step):
            cols["at"].append(order[at])
            cols["bytes"].append(size)
            cols["parts"].append(parts[order[at:min(at + step, b)]].astype(f"<i{size}").tobytes())
    at = np.array(cols["at"], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(position[at], pa.int32()), pa.array(entry[at], pa.int32()), pa.array(salt[at], pa.int64()),
         pa.array(cols["bytes"], pa.int32()), pa.array(cols["parts"], pa.binary()), pa.array(moved[at])],
        names=["position", "entry", "salt", "bytes", "parts", "moved"])


def from_blocks(batch: pa.RecordBatch, width: int):
    """The parts of blocks, and position, entry and salt of each."""
    found = []
    sizes = batch.column(3).to_numpy()
    for size in np.unique(sizes):
        some = batch.filter(pa.array(sizes == size))
        raw, offsets = utf8(some.column(4))
        n = np.diff(offsets) // (size * width)
        found.append((raw.view(f"<i{size}").reshape(-1, width).astype(np.int64), *(np.repeat(some.column(c).to_numpy(), n) for c in range(3))))
    return tuple(np.concatenate(c) for c in zip(*found))


# ------------------------------------------------------------------ steps


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def placed(vectors: DataFrame, books, n: int) -> DataFrame:
    """First assignment: every part in a block of its owner."""
    salts = -(-n // RESIDENT)

    def run(batches):
        book = books.value.entries
        positions, entries, width = book.shape
        task = pyspark.TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            parts = whole_parts(batch.column(0), positions, width)
            if not len(parts):
                continue
            entry = np.stack([nearest(parts[:, p], book[p])[0] for p in range(positions)], axis=1).ravel()
            position = np.tile(np.arange(positions), len(parts))
            salt = np.full(len(entry), (task * 31 + number) % salts)
            yield to_blocks(parts.reshape(-1, width), position, entry, salt, np.zeros(len(entry), dtype=bool), entries)

    return map_arrow(vectors, run, BLOCK)


def compared(members: DataFrame, books) -> DataFrame:
    """Members against new codebooks: those that keep their entry and those that change it."""

    def run(batches):
        book = books.value.entries
        _, entries, width = book.shape
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                parts, position, entry, salt = from_blocks(batch.slice(at, STEP), width)
                now = np.empty(len(parts), dtype=np.int64)
                for p in np.unique(position):
                    here = position == p
                    now[here] = nearest(parts[here], book[p])[0]
                yield to_blocks(parts, position, now, salt, now != entry, entries)

    return map_arrow(members, run, BLOCK)


def at_owners(blocks: DataFrame) -> DataFrame:
    """Blocks moved to the owners of their entries, and written there."""
    return staged(blocks.repartition("position", "entry", "salt"), "resident-parts")


def updated(members: DataFrame, books) -> Codebooks:
    """New entries: componentwise floor of the mean of the members; an entry without any stays."""
    old = books.value.entries

    def run(batches):
        positions, entries, width = old_shape
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                parts, position, entry, _ = from_blocks(batch.slice(at, STEP), width)
                key = position.astype(np.int64) * entries + entry
                order = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.diff(key[order], prepend=-1))
                high = np.add.reduceat(parts[order] >> 32, starts)
                low = np.add.reduceat(parts[order] & 0xFFFFFFFF, starts)
                n = np.diff(np.append(starts, len(order)))
                key = key[order][starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(key // entries, width), pa.int32()), pa.array(np.repeat(key % entries, width), pa.int32()),
                     pa.array(np.tile(np.arange(width), len(key)), pa.int32()), pa.array(np.repeat(n, width), pa.int64()),
                     pa.array(high.ravel(), pa.int64()), pa.array(low.ravel(), pa.int64())],
                    names=["position", "entry", "at", "n", "high", "low"])

    old_shape = old.shape
    sums = map_arrow(members, run, "position int, entry int, at int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    totals = sums.groupBy("position", "entry", "at").agg(F.sum("n").alias("n"), *exact)
    new = old.copy()
    for r in totals.collect():  # one row for each number of the codebooks
        new[r["position"], r["entry"], r["at"]] = ((int(r["high"]) << 32) + int(r["low"])) // r["n"]
    return Codebooks(new)


def first_codebooks(vectors: DataFrame, vec_id: str, vector: str, positions: int, entries: int) -> tuple[Codebooks, int]:
    """The parts of the vectors with the smallest ids, and the number of vectors."""
    n, longest = vectors.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    if not n:
        return Codebooks(np.zeros((positions, 0, 1), np.int64)), 0
    width = max(1, -(-longest // positions))
    order = [F.col(vec_id).asc_nulls_last(), F.col(vector)]
    seeds = vectors.select(vec_id, vector).orderBy(*order).limit(entries).collect()
    parts = whole_parts(pa.array([list(r[1]) for r in seeds], pa.list_(pa.float64())), positions, width)
    return Codebooks(np.ascontiguousarray(parts.transpose(1, 0, 2))), n


def learned(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", positions: int = POSITIONS,
            entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` Lloyd rounds over all usable vectors."""
    spark = vectors.sparkSession.sparkContext
    vectors = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    first, n = first_codebooks(vectors, "vec_id", "vector", positions, entries)
    if not n:
        return first
    books = spark.broadcast(first)
    members = at_owners(placed(vectors.select("vector"), books, n)) if rounds else None
    for number in range(rounds):
        if number:
            seen = staged(compared(members, books), "compared-parts")
            members = seen.where(~F.col("moved")).unionAll(at_owners(seen.where(F.col("moved"))))
        books = spark.broadcast(updated(members, books))
    return books.value


FIELDS = T.StructType([T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])


def encoded(vectors: DataFrame, books: Codebooks, vector: str = "embedding", out: str = "coded") -> DataFrame:
    """Usable rows with one more struct column (the last; ``out`` where no column has that name).

    Its fields: ``code``, two hex digits for each part's entry, and ``error``, the squared distance.
    """
    out = fresh_name(out, vectors.columns)
    vectors_at = vectors.columns.index(vector)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    digits = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)

    def run(batches):
        book = shared.value.entries
        positions, _, width = book.shape
        for batch in batches:
            parts = whole_parts(batch.column(vectors_at), positions, width)
            found = [nearest(parts[:, p], book[p]) for p in range(positions)] if len(parts) else []
            code = np.stack([f[0] for f in found], axis=1) if found else np.zeros((0, positions), np.int64)
            text = np.ascontiguousarray(digits[code])
            offsets = np.arange(len(parts) + 1, dtype=np.int32) * (2 * positions)
            codes = pa.StringArray.from_buffers(len(parts), pa.py_buffer(offsets), pa.py_buffer(text))
            if any(d.dtype == object for _, d in found):
                error = [min(sum(int(d[i]) for _, d in found), _MOST) for i in range(len(parts))]
            else:
                error = sum((d for _, d in found), np.zeros(len(parts), np.int64))
            made = pa.StructArray.from_arrays([codes, pa.array(error, pa.int64())], names=["code", "error"])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    rows = vectors.where(usable(vectors[vector]))
    return map_arrow(rows, run, T.StructType([*vectors.schema.fields, T.StructField(out, FIELDS)]))


def with_label_error(coded: DataFrame, label: str = "label", error: str = "error", out: str = "label_error") -> DataFrame:
    """Add the error summed over rows of equal labels; rows without a label are one group.

    One row a label is joined back; a hot label is partially summed first, and Spark splits
    its rows (or broadcasts the sums, when their file is small).
    """
    key = fresh_name("__label", [*coded.columns, out])
    total = F.least(F.sum(F.col(error).cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    sums = staged(coded.groupBy(F.col(label).alias(key)).agg(total.alias(out)), "label-errors")
    return coded.join(sums, coded[label].eqNullSafe(sums[key])).drop(key)
