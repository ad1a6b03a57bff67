"""Words, shingles and hashes of whole Arrow text batches, as numpy arrays.

Small helpers used inside Spark tasks (``mapInArrow``): the words of all texts of a
slice are found and hashed at once, so no Python code runs per word.  Texts stay whole;
a batch is only worked through in slices of about ``SLICE_BYTES`` (a longer text is a
slice of its own).  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shipping import map_arrow

SLICE_BYTES = 1 << 18

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_table(keep: Callable[[int], bool], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Byte -> byte with A-Z lowered, and byte -> whether it belongs to a word."""
    made = np.arange(256, dtype=np.uint8)
    if lower:
        made[65:91] += 32
    return made, np.array([keep(b) for b in range(256)])


#: words are runs of everything but blank, tab, LF, VT, FF, CR
BLANK_SEPARATED = byte_table(lambda b: b not in (9, 10, 11, 12, 13, 32))
#: the same, letters as they are
PRETOKENS = byte_table(lambda b: b not in (9, 10, 11, 12, 13, 32), lower=False)
#: words are runs of ASCII letters and digits and of all characters beyond ASCII
ALPHANUMERIC = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur style): spreads every input bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string (or binary) column and the n + 1 offsets of its texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=len(col) + 1, offset=col.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``size`` text bytes; no row is cut."""
    if not batch.num_rows:
        return
    _, off = utf8(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, dtype=U64)
    out[0], have = U64(1), 1
    while have < n:
        step = U64(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have:have + more] = out[:more] * step
        have += more
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = SLICE_BYTES
    while size < n:
        size *= 2
    if size not in _POWERS:
        t = _powers(size, _ODD), _powers(size, pow(_ODD, -1, 1 << 64))
        if size > SLICE_BYTES:
            return t  # for one oversized word; not kept
        _POWERS[size] = t
    return _POWERS[size]


class Words:
    """The words of a slice: byte range, 64-bit hash, and each text's range of words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
        self.bytes, inside = table[0][raw], table[1][raw]
        docs = offsets[:-1][offsets[1:] > offsets[:-1]]
        lasts = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        before[docs] = False
        self.start = np.flatnonzero(inside & ~before)
        before[:-1] = inside[1:]
        before[lasts] = False
        self.end = np.flatnonzero(inside & ~before) + 1
        self.first = np.searchsorted(self.start, offsets)  # text i has words first[i]..first[i+1]
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), dtype=U64)
        at = 0
        while at < len(out):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + SLICE_BYTES, "right")))
            part = self.bytes[base:self.end[to - 1]]
            power, inverse = _tables(len(part))
            sums = np.empty(len(part) + 1, dtype=U64)
            sums[0] = 0
            np.cumsum(part * power[:len(part)], out=sums[1:])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64)
            at = to
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, first: int, last: int) -> bytes:
        """Words ``first..last-1``, lowered, joined by one blank."""
        return b" ".join(self.bytes[s:e].tobytes() for s, e in zip(self.start[first:last], self.end[first:last]))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (over text borders too: mask them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    out = hashes[:m].copy()
    step = U64(_ODD)
    for j in range(1, n):
        out *= step
        out += hashes[j:j + m]
    return mix(out + U64(n))


def run_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the ``n``-word runs inside each text, and each text's range in them."""
    per = np.maximum(np.diff(first) - n + 1, 0)
    ends = np.cumsum(per)
    pos = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[:-1] - (ends - per), per)
    return pos, np.concatenate([[0], ends])


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Index of each value in an ordered array of distinct values; -1 where absent."""
    if not len(ordered):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


def fresh_name(stem: str, taken: list[str]) -> str:
    """A column name that no given column has, whatever its case."""
    low = {c.lower() for c in taken}
    while stem.lower() in low:
        stem += "_"
    return stem


def annotate(docs: DataFrame, text: str, kernel, fields: T.StructType, out: str) -> DataFrame:
    """Add the struct column ``out`` that ``kernel`` makes of each whole text.

    ``kernel(texts: pa.Array) -> list[pa.Array]`` gives one array per field.  All other
    columns pass through untouched, whatever their names; one narrow stage, no shuffle.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(out, fields)])
    names = [f.name for f in fields]
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                made = kernel(part.column(at))
                struct = pa.StructArray.from_arrays(made, names=names)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*part.schema.names, out])

    return map_arrow(docs, run, schema)
