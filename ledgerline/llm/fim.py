"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in training order.

One narrow stage (``mapInArrow``, no shuffle).  Each slice of a batch is one pipeline of
``pyarrow.compute`` calls, without Python code per text or unit: the texts are split into
lists of units, the lists flattened beside the index of their text, each unit gets its
ordinal, units are filtered by role (before the first cut, between the cuts, after the
second), the three lists are built again and joined, and the joined pieces are put
together with the sentinels.

The cuts come from the SHA-256 of ``seed:doc_id``, so a rerun, a retried task and any
partitioning give the same output.

Defined cases: a null text counts as empty; an empty text and one that already holds a
sentinel stay plain (so that every output can be undone); a null id draws as the empty
string; rows of equal id draw alike and are all kept; an empty table gives an empty one;
all other columns pass through, whatever their names.  Texts are never cut short: a
slice holds about a quarter megabyte of text, or one longer text, and some forty times
that while it is worked on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import map_arrow
from .textarrays import fresh_name, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20

#: patterns over UTF-8 bytes; every byte of a text belongs to one unit
UNITS = {
    "char": r"[^\x80-\xBF][\x80-\xBF]*",
    "word": r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+",
    "line": r"[^\n]*\n|[^\n]+",
}
#: a byte that UTF-8 never uses ends each unit while lists are made
_END = b"\xff"

FIELDS = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_units", T.LongType()), T.StructField("middle_units", T.LongType()),
    T.StructField("output", T.StringType()),
])


def _remainder(a, b):
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _pieces(flat: pa.Array, role: pa.Array, counts: pa.Array) -> pa.Array:
    """The units of one role, joined for each text."""
    ends = pc.cumulative_sum(counts).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(role)), b"")


def arrange(texts: pa.Array, draws: list[pa.Array], pattern: str, plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """The fields of ``FIELDS`` for a slice of texts and its four draws."""
    text = texts.fill_null("").cast(pa.binary())
    units = pc.split_pattern(pc.replace_substring_regex(text, pattern=pattern, replacement=rb"\0" + _END), pattern=_END)
    n = pc.subtract(pc.list_value_length(units), 1).cast(pa.int64())  # the piece after the last end is no unit
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(units.offsets[:-1].cast(pa.int64()), parent))

    a, b = (_remainder(d, pc.add(n, 1)) for d in draws[:2])
    first, second = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    in_prefix = pc.less(ordinal, pc.take(first, parent))
    in_suffix = pc.and_(pc.greater_equal(ordinal, pc.take(second, parent)), pc.less(ordinal, pc.take(n, parent)))
    in_middle = pc.and_(pc.invert(in_prefix), pc.less(ordinal, pc.take(second, parent)))
    middle_n = pc.subtract(second, first)
    prefix = _pieces(flat, in_prefix, first)
    middle = _pieces(flat, in_middle, middle_n)
    suffix = _pieces(flat, in_suffix, pc.subtract(n, second))

    marked = [pc.match_substring(text, pattern=s) for s in (PREFIX, SUFFIX, MIDDLE)]
    plain = pc.or_(pc.or_(pc.or_(*marked[:2]), marked[2]),
                   pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(draws[2], 100), 100 - plain_percent)))
    spm = pc.less(_remainder(draws[3], 100), spm_percent)
    p, s, m = (pa.scalar(x.encode()) for x in (PREFIX, SUFFIX, MIDDLE))
    output = pc.if_else(plain, text, pc.if_else(
        spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b""),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b"")))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    return [n, form, pc.if_else(plain, none, first), pc.if_else(plain, none, middle_n), output.cast(pa.string(), safe=False)]


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.transform(F.array(*[F.lit(1 + 8 * i) for i in range(4)]),
                       lambda at: F.conv(F.substring(digest, at, F.lit(8)), 16, 10).cast("long"))


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1, unit: str = "char",
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, out: str = "fim") -> DataFrame:
    """``docs`` with one more struct column (the last; ``out`` where no column has that name).

    Its fields: ``n`` units of the text, ``form`` (plain, psm, spm), ``prefix_units`` and
    ``middle_units`` (null where plain), ``output``.
    """
    drawn = fresh_name("__draws", docs.columns)
    out = fresh_name(out, docs.columns)
    rows = docs.withColumn(drawn, draws(docs[doc_id], seed))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, FIELDS)])
    names, at, pattern = [f.name for f in FIELDS], docs.columns.index(text), UNITS[unit]

    def run(batches):
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                *cols, h = part.columns
                h = [pc.list_element(h, i) for i in range(4)]
                made = pa.StructArray.from_arrays(arrange(cols[at], h, pattern, plain_percent, spm_percent), names=names)
                yield pa.RecordBatch.from_arrays([*cols, made], names=[*part.schema.names[:-1], out])

    return map_arrow(rows, run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text back from its output and form.

    A piece never holds a sentinel, nor does one arise where a piece meets a sentinel, so the
    output falls into exactly three pieces.
    """
    piece = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "plain", output)
             .when(form == "psm", F.concat(piece[1], piece[3], piece[2]))
             .otherwise(F.concat(piece[2], piece[3], piece[1])))
