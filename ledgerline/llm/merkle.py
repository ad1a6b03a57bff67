"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line of the text, cut further after every ". "; a section is a run of
paragraphs that ends with one whose hash begins with a digit of ``ENDS`` (every eighth on
average), so what stands before or after an edit keeps its sections wherever it moves.
The root hashes the section hashes, a section its paragraph hashes.  The fingerprint is the
root followed by the short paragraph hashes in order, so roots test equality, and two
fingerprints alone tell how much the texts have in common.  Only DataFrame functions.

An edit is located from the differing branches (``changes``): sections, and paragraphs, that
the two texts have in common at their start and at their end are set aside, and of the rest
those count whose hash the other rest does not hold.  That last step compares the two
rests, so it costs the square of the edit (not of the text).

``next_texts`` gives each row the text of the next one in the order of ids: rows are cut
into ranges of ids of bounded size (an id with many texts into several, by their hash), the first row of each range is handed to the range
before it, and a window looks one row ahead inside a range.  One shuffle of the texts, no
task sees them all.

Defined cases: null texts are empty (one empty paragraph); null ids come last; rows of
one id follow each other in the order of their text's hash; a single row is its own next;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

#: first hex digit of the hash of a paragraph that ends a section
ENDS = ("0", "1")
#: hex digits of a paragraph hash in a fingerprint
DIGITS = 12
#: bytes of text in a range of ids; with more than MOST_RANGES of them, ranges grow instead
RANGE_BYTES = 8 << 20
MOST_RANGES = 1 << 16


def paragraphs(text: Column) -> Column:
    return F.split(F.replace(text, F.lit(". "), F.lit(".\n")), "\n", -1)


def paragraph_hashes(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.sha2(p.cast("binary"), 256))


def section_hashes(hashes: Column) -> Column:
    """Hashes of the sections of an array of paragraph hashes (a column: it is read in each section)."""
    last = F.size(hashes) - 1
    ends = F.filter(F.transform(hashes, lambda h, i: F.when(F.substring(h, 1, 1).isin(*ENDS) | (i == last), i + 1)),
                    lambda i: i.isNotNull())
    starts = F.concat(F.array(F.lit(1)), F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda e: e + 1))
    return F.zip_with(starts, ends, lambda a, b: F.sha2(F.array_join(F.slice(hashes, a, b - a + 1), "").cast("binary"), 256))


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, "").cast("binary"), 256)


def short(hashes: Column) -> Column:
    return F.transform(hashes, lambda h: F.substring(h, 1, DIGITS))


def fingerprint(hashes: Column, sections: Column) -> Column:
    """Root and short paragraph hashes of a text."""
    return F.concat(root(sections), F.lit(":"), F.array_join(short(hashes), "."))


def same(a: Column, b: Column) -> Column:
    """Whether two fingerprints have one root: equal texts."""
    return F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct hashes of two arrays, twice, over the sum of both numbers."""
    both = F.size(F.array_intersect(a, b))
    return (2.0 * both) / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)))


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once a row: a function over an array reads them for each element."""
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _agree(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common at their start."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def changes(df: DataFrame, new: str, old: str, out: str) -> DataFrame:
    """Add ``out``: the places (from 0) of the elements of ``new`` that ``old`` has not, in order.

    Both are arrays of hashes, of sections or of paragraphs.
    """
    head, rest_new, rest_old = (f"__{out}_{x}" for x in ("head", "new", "old"))
    a, b = F.col(new), F.col(old)
    df = worked_out(df, **{head: _agree(a, b)})
    tail = F.least(_agree(F.reverse(a), F.reverse(b)), F.least(F.size(a), F.size(b)) - F.col(head))
    df = worked_out(df, **{rest_new: F.slice(a, F.col(head) + 1, F.size(a) - F.col(head) - tail),
                           rest_old: F.slice(b, F.col(head) + 1, F.size(b) - F.col(head) - tail)})
    places = F.filter(F.transform(F.col(rest_new), lambda h, i: F.when(~F.array_contains(F.col(rest_old), h), F.col(head) + i)),
                      lambda i: i.isNotNull())
    return df.withColumn(out, places).drop(head, rest_new, rest_old)


def _below(value: Column, points: list) -> Column:
    """How many of the ascending numbers are less than ``value``: blocks of 256 first, then one block."""
    blocks = [points[i:i + 256] for i in range(0, len(points), 256)]

    def less(numbers):
        return F.size(F.filter(numbers, lambda p: p < value))

    lits = [F.array(*[F.lit(p) for p in b]) for b in blocks]
    if len(lits) == 1:
        return less(lits[0])
    block = less(F.array(*[F.lit(b[-1]) for b in blocks]))
    return block * 256 + F.coalesce(less(F.try_element_at(F.array(*lits), block + 1)), F.lit(0))


def next_texts(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) with ``next``: the text of the next row, ids descending, in a ring."""
    size, n = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    if n == 0:
        return docs.withColumn("next", F.col("text"))
    cuts = min(max(int(size // range_bytes), 1), MOST_RANGES)
    points = []
    if cuts > 1:
        probs = [i / cuts for i in range(1, cuts)]
        points = sorted(docs.agg(F.percentile_approx("doc_id", probs, 10 * cuts)).first()[0] or [])
    # range 0 holds the largest ids; null ids close the last range
    part = F.lit(len(points)) - F.coalesce(_below(F.col("doc_id"), points), F.lit(0)) if points else F.lit(0)
    # an id that is several cut points fills several ranges, by the hash of its texts
    hot = {p: n for p, n in Counter(points).items() if n > 1}
    if hot:
        n = F.create_map(*[F.lit(x) for item in hot.items() for x in item])[F.col("doc_id")]
        share = (F.xxhash64("text").cast("double") / 2.0 ** 64 + 0.5) * n
        part = part - F.coalesce(n - 1 - F.least(F.floor(share).cast("int"), n - 1), F.lit(0))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), part.cast("int").alias("part"))
    rank = F.struct("doc_id", (-F.col("mark").cast("decimal(20,0)")).alias("m"))
    # one row per range: its first row in the order
    heads = staged(d.groupBy("part").agg(F.max(rank).alias("top")).select("part", "top.doc_id", "top.m"), "merkle-heads")
    w = Window.orderBy("part")
    ring = heads.select(F.coalesce(F.lag("part").over(w), F.max("part").over(Window.partitionBy())).alias("to"), "doc_id", "m")
    ring = staged(ring, "merkle-heads")
    h = ring.alias("h")
    first = d.alias("d").join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id"))
                              & (-F.col("d.mark").cast("decimal(20,0)") == F.col("h.m")))
    first = first.select("d.doc_id", "d.text", "d.mark", F.col("h.to").alias("part")).dropDuplicates(["part"])
    rows = d.withColumn("lent", F.lit(False)).unionAll(first.withColumn("lent", F.lit(True)))
    w = Window.partitionBy("part").orderBy("lent", *order)
    ahead = rows.withColumn("next", F.lead("text").over(w))
    return ahead.where(~F.col("lent")).select("doc_id", "text", "next")


def edited(text: Column, other: Column) -> Column:
    """The last third of a text replaced by as many characters from the start of another."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and where they differ.

    ``changed`` holds the places of the sections and paragraphs that the edited text has and the text
    has not, and of those that it lost.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = next_texts(d, range_bytes).withColumn("edited", edited(F.col("text"), F.col("next")))
    d = d.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "text", "next", "edited")
    d = worked_out(d, edited_sha256=F.sha2(F.col("edited").cast("binary"), 256), own=paragraph_hashes(F.col("text")),
                   new=paragraph_hashes(F.col("edited")), other=paragraph_hashes(F.col("next"))).drop("text", "next", "edited")
    own, new, other = F.col("own"), F.col("new"), F.col("other")
    d = worked_out(d, own_sections=section_hashes(own), new_sections=section_hashes(new))
    d = changes(changes(d, "new_sections", "own_sections", "sections"), "new", "own", "paragraphs")
    d = changes(changes(d, "own_sections", "new_sections", "lost_sections"), "own", "new", "lost_paragraphs")
    located = F.struct("sections", "paragraphs", "lost_sections", "lost_paragraphs")
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint(own, F.col("own_sections")).alias("fingerprint"),
                    fingerprint(new, F.col("new_sections")).alias("edited_fingerprint"), located.alias("changed"),
                    likeness(short(own), short(new)).alias("near_edited"), likeness(short(own), short(other)).alias("near_next"))
