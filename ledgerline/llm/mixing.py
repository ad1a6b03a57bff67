"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Targets: sources share ``share`` times all words by weight; a source whose target would
pass ``epochs`` times its size is clamped there, and what it gives up is shared out by
weight again until no target is above.  Sampling: every document of a source is taken
whole as often as the target allows, and the rest of the target is filled with one more
repetition of documents in a seeded random order, up to the one whose middle passes it.

The order is cut into 65,536 slices per source by the seeded hash.  Running sums go over
the slices first and over the documents of a slice after that, so a source with a third
of all documents is spread like any other.  Only DataFrame functions; the driver sees
a few sums per round.

Defined cases: null texts have size 0, null sources are one source (the last); rows that
repeat an id and size are taken alike; empty documents and empty sources take 0 words; an
empty table gives no rows; extra columns are ignored by ``plan`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_place
from .tables import staged
from .textarrays import fresh_name

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
_SLICE_DIGITS = 4


def n_words(text: Column) -> Column:
    """Number of runs of characters other than blank, tab, LF, VT, FF, CR; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw_key(doc_id: Column, seed: str = SEED) -> Column:
    """The seeded place of a document: an MD5 of seed and id."""
    return F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string")).cast("binary"))


def water_level(sources: DataFrame, share: float = SHARE) -> float:
    """The words per unit of weight at which the clamped targets fill the share.

    ``sources`` has weight and cap (long).  Each round clamps the sources that are above
    their cap at the current level and shares the rest out among the others.
    """
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    level, goal = None, share * total
    rest, free = goal, weight
    while free and level != rest / free:
        level = rest / free
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        clamped, free = sources.agg(F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        rest = goal - clamped
    return level


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source (code point order, null last): source, source_size, target."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = with_place(totals, "place", F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(x) for x in weights])
    s = s.withColumn("weight", F.element_at(w, (F.col("place") % len(weights) + 1).cast("int"))) \
         .withColumn("cap", epochs * F.col("source_size"))
    s = staged(s, "mixing-sources")
    level = water_level(s, share)
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(sized: DataFrame, **options) -> DataFrame:
    """Per source: source_size, target, whole repetitions and the last place of the extra one.

    ``sized`` has doc_id, source, size and key.  ``last`` is null where no document gets
    an extra repetition.
    """
    t = staged(targets(sized, **options), "mixing-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    t = t.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    units = sized.groupBy("source", "key", "doc_id", "size").agg((F.col("size") * F.count(F.lit(1))).alias("unit"))
    units = staged(units.withColumn("slice", F.substring("key", 1, _SLICE_DIGITS)), "mixing-units")
    w = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cuts = units.groupBy("source", "slice").agg(F.sum("unit").alias("n")) \
                .select("source", "slice", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("ahead"), "n")
    # the slice in which a source's rest runs out: at most one or two per source
    c = cuts.alias("c").join(t.select("source", "rest").alias("t"), _same(F.col("c.source"), F.col("t.source"))) \
            .where((F.col("ahead") <= F.col("rest")) & (F.col("rest") > 0)) \
            .groupBy(F.col("c.source").alias("source")) \
            .agg(F.max(F.struct("slice", "ahead")).alias("cut"), F.first("rest").alias("rest"))
    c = staged(c, "mixing-cuts")
    u = units.alias("u").join(c.alias("c"), _same(F.col("u.source"), F.col("c.source")))
    inside = u.where(F.col("u.slice") == F.col("c.cut.slice")).select("u.*", "c.cut.ahead", "c.rest")
    w = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct("key", "doc_id", "size")
    inside = inside.withColumn("done", F.col("ahead") + F.coalesce(F.sum("unit").over(w), F.lit(0)))
    inside = inside.where(2 * F.col("done") + F.col("unit") <= 2 * F.col("rest")).select("source", place.alias("place"))
    earlier = u.where(F.col("u.slice") < F.col("c.cut.slice")).select("u.source", F.struct("u.key", "u.doc_id", "u.size").alias("place"))
    last = inside.unionAll(earlier).groupBy("source").agg(F.max("place").alias("last"))
    s = t.alias("t").join(last.alias("l"), _same(F.col("t.source"), F.col("l.source")), "left") \
         .select("t.source", "source_size", "target", "whole", "last")
    return staged(s, "mixing-plan")


def _repetitions(place: Column) -> Column:
    extra = F.coalesce(place <= F.col("s.last"), F.lit(False)).cast("long")
    return F.col("s.whole") + extra


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
        **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repetitions counted)."""
    sized = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
                       .withColumn("key", draw_key(F.col("doc_id"), seed)), "mixing-sizes")
    p = plan(sized, **options)
    j = sized.alias("d").join(p.alias("s"), _same(F.col("d.source"), F.col("s.source")))
    times = _repetitions(F.struct("d.key", "d.doc_id", "d.size"))
    return j.select("d.doc_id", "d.size", "s.source_size", "s.target", (F.col("d.size") * times).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
          **options) -> DataFrame:
    """The documents as often as the mix takes them, with their columns as they were."""
    sized = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
                       .withColumn("key", draw_key(F.col("doc_id"), seed)), "mixing-sizes")
    p = plan(sized, **options)
    key, size = draw_key(F.col(f"d.`{doc_id}`"), seed), n_words(F.col(f"d.`{text}`"))
    j = docs.alias("d").join(p.alias("s"), _same(F.col(f"d.`{source}`"), F.col("s.source")))
    copy = fresh_name("__copy", docs.columns)
    times = _repetitions(F.struct(key.alias("key"), F.col(f"d.`{doc_id}`").alias("doc_id"), size.alias("size")))
    j = j.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return j.select(*[F.col(f"d.`{c}`") for c in docs.columns])
