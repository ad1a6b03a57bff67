"""Connected components of a large graph by alternating star contraction.

Every round rewires each node's neighbours to the least node it sees: first the larger
ones, then the smaller ones.  The number of rounds grows with the logarithm of the
longest chain.  Each round is a grouped minimum (combined before its shuffle) and a
join; edges are written to the shared folder between rounds and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged


def _rewired(edges: DataFrame, larger: bool) -> DataFrame:
    """Point the neighbours of every node ``u`` (larger ones or the rest) to its least neighbour."""
    if larger:
        e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    j = e.join(least, "u")
    if larger:
        out = j.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; label = least node of its component.

    ``edges`` has long columns ``a`` and ``b`` in any order; loops and repeats are allowed,
    null ends are not edges.  No edges give no rows.
    """
    e = edges.where((F.col("a") != F.col("b"))).select("a", "b").distinct()
    mark = None
    while True:
        e = staged(_rewired(_rewired(e, True), False), "components")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(roots)
