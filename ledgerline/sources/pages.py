"""Landed API pages and name trees (SRC-1, SRC-2, JSN-1).

Layout of a landing folder: ``<root>/indicator=<id>/page_<n>.json`` or
``<root>/indicator=<id>/page=<n>/<any name>``, each file a JSON array of records.  The
indicator id comes from the folder name and the page number from the folder or the file
name; pages are read in parallel.  A file that is not JSON yields one row whose ``_corrupt_record``
holds its text, so failed pages can be counted (AGG-9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.indicators import PAGE_SCHEMA

CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE_SCHEMA, glob: str = "*.json") -> DataFrame:
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(s).option("multiLine", True).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
               .option("pathGlobFilter", glob).json(path))
    in_folder = F.regexp_extract(F.col("_metadata.file_path"), r"/page=(\d+)/", 1)
    page = F.when(in_folder != "", in_folder).otherwise(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1))
    ind = F.regexp_extract(F.col("_metadata.file_path"), r"indicator=([^/]+)/", 1)
    return (df.withColumn("indicator", F.when(ind != "", ind.try_cast("int")))
              .withColumn("page", F.when(page != "", page.cast("int"))))


def page_records(pages: DataFrame, text: str, schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """SRC-1 on text rows: one row per record of a page's JSON array, and one row with ``failed``
    set for a page that is not JSON."""
    s = T.StructType([T.StructField("r", T.ArrayType(schema)), T.StructField(CORRUPT, T.StringType())])
    whole = F.concat(F.lit('{"r":'), F.col(text), F.lit("}"))
    p = pages.withColumn("__p", F.from_json(whole, s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"__p.{CORRUPT}").isNotNull()
    one = F.when(bad, F.array(F.lit(None).cast(schema))).otherwise(F.col("__p.r"))
    keep = [c for c in pages.columns if c != text]
    p = p.select(*keep, bad.alias("failed"), F.explode(one).alias("__r"))
    return p.select(*keep, "__r.*", "failed")


def name_tree(trees: DataFrame, text: str, order: str) -> DataFrame:
    """SRC-2 on text rows: id and lower-cased name; a repeated id keeps its last name."""
    nodes = F.from_json(F.col(text), "array<struct<id: double, name: string>>")
    t = trees.select(F.col(order).alias("__o"), F.posexplode(nodes).alias("__at", "__n"))
    return (t.where(F.col("__n.id").isNotNull()).groupBy(F.col("__n.id").alias("id"))
             .agg(F.max_by(F.lower("__n.name"), F.struct("__o", "__at")).alias("name")))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Name tree ``[{"id": .., "name": ..}, ..]`` -> ``id double, name`` lower-cased.

    A repeated id keeps its last name, as ``dict(zip(ids, names))`` does; the
    order is file, then position in the file.
    """
    df = (spark.read.schema("id double, name string").option("multiLine", True).json(path)
               .withColumn("__pos", F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())))
    return (df.where(F.col("id").isNotNull())
              .groupBy("id").agg(F.max_by(F.lower("name"), "__pos").alias("name")))


def json_field(col, field: str, ddl: str = "int"):
    """JSN-1: one field of a JSON text column, parsed with a fixed schema."""
    return F.from_json(F.col(col) if isinstance(col, str) else col, f"`{field}` {ddl}")[field]
