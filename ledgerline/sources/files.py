"""File sources: report XML, code dictionary, delimited extracts, folder listing, cell tables
(SRC-3 .. SRC-8)."""

from __future__ import annotations

import csv
import re
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import dedupe_names
from ..operators.ordering import part_number, running_starts
from ..session import checkpoint_path, java_charsets

# ------------------------------------------------------------------ extract layouts (SRC-6)
# The three upload layouts of the load procedure, column by column.
_SIX = ["on_terr", "other_terr", "other_region", "other_countries", "onl_rf", "onl_other"]
FL_TRANS_DDL = ", ".join(
    ["mcc string", "region_name string", "ao_name string", "district_name string", "gender string",
     "age_group smallint", "income_group int", "client_cnt_in_cluster int"]
    + [f"trans_amount_{s} decimal(19,2)" for s in _SIX]
    + [f"count_trans_{s} bigint" for s in _SIX]
    + [f"client_cnt_{s} bigint" for s in _SIX]
    + ["partition_dt string"])
FL_TRANS_METRICS = ([f"trans_amount_{s}" for s in _SIX] + [f"count_trans_{s}" for s in _SIX]
                    + [f"client_cnt_{s}" for s in _SIX])

_SOURCES = ["kids", "pensions", "self", "salary", "stipend", "pension", "dividend", "unemployment",
            "pregnancy", "additional_payment"]
_AVG = ["all", "salary", "pension", "stipend", "dividend", "unemployment", "pregnancy", "additional_payment"]
FL_BLAGO_DDL = ", ".join(
    ["region_name string", "ao_name string", "district_name string", "gender string", "age_group smallint",
     "income_group int", "client_cnt_in_cluster int"]
    + [f"{s}_ratio decimal(5,4)" for s in _SOURCES]
    + [f"avg_{s}_rur decimal(19,2)" for s in _AVG]
    + ["avg_deposit decimal(19,2)", "avg_cards_check decimal(19,2)", "avg_dovosstr decimal(19,2)",
       "avg_trans_amount decimal(19,2)", "avg_deposit_ratio decimal(5,4)", "avg_cards_check_ratio decimal(5,4)",
       "avg_dovosstr_ratio decimal(5,4)", "partition_dt string"])
# income sources weighed in the total-income check: (average, share)
FL_BLAGO_TERMS = [(f"avg_{s}_rur", f"{s}_ratio") for s in
                  ["salary", "pension", "stipend", "dividend", "unemployment", "pregnancy", "additional_payment"]]

UL_DDL = ", ".join([
    "num smallint", "region smallint", "adm_district decimal(20,0)", "district decimal(20,0)", "type string",
    "okved_chapter string", "okved_class smallint", "okved_subclass smallint", "segment string",
    "tax_type string", "cnt_inn decimal(20,0)", "SUM_income decimal(19,2)", "ratio_SUM_income decimal(5,4)",
    "avg_SUM_dt decimal(19,2)", "ratio_SUM_dt decimal(5,4)", "avg_SUM_kt decimal(19,2)",
    "ratio_SUM_kt decimal(5,4)", "avg_income decimal(19,2)", "avg_employee_ip smallint",
    "SUM_salary decimal(19,2)", "avg_salary decimal(19,2)", "avg_employee decimal(20,0)",
    "ratio_SUM_salary decimal(5,4)", "all_trans_amount decimal(19,2)", "all_trans_cnt decimal(19,2)",
    "all_uniq_client_cnt decimal(19,2)", "all_avg_cheque decimal(19,2)", "ratio_all_trans decimal(5,4)",
    "online_trans_amount decimal(19,2)", "online_trans_cnt decimal(19,2)",
    "online_uniq_client_cnt decimal(19,2)", "online_avg_cheque decimal(19,2)",
    "ratio_online_trans decimal(5,4)", "partition_dt string"])

LAYOUTS = {"fl_trans": FL_TRANS_DDL, "fl_blago": FL_BLAGO_DDL, "ul": UL_DDL}


def read_delimited(spark: SparkSession, path: str, ddl: str, sep: str = ";", encoding: str = "UTF-8",
                   mode: str = "FAILFAST") -> DataFrame:
    """SRC-6: ``;``-separated, ``"``-quoted extract (quotes doubled) with a header line and a fixed layout."""
    return (spark.read.schema(ddl).option("sep", sep).option("quote", '"').option("escape", '"').option("header", True)
                 .option("encoding", encoding).option("lineSep", "\n").option("mode", mode).csv(path))


def read_upload(spark: SparkSession, path: str, kind: str, **kw) -> DataFrame:
    return read_delimited(spark, path, LAYOUTS[kind], **kw)


def parse_delimited(lines: DataFrame, line: str, ddl: str, sep: str = ";", mode: str = "FAILFAST") -> DataFrame:
    """SRC-6 on text rows: each line parsed with the upload options into the given layout."""
    row = F.from_csv(F.col(line), ddl, {"sep": sep, "quote": '"', "escape": '"', "mode": mode})
    return lines.select(row.alias("__row")).select("__row.*")


def parse_headerless(lines: DataFrame, line: str, names: list[str], sep: str = ";") -> DataFrame:
    """SRC-8 on text rows: named columns, and the empty one behind the closing separator dropped."""
    ddl = ", ".join(f"`{n}` string" for n in [*names, "__end"])
    row = F.from_csv(F.col(line), ddl, {"sep": sep})
    return lines.select(row.alias("__row")).select(*[F.col(f"__row.`{n}`") for n in names])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-7: names of the files in a folder (depth 1), without reading their content."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(folder)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("title"))


def read_headerless(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """SRC-8: text table without header whose lines end in the separator: last empty column dropped."""
    df = spark.read.option("sep", sep).option("header", False).option("encoding", encoding).csv(path)
    return df.drop(df.columns[-1])


def list_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-7: names right below a folder, for files as they are and for folders of part files.

    Only the listing is read; the content column is not asked for.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
                  .select(F.split(F.col("path"), re.escape("/" + folder.rstrip("/").split("/")[-1] + "/"), 2).alias("p")))
    return files.select(F.substring_index(F.element_at("p", -1), "/", 1).alias("title")).distinct()


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The lines of a file or of a folder of part files with their global number, from 0.

    Lines are numbered within the blocks that tasks read, and blocks by part and place; the only
    window runs over one row per block.
    """
    where = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    raw = spark.read.text(path).select(*where, F.monotonically_increasing_id().alias("id"), "value")
    blocks = raw.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = running_starts(blocks, "n", [part_number(F.col("file")), "file", "block"], "start")
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    with java_charsets(spark):  # decode takes the list of charsets that stands when it is built
        return raw.join(starts, ["file", "block"]).select((F.col("start") + F.col("id") - F.col("first")).alias("line_no"),
                                                          text.alias("line"))


def first_file(spark: SparkSession, path: str) -> str:
    """The file that holds the first lines of an output (from the listing)."""
    def place(f):
        name = f.rsplit("/", 1)[-1]
        number = re.match(r"part-(\d+)", name)
        return (int(number.group(1)) if number else -1, name)

    return min(spark.read.text(path).inputFiles(), key=place)


def read_two_line_header(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """PRJ-9 / SRC-8: a text table below two header lines, element over attribute.

    The two lines are taken off the first file; the columns are named ``element__attribute``,
    with repeats of an element numbered, and an empty last column (lines that end in the
    separator) is dropped.  The body is one scan with that fixed schema, all text.  A row counts
    as a header line if it stands in the first file's first block and repeats the line in all columns.
    """
    first = first_file(spark, path)
    top = spark.read.option("encoding", encoding).text(first).limit(2)
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    header = list(csv.reader([r[0] for r in top.select(text).collect()], delimiter=sep))
    if len(header) < 2 or len(header[0]) != len(header[1]):
        raise ValueError(f"no two header lines of equal length in {first}")
    raw = [f"c{i}" for i in range(len(header[0]))]
    body = (spark.read.schema(", ".join(f"{c} string" for c in raw)).option("sep", sep).option("quote", '"')
                 .option("escape", '"').option("header", False).option("encoding", encoding).csv(path))
    lines = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v or None)) for c, v in zip(raw, line)]) for line in header]
    top_block = F.col("_metadata.file_path").endswith("/" + first.rsplit("/", 1)[-1]) & (F.col("_metadata.file_block_start") == 0)
    body = body.where(~(top_block & reduce(or_, lines)))
    if not header[0][-1] and not header[1][-1]:
        raw, header = raw[:-1], [line[:-1] for line in header]
    names = [f"{n}__{a}" if a else n for n, a in zip(dedupe_names(header[0]), header[1])]
    return body.select(*[F.col(c).alias(n) for c, n in zip(raw, names)])


# ------------------------------------------------------------------ dictionary (SRC-4)
def read_code_dictionary(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """``code;element`` lines -> ``code int, element string``."""
    return (spark.read.schema("code int, element string").option("sep", sep).option("header", False)
                 .option("encoding", "UTF-8").csv(path).where(F.col("code").isNotNull()))


# ------------------------------------------------------------------ report XML (SRC-3)
_PROLOG = r"^\uFEFF?\s*<\?xml[\s\S]*?\?>"
_DECLARED = r"^[^<]*<\?xml[^>]*?encoding\s*=\s*[\"']([^\"']+)[\"']"


def read_xml_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file_name``, ``content`` (text).

    Files are read as bytes; the charset named in the XML declaration decides the
    decoding, and the declaration is then removed.  Without a declared charset the file is
    UTF-8; a charset that is neither stops the job instead of garbling the names.
    """
    raw = spark.read.format("binaryFile").load(path)
    with java_charsets(spark):
        return raw.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                          xml_text(F.col("content")).alias("content"))


def xml_text(content):
    """The text of an XML file's bytes, by the charset of its declaration, without the declaration."""
    declared = F.regexp_extract(F.decode(content, "ISO-8859-1"), _DECLARED, 1)
    charset = F.lower(declared)
    text = (F.when(charset.isin("windows-1251", "cp1251"), F.decode(content, "windows-1251"))
             .when(charset.isin("", "utf-8", "utf8", "us-ascii"), F.decode(content, "UTF-8"))
             .otherwise(F.raise_error(F.concat(F.lit("unknown charset of an XML file: "), declared))))
    return F.regexp_replace(text, _PROLOG, "")


DOCUMENT = "Документ"
#: files of a listing up to which a table of one row a file is sent whole to the tasks that read the files
SENT_FILES = 100_000


def _sent(per_file: DataFrame, read: DataFrame) -> DataFrame:
    """A table of one row a file, marked to be broadcast unless ``read`` lists too many files: the rows of the
    files, which it is joined to, are then not shuffled.  (Spark takes its size for that of what it is made from.)"""
    return F.broadcast(per_file) if len(read._jdf.inputFiles()) <= SENT_FILES else per_file


def read_report_heads(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SRC-3 for files of any size: ``file_path`` and ``head``, the text before the file's first document.

    The files are read as pieces that end in ``>``, so no task holds more of a file than a tag;
    only the pieces before the first document are put together.  They have to stand in the first
    block that a task reads.  Another charset in the declaration than the one read stops the job.
    """
    latin = "ISO-8859-1"  # one character a byte: the charset is known only once the head is there
    read = spark.read.option("lineSep", ">").text(path)
    pieces = read.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("id"), "value")
    piece = F.decode(F.col("value").cast("binary"), latin)
    tag = F.substring_index(piece, "<", -1)
    names = sorted({DOCUMENT.encode(charset) for charset in {encoding, "UTF-8", "windows-1251"}})
    # the bytes are looked for first: few pieces hold them, and only those are decoded
    holds = reduce(or_, [F.col("value").contains(F.lit(b"<" + n).cast("string")) for n in names])
    opens = holds & reduce(or_, [
        tag.startswith(n.decode(latin)) & F.substring(tag, len(n) + 1, 1).rlike(r"^(\s|/|)$") for n in names])
    first = pieces.where(opens).groupBy("file_path").agg(F.min("id").alias("first"))
    before = pieces.join(_sent(first, read), "file_path").where(F.col("id") < F.col("first"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("id", piece.alias("piece")))), lambda x: F.concat(x["piece"], F.lit(">")))
    heads = _sent(before.groupBy("file_path").agg(F.array_join(parts, "").alias("head")), read)
    declared = F.regexp_extract("head", _DECLARED, 1)
    named = F.lower(F.replace(declared, F.lit("windows-"), F.lit("cp")))
    same = named.isin("", encoding.lower().replace("windows-", "cp"), encoding.lower().replace("-", ""))
    return heads.select("file_path", F.when(same, F.decode(F.encode("head", latin), encoding)).otherwise(F.raise_error(
        F.concat(F.lit(f"an XML file read as {encoding} declares the charset "), declared))).alias("head"))


def read_report_documents(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """SRC-3 for files of any size: one row per ``Документ`` (``file_path``, ``doc_no``, ``doc``), cut by the reader.

    The row-tag source streams through a file, so a file of many documents is no single row.  Its
    rows are written once; a document's number is its place among those of its file.  A
    document that is cut off or not well-formed gives no row, the whole ones before it do.
    """
    bad = "_corrupt_record"
    docs = (spark.read.format("xml").option("rowTag", DOCUMENT).option("encoding", encoding).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", bad).schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())]))
                 .load(path))
    rows = docs.select(F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("id"),
                       F.struct(*[F.col(f"`{f.name}`") for f in schema]).alias("doc"), F.col(bad).isNull().alias("whole"))
    folder = checkpoint_path(spark, f"documents-{uuid.uuid4().hex}")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder).where("whole")
    first = rows.groupBy("file_path").agg(F.min("id").alias("first"))
    return rows.join(_sent(first, docs), "file_path").select("file_path", (F.col("id") - F.col("first")).cast("int").alias("doc_no"), "doc")


# ------------------------------------------------------------------ cell tables (SRC-5)
def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, sep: str = ";") -> DataFrame:
    """Cell tables: Parquet, or CSV with a header and a given schema (Spark has no Excel source)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    if schema is None:
        raise ValueError("a CSV cell table needs its schema")
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "FAILFAST").csv(path)
