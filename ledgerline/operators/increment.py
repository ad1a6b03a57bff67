"""Incremental load by reporting period (CMP-9, CMP-15, CMP-16, WIN-1, TOP-1).

Only periods absent from the history are appended; running the same upload
twice appends nothing the second time.  The history is partitioned by the period column:
a filter or join on the period reads the files of the wanted periods only, and the
periods themselves are known from the commit entries or the directory listing, without rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_in_name, period_text, previous_month_start
from ..functions.text import route_by_name
from ..session import create_once, materialize

# Which upload layout a file name announces (CHARINDEX order of the reference).
KIND_RULES = [("fl_trans", "fl_trans"), ("fl_blago", "fl_blago"), ("ul_", "ul")]


def file_catalog(files: DataFrame, title: str = "title") -> DataFrame:
    """Titles with their date, kind and reporting period (first day of the previous month)."""
    d = date_in_name(title)
    return (files.where(F.col(title).like("%.csv"))
                 .select(F.col(title).alias("title"), d.alias("file_date"),
                         route_by_name(F.col(title), KIND_RULES).alias("kind"),
                         period_text(previous_month_start(d)).alias("actdate")))


def latest_file(files: DataFrame, title: str = "title", by: list[str] | None = None) -> DataFrame:
    """TOP-1 / CMP-9: newest ``.csv`` by the date in its name (ties: the larger title).

    One partial aggregate of ``max(struct(date, title))``: no sort of the listing.
    ``by`` gives the newest per group instead (e.g. per kind).
    """
    cat = file_catalog(files, title)
    best = F.max(F.struct("file_date", "title", "kind", "actdate")).alias("best")
    agg = cat.groupBy(*by).agg(best) if by else cat.agg(best)
    cols = [F.col(f"best.{c}").alias(c) for c in ("title", "file_date", "kind", "actdate") if c not in (by or [])]
    return agg.select(*(by or []), *cols)


def period_frequency(periods: DataFrame, col: str = "partition_dt") -> DataFrame:
    """WIN-1: ``COUNT(p) OVER (PARTITION BY p)`` on a table of periods."""
    return periods.withColumn("freq", F.count(col).over(Window.partitionBy(col)))


def stacked_periods(upload: DataFrame, history: DataFrame, col: str = "partition_dt") -> DataFrame:
    """SET-3: distinct periods of the upload over distinct periods of the history (UNION ALL)."""
    return upload.select(col).distinct().unionAll(history.select(col).distinct())


def new_periods(upload: DataFrame, history: DataFrame, col: str = "partition_dt") -> DataFrame:
    """CMP-15: periods of the upload that the history does not hold.

    Same rows as the reference's "frequency 1 and NOT IN history"; null
    periods are never new (NOT IN over a null would empty the result, so nulls
    are dropped on both sides and a plain anti join is used).
    """
    u = upload.select(col).where(F.col(col).isNotNull()).distinct()
    h = history.select(col).where(F.col(col).isNotNull()).distinct()
    return u.join(h, col, "left_anti")


def rows_to_append(upload: DataFrame, history: DataFrame, col: str = "partition_dt") -> DataFrame:
    """JON-7: upload rows whose period is new (``WHERE p IN (SELECT * FROM Uniq)``), by a semi join."""
    return upload.join(new_periods(upload, history, col), col, "left_semi")


# ------------------------------------------------------------------ the history and its commit entries
LOG_DDL = "version long, load string, periods array<string>, lost array<string>"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet folder; None when there is none.

    Only a missing path means "no history": any other failure is raised, since a history taken for
    empty would be loaded twice.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _log(history_path: str) -> str:
    return history_path.rstrip("/") + "_log"


def _loads(history_path: str) -> str:
    return history_path.rstrip("/") + "_loads"


def commit_entries(spark: SparkSession, history_path: str) -> list:
    """The numbered commit entries of a history, oldest first: one row per append."""
    try:
        log = spark.read.schema(LOG_DDL).json(_log(history_path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(log.collect(), key=lambda r: r["version"])


def listed_periods(spark: SparkSession, path: str, col: str = "partition_dt") -> DataFrame:
    """JON-8: the periods of a period-partitioned folder, from its listing: no file is opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                  .option("pathGlobFilter", "*.parquet").load(path).select("path"))
    name = F.regexp_extract("path", f"/{col}=([^/]*)/", 1)
    found = files.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias(col)).distinct()
    return found.where(~F.col(col).isin("", "__HIVE_DEFAULT_PARTITION__"))


def write_history(df: DataFrame, path: str, col: str = "partition_dt", mode: str = "errorifexists") -> None:
    """Rows in one folder per period.  The rows of a period are brought together, a large period in
    several tasks (rebalanced by size, not dealt to one task by key)."""
    df.hint("rebalance", F.col(col)).write.mode(mode).partitionBy(col).parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType, col: str = "partition_dt") -> DataFrame | None:
    """The committed rows of a period-partitioned history; None when there is none yet.

    It has the upload's layout; reading it with that schema keeps the period as text
    (partition discovery would turn ``yyyy-MM-dd`` into a date).  A load without a commit entry
    (a run that died, or has not finished) is not read, nor are periods that another run
    committed first.  Filters on the period prune folders in every load.
    """
    base = _read(spark, path, schema)
    entries = [e for e in commit_entries(spark, path) if e["load"]]
    if not entries:
        return base
    root = _loads(path)
    wide = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    loads = spark.read.schema(wide).option("basePath", root).parquet(*[f"{root}/load={e['load']}" for e in entries])
    for e in entries:
        if e["lost"]:
            loads = loads.where(~((F.col("load") == e["load"]) & F.col(col).isin(e["lost"])))
    loads = loads.select(*[F.col(f"`{f.name}`") for f in schema])
    return loads if base is None else base.select(*loads.columns).unionAll(loads)


def _commit(spark: SparkSession, history_path: str, version: int, load: str | None, periods: list[str], lost: list[str]) -> bool:
    """Write commit entry ``version`` unless another run has; whether it is ours."""
    entry = {"version": version, "load": load, "periods": periods, "lost": lost}
    return create_once(spark, f"{_log(history_path)}/{version:020d}.json", json.dumps(entry, ensure_ascii=False) + "\n")


def append_new(spark: SparkSession, upload: DataFrame, history_path: str,
               col: str = "partition_dt", checks: DataFrame | None = None,
               on_fail: str = "append") -> dict:
    """CMP-16 / SNK-4: add the rows of new periods to a period-partitioned Parquet history.

    The rows are written first, into a folder of this run; what counts as loaded is decided by
    numbered commit entries (``<history>_log``), each created only if it is not there yet.  So of
    two runs that append at once one gets the number; the other reads the entries again,
    gives up the periods that have come in meanwhile, and tries the next number.  Every row
    is in the history once; a run that dies before its entry leaves a folder that nobody
    reads, and is repeated whole.  Entry 0 holds the periods of a history that is older than its
    entries, taken from its listing.

    ``checks`` is a check summary (``check_summary``); with ``on_fail="block"`` a failed
    check stops the append.  The reference's gate is always open (decision D-5), hence
    the default ``"append"``.  Returns a small status dict; only periods reach the driver.
    """
    if checks is not None and on_fail == "block" and not checks.where(F.col("failed")).isEmpty():
        return {"status": "blocked", "n_periods": 0}
    entries = commit_entries(spark, history_path)
    if not entries:
        old = _read(spark, history_path, upload.schema)
        held = [] if old is None else sorted(r[0] for r in listed_periods(spark, history_path, col).collect())
        _commit(spark, history_path, 0, None, held, [])
        entries = commit_entries(spark, history_path)
    load, written = uuid.uuid4().hex, None
    while True:
        done = {p for e in entries for p in e["periods"]}
        if written is None:
            held = spark.createDataFrame([(p,) for p in sorted(done)], T.StructType([T.StructField(col, T.StringType())]))
            # the rows and the entry follow from one list of periods
            new = materialize(new_periods(upload.withColumn(col, F.col(col).cast("string")), held, col))
            written = sorted(r[0] for r in new.collect())
            if written:
                write_history(upload.join(new, col, "left_semi"), f"{_loads(history_path)}/load={load}", col)
        mine = [p for p in written if p not in done]
        if not mine:
            return {"status": "no new periods", "n_periods": 0}
        if _commit(spark, history_path, entries[-1]["version"] + 1, load, mine, [p for p in written if p in done]):
            return {"status": "appended", "n_periods": len(mine)}
        entries = commit_entries(spark, history_path)
