"""Statistical indicators from paged records (CMP-2 and its parts).

The reference pulls four indicators page by page, filters each page, decodes
two id columns through name trees, cleans the value text, takes the minimum per
key and stacks the four results.  Here all indicators travel in one DataFrame:
the four near-copies become one 4-row spec table, so the whole job is one plan
(one scan, two dimension joins, one aggregate).
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import export_date
from ..functions.numbers import decimal_comma
from ..functions.text import EMPTY, GOOD, UNREADABLE, clean_value, value_state

# The indicators of the reference job -- id (DIM_1743), flag column that
# must equal 1, value mode, and the label written to DIM_1.
INDICATOR_SPEC = [
    (50, "DIM_1294", "plain", "количество действующих ИП, сведения о которых содержатся в ЕГРИП"),
    (9950, "DIM_1294", "plain", "количество зарегистрированных ИП в ЕГРИП"),
    (53, "DIM_1296", "plain", "количество прекративших деятельность ИП, сведения о которых внесены в ЕГРИП"),
    (51, "DIM_1296", "scaled", "количество прекративших деятельность ИП, сведения о которых содержатся в ЕГРИП"),
]
# Constant output columns of the unified table
UNIT_LABEL = "ед."
DIM_3_TEXT = "null"

PAGE_FIELDS = ["DIM_1293", "DIM_1743", "DIM_1294", "DIM_1296", "DIM_1297", "DIM_369", "DIM_1295"]
PAGE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in PAGE_FIELDS]
                           + [T.StructField("DT", T.StringType()), T.StructField("VL", T.StringType())])
OUT_COLS = ["DIM_1", "DIM_2", "DIM_3", "DIM_4", "DIM_5", "date", "val"]


def spec_frame(spark: SparkSession, spec=INDICATOR_SPEC) -> DataFrame:
    rows = [(float(i), flag, mode, label, n) for n, (i, flag, mode, label) in enumerate(spec)]
    return spark.createDataFrame(rows, "ind_id double, flag_col string, mode string, label string, ordinal int")


def filter_indicator(pages: DataFrame, spec: DataFrame) -> DataFrame:
    """FLT-1: ``DIM_1293 = 2 and DIM_1743 = id and <flag> = 1 and DIM_1297 = 22`` for every spec row.

    The spec is a literal table of a few rows, so broadcasting it is safe.
    """
    j = pages.where((F.col("DIM_1293") == 2.0) & (F.col("DIM_1297") == 22.0)) \
             .join(F.broadcast(spec), F.col("DIM_1743") == F.col("ind_id"))
    flag = F.when(F.col("flag_col") == "DIM_1294", F.col("DIM_1294")).otherwise(F.col("DIM_1296"))
    return j.where(flag == 1.0)


def decode_dimension(df: DataFrame, col: str, dim: DataFrame, out: str | None = None,
                     id_col: str = "id", name_col: str = "name") -> DataFrame:
    """JON-1: replace an id by its name; ids without a name stay, as text."""
    out = out or col
    d = dim.select(F.col(id_col).alias("__id"), F.col(name_col).alias("__name"))
    j = df.join(d, F.col(col) == F.col("__id"), "left")
    return j.withColumn(out, F.coalesce(F.col("__name"), F.col(col).cast("string"))).drop("__id", "__name")


def min_by_keys(df: DataFrame, keys: list[str], value: str, out: str | None = None) -> DataFrame:
    """AGG-1: minimum per key; rows with a null key are dropped (pandas groupby), nulls skipped."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.min(value).alias(out or value))


VALUE_STATES = (GOOD, EMPTY, UNREADABLE)


def observe_values(df: DataFrame, counts: Observation, ordinals: list[int], value: str = "VL",
                   ordinal: str = "ordinal") -> DataFrame:
    """D-3: count good, empty and unreadable values of each indicator while ``df`` is computed.

    The counts ride on the plan (``CollectMetrics``): no second scan, no row changes.  They are
    there (``value_counts``) once an action has run.  Spark adds up what tasks report, so
    tasks that a lost executor makes run again may count twice; a count of bad values is a sign,
    not a ledger.
    """
    state = value_state(value)
    return df.observe(counts, *[F.count_if((F.col(ordinal) == o) & (state == s)).alias(f"{s}_{o}")
                                for o in ordinals for s in VALUE_STATES])


def value_counts(spark: SparkSession, counts: Observation, labels: dict[int, str]) -> DataFrame:
    """The observed counts as rows: ordinal, DIM_1, good, empty, unreadable (one row an indicator)."""
    got = counts.get
    rows = [(o, label, *[got[f"{s}_{o}"] for s in VALUE_STATES]) for o, label in labels.items()]
    return spark.createDataFrame(rows, "ordinal int, DIM_1 string, good long, empty long, unreadable long")


def build_indicators(pages: DataFrame, categories: DataFrame, slices: DataFrame,
                     spec: DataFrame, counts: Observation | None = None,
                     ordinals: list[int] = tuple(range(len(INDICATOR_SPEC)))) -> DataFrame:
    """CMP-2: filter, decode, clean, min and unify all indicators in one plan.

    Output ``DIM_1 .. DIM_5, date, val`` plus ``ordinal`` (the spec order, used
    by the export sort).  With ``counts`` the values of the indicators ``ordinals`` are
    counted beside the plan (``observe_values``).
    """
    f = filter_indicator(pages, spec)
    if counts is not None:
        f = observe_values(f, counts, list(ordinals))
    f = decode_dimension(f, "DIM_1295", categories, "DIM_2")
    f = decode_dimension(f, "DIM_369", slices, "DIM_5")
    val = F.when(F.col("mode") == "scaled", clean_value("VL", "scaled")).otherwise(clean_value("VL", "plain"))
    f = f.select(F.col("label").alias("DIM_1"), "ordinal", "DIM_2", "DIM_5", F.col("DT").alias("date"),
                 val.alias("val"))
    m = min_by_keys(f, ["DIM_5", "DIM_1", "ordinal", "DIM_2", "date"], "val")
    return m.select("DIM_1", "DIM_2", F.lit(DIM_3_TEXT).alias("DIM_3"), F.lit(UNIT_LABEL).alias("DIM_4"),
                    "DIM_5", "date", "val", "ordinal")


def indicator_export(ind: DataFrame, date_fmt: str = "MM.dd.yyyy") -> DataFrame:
    """SRT-1 / STR-4 / DAT-2: text form of the unified table, in the order the file is written.

    Dates that do not parse become null (``errors='coerce'``); values get a
    decimal comma; rows are ordered by indicator, then DIM_2..DIM_5 and date.
    """
    d = F.try_to_date(F.col("date"))
    out = ind.select("ordinal", "DIM_1", "DIM_2", "DIM_3", "DIM_4", "DIM_5", d.alias("__d"),
                     export_date(d, date_fmt).alias("date"), decimal_comma("val").alias("val"))
    return (out.orderBy("ordinal", F.asc_nulls_last("DIM_2"), "DIM_3", "DIM_4", F.asc_nulls_last("DIM_5"),
                        F.asc_nulls_last("__d"))
               .select(*OUT_COLS))


def failed_pages(df: DataFrame, indicator: str, page: str, bad, records_of: str, expected: DataFrame | None = None,
                 expected_count: str = "n_expected") -> DataFrame:
    """AGG-9: per indicator: pages landed, pages that failed, pages missing, and records
    loaded (non-null ``records_of`` values).

    ``expected`` (indicator, ``expected_count``) is the page count that the service states
    before the pull; missing = expected - landed, and an indicator with no page at all is
    a row too.  Without it only gaps between the first and the last landed page show.

    Two-stage aggregate: first one row per (indicator, page), then per
    indicator -- every stage is a partial + final hash aggregate.  Counting a
    data column also keeps a raw JSON scan legal (Spark refuses queries that
    read nothing but the corrupt-record column).
    """
    bad = F.col(bad) if isinstance(bad, str) else bad
    per_page = df.groupBy(indicator, page).agg(F.max(bad.cast("int")).alias("__bad"),
                                               F.count(records_of).alias("__rec"))
    out = per_page.groupBy(indicator).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("__bad").cast("long").alias("failed_pages"),
        (F.max(page) - F.min(page) + 1 - F.count(F.lit(1))).cast("long").alias("missing_pages"),
        F.sum("__rec").cast("long").alias("records"))
    if expected is None:
        return out
    e = expected.select(indicator, F.col(expected_count).cast("long").alias("__expected"))
    j = e.join(out, indicator, "full_outer")
    n = F.coalesce("n_pages", F.lit(0).cast("long"))
    return j.select(indicator, n.alias("n_pages"), F.coalesce("failed_pages", F.lit(0).cast("long")).alias("failed_pages"),
                    F.coalesce(F.greatest(F.col("__expected") - n, F.lit(0).cast("long")), "missing_pages").alias("missing_pages"),
                    F.coalesce("records", F.lit(0).cast("long")).alias("records"))


def columns_with_values(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """The columns that hold any value: one aggregate counts the non-null values of all at once."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if counts[f"c{i}"] > 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """PRJ-7: drop columns that hold no value at all.

    One aggregate job (an action: the column list depends on the data).
    """
    return df.select(*[F.col(f"`{c}`") for c in columns_with_values(df)])


#: read Parquet by the source that takes aggregates down to the footers
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Non-null counts of flat columns, answered from the footers of the Parquet files.

    The plan holds no column data (``PushedAggregation``).
    """
    before = {k: spark.conf.get(k, None) for k in FOOTER_CONF}
    try:
        for k, v in FOOTER_CONF.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(path).agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
        df._jdf.queryExecution().executedPlan()  # planned while the settings hold
        return df
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_null_file_columns(spark: SparkSession, path: str) -> DataFrame:
    """PRJ-7 on Parquet files: columns without any value are dropped by the files' own statistics.

    Nested columns have no count in a footer, and files without statistics refuse; both are counted
    by a scan instead.
    """
    df = spark.read.parquet(path)
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [f.name for f in df.schema if not isinstance(f.dataType, nested)]
    try:
        counts = footer_counts(spark, path, flat).first()
        full = {c for i, c in enumerate(flat) if counts[i] > 0}
    except PySparkException:
        full = set(columns_with_values(df, flat))
    rest = [c for c in df.columns if c not in flat]
    full |= set(columns_with_values(df, rest)) if rest else set()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in full])
