"""Sinks (SNK-1 .. SNK-3; SNK-4 is ``operators.increment.append_new``).

An output is a folder of part files whose concatenation in part order is the one file that
the reference writes: the header lines are the first part, and the body follows in the
order of its sort (a range-partitioned sort keeps parts in order).  Output names
carry a ``run_date`` parameter instead of today's date so that reruns are repeatable (DAT-5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import java_charsets


def dated(root: str, name: str, run_date: str) -> str:
    """DAT-5: path of an output of one run."""
    return f"{root.rstrip('/')}/{name}_{run_date}"


def header_rows(df: DataFrame, header: list[list[str]], names: list[str]) -> DataFrame:
    """The header lines as rows of one partition, in order."""
    lines = df.sparkSession.range(0, len(header), 1, 1)
    at = F.col("id").cast("int") + 1
    return lines.select(*[F.element_at(F.array(*[F.lit(h[i]) for h in header]), at).alias(n) for i, n in enumerate(names)])


def write_lines(df: DataFrame, path: str, header: list[list[str]], sep: str = ";", encoding: str = "UTF-8",
                closing: bool = False, mode: str = "overwrite") -> None:
    """``df`` as text lines below its header lines, parts in the order of ``df``.

    ``closing`` ends every line in the separator.  Nulls are empty; a field with the separator, a
    quote or a line break is quoted, and quotes in it are doubled.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    body = df.select(*[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(df.columns, names)])
    out = header_rows(df, header, names).unionAll(body)
    if closing:
        out = out.withColumn("end", F.lit(None).cast("string"))
    with java_charsets(df.sparkSession):
        (out.write.mode(mode).option("header", False).option("sep", sep).option("encoding", encoding)
            .option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_indicator_csv(df: DataFrame, path: str, encoding: str = "cp1251", mode: str = "overwrite") -> None:
    """SNK-1: the unified indicator table below one header line, cp1251, in the order of ``df``.

    ``df`` should come from ``indicator_export`` (already in file order).
    """
    write_lines(df, path, [df.columns], ",", encoding, mode=mode)


def two_level(columns: list[str]) -> list[list[str]]:
    """Two header lines (element over attribute) of ``element__attribute`` columns."""
    cut = [c.rpartition("__") for c in columns]
    return [[name or attr for name, _, attr in cut], [attr if name else "" for name, _, attr in cut]]


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite", closing: bool = False,
                     header: list[list[str]] | None = None) -> None:
    """SNK-2: wide reports, ``;``-separated UTF-8, below two header lines: element over attribute.

    ``header`` gives other lines (``reports.header_lines``: elements without repeat numbers).
    """
    write_lines(df, path, header or two_level(df.columns), ";", "UTF-8", closing, mode)


def write_wide_reports(tables: dict[str, DataFrame], root: str, run_date: str, mode: str = "overwrite",
                       headers: dict[str, list[list[str]]] | None = None) -> dict:
    """SNK-3: each report kind to its own dated folder, lines ending in ``;``; returns kind -> path."""
    out = {}
    for kind, df in tables.items():
        out[kind] = dated(root, f"reports_{kind}", run_date)
        write_report_csv(df, out[kind], mode, closing=True, header=(headers or {}).get(kind))
    return out
