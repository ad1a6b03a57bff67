"""Date helpers (DAT-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_col


def date_in_name(title) -> Column:
    """``..._YYYYMMDD.csv`` -> date (DAT-3): the 8 characters before the 4-character extension."""
    t = as_col(title)
    return F.try_to_date(F.substring(t, -12, 8), "yyyyMMdd")


def previous_month_start(d) -> Column:
    """First day of the month before ``d`` (DAT-4): 2022-03-15 -> 2022-02-01."""
    return F.trunc(F.add_months(as_col(d), -1), "MM")


def period_text(d) -> Column:
    """Period key as text ``yyyy-MM-dd`` (kept as text: the checks apply LIKE '%-%')."""
    return F.date_format(as_col(d), "yyyy-MM-dd")


def month_period(ts) -> Column:
    return period_text(F.trunc(as_col(ts).cast("date"), "MM"))


def export_date(d, fmt: str = "MM.dd.yyyy") -> Column:
    """Date as text for the indicator export (DAT-2, decision D-4: month.day.year)."""
    return F.date_format(as_col(d), fmt)
