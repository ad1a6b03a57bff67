"""Text and code helpers: value cleaning (CMP-1), code kind (FLT-3), routing (FLT-12/13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_col

# Fixed value: what counts as a number for the code-kind test (T-SQL ISNUMERIC,
# without the lone sign / currency cases).
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

TOTAL, GROUP, CODE = "total", "group", "code"


def code_kind(code) -> Column:
    """Level of a row from its code column: null = grand total, digits = code, text = group."""
    c = as_col(code)
    return (F.when(c.isNull(), F.lit(TOTAL))
             .when(c.rlike(NUMERIC_PATTERN), F.lit(CODE))
             .otherwise(F.lit(GROUP)))


def _digits(v: Column) -> Column:
    # "1 234,5%" -> "1234.5"
    return F.replace(F.replace(F.replace(v, F.lit(" "), F.lit("")), F.lit(","), F.lit(".")),
                     F.lit("%"), F.lit(""))


def clean_value(vl, mode: str = "plain") -> Column:
    """Indicator text to double (CMP-1).

    plain : ``"1 234,5"`` -> 1234.5, ``"12%"`` -> 12.0, ``"-"`` -> null
    scaled: values without ``%`` are divided by 1000, ``"-"`` -> 0.0
    Text that is not a number becomes null (``try_cast``) instead of stopping the job.
    """
    v = as_col(vl)
    num = _digits(v).try_cast("double")
    if mode == "plain":
        return F.when(v == "-", F.lit(None).cast("double")).otherwise(num)
    if mode == "scaled":
        return (F.when(v == "-", F.lit(0.0))
                 .when(F.contains(v, F.lit("%")), num)
                 .otherwise(num / 1000.0))
    raise ValueError(f"unknown mode {mode!r}")


GOOD, EMPTY, UNREADABLE = "good", "empty", "unreadable"


def value_state(vl) -> Column:
    """What ``clean_value`` makes of a value text: a number, nothing (null, blank, ``-``), or
    text that is no number (D-3: it becomes null and is counted)."""
    v = as_col(vl)
    return (F.when(v.isNull() | (F.trim(v) == "") | (v == "-"), F.lit(EMPTY))
             .when(_digits(v).try_cast("double").isNotNull(), F.lit(GOOD)).otherwise(F.lit(UNREADABLE)))


def route_by_name(name, rules: list[tuple[str, str]]) -> Column:
    """First rule whose needle occurs in ``name`` gives the kind (CHARINDEX > 0); else null."""
    n = as_col(name)
    out = None
    for needle, kind in rules:
        cond = F.instr(n, needle) > 0
        out = F.when(cond, F.lit(kind)) if out is None else out.when(cond, F.lit(kind))
    return out


def route_by_prefix(name, prefixes: dict[str, str], length: int = 8) -> Column:
    """Kind from the first ``length`` characters of an id (FLT-12); other ids give null."""
    # a lookup, so that the id, however it is made, is worked out once
    return F.element_at(F.create_map(*[F.lit(x) for p in prefixes.items() for x in p]), F.substring(as_col(name), 1, length))


def letter_count(s, letter: str) -> Column:
    """How often one letter occurs (STR-9)."""
    return F.regexp_count(as_col(s), F.lit(letter))
