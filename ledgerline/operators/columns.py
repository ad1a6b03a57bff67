"""Column-list helpers that are not tied to one job (PRJ-2, PRJ-8 on a plain name list)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """PRJ-2: new names assigned by position."""
    return df.toDF(*names)


def dedupe_names(names: list[str]) -> list[str]:
    """PRJ-8: the n-th repeat of a name gets ``_n`` (first keeps its name), as a header
    line read without names is renamed."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n, 0)
        seen[n] = k + 1
        out.append(n if k == 0 else f"{n}_{k}")
    return out


def unused_name(stem: str, taken: list[str]) -> str:
    """A column name that none of the given columns has, whatever its case."""
    low = {c.lower() for c in taken}
    while stem.lower() in low:
        stem += "_"
    return stem
