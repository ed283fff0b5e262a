"""Long to wide with columns found in the data, and the sparse form for more levels than a table should have columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that a wide table may get from the data.
WIDEST = 2_000


def levels_of(df: DataFrame, column: str, widest: int = WIDEST) -> list:
    """The levels of a column in order, without null; more than ``widest`` are an error, so no level is ever left out."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(widest + 1).collect()
    if len(found) > widest:
        raise ValueError(f"{column} has more than {widest} levels; use sparse_cells")
    return sorted(r[0] for r in found)


def wide_cells(df: DataFrame, by: Sequence[str], column: str, value: Column, levels: Sequence | None = None, widest: int = WIDEST) -> DataFrame:
    """One row per ``by`` and one column per level of ``column``, holding the aggregate ``value``; NULL where there is none.

    Without ``levels`` they are read from the data first. A null level gives no column.
    """
    levels = levels_of(df, column, widest) if levels is None else list(levels)
    if not levels:
        return df.select(*by).distinct()
    return df.groupBy(*by).pivot(column, levels).agg(value)


def sparse_cells(df: DataFrame, by: Sequence[str], column: str, value: Column, name: str = "cells") -> DataFrame:
    """One row per ``by`` with a sorted array of (level, value), for any number of levels.

    Values are aggregated per cell before they are gathered, so a row holds its own levels and nothing per line.
    """
    cells = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(value.alias("value"))
    return cells.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(column).alias("level"), "value"))).alias(name))
