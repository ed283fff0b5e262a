"""Label, one-hot and rare-value encoding.

Each encoder learns its mapping from one DataFrame and can be applied to others,
so that test rows never influence what was learned on training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import with_row_number

RARE = "Rare"


def frequency_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for every non-null value of every column, in one shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(cells).alias("cell")).select("cell.*")
    return long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def category_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column, for columns whose levels become columns themselves."""
    found = {c: [] for c in cols}
    if cols:
        for row in frequency_table(df, cols).select("column_name", "value").collect():
            found[row.column_name].append(row.value)
    return {c: sorted(values) for c, values in found.items()}


def level_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, code): position of every distinct value among its column's sorted values, from 0.

    Levels are numbered over one range-split order of all columns, so any number of them is numbered in many tasks.
    """
    levels = frequency_table(df, cols).select("column_name", "value")
    numbered = with_row_number(levels, [F.col("column_name").asc(), F.col("value").asc()], "_n")
    starts = numbered.groupBy("column_name").agg(F.min("_n").alias("_first"))
    return numbered.join(F.broadcast(starts), "column_name").select("column_name", "value", (F.col("_n") - F.col("_first")).cast("int").alias("code"))


def label_encode(df: DataFrame, cols: Sequence[str], codes: DataFrame | None = None) -> DataFrame:
    """Each column's value becomes its code; unseen and missing give NULL. A column without levels stays as it is.

    ``codes`` (see ``level_codes``) may come from other rows. They are joined, so levels may be many.
    """
    if not cols:
        return df
    codes = level_codes(df, cols) if codes is None else codes
    known = {r[0] for r in codes.select("column_name").distinct().collect()}
    names = df.columns
    for c in [c for c in cols if c in known]:
        own = codes.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = df.join(own, F.col(c).cast("string") == F.col("_value"), "left").drop("_value", c).withColumnRenamed("_code", c)
    return df.select(*names)


def one_hot(
    df: DataFrame, cols: Sequence[str], levels: dict[str, list[str]] | None = None, drop_first: bool = False
) -> DataFrame:
    """Named 0/1 columns ``<col>_<value>`` in place of each column; NULL gives all zeros.

    A dot in a value becomes '_' in the name, since a dot in a column name means a field.
    """
    levels = levels if levels is not None else category_levels(df, cols)
    made = {
        f"{c}_{v}".replace(".", "_"): F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0))
        for c in cols
        for v in levels[c][1 if drop_first else 0 :]
    }
    return df.withColumns(made).drop(*cols)


def rare_values(df: DataFrame, cols: Sequence[str], ratio: float) -> DataFrame:
    """(column_name, value) of every value held by less than ``ratio`` of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    table = frequency_table(df, cols).crossJoin(F.broadcast(total))
    return table.where(F.col("n") / F.col("rows") < ratio).select("column_name", "value")


def common_levels(df: DataFrame, cols: Sequence[str], ratio: float) -> dict[str, list[str]]:
    """Values per column held by at least ``ratio`` of all rows.

    At most ``1 / ratio`` values per column can qualify, so the result is bounded
    whatever the number of distinct values.
    """
    if not cols:
        return {}
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    table = frequency_table(df, cols).crossJoin(F.broadcast(total))
    found = {c: [] for c in cols}
    for row in table.where(F.col("n") / F.col("rows") >= ratio).select("column_name", "value").collect():
        found[row.column_name].append(row.value)
    return {c: sorted(values) for c, values in found.items()}


def rare_encode(
    df: DataFrame, cols: Sequence[str], ratio: float = 0.01, common: dict[str, list[str]] | None = None
) -> DataFrame:
    """Values below the ratio become 'Rare'; NULL stays NULL."""
    common = common if common is not None else common_levels(df, cols, ratio)
    made = {}
    for c in cols:
        text = F.col(c).cast("string")
        made[c] = F.when(text.isin(common[c]), text).when(text.isNotNull(), F.lit(RARE)) if common[c] else (
            F.when(text.isNotNull(), F.lit(RARE))
        )
    return df.withColumns(made)
