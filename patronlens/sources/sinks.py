"""Writers for result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_row_number


def write_csv(df: DataFrame, path: str, position_order: Sequence[Column] | None = None) -> None:
    """CSV with header; with an order given, a 0-based position leads every row."""
    if position_order:
        df = with_row_number(df, position_order, "_n").select((F.col("_n") - 1).alias("position"), *df.columns)
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def export_keys(df: DataFrame, condition: Column, key: str, name: str) -> DataFrame:
    """One-column table of the keys that meet a condition."""
    return df.where(condition).select(F.col(key).alias(name))
