"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import ACCURACY, group_quantiles, quantile_row


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    filled = df.crossJoin(F.broadcast(means)).withColumns({c: F.coalesce(c, f"_mean_{c}") for c in cols})
    return filled.drop(*[f"_mean_{c}" for c in cols])


def fill_median(df: DataFrame, cols: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    medians = quantile_row(df, cols, [0.5], accuracy)
    filled = df.crossJoin(F.broadcast(medians)).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"q_{c}")[0]) for c in cols}
    )
    return filled.drop(*[f"q_{c}" for c in cols])


def fill_group_median(df: DataFrame, column: str, group: str, accuracy: int = ACCURACY) -> DataFrame:
    """Fill from the median of the row's group; rows without a group stay as they are."""
    named = df.where(F.col(group).isNotNull())
    medians = group_quantiles(named, [group], column, {"_median": 0.5}, accuracy)
    joined = named.join(medians, group, "left")
    filled = joined.withColumn(column, F.coalesce(F.col(column).cast("double"), "_median")).select(*df.columns)
    rest = df.where(F.col(group).isNull()).withColumn(column, F.col(column).cast("double"))  # kept out of the join: all one key
    return filled.unionByName(rest)


def mode_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent value per column; the smallest one among ties."""
    from .encoding import frequency_table

    table = frequency_table(df, cols)
    best = table.groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best"))
    return best.agg(*[F.max(F.when(F.col("column_name") == c, F.col("best.value"))).alias(f"mode_{c}") for c in cols])


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    if not cols:
        return df
    modes = mode_row(df, cols)
    filled = df.crossJoin(F.broadcast(modes)).withColumns({c: F.coalesce(c, f"mode_{c}") for c in cols})
    return filled.drop(*[f"mode_{c}" for c in cols])
