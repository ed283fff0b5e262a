"""Outlier limits, capping, flags and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import ACCURACY, exact_quantiles, quantile_row


def _limits(q: Column) -> tuple[Column, Column]:
    spread = q[1] - q[0]
    return q[0] - 1.5 * spread, q[1] + 1.5 * spread


def outlier_limits(
    df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99, accuracy: int = ACCURACY
) -> DataFrame:
    """(column_name, low_limit, up_limit): quantiles widened by 1.5 times their distance."""
    table = exact_quantiles(df, cols, [low, high], accuracy=accuracy)
    lo, up = _limits(F.col("q"))
    return table.select("column_name", lo.alias("low_limit"), up.alias("up_limit"))


def _with_limits(df: DataFrame, cols: Sequence[str], low: float, high: float, accuracy: int) -> DataFrame:
    return df.crossJoin(F.broadcast(quantile_row(df, cols, [low, high], accuracy)))


def cap_upper(
    df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99, accuracy: int = ACCURACY
) -> DataFrame:
    """Values above the upper limit become the limit; low values and NULL stay.

    The limits of all columns come from one job over the uncapped rows.
    """
    limited = _with_limits(df, cols, low, high, accuracy)
    made = {}
    for c in cols:
        up = _limits(F.col(f"q_{c}"))[1]
        made[c] = F.when(F.col(c) > up, up).otherwise(F.col(c).cast("double"))
    return limited.withColumns(made).drop(*[f"q_{c}" for c in cols])


def _is_outlier(c: str) -> Column:
    lo, up = _limits(F.col(f"q_{c}"))
    return F.coalesce((F.col(c) < lo) | (F.col(c) > up), F.lit(False))


def has_outlier(
    df: DataFrame, cols: Sequence[str], low: float = 0.01, high: float = 0.99, accuracy: int = ACCURACY
) -> DataFrame:
    """(column_name, has_outlier) for every column, from one aggregate."""
    flags = _with_limits(df, cols, low, high, accuracy).agg(
        *[F.coalesce(F.max(_is_outlier(c)), F.lit(False)).alias(c) for c in cols]
    )
    return flags.unpivot([], list(cols), "column_name", "has_outlier")


def outlier_rows(
    df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, accuracy: int = ACCURACY
) -> DataFrame:
    """The rows whose value lies outside the limits."""
    limited = _with_limits(df, [column], low, high, accuracy)
    return limited.where(_is_outlier(column)).drop(f"q_{column}")
