"""Monthly cohorts and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import month_of, months_apart, ratio
from ..operators.reshaping import levels_of, wide_cells


def first_per_key(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """The smallest ``column`` of the key on every row.

    An aggregate joined back, not a window: it is combined before the shuffle and
    a key that holds much of the table can still be split by the join. Rows without
    a key, which would all meet in one task, are kept out of the join.
    """
    named = df.where(F.col(key).isNotNull())
    first = named.groupBy(key).agg(F.min(column).alias(name))
    rest = df.where(F.col(key).isNull()).withColumn(name, F.lit(None).cast(df.schema[column].dataType))
    return named.join(first, key).select(*df.columns, name).unionByName(rest)


def active_months(lines: DataFrame) -> DataFrame:
    """Distinct (customer_id, order_month) with the customer's cohort month.

    Months are made distinct before the window, so a customer has at most one row
    per month there, however many lines there are.
    """
    months = (
        lines.where(F.col("customer_id").isNotNull())
        .select("customer_id", month_of("invoice_date").alias("order_month"))
        .distinct()
    )
    return months.withColumn("cohort", F.min("order_month").over(W.partitionBy("customer_id")))


def cohort_table(lines: DataFrame) -> DataFrame:
    """(cohort, order_month, n_customers, period_number)."""
    return (
        active_months(lines)
        .groupBy("cohort", "order_month")
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .withColumn("period_number", months_apart("order_month", "cohort"))
    )


def retention(cohorts: DataFrame) -> DataFrame:
    """Long retention table: share of the cohort's first month, one row per period."""
    size = F.max(F.when(F.col("period_number") == 0, F.col("n_customers"))).over(W.partitionBy("cohort"))
    sized = cohorts.withColumn("cohort_size", size)
    return sized.withColumn("retention", ratio("n_customers", "cohort_size"))


def retention_matrix(cohorts: DataFrame, periods: Sequence[int] | None = None) -> DataFrame:
    """Wide retention, one column ``period_<k>`` per wanted period, or per period of the data; an absent month is NULL."""
    periods = levels_of(cohorts, "period_number") if periods is None else periods
    wide = wide_cells(retention(cohorts), ["cohort"], "period_number", F.first("retention"), periods)
    return wide.withColumnsRenamed({str(p): f"period_{p}" for p in periods})
