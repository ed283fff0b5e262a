"""Cleaning of retail lines, RFM metrics, scores and segments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import contains_or_false, elapsed_days, mapped
from ..operators.binning import qcut
from ..operators.outliers import cap_upper
from ..session import materialise

# Score patterns (recency digit, frequency digit) and segment names.
SEGMENT_PATTERNS = [
    ("[1-2][1-2]", "Hibernating"),
    ("[1-2][3-4]", "At_Risk"),
    ("[1-2]5", "Cant_Loose"),
    ("3[1-2]", "About_to_Sleep"),
    ("33", "Need_Attention"),
    ("[3-4][4-5]", "Loyal_Customers"),
    ("41", "Promising"),
    ("51", "New_Customers"),
    ("[4-5][2-3]", "Potential_Loyalists"),
    ("5[4-5]", "Champions"),
]


def drop_cancelled(lines: DataFrame, invoice: str = "invoice") -> DataFrame:
    """Keep lines whose invoice has no 'C' anywhere; a missing invoice is kept."""
    return lines.where(~contains_or_false(invoice, "C"))


def with_total_price(lines: DataFrame) -> DataFrame:
    return lines.withColumn("total_price", F.col("quantity") * F.col("price"))


def sales_lines(lines: DataFrame) -> DataFrame:
    """Complete lines that are no returns, with their total price."""
    return with_total_price(drop_cancelled(lines).na.drop("any"))


def clean_retail(lines: DataFrame, stored: bool = False) -> DataFrame:
    """Complete, uncancelled, positive lines with quantity and price capped.

    The limits read the kept lines twice and the result reads them again. When
    ``lines`` come out of joins, the kept lines are written once instead of being
    joined three times; ``stored`` says that they are a plain table already.
    """
    kept = drop_cancelled(lines.na.drop("any")).where(F.col("quantity") > 0)
    return with_total_price(cap_upper(kept if stored else materialise(kept), ["quantity", "price"]))


def analysis_date(latest: Column, days: int = 2) -> Column:
    """Midnight of the day ``days`` after the latest purchase."""
    return F.date_trunc("day", latest) + F.make_dt_interval(F.lit(days))


def rfm_metrics(lines: DataFrame, today: Column | None = None) -> DataFrame:
    """(customer_id, recency, frequency, monetary).

    Recency counts whole days since the last purchase, frequency counts lines.
    Without ``today`` the analysis date follows from the latest purchase. The
    customer table is written once, so that the date, the score quantiles and the
    scores read it instead of the lines.
    """
    customers = materialise(lines.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max(F.col("invoice_date").cast("timestamp")).alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_price").alias("monetary"),
    ))
    if today is None:
        latest = customers.agg(analysis_date(F.max("last_purchase")).alias("_today"))
        customers, today = customers.crossJoin(F.broadcast(latest)), F.col("_today")
    return customers.where((F.col("monetary") > 0) & (F.col("frequency") > 0)).select(
        "customer_id", elapsed_days(today, "last_purchase").alias("recency"), "frequency", "monetary"
    )


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Quintile scores; recent customers get 5. One quantile job serves all three."""
    scored = qcut(
        rfm,
        {
            "recency_score": ("recency", [5, 4, 3, 2, 1]),
            "frequency_score": ("frequency", [1, 2, 3, 4, 5]),
            "monetary_score": ("monetary", [1, 2, 3, 4, 5]),
        },
    )
    digits = [F.col(c).cast("string") for c in ("recency_score", "frequency_score", "monetary_score")]
    return scored.withColumn("rfm_score", F.concat(*digits))


def segment_name(rf: Column) -> Column:
    """Segment of a two-digit score; the 25 codes become one literal map, so ``rf`` is evaluated once."""
    codes = [f"{r}{f}" for r in range(1, 6) for f in range(1, 6)]
    names = {code: next(name for pattern, name in SEGMENT_PATTERNS if re.fullmatch(pattern, code)) for code in codes}
    return mapped(rf, names)


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_name(F.substring("rfm_score", 1, 2)))


def segment_profile(df: DataFrame, segment: str, metrics: list[str], stats: tuple[str, ...] = ("mean", "count")) -> DataFrame:
    """Chosen statistics of each metric per segment, columns ``<metric>_<stat>``."""
    known = {"mean": F.avg, "count": F.count, "sum": F.sum, "median": F.median}
    return df.groupBy(segment).agg(*[known[s](m).alias(f"{m}_{s}") for m in metrics for s in stats])


def rfm_table(lines: DataFrame, today: Column | None = None) -> DataFrame:
    """Lines to named segments in one plan."""
    return rfm_segments(rfm_scores(rfm_metrics(sales_lines(lines), today)))
