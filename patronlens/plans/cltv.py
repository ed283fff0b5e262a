"""Customer lifetime value by formula, and the reports around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators.binning import minmax, qcut
from ..session import materialise
from .rfm import drop_cancelled, segment_profile, with_total_price


def cltv_lines(lines: DataFrame) -> DataFrame:
    return with_total_price(drop_cancelled(lines).where(F.col("quantity") > 0).na.drop("any"))


def cltv_formula(lines: DataFrame, transactions: str = "lines", margin: float = 0.05) -> DataFrame:
    """Average order value, purchase frequency, margin, customer value and lifetime value.

    ``transactions`` counts lines, or distinct ``invoices``. Churn is the share of
    customers with a single transaction; without any of them values are NULL. The
    customer table is written once and serves the shares, the scale and the bins.
    """
    known = lines.where(F.col("customer_id").isNotNull())
    if transactions == "invoices":
        # one row per invoice first: a large customer is summed in pieces
        known = known.groupBy("customer_id", "invoice").agg(
            F.sum("quantity").alias("quantity"), F.sum("total_price").alias("total_price")
        )
    base = materialise(known.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transaction"),
        F.sum("quantity").alias("total_unit"),
        F.sum("total_price").alias("total_price"),
    ))
    shares = base.agg(
        F.count(F.lit(1)).alias("_customers"), F.count_if(F.col("total_transaction") > 1).alias("_repeat")
    )
    churn = F.lit(1.0) - F.col("_repeat") / F.col("_customers")
    out = (
        base.crossJoin(F.broadcast(shares))
        .withColumn("avg_order_value", ratio("total_price", "total_transaction"))
        .withColumn("purchase_frequency", ratio("total_transaction", "_customers"))
        .withColumn("profit_margin", F.col("total_price") * F.lit(margin))
        .withColumn("cv", F.try_divide(F.col("avg_order_value") * F.col("purchase_frequency"), churn))
        .withColumn("cltv", F.col("cv") * F.col("profit_margin"))
    )
    return out.drop("_customers", "_repeat")


def cltv_segments(cltv: DataFrame, labels=("D", "C", "B", "A")) -> DataFrame:
    scaled = minmax(cltv, {"scaled_cltv": "cltv"}, 1.0, 100.0)
    return qcut(scaled, {"segment": ("scaled_cltv", list(labels))})


def cltv_segment_summary(segmented: DataFrame) -> DataFrame:
    metrics = ["total_transaction", "total_unit", "total_price", "cltv", "scaled_cltv"]
    return segment_profile(segmented, "segment", metrics, ("mean", "count", "sum"))


def repeat_rate(lines: DataFrame, customer: str = "customer_id", invoice: str = "invoice") -> DataFrame:
    """Share of customers with more than one order, in one row."""
    orders = lines.where(F.col(customer).isNotNull()).select(customer, invoice).distinct()
    per_customer = orders.groupBy(customer).agg(F.count(invoice).alias("n_orders"))
    return per_customer.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg(F.when(F.col("n_orders") > 1, 1.0).otherwise(0.0)).alias("repeat_rate"),
    ).withColumn("churn_rate", F.lit(1.0) - F.col("repeat_rate"))


def best_sellers(lines: DataFrame, k: int) -> DataFrame:
    """Products by units sold; missing descriptions are no product."""
    return (
        lines.where(F.col("description").isNotNull())
        .groupBy("description")
        .agg(F.sum("quantity").alias("units"))
        .orderBy(F.col("units").desc_nulls_last(), "description")
        .limit(k)
    )


def revenue_by_country(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("country").isNotNull()).groupBy("country").agg(F.sum("total_price").alias("revenue"))
