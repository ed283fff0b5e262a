"""Level-based personas: revenue per customer level, price segments, lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import joined_key
from ..operators.binning import cut, qcut
from ..session import materialise

# Upper ends of the age bands and their labels; the last band ends at the highest age.
AGE_EDGES = [0, 19, 24, 31, 41]
AGE_LABELS = ["0_18", "19_23", "24_30", "31_40"]

LEVELS = ["country", "device", "gender", "age"]


def persona_revenue(users: DataFrame, purchases: DataFrame) -> DataFrame:
    """Revenue per (country, device, gender, age) with age band and persona key.

    Purchases are summed per user before the join: users with many purchases
    cross the shuffle once.
    """
    spent = purchases.groupBy("uid").agg(F.sum("price").alias("price"))
    levels = (
        spent.join(users, "uid")
        .where(" AND ".join(f"{c} IS NOT NULL" for c in LEVELS))
        .groupBy(*LEVELS)
        .agg(F.coalesce(F.sum("price"), F.lit(0.0)).alias("price"))
    )
    levels = materialise(levels)  # read again for the highest age and the price bins
    oldest = levels.agg(F.max("age").alias("_oldest"))
    banded = levels.crossJoin(F.broadcast(oldest))
    last_label = F.concat(F.lit("41_"), F.col("_oldest").cast("string"))
    banded = banded.withColumn("age_cat", cut("age", AGE_EDGES + [F.col("_oldest")], AGE_LABELS + [last_label]))
    key = joined_key("country", F.upper("device"), "gender", "age_cat")
    return banded.withColumn("customers_level_based", key).drop("_oldest")


def persona_segments(levels: DataFrame) -> DataFrame:
    return qcut(levels, {"segment": ("price", ["D", "C", "B", "A"])})


def persona_totals(levels: DataFrame) -> DataFrame:
    """One row per persona: its revenue over all ages of the band, and its segment."""
    rolled = levels.groupBy("customers_level_based").agg(F.sum("price").alias("price"))
    return persona_segments(rolled)


def find_persona(segmented: DataFrame, persona: str) -> DataFrame:
    return segmented.where(F.col("customers_level_based") == persona)
