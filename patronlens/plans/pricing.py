"""Category prices: fixed price, price bands, income per price scenario."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import segmented_totals
from ..operators.quantiles import group_quantiles, quoted
from .abtest import mean_intervals, pairwise_mann_whitney


def category_prices(df: DataFrame, category: str, price: str) -> DataFrame:
    """(category, mean, median, n, n_unique).

    Unique prices are formed per (category, price) before they are counted, so a
    category with very many lines is spread over the cluster.
    """
    known = df.where(F.col(category).isNotNull()).select(category, price)
    per_price = known.groupBy(category, price).agg(
        F.count(price).alias("_n"), F.sum(price).alias("_sum")
    )
    basic = per_price.groupBy(category).agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean"), F.sum("_n").alias("n"), F.count(price).alias("n_unique")
    )
    medians = group_quantiles(known, [category], price, {"median": 0.5})
    return basic.join(medians, category, "left")


def similar_categories(pairs: DataFrame, category: str) -> DataFrame:
    """Categories that do not differ significantly from at least one other."""
    alike = pairs.where(~F.col("rejected"))
    return alike.select(F.explode(F.array("first", "second")).alias(category)).distinct()


def fixed_price(df: DataFrame, category: str, price: str, categories: Sequence | None = None) -> DataFrame:
    """One row: mean of the medians of similar categories, or of the given ones."""
    prices = category_prices(df, category, price)
    if categories is not None:
        chosen = prices.where(F.col(category).isin(list(categories)))
    else:
        chosen = prices.join(similar_categories(pairwise_mann_whitney(df, category, price), category), category, "left_semi")
    return chosen.agg(F.count(F.lit(1)).alias("n_categories"), F.avg("median").alias("fixed_price"))


def price_bands(df: DataFrame, category: str, price: str, level: float = 0.95) -> DataFrame:
    return mean_intervals(df, category, price, level)


def price_scenarios(df: DataFrame, category: str, price: str, candidates: Sequence[float]) -> DataFrame:
    """(category, candidate, buyers, income): sales that would still happen at each price.

    All candidates are counted in one aggregate; no row is multiplied.
    """
    counted = (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(*[F.count_if(F.col(price) >= p).alias(f"b{i}") for i, p in enumerate(candidates)])
    )
    cells = F.array(
        *[F.struct(F.lit(float(p)).alias("candidate"), F.col(f"b{i}").alias("buyers")) for i, p in enumerate(candidates)]
    )
    long = counted.select(category, F.explode(cells).alias("cell")).select(category, "cell.*")
    return long.withColumn("income", F.col("buyers") * F.col("candidate"))


def price_table_scenarios(df: DataFrame, category: str, price: str, candidates: DataFrame) -> DataFrame:
    """(category, candidate, buyers, income) for a table (category, candidate) of any number of prices.

    Sales are counted per price, and one running total from the highest price down passes sales and candidates alike: a
    candidate reads how many sales came before it. Rows are those of the distinct prices and candidates, no pair of them is
    formed, and a category of many prices is scanned by ranges. Missing prices and candidates play no part; a candidate of
    a category without sales has 0 buyers.
    """
    paid = F.expr(f"nanvl(CAST({quoted(price)} AS DOUBLE), CAST(NULL AS DOUBLE))").alias("candidate")
    sold = df.select(F.col(category).alias("_category"), paid).dropna().groupBy("_category", "candidate").agg(F.count(F.lit(1)).alias("_n"))
    asked = candidates.select(F.col(category).alias("_category"), F.col("candidate").cast("double").alias("candidate")).dropna().distinct()
    rows = sold.withColumn("_asked", F.lit(0)).unionByName(asked.select("*", F.lit(0).cast("long").alias("_n"), F.lit(1).alias("_asked")))
    told = segmented_totals(rows, "_category", [F.col("candidate").desc(), F.col("_asked").asc()], {"buyers": "_n"})
    return told.where("_asked = 1").select(
        F.col("_category").alias(category), "candidate", "buyers", (F.col("buyers") * F.col("candidate")).alias("income")
    )
