"""Baskets, frequent itemsets, association rules and segment recommendations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.binning import minmax, qcut
from ..operators.reshaping import levels_of, sparse_cells, wide_cells
from ..session import materialise
from .itemsets import grouped_itemsets, least_counts


def basket_items(lines: DataFrame, item: str = "stock_code", invoice: str = "invoice") -> DataFrame:
    """(basket, item, in_basket): 1 where the net quantity on the invoice is positive."""
    known = lines.where(F.col(invoice).isNotNull() & F.col(item).isNotNull())
    net = known.groupBy(F.col(invoice).alias("basket"), F.col(item).alias("item")).agg(F.sum("quantity").alias("net"))
    return net.select("basket", "item", F.when(F.col("net") > 0, 1).otherwise(0).alias("in_basket"))


def item_support(items: DataFrame) -> DataFrame:
    """(item, n_baskets)."""
    held = items.where(F.col("in_basket") == 1)
    return held.groupBy("item").agg(F.count(F.lit(1)).alias("n_baskets"))


def basket_sizes(items: DataFrame) -> DataFrame:
    """(basket, n_items)."""
    return items.groupBy("basket").agg(F.sum("in_basket").alias("n_items"))


def basket_sets(items: DataFrame) -> DataFrame:
    """(basket, items), each basket a sorted array of distinct items."""
    held = items.where(F.col("in_basket") == 1)
    return held.groupBy("basket").agg(F.array_sort(F.collect_list("item")).alias("items"))


def basket_matrix(items: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """0/1 view of chosen items, or of all items of the data, for display; mining uses the sparse form."""
    columns = levels_of(items, "item") if columns is None else columns
    return wide_cells(items, ["basket"], "item", F.max("in_basket"), columns).na.fill(0, columns)


def basket_cells(items: DataFrame) -> DataFrame:
    """(basket, cells): the same view for any number of items, a sorted array of (item, 0/1) per basket."""
    return sparse_cells(items, ["basket"], "item", F.max("in_basket"))


@dataclass(frozen=True)
class Itemsets:
    """Frequent itemsets (``items`` sorted, ``freq``) and the number of baskets."""

    table: DataFrame
    n_baskets: int

    def with_support(self) -> DataFrame:
        return self.table.withColumn("support", F.col("freq") / F.lit(float(self.n_baskets)))


def frequent_itemsets(items: DataFrame, min_support: float = 0.01, written: bool = False) -> Itemsets:
    """All itemsets held by at least ``min_support`` of the baskets.

    ``written`` says that ``items`` is read straight from a table. Only items that are frequent alone can be part of one, and at most
    (mean basket size / min_support) of them exist. Dropping the others first
    bounds every basket array, also that of an invoice with very many lines.
    """
    items = items if written else materialise(items)
    n = items.agg(F.count_distinct("basket")).first()[0]
    least = max(math.ceil(min_support * n - 1e-9), 1)
    frequent = item_support(items).where(F.col("n_baskets") >= least).select("item")
    kept = items.join(frequent, "item", "left_semi")
    baskets = materialise(basket_sets(kept).select("items"))
    n_kept = baskets.count()
    if n_kept == 0:
        return Itemsets(items.sparkSession.createDataFrame([], "items array<string>, freq long"), n)
    miner = FPGrowth(itemsCol="items", minSupport=max((least - 0.5) / n_kept, 0.0))
    found = miner.fit(baskets).freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    return Itemsets(materialise(found), n)


def rule_measures(support: Column, antecedent: Column, consequent: Column) -> dict[str, Column]:
    confidence = support / antecedent
    return {
        "confidence": confidence,
        "lift": confidence / consequent,
        "leverage": support - antecedent * consequent,
        "conviction": F.try_divide(F.lit(1.0) - consequent, F.lit(1.0) - confidence),  # NULL: always true
    }


def _rules_of(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A rule for every split of every itemset (items, support) into two non-empty parts, within each of ``by``.

    Splits are rows of a generator, numbered by a long, so a large itemset never stands in one array of all its splits.
    """
    numbered = sets.where(F.size("items") > 1).select(
        *by, "support", "items", F.explode(F.expr("sequence(1L, shiftleft(1L, size(items)) - 2L)")).alias("_m")
    )
    part = "filter(items, (x, i) -> (shiftright(_m, i) & 1L) = {})"
    splits = numbered.select(*by, "support", F.expr(part.format("1L")).alias("antecedents"), F.expr(part.format("0L")).alias("consequents"))
    left = sets.select(*by, F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    right = sets.select(*by, F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    rules = splits.join(left, [*by, "antecedents"]).join(right, [*by, "consequents"])
    return rules.withColumns(rule_measures(*[F.col(c) for c in ("support", "antecedent_support", "consequent_support")]))


def association_rules(itemsets: Itemsets, metric: str = "support", min_threshold: float = 0.01) -> DataFrame:
    """A rule for every split of every itemset into two non-empty parts."""
    rules = _rules_of(itemsets.with_support())
    return rules.where(F.col(metric) >= min_threshold - 1e-12).select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        "confidence", "lift", "leverage", "conviction",
    )


def rule_order() -> list[Column]:
    """Strongest rule first; a complete order."""
    return [F.round("lift", 9).desc(), F.col("support").desc(), F.col("antecedents").asc(), F.col("consequents").asc()]


def top_rules(rules: DataFrame, k: int) -> DataFrame:
    return rules.orderBy(*rule_order()).limit(k)


def create_rules(
    lines: DataFrame, country: str | None = None, item: str = "stock_code", min_support: float = 0.01
) -> DataFrame:
    """Rules of all lines, or of one country."""
    chosen = lines if country is None else lines.where(F.col("country") == country)
    return association_rules(frequent_itemsets(basket_items(chosen, item), min_support), "support", min_support)


def segment_rules(lines: DataFrame, segment: str = "segment", item: str = "stock_code", min_support: float = 0.01) -> DataFrame:
    """Rules of every segment's own baskets, with the segment's support limit: (segment, antecedents, consequents, measures).

    ``lines`` carry the customer's segment; lines without one, without an invoice or an item play no part. All segments are
    mined in one run, each with its own least count, so the result is that of mining each of them alone.
    """
    known = lines.where(F.col(segment).isNotNull() & F.col("invoice").isNotNull() & F.col(item).isNotNull())
    net = known.groupBy(F.col(segment).alias("_segment"), F.col("invoice").alias("basket"), F.col(item).cast("string").alias("item")).agg(F.sum("quantity").alias("net"))
    items = materialise(net.select("_segment", "basket", "item", (F.col("net") > 0).alias("_in")))
    sizes = materialise(least_counts(items, "_segment", min_support))  # a basket of returns alone counts, too
    found = grouped_itemsets(items.where("_in").drop("_in"), sizes, "_segment")
    sets = materialise(found.join(sizes, "_segment").select("_segment", "items", (F.col("freq") / F.col("n").cast("double")).alias("support")))
    return _rules_of(sets, ["_segment"]).select(
        F.col("_segment").alias(segment), "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        "confidence", "lift", "leverage", "conviction",
    )


def segment_products(lines: DataFrame, segment: str = "segment", item: str = "stock_code", min_support: float = 0.01) -> DataFrame:
    """(segment, recommended_product): first consequent of the strongest rule of each segment."""
    strongest = segment_rules(lines, segment, item, min_support).groupBy(segment).agg(
        F.min(F.struct((-F.round("lift", 9)).alias("a"), (-F.col("support")).alias("b"), "antecedents", "consequents")).alias("best")
    )
    return strongest.select(segment, F.array_min("best.consequents").alias("recommended_product"))


def recommend_by_value(
    lines: DataFrame, values: DataFrame, country: str, value: str = "clv", item: str = "stock_code",
    labels: Sequence[str] = ("C", "B", "A"), min_support: float = 0.01,
) -> DataFrame:
    """The whole chain: predicted value to segment, the segment's lines to rules, the strongest rule to a product.

    ``values`` (customer_id, value) is a forecast of each customer; its result is kept with ``value`` scaled to 1..100, the
    ``segment`` (equal thirds by default, the best last) and ``recommended_product``, empty outside ``country``.
    """
    scaled = minmax(materialise(values.select("customer_id", value)), {value: value}, 1.0, 100.0)
    segments = materialise(qcut(materialise(scaled), {"segment": (value, list(labels))}))
    products = segment_products(lines.join(segments.select("customer_id", "segment"), "customer_id"), item=item, min_support=min_support)
    return recommend(segments, products, lines, country)


def recommend(customers: DataFrame, products: DataFrame, lines: DataFrame, country: str, segment: str = "segment") -> DataFrame:
    """The segment's product for customers of one country, an empty text for all others."""
    local = (
        lines.where((F.col("country") == country) & F.col("customer_id").isNotNull()).select("customer_id").distinct()
    )
    marked = customers.join(local.withColumn("_local", F.lit(True)), "customer_id", "left")
    offered = marked.join(products, segment, "left")
    product = F.when(F.col("_local"), F.coalesce("recommended_product", F.lit(""))).otherwise("")
    return offered.withColumn("recommended_product", product).drop("_local")


def product_name(lines: DataFrame, stock_code: str) -> DataFrame:
    """Name of one product: the alphabetically first description of its code."""
    return (
        lines.where((F.col("stock_code") == stock_code) & F.col("description").isNotNull())
        .groupBy("stock_code")
        .agg(F.min("description").alias("description"))
    )
