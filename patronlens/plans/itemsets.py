"""Frequent itemsets of many groups in one run, each group with a least count of its own.

Baskets are projected: for an item, what precedes it in the baskets that hold it, rarer items last. Equal projections are
counted together, so a very common item, which stands first, leaves next to nothing. A projection that is small is mined
in one place with its group's least count; a large one is projected again by its next item, with all others of its kind.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Distinct paths that one task mines at most; larger projections are parted by their next item.
SMALL = 50_000


def grown(paths: dict[tuple, int], least: int) -> Iterator[tuple[tuple, int]]:
    """(items, count) of every itemset that at least ``least`` of the counted paths hold. Items keep the paths' order."""
    counts: dict = defaultdict(int)
    for path, n in paths.items():
        for item in path:
            counts[item] += n
    frequent = {item: n for item, n in counts.items() if n >= least}
    for item, n in frequent.items():
        yield (item,), n
        before: dict[tuple, int] = defaultdict(int)
        for path, m in paths.items():
            if item in path:
                kept = tuple(x for x in path[: path.index(item)] if x in frequent)
                if kept:
                    before[kept] += m
        for items, m in grown(before, least):
            yield (*items, item), m


def least_counts(held: DataFrame, group: str, min_support: float) -> DataFrame:
    """(group, n, least): baskets of each group, and ceil(min_support * n), at least 1."""
    sizes = held.groupBy(group).agg(F.count_distinct("basket").alias("n"))
    return sizes.withColumn("least", F.greatest(F.ceil(F.col("n") * min_support - 1e-9), F.lit(1)).cast("bigint"))


def _mined(small: DataFrame, group: str) -> DataFrame:
    """Itemsets of small projections; the suffix belongs to each of them."""
    kind = small.schema[group].dataType.simpleString()

    def mine(key: tuple, rows: pa.Table) -> pa.Table:
        paths: dict[tuple, int] = defaultdict(int)
        for path, n in zip(rows["path"].to_pylist(), rows["n"].to_pylist()):
            paths[tuple(path)] += n
        suffix = key[1].as_py()
        found = [([*items, *suffix], n) for items, n in grown(paths, rows["least"][0].as_py())]
        items, freq = zip(*found) if found else ((), ())
        return pa.table({"g": pa.array([key[0].as_py()] * len(found), rows.schema.field(group).type), "items": pa.array(items, pa.list_(pa.string())), "freq": pa.array(freq, pa.int64())})

    return small.groupBy(group, "suffix").applyInArrow(mine, f"g {kind}, items array<string>, freq bigint").withColumnRenamed("g", group)


def grouped_itemsets(held: DataFrame, least: DataFrame, group: str = "group", small: int = SMALL) -> DataFrame:
    """(group, items, freq): itemsets (sorted arrays of text) that at least ``least`` baskets of their group hold.

    held (group, basket, item): distinct rows, items as text. least (group, least): one row a group. Items below their
    group's least count are dropped first, so a basket array has at most (mean basket size of the group / support) items.
    A group of few baskets, whose least count is 1, has no part in what a large one costs. Empty input gives no sets.
    """
    single = held.groupBy(group, "item").agg(F.count(F.lit(1)).alias("f")).join(least.select(group, "least"), group).where("f >= least")
    kept = held.join(single, [group, "item"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("f")).alias("f"), "item"))), lambda x: x["item"])
    baskets = kept.groupBy(group, "basket").agg(F.first("least").alias("least"), ordered.alias("path"))
    paths = baskets.groupBy(group, "path").agg(F.first("least").alias("least"), F.count(F.lit(1)).alias("n"))
    state = paths.select(group, "least", F.expr("CAST(array() AS array<string>)").alias("suffix"), "path", "n")
    parts = []
    while True:
        each = state.select(group, "least", "suffix", "path", "n", F.posexplode("path").alias("at", "item"))
        projected = each.select(group, "least", F.concat(F.array("item"), "suffix").alias("suffix"), F.expr("slice(path, 1, at)").alias("path"), "n")
        projected = materialise(projected.groupBy(group, "least", "suffix", "path").agg(F.sum("n").alias("n")))
        heads = projected.groupBy(group, "suffix").agg(F.first("least").alias("least"), F.sum("n").alias("freq"), F.count(F.lit(1)).alias("paths")).where("freq >= least")
        heads = materialise(heads.select(group, F.col("suffix").alias("items"), "freq", "paths"))
        parts.append(heads.select(group, "items", "freq"))
        going_on = projected.where(F.size("path") > 0).join(heads.select(group, F.col("items").alias("suffix"), "paths"), [group, "suffix"])
        parts.append(_mined(going_on.where(F.col("paths") <= small), group))
        if heads.where(F.col("paths") > small).isEmpty():
            break
        # items that are rare within the projection are left out, so that more paths become equal
        large = materialise(going_on.where(F.col("paths") > small).select(group, "least", "suffix", "path", "n"))
        common = large.select(group, "least", "suffix", "n", F.explode("path").alias("item")).groupBy(group, "least", "suffix", "item").agg(F.sum("n").alias("f")).where("f >= least")
        common = common.groupBy(group, "suffix").agg(F.collect_list("item").alias("common"))  # items frequent with the suffix
        state = large.join(common, [group, "suffix"]).withColumn("path", F.array_intersect("path", "common")).where(F.size("path") > 0)
        state = state.groupBy(group, "least", "suffix", "path").agg(F.sum("n").alias("n"))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found.withColumn("items", F.array_sort("items"))
