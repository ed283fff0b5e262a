"""Row positions and running totals over a total order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise


def running_totals(df: DataFrame, order: Sequence[Column], amounts: dict[str, str]) -> DataFrame:
    """Add, for each ``new: source`` in ``amounts``, the sum of ``source`` up to and including the row.

    The rows are split by value range, each range is summed on its own and is
    then shifted by the totals of the ranges before it. ``order`` must be a total
    order (end it with a key) so that equal values can fall into different ranges.
    The split is written to a table first: range borders are sampled, and both
    reads have to see the same ones.
    """
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    per_range = ranged.groupBy("_range").agg(*[F.sum(src).alias(f"_t_{new}") for new, src in amounts.items()])
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per shuffle partition
    shifts = per_range.select(
        "_range", *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in amounts]
    )
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = ranged.join(F.broadcast(shifts), "_range")  # as many rows as shuffle partitions
    out = summed.withColumns({new: F.sum(src).over(inside) + F.col(f"_s_{new}") for new, src in amounts.items()})
    return out.drop("_range", *[f"_s_{new}" for new in amounts])


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """1-based position over the whole table."""
    return running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, {name: "_one"}).drop("_one")


def top_share_flag(df: DataFrame, by: Sequence[Column], share: float, name: str = "top_flag") -> DataFrame:
    """1 for the first ``ceil(share * rows)`` rows of the order, else 0 (Pareto flag)."""
    numbered = with_row_number(df, by, "_position")
    total = numbered.agg(F.count(F.lit(1)).alias("_rows"))
    flag = (F.col("_position") <= F.ceil(F.col("_rows") * F.lit(share))).cast("int")
    return numbered.crossJoin(F.broadcast(total)).withColumn(name, flag).drop("_position", "_rows")


def carried_totals(per_range: DataFrame, segment: str, amount: str, ranges: int, range_: str = "_range") -> DataFrame:
    """(range, segment, amount): what each segment has in the ranges before, for every range 0 .. ranges - 1.

    per_range (range, segment, amount): totals of the ranges that hold the segment. The result has ranges x segments rows.
    """
    every = per_range.select(segment).distinct().select(F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias(range_), segment, F.lit(0).cast("long").alias(amount))
    dense = per_range.select(range_, segment, amount).unionByName(every).groupBy(range_, segment).agg(F.sum(amount).alias(amount))
    before = W.partitionBy(segment).orderBy(range_).rowsBetween(W.unboundedPreceding, -1)  # a row for each range
    return dense.withColumn(amount, F.coalesce(F.sum(amount).over(before), F.lit(0)))


def segmented_totals(df: DataFrame, segment: str, order: Sequence[Column], amounts: dict[str, str]) -> DataFrame:
    """Add, for each ``new: source`` in ``amounts``, the sum of ``source`` over the segment's rows before this one.

    Rows are split by ranges of (segment, order), which must be a total order. A segment that spans many ranges is summed
    in each of them and shifted by its totals before; a range border parts one segment only, so the shifts have no more
    rows than there are ranges and segments. A large segment is thus scanned by as many tasks as its ranges.
    """
    ranged = materialise(df.repartitionByRange(F.col(segment), *order).withColumn("_range", F.spark_partition_id()))
    per_range = ranged.groupBy("_range", segment).agg(*[F.sum(src).alias(f"_t_{new}") for new, src in amounts.items()])
    before = W.partitionBy(segment).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # ranges of one segment
    shifts = per_range.select("_range", F.col(segment).alias("_of"), *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in amounts])
    inside = W.partitionBy("_range", segment).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = ranged.withColumns({f"_i_{new}": F.coalesce(F.sum(src).over(inside), F.lit(0)) for new, src in amounts.items()})
    keyed = summed.withColumnRenamed("_range", "_in").join(shifts, (F.col("_in") == F.col("_range")) & F.col(segment).eqNullSafe(F.col("_of")))
    return keyed.select(*df.columns, *[(F.col(f"_i_{new}") + F.col(f"_s_{new}")).alias(new) for new in amounts])
