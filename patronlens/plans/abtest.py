"""Hypothesis tests over a long table (group, value); every test is a Spark aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import probability as P
from ..functions.columns import ratio
from ..operators.ordering import carried_totals, segmented_totals, with_row_number
from ..operators.quantiles import group_quantiles
from ..session import materialise

#: Groups and values of a block of the pair matrix.
PAIR_BLOCK, VALUE_BLOCK = 256, 512


def _present(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.select(group, F.col(value).cast("double").alias(value)).where(
        F.col(group).isNotNull() & F.col(value).isNotNull()
    )


def mean_intervals(df: DataFrame, group: str, value: str, level: float = 0.95) -> DataFrame:
    """(group, n, mean, std, low, high): t confidence interval of each group's mean."""
    stats = _present(df, group, value).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    t = P.t_quantile(F.lit(0.5 + level / 2), (F.col("n") - 1).cast("double"))
    return (
        stats.withColumn("_half", t * F.col("std") / F.sqrt("n"))
        .withColumn("low", F.col("mean") - F.col("_half"))
        .withColumn("high", F.col("mean") + F.col("_half"))
        .drop("_half")
    )


def moment_normality(df: DataFrame, group: str, value: str) -> DataFrame:
    """Jarque-Bera test per group from skewness and kurtosis, for groups of any size."""
    stats = _present(df, group, value).groupBy(group).agg(
        F.count(value).alias("n"), F.skewness(value).alias("skew"), F.kurtosis(value).alias("excess")
    )
    stat = F.col("n") / 6.0 * (F.col("skew") * F.col("skew") + F.col("excess") * F.col("excess") / 4.0)
    return stats.withColumn("statistic", stat).withColumn("p_value", F.exp(-F.col("statistic") / 2.0))


def shapiro_normality(df: DataFrame, group: str, value: str) -> DataFrame:
    """Shapiro-Wilk W and p for each group, the same test for every size.

    The test runs over counted values: equal values are one row, which stands for a run of positions and takes the sum of
    the run's normal scores at once. So neither a large group nor a value that most rows share meets in one task. W comes
    from the sums and the two outermost values at either end. The published p was fitted for up to 5000 values; it is an
    extrapolation beyond. Fewer than three or only equal values give NULL.
    """
    counted = _present(df, group, value).groupBy(group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    placed = segmented_totals(counted, group, [F.col("_v").asc()], {"_before": "_c"})
    sizes = placed.groupBy(F.col(group).alias("_g")).agg(F.sum("_c").alias("_n"), (F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("_mean"))
    sizes = materialise(sizes.withColumn("_mm", P.score_sums(F.lit(0).cast("long"), "_n", "_n")["square"]))
    runs = placed.join(sizes, F.col(group) == F.col("_g")).withColumn("_x", F.col("_v") - F.col("_mean"))
    runs = runs.withColumn("_m", P.score_sums("_before", "_c", "_n")["once"])
    at = lambda i: F.coalesce(F.max(F.when((F.col("_before") < i) & (i <= F.col("_before") + F.col("_c")), F.col("_x"))), F.lit(0.0))
    sums = runs.groupBy(group).agg(
        F.max("_n").cast("double").alias("n"), F.max("_mm").alias("mm"), F.sum(F.col("_m") * F.col("_x")).alias("mx"),
        F.sum(F.col("_x") * F.col("_x") * F.col("_c")).alias("xx"), at(F.lit(1)).alias("low"), at(F.lit(2)).alias("low2"),
        at(F.col("_n") - 1).alias("high2"), at(F.col("_n")).alias("high"), F.count("_x").alias("_values"),
    )
    tested = sums.withColumn("_t", P.shapiro(F.struct("n", "mm", "mx", F.when(F.col("_values") > 1, F.col("xx")).otherwise(0.0).alias("xx"), "low", "low2", "high2", "high")))
    return tested.select(group, F.nanvl("_t.statistic", F.lit(None)).alias("statistic"), F.nanvl("_t.p_value", F.lit(None)).alias("p_value"), F.lit("shapiro").alias("method"))


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """Median-centred Levene test over all groups, one row."""
    data = _present(df, group, value)
    medians = group_quantiles(data, [group], value, {"_median": 0.5})
    spread = data.join(medians, group).select(
        group, F.abs(F.col(value) - F.col("_median")).alias("_z")
    )
    per_group = spread.groupBy(group).agg(
        F.count("_z").alias("n"), F.avg("_z").alias("m"), F.var_pop("_z").alias("v")
    )
    whole = per_group.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("_sq"),
        F.sum(F.col("n") * F.col("m")).alias("_sum"),
    )
    between = F.col("_sq") - F.col("_sum") * F.col("_sum") / F.col("n")
    df1, df2 = F.col("groups") - 1, F.col("n") - F.col("groups")
    tested = whole.select(
        "groups", "n", F.try_divide(df2 * between, df1 * F.col("within")).alias("statistic")
    )
    return tested.withColumn(
        "p_value", P.f_upper("statistic", (F.col("groups") - 1).cast("double"), (F.col("n") - F.col("groups")).cast("double"))
    )


def _side(group: str, key, name: str, what: Column) -> Column:
    return F.max(F.when(F.col(group) == key, what)).alias(name)


def t_test(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Two-sample t-test with pooled variance, one row."""
    stats = _present(df, group, value).where(F.col(group).isin(first, second)).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")
    )
    wide = stats.agg(
        *[_side(group, key, f"{c}{i}", F.col(c)) for i, key in ((1, first), (2, second)) for c in ("n", "m", "v")]
    )
    df_ = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / df_
    stat = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2"))))
    tested = wide.select("n1", "n2", F.col("m1").alias("mean1"), F.col("m2").alias("mean2"), stat.alias("statistic"))
    return tested.withColumn("p_value", P.t_two_sided("statistic", (F.col("n1") + F.col("n2") - 2).cast("double")))


def _pair_sums(data: DataFrame, group: str, value: str, keys: Sequence) -> DataFrame:
    """(first, second, n1, n2, u1, ties) for all pairs of ``keys``, from one pass over the counts of (value, group).

    A value of the first group beats all smaller values of the second one and half of the equal ones. Counts are split by
    ranges of values; a range starts from what each group has below it and returns sums of products of counts. Its
    matrix is formed in blocks of PAIR_BLOCK groups, VALUE_BLOCK values at a time.
    """
    number = {key: i for i, key in enumerate(keys)}
    spark = data.sparkSession
    numbers = spark.createDataFrame([(k, i) for k, i in number.items()], data.select(group).schema.add("_g", "integer"))
    counts = data.join(F.broadcast(numbers), group).groupBy(F.col(value).alias("_v"), "_g").agg(F.count(F.lit(1)).alias("_n"))
    ranged = materialise(counts.repartitionByRange("_v").withColumn("_range", F.spark_partition_id()))
    per_range = ranged.groupBy("_range", "_g").agg(F.sum("_n").alias("_n"))
    starts = carried_totals(per_range, "_g", "_n", 1 + (ranged.agg(F.max("_range")).first()[0] or 0)).where("_n > 0")
    rows = ranged.select("_range", "_v", "_g", "_n").unionByName(starts.select("_range", F.lit(None).cast("double").alias("_v"), "_g", "_n"))
    size = len(keys)

    def products(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        below = np.zeros(size)
        first = pdf["_v"].isna()
        below[pdf.loc[first, "_g"]] = pdf.loc[first, "_n"]
        inside = pdf[~first]
        values, at = np.unique(inside["_v"].to_numpy(), return_inverse=True)
        order = np.argsort(at, kind="stable")
        at, of, n = at[order], inside["_g"].to_numpy()[order], inside["_n"].to_numpy(float)[order]
        for a in range(0, size, PAIR_BLOCK):
            mine = slice(a, min(a + PAIR_BLOCK, size))
            u, ties, so_far = np.zeros((mine.stop - a, size)), np.zeros((mine.stop - a, size)), below.copy()
            for s in range(0, len(values), VALUE_BLOCK):
                lo, hi = np.searchsorted(at, [s, s + VALUE_BLOCK])
                table = np.zeros((min(VALUE_BLOCK, len(values) - s), size))
                table[at[lo:hi] - s, of[lo:hi]] = n[lo:hi]
                upto = np.cumsum(table, axis=0) + so_far
                own, square = table[:, mine], table**2
                u += own.T @ (upto - table / 2)
                cubes = (table**3 - table).sum(axis=0)
                ties += cubes[mine, None] + cubes[None, :] + 3 * (square[:, mine].T @ table + own.T @ square)
                so_far = upto[-1]
            i, j = np.meshgrid(np.arange(a, mine.stop), np.arange(size), indexing="ij")
            keep = i < j
            yield pd.DataFrame({"_i": i[keep], "_j": j[keep], "u1": u[keep], "ties": ties[keep]})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A partition of the range-keyed exchange holds whole ranges."""
        held = [b for b in batches if len(b)]
        if held:
            for _, part in pd.concat(held).groupby("_range"):
                yield from products(part)

    summed = rows.repartition("_range").mapInPandas(each, "_i int, _j int, u1 double, ties double").groupBy("_i", "_j").agg(F.sum("u1").alias("u1"), F.sum("ties").alias("ties"))
    totals = per_range.groupBy("_g").agg(F.sum("_n").alias("n")).join(F.broadcast(numbers), "_g")
    one = totals.select(F.col("_g").alias("_i"), F.col(group).alias("first"), F.col("n").alias("n1"))
    two = totals.select(F.col("_g").alias("_j"), F.col(group).alias("second"), F.col("n").alias("n2"))
    return summed.join(one, "_i").join(two, "_j").select("first", "second", "n1", "n2", "u1", "ties")


def _mann_whitney(sums: DataFrame) -> DataFrame:
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n, mu = n1 + n2, n1 * n2 / 2.0
    var = n1 * n2 / 12.0 * ((n + 1.0) - F.try_divide(F.col("ties"), n * (n - 1.0)))
    u = F.least("u1", n1 * n2 - F.col("u1"))
    z = F.greatest(F.try_divide(mu - u - 0.5, F.sqrt(F.greatest(var, F.lit(0.0)))), F.lit(0.0))
    tested = sums.select("first", "second", "n1", "n2", u.alias("statistic"), F.when(var > 0, z).alias("z"))
    tested = tested.withColumn("p_one_sided", P.normal_upper("z"))
    both = F.col("p_one_sided") * 2
    return tested.withColumn("p_two_sided", F.when(both > 1.0, 1.0).otherwise(both))  # least() would hide a NULL


def mann_whitney(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Mann-Whitney U (the smaller one) with tie- and continuity-corrected p-values, one row."""
    return _mann_whitney(_pair_sums(_present(df, group, value), group, value, [first, second]))


def pairwise_mann_whitney(df: DataFrame, group: str, value: str, alpha: float = 0.05) -> DataFrame:
    """Every unordered pair of groups with its test and the decision at ``alpha``; the data is read once for all pairs."""
    data = _present(df, group, value)
    keys = sorted(r[0] for r in data.select(group).distinct().collect())  # the result has a row for each pair of these
    return _mann_whitney(_pair_sums(data, group, value, keys)).withColumn("rejected", F.col("p_one_sided") < alpha)


def choose_test(df: DataFrame, group: str, value: str, first, second, alpha: float = 0.05) -> DataFrame:
    """t-test when both groups look normal with equal variances, else Mann-Whitney; one row."""
    pair = df.where(F.col(group).isin(first, second))
    normal = shapiro_normality(pair, group, value).agg(F.min("p_value").alias("normality_p"))
    spread = levene(pair, group, value).select(F.col("p_value").alias("variance_p"))
    t = t_test(pair, group, value, first, second).select(
        F.col("statistic").alias("t_statistic"), F.col("p_value").alias("t_p")
    )
    u = mann_whitney(pair, group, value, first, second).select(
        F.col("statistic").alias("u_statistic"), F.col("p_two_sided").alias("u_p")
    )
    one = normal.crossJoin(spread).crossJoin(t).crossJoin(u)  # four one-row tables
    parametric = (F.col("normality_p") > alpha) & (F.col("variance_p") > alpha)
    p = F.when(parametric, F.col("t_p")).otherwise(F.col("u_p"))
    return one.select(
        F.when(parametric, "t").otherwise("mann_whitney").alias("test"),
        "normality_p",
        "variance_p",
        F.when(parametric, F.col("t_statistic")).otherwise(F.col("u_statistic")).alias("statistic"),
        p.alias("p_value"),
        (p < alpha).alias("rejected"),
    )


def conversion_rate(df: DataFrame, purchases: str, clicks: str) -> DataFrame:
    return df.withColumn("conversion_rate", ratio(purchases, clicks) * 100.0)


def side_by_side(df: DataFrame, group: str, value: str, order: Sequence[Column], first, second) -> DataFrame:
    """(position, first_value, second_value): two groups next to each other by position.

    Positions come from one global order in which the groups follow each other,
    so a large group is numbered in many tasks.
    """
    chosen = df.where(F.col(group).isin(first, second))
    numbered = with_row_number(chosen, [F.col(group).asc(), *order], "_n")
    starts = chosen.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    lower = min(first, second)
    shift = starts.agg(F.coalesce(F.max(F.when(F.col(group) == lower, F.col("_size"))), F.lit(0)).alias("_shift"))
    placed = numbered.crossJoin(F.broadcast(shift)).withColumn(
        "position", F.col("_n") - 1 - F.when(F.col(group) == lower, 0).otherwise(F.col("_shift"))
    )
    a = placed.where(F.col(group) == first).select("position", F.col(value).alias("first_value"))
    b = placed.where(F.col(group) == second).select("position", F.col(value).alias("second_value"))
    return a.join(b, "position", "full")
