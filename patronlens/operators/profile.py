"""Table and column profiles; each is one or two jobs over all columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encoding import frequency_table
from .quantiles import ACCURACY, exact_quantiles, literal, quoted

PROFILE_PROBS = (0.0, 0.05, 0.50, 0.95, 0.99, 1.0)


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _per_column(df: DataFrame, cols: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One aggregate over the table, turned into one row per column.

    ``measures`` are SQL templates in which ``{c}`` stands for the column.
    """
    if not cols:
        raise ValueError("no columns to profile")
    wide = df.agg(
        *[F.expr(f"{sql.format(c=quoted(c))} AS `{i}_{name}`") for i, c in enumerate(cols) for name, sql in measures.items()]
    )
    cells = ", ".join(
        "struct(" + ", ".join([f"{literal(c)} AS column_name", *[f"`{i}_{name}` AS {name}" for name in measures]]) + ")"
        for i, c in enumerate(cols)
    )
    return wide.selectExpr(f"inline(array({cells}))")


MISSING = "count_if({c} IS NULL)"


def table_profile(df: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """(column_name, data_type, n_rows, n_null, quantiles 0 / .05 / .5 / .95 / .99 / 1)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    base = _per_column(df, df.columns, {"n_rows": "count(1)", "n_null": MISSING})
    names = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    base = base.withColumn("data_type", F.element_at(names, F.col("column_name")))
    q = exact_quantiles(df, numeric_columns(df), PROFILE_PROBS, accuracy=accuracy)
    labels = ["q00", "q05", "q50", "q95", "q99", "q100"]
    q = q.select("column_name", *[F.col("q")[i].alias(name) for i, name in enumerate(labels)])
    return base.join(F.broadcast(q), "column_name", "left")  # one row per column of the table


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, {"n_null": MISSING})


def zero_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _per_column(df, cols, {"n_zero": "count_if({c} = 0)"})


def missing_table(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percentage, most missing first."""
    counts = _per_column(df, df.columns, {"n_rows": "count(1)", "n_miss": MISSING})
    shown = counts.where(F.col("n_miss") > 0)
    shown = shown.withColumn("ratio", F.round(F.col("n_miss") / F.col("n_rows") * 100, 2)).drop("n_rows")
    return shown.orderBy(F.col("n_miss").desc(), "column_name")


def missing_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns that hold at least one missing value."""
    cols = list(df.columns if cols is None else cols)
    row = df.agg(F.expr("count(1)"), *[F.expr(f"count({quoted(c)})") for c in cols]).first()
    return [c for c, n in zip(cols, row[1:]) if n < row[0]]


def describe(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), accuracy: int = ACCURACY
) -> DataFrame:
    """(column_name, n, mean, std, min, q array, max), one row per column."""
    basic = _per_column(
        df,
        cols,
        {
            "n": "count({c})",
            "mean": "avg({c})",
            "std": "stddev_samp({c})",
            "min": "min(CAST({c} AS DOUBLE))",
            "max": "max(CAST({c} AS DOUBLE))",
        },
    )
    q = exact_quantiles(df, cols, probs, accuracy=accuracy).select("column_name", "q")
    return basic.join(F.broadcast(q), "column_name", "left")  # one row per column of the table


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_distinct, n_levels); ``n_levels`` counts NULL as a value.

    The distinct values are formed per (column, value), so no group is held whole.
    """
    cols = list(cols or df.columns)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    pairs = df.select(F.explode(cells).alias("cell")).select("cell.*").distinct()
    return pairs.groupBy("column_name").agg(
        F.count("value").alias("n_distinct"), F.count(F.lit(1)).alias("n_levels")
    )


@dataclass(frozen=True)
class Roles:
    categorical: list[str]
    cardinal: list[str]
    numeric: list[str]
    numeric_categorical: list[str]


def role_table(df: DataFrame, low_levels: int = 10, car_th: int = 20) -> DataFrame:
    """Role of every column: cat, cat_but_car, num or num_but_cat.

    Numbers with fewer than ``low_levels`` values are categories; text with more
    than ``car_th`` values is cardinal.
    """
    numeric = F.col("column_name").isin(numeric_columns(df))
    n = F.col("n_distinct")
    role = (
        F.when(numeric & (n < low_levels), "num_but_cat")
        .when(numeric, "num")
        .when(n > car_th, "cat_but_car")
        .otherwise("cat")
    )
    return distinct_counts(df).select("column_name", "n_distinct", role.alias("role"))


def distinct_up_to(df: DataFrame, cols: Sequence[str], limit: int, nulls: bool = False) -> dict[str, int | None]:
    """Exact number of distinct values per column, or None when it is above ``limit``.

    A sketch of all columns, one small aggregate, first sets aside the columns that
    hold far more values than the limit. Only the others are counted exactly, so
    identifiers and amounts never cross the shuffle.
    """
    cols = list(cols)
    if not cols:
        return {}
    sketch = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    near = [c for i, c in enumerate(cols) if sketch[f"n{i}"] <= 4 * limit + 100]
    counted = {}
    if near:
        for r in distinct_counts(df, near).collect():  # one row per column
            counted[r.column_name] = r.n_levels if nulls else r.n_distinct
    found = {c: counted.get(c, 0) if c in near else None for c in cols}
    return {c: None if n is not None and n > limit else n for c, n in found.items()}


def column_roles(df: DataFrame, low_levels: int = 10, car_th: int = 20) -> Roles:
    """The roles of ``role_table`` as column lists, without counting columns that have many values."""
    n = distinct_up_to(df, df.columns, max(low_levels, car_th))
    numeric = set(numeric_columns(df))
    few = [c for c in df.columns if c in numeric and n[c] is not None and n[c] < low_levels]
    cardinal = [c for c in df.columns if c not in numeric and (n[c] is None or n[c] > car_th)]
    return Roles(
        [c for c in df.columns if c in few or (c not in numeric and c not in cardinal)],
        cardinal,
        [c for c in df.columns if c in numeric and c not in few],
        few,
    )


def columns_by_levels(df: DataFrame, low: int, high: int | None, kind: str | None = None, cols=None) -> list[str]:
    """Columns with ``low`` to ``high`` levels (NULL counts as one); no ``high`` means at least ``low``."""
    chosen = {"text": text_columns(df), "numeric": numeric_columns(df), None: df.columns}[kind]
    if cols is not None:
        chosen = [c for c in chosen if c in cols]
    n = distinct_up_to(df, chosen, high if high is not None else low - 1, nulls=True)
    if high is None:
        return [c for c in chosen if n[c] is None]
    return [c for c in chosen if n[c] is not None and n[c] >= low]


def category_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n, ratio in percent of all rows)."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    return (
        frequency_table(df, cols)
        .crossJoin(F.broadcast(total))
        .select("column_name", "value", "n", (F.lit(100.0) * F.col("n") / F.col("rows")).alias("ratio"))
    )


def target_by_category(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column_name, value, n, target_mean); missing category values are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(cells).alias("cell"), F.col(target).alias("_t")).select("cell.*", "_t")
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_t").alias("target_mean"))
    )


def rare_report(df: DataFrame, cols: Sequence[str], target: str, ratio: float = 0.01) -> DataFrame:
    """Count, share and target mean per value, for columns that hold at least one rare value."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    table = target_by_category(df, cols, target).crossJoin(F.broadcast(total))
    table = table.withColumn("ratio", F.col("n") / F.col("rows")).drop("rows")
    affected = table.where(F.col("ratio") < ratio).select("column_name").distinct()
    return table.join(F.broadcast(affected), "column_name", "left_semi")  # one row per column of the table


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(left_column, right_column, r) for every unordered pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.explode(cells).alias("cell")).select("cell.*")


def target_correlations(df: DataFrame, cols: Sequence[str], target: str, limit: float = 0.60) -> DataFrame:
    """(column_name, r, is_high) with ``is_high`` when |r| exceeds the limit."""
    pair = f"corr(CAST({{c}} AS DOUBLE), CAST({quoted(target)} AS DOUBLE))"
    table = _per_column(df, [c for c in cols if c != target], {"r": pair})
    return table.withColumn("is_high", F.coalesce(F.abs("r") > limit, F.lit(False)))
