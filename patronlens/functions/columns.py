"""Scalar column builders; all stay inside JVM code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_or_false(c, text: str) -> Column:
    """Substring test in which a missing value counts as 'does not contain'."""
    return F.coalesce(col(c).contains(text), F.lit(False))


def ratio(a, b) -> Column:
    """``a / b``; a zero or missing divisor gives NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clean_double(c) -> Column:
    """Double in which NaN is NULL."""
    value = col(c).cast("double")
    return F.when(~F.isnan(value), value)


def elapsed_days(later, earlier) -> Column:
    """Whole days between two instants, rounded down (not calendar days)."""
    seconds = F.unix_seconds(col(later).cast("timestamp")) - F.unix_seconds(col(earlier).cast("timestamp"))
    return F.floor(seconds / F.lit(86400)).cast("long")


def month_of(ts) -> Column:
    return F.trunc(col(ts), "month")


def months_apart(later, earlier) -> Column:
    """Exact number of months between two month starts."""
    a, b = col(later), col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("int")


def weeks(days) -> Column:
    return col(days) / F.lit(7.0)


def joined_key(*parts) -> Column:
    """Parts joined by '_'; NULL as soon as one part is missing."""
    cols = [col(p).cast("string") for p in parts]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(complete, F.concat_ws("_", *cols))


def last_match(branches, default=None) -> Column:
    """CASE in which the last true condition wins, as repeated assignment does."""
    expr = None
    for condition, value in reversed(list(branches)):
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def mapped(c, mapping: dict) -> Column:
    """Value looked up in a literal map; NULL when absent."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.element_at(F.create_map(*pairs), col(c))


def extracted(c, pattern: str, group: int = 1) -> Column:
    """Regex group; NULL instead of an empty string when nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def word_count(c) -> Column:
    """Number of pieces between single blanks."""
    return F.size(F.split(col(c), " "))


def words_starting_with(c, prefix: str) -> Column:
    return F.size(F.filter(F.split(F.trim(col(c)), r"\s+"), lambda w: w.startswith(prefix)))


def positive_flag(c) -> Column:
    return F.when(col(c) > 0, 1).otherwise(0)


def null_flag(c) -> Column:
    return col(c).isNull().cast("int")


def first_of_sorted(c) -> Column:
    """Smallest element of an array; NULL for an empty array."""
    return F.try_element_at(F.array_sort(col(c)), F.lit(1))
