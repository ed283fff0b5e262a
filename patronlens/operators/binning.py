"""Fixed and quantile bins, min-max scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from .quantiles import ACCURACY, quoted, with_quantiles


def cut(c, edges: Sequence, labels: Sequence) -> Column:
    """Right-closed bins ``(edges[i], edges[i + 1]]``; outside all bins gives NULL.

    Edges are numbers or columns, so that the last one may be an aggregate.
    """
    x = col(c)
    edges = [e if isinstance(e, Column) else F.lit(e) for e in edges]
    expr = None
    for low, high, label in zip(edges, edges[1:], labels):
        label = label if isinstance(label, Column) else F.lit(label)
        hit = (x > low) & (x <= high)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr


def _bin_expr(c: str, labels: Sequence) -> Column:
    x, q, k = f"CAST({quoted(c)} AS DOUBLE)", quoted(f"q_{c}"), len(labels)
    whole = all(isinstance(label, int) for label in labels)
    text = [str(v) if whole else "'" + str(v).replace("'", "\\'") + "'" for v in labels]
    coincide = " OR ".join(f"{q}[{i}] >= {q}[{i + 1}]" for i in range(k))
    kind = "INT" if whole else "STRING"
    bins = " ".join(f"WHEN {x} <= {q}[{i + 1}] THEN {text[i]}" for i in range(k - 1))
    return F.expr(
        f"CASE WHEN {x} IS NULL THEN NULL "
        f"WHEN {coincide} THEN CAST(raise_error('bin edges of {c} must be unique') AS {kind}) {bins} ELSE {text[-1]} END"
    )


def qcut(df: DataFrame, bins: dict[str, tuple[str, Sequence]], accuracy: int = ACCURACY) -> DataFrame:
    """Quantile bins for several columns at once: ``{new: (source, labels)}``.

    Bins are right-closed on interpolated quantiles, the minimum belongs to the
    first bin, ties stay together, and coinciding edges raise. Columns that need
    the same number of bins share one quantile job. Integer labels stay integers.
    """
    sizes = sorted({len(labels) for _, labels in bins.values()})
    for k in sizes:
        group = {new: spec for new, spec in bins.items() if len(spec[1]) == k}
        sources = sorted({src for src, _ in group.values()})
        edged = with_quantiles(df, sources, [i / k for i in range(k + 1)], accuracy)
        made = {new: _bin_expr(src, labels) for new, (src, labels) in group.items()}
        df = edged.withColumns(made).drop(*[f"q_{src}" for src in sources])
    return df


def minmax(df: DataFrame, cols: dict[str, str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Scale ``{new: source}`` to [low, high]; a constant column becomes ``low``."""
    stats = df.agg(
        *[F.min(c).cast("double").alias(f"_min_{c}") for c in set(cols.values())],
        *[F.max(c).cast("double").alias(f"_max_{c}") for c in set(cols.values())],
    )
    made = {}
    for new, c in cols.items():
        span = F.col(f"_max_{c}") - F.col(f"_min_{c}")
        unit = F.when(span > 0, (F.col(c) - F.col(f"_min_{c}")) / F.when(span > 0, span)).when(
            F.col(c).isNotNull(), F.lit(0.0)
        )
        made[new] = unit * F.lit(float(high - low)) + F.lit(float(low))
    helpers = [f"_{side}_{c}" for side in ("min", "max") for c in set(cols.values())]
    return df.crossJoin(F.broadcast(stats)).withColumns(made).drop(*helpers)


def standardise(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """``(x - mean) / population standard deviation`` for ``{new: source}``."""
    sources = sorted(set(cols.values()))
    stats = df.agg(
        *[F.avg(c).alias(f"_avg_{c}") for c in sources], *[F.stddev_pop(c).alias(f"_std_{c}") for c in sources]
    )
    made = {
        new: F.when(F.col(f"_std_{c}") > 0, F.try_divide(F.col(c) - F.col(f"_avg_{c}"), F.col(f"_std_{c}"))).when(
            F.col(c).isNotNull(), F.lit(0.0)
        )
        for new, c in cols.items()
    }
    helpers = [f"_{s}_{c}" for s in ("avg", "std") for c in sources]
    return df.crossJoin(F.broadcast(stats)).withColumns(made).drop(*helpers)
