"""Exact, linearly interpolated quantiles that never sort a whole column in one task.

The built-in exact percentile keeps every distinct value of a column in one
reducer. Here a mergeable sketch first brackets each wanted rank; then the rows
outside the brackets are only counted (map-side) and the few distinct values
inside them are ranked, in slices. With accuracy A at most about 4 * len(probs) / A
of the rows reach the ranking step, equal values collapse to one row before the
shuffle, and one task ranks one slice of one bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ACCURACY = 20_000
#: Parts into which each bracket is cut before ranking.
SLICES = 256
_NAME = "column_name"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _brackets(probs: Sequence[float], accuracy: int) -> list[float]:
    slack = 2.0 / accuracy
    return [edge for p in probs for edge in (max(p - slack, 0.0), min(p + slack, 1.0))]


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per (by..., column_name) with ``n`` and ``q``, an array aligned with ``probs``.

    Missing values and NaN are ignored; a column without values gives no row.
    Expressions are written as SQL text: one parse per column is much cheaper for
    the driver than building each node from Python.
    """
    by, cols = list(by), list(cols)
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    ranked = [float(probs[i]) for i in order]
    k = len(ranked)
    keys = [quoted(b) for b in by]
    base = df.selectExpr(
        *keys, *[f"nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS _v{i}" for i, c in enumerate(cols)]
    )

    # 1. two sketched values around every wanted rank
    edges = ", ".join(f"{e!r}D" for e in _brackets(ranked, accuracy))
    sketch = base.groupBy(*by).agg(
        *[F.expr(f"percentile_approx(_v{i}, array({edges}), {accuracy}) AS _e{i}") for i in range(len(cols))]
    )
    if by:
        names = [f"_qk{i}" for i in range(len(by))]
        sketch = sketch.withColumnsRenamed(dict(zip(by, names)))
        located = base.join(sketch, on=F.expr(" AND ".join(f"{b} <=> {n}" for b, n in zip(keys, names))))
    else:
        located = base.crossJoin(F.broadcast(sketch))  # the sketch is exactly one row

    # 2. one (segment, value) per cell: the value inside a bracket, NULL in the gap below it
    cells = ", ".join(f"struct({literal(c)} AS {_NAME}, _v{i} AS _qv, _e{i} AS _qe)" for i, c in enumerate(cols))
    if len(cols) == 1:
        long = located.selectExpr(*keys, f"{literal(cols[0])} AS {_NAME}", "_v0 AS _qv", "_e0 AS _qe")
    else:
        long = located.selectExpr(*keys, f"inline(array({cells}))")
    segment = " ".join(f"WHEN _qv <= _qe[{2 * i + 1}] THEN {i}" for i in range(k))
    low = "CASE _seg " + " ".join(f"WHEN {i} THEN _qe[{2 * i}]" for i in range(k)) + " END"
    high = "CASE _seg " + " ".join(f"WHEN {i} THEN _qe[{2 * i + 1}]" for i in range(k)) + " END"
    long = long.where("_qv IS NOT NULL").selectExpr(*keys, _NAME, "_qv", "_qe", f"CASE {segment} ELSE {k} END AS _seg")
    long = long.selectExpr(*keys, _NAME, "_qv", "_seg", f"{low} AS _low", f"{high} - {low} AS _width")
    long = long.selectExpr(
        *keys,
        _NAME,
        "_qv",
        "_seg",
        f"CASE WHEN _qv < _low OR _low IS NULL THEN -1 WHEN _width > 0 AND _width < 1e300D "
        f"THEN CAST(floor((_qv - _low) / _width * {SLICES}) AS INT) ELSE 0 END AS _slice",
    )
    long = long.selectExpr(*keys, _NAME, "_qv", "_seg", "_slice", "CASE WHEN _slice >= 0 THEN _qv END AS _bin")
    place = [*by, _NAME, "_seg", "_slice"]
    counts = long.groupBy(*place, "_bin").agg(
        F.expr("count(1) AS _cnt"), F.expr("min(_qv) AS _lo"), F.expr("max(_qv) AS _hi")
    )

    # 3. ranks: slice totals tell which slices hold a wanted rank; only those are ranked
    part = ", ".join([*keys, _NAME])
    ranks = [(f"_{side}{i}", f"{side}((_n - 1) * {p!r}D)") for i, p in enumerate(ranked) for side in ("floor", "ceil")]
    totals = counts.groupBy(*place).agg(
        F.expr("sum(_cnt) AS _t"), F.expr("min(_lo) AS _first"), F.expr("max(_hi) AS _last")
    ).selectExpr(
        *[f"{quoted(c)} AS _j{i}" for i, c in enumerate(place)],
        "_t",
        "_first",
        "_last",
        f"sum(_t) OVER (PARTITION BY {part} ORDER BY _seg, _slice ROWS UNBOUNDED PRECEDING) - _t AS _before",
        f"sum(_t) OVER (PARTITION BY {part}) AS _n",
    )
    totals = totals.where(" OR ".join(f"(_before <= {r} AND {r} < _before + _t)" for _, r in ranks))
    if not by:
        totals = F.broadcast(totals)  # at most two slices per column and quantile
    same = F.expr(" AND ".join(f"{quoted(c)} <=> _j{i}" for i, c in enumerate(place)))
    placed = counts.join(totals, on=same).selectExpr(
        *keys,
        _NAME,
        "_cnt",
        "_lo",
        "_hi",
        "_first",
        "_last",
        f"_before + sum(_cnt) OVER (PARTITION BY {part}, _seg, _slice ORDER BY _bin ROWS UNBOUNDED PRECEDING) AS _end",
        "_n",
    )
    missed = "CAST(raise_error('quantile sketch missed its bracket; raise accuracy') AS DOUBLE)"
    picks = ["max(_n) AS _n"]
    for name, rank in ranks:
        picks.append(
            f"max(CASE WHEN _end - _cnt <= {rank} AND {rank} < _end THEN CASE WHEN _first = _last THEN _first "
            f"WHEN _lo = _hi OR {rank} = _end - _cnt THEN _lo WHEN {rank} = _end - 1 THEN _hi ELSE {missed} END END) AS {name}"
        )
    best = placed.groupBy(*by, _NAME).agg(*[F.expr(e) for e in picks])
    slot = {original: i for i, original in enumerate(order)}
    q = ", ".join(
        f"_floor{i} + (_ceil{i} - _floor{i}) * ((_n - 1) * {p!r}D - floor((_n - 1) * {p!r}D))"
        for i, p in ((slot[j], float(probs[j])) for j in range(k))
    )
    return best.selectExpr(*keys, _NAME, "_n AS n", f"array({q}) AS q")


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """The same quantiles as exactly one row: array column ``q_<name>`` per input column."""
    table = exact_quantiles(df, cols, probs, accuracy=accuracy)
    picks = [f"max(CASE WHEN {_NAME} = {literal(c)} THEN q END) AS {quoted('q_' + c)}" for c in cols]
    return table.agg(*[F.expr(e) for e in picks])


def with_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """Attach the one-row quantile arrays to every row."""
    return df.crossJoin(F.broadcast(quantile_row(df, cols, probs, accuracy)))


def group_quantiles(
    df: DataFrame, by: Sequence[str], column: str, probs: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group with one named column per quantile."""
    table = exact_quantiles(df, [column], list(probs.values()), by=by, accuracy=accuracy)
    return table.select(*by, *[F.col("q")[i].alias(name) for i, name in enumerate(probs)])
