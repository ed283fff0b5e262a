"""Maximum likelihood where every evaluation is one distributed sum.

The driver holds a handful of numbers only: it proposes parameter vectors, Spark returns for each the sums of the
log-likelihood, of its gradient and of its second derivatives, several vectors per pass over the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Per row: log-likelihood (n), gradient (d, n), second derivatives (d, d, n).
Derivatives = tuple[np.ndarray, np.ndarray, np.ndarray]
Model = Callable[[np.ndarray, dict[str, np.ndarray]], Derivatives]
#: Multiples of a Newton step that are tried in one pass.
STEPS = (4.0, 1.0, 0.25, 1 / 16)


@dataclass(frozen=True)
class Fit:
    """``limits`` are the numbers of parameters that went to a limit of the model; ``gradient`` is that of the
    objective by the logarithms of the parameters, ``passes`` the number of passes over the table."""

    params: np.ndarray
    objective: float
    gradient: np.ndarray
    limits: tuple[int, ...]
    passes: int


def likelihood_sums(table: DataFrame, model: Model, candidates: Sequence[np.ndarray]) -> list[Derivatives]:
    """Weighted sums of the log-likelihood and its derivatives for every candidate; ``table`` has a weight column ``w``."""
    vectors = [np.asarray(c, dtype=float) for c in candidates]
    d = len(vectors[0])
    width = 1 + d + d * d

    def partial(batches):
        totals = np.zeros((len(vectors), width))
        for pdf in batches:
            data = {c: pdf[c].to_numpy(dtype=float) for c in pdf.columns}
            with np.errstate(all="ignore"):  # a vector far off may overflow; its sum is then not finite and is never chosen
                for i, v in enumerate(vectors):
                    value, slope, bend = model(v, data)
                    totals[i] += np.concatenate([(data["w"] * value).sum(keepdims=True), slope @ data["w"], (bend @ data["w"]).ravel()])
        places = np.arange(totals.size, dtype="int32")
        yield pd.DataFrame({"place": places, "total": totals.ravel()})

    sums = table.mapInPandas(partial, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    flat = np.full(len(vectors) * width, np.nan)
    for row in sums.collect():  # 1 + d + d * d rows per candidate
        flat[row.place] = row.total
    return [(v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for v in flat.reshape(-1, width)]


def fit(
    table: DataFrame,
    model: Model,
    starts: Sequence[Sequence[float]],
    penalizer: float = 0.0,
    tolerance: float = 1e-6,
    max_passes: int = 40,
    bound: float = 12.0,
    vanishing: Sequence[int] = (),
) -> Fit:
    """Positive parameters that minimise ``-mean log-likelihood + penalizer * sum(parameters ** 2)``.

    Newton steps on the logarithms of the parameters, which stay within ``bound``; one pass sums value, gradient and second
    derivatives for all starts, and then for several lengths of each step. ``vanishing``: parameters that may go to 0,
    which is a limit of the model. A fit that ends on any other bound, at no optimum or not at all raises an error.
    """
    weight = table.agg(F.sum("w")).first()[0]
    if not weight:
        raise ValueError("nothing to fit")
    passes = 0

    def evaluate(points: Sequence[np.ndarray]) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
        """The best of the points with its value and derivatives."""
        nonlocal passes
        passes += 1
        out = []
        for at, (ll, slope, bend) in zip(points, likelihood_sums(table, model, [np.exp(p) for p in points])):
            p = np.exp(at)
            by_log = p * (-slope / weight + 2 * penalizer * p)
            curve = np.outer(p, p) * (-bend / weight + 2 * penalizer * np.eye(len(p))) + np.diag(by_log)
            value = -ll / weight + penalizer * float((p**2).sum())
            usable = np.isfinite(value) and np.isfinite(by_log).all() and np.isfinite(curve).all()
            out.append((at, value if usable else np.inf, by_log, curve))
        return min(out, key=lambda o: o[1])

    point, value, gradient, curve = evaluate([np.log(np.asarray(s, dtype=float)) for s in starts])
    if not np.isfinite(value):
        raise ValueError("the likelihood is not finite at any start")
    shrink, free = 1.0, np.arange(len(point))
    while passes < max_passes:
        # parameters that rest on a bound and would leave it stay there
        free = np.flatnonzero(~(((point >= bound) & (gradient < 0)) | ((point <= -bound) & (gradient > 0))))
        if not free.size or np.abs(gradient[free]).max() < tolerance:
            break
        size, axes = np.linalg.eigh(curve[np.ix_(free, free)])
        step = np.zeros(len(point))
        step[free] = -axes @ ((axes.T @ gradient[free]) / np.maximum(np.abs(size), 1e-9))
        step *= min(1.0, 3.0 / np.linalg.norm(step)) * shrink
        best = evaluate([np.clip(point + k * step, -bound, bound) for k in STEPS])
        if best[1] < value:
            gained = value - best[1]
            (point, value, gradient, curve), shrink = best, 1.0
            if gained < 1e-14 * max(abs(value), 1.0):
                break
        elif shrink < 1e-6:
            break
        else:
            shrink /= 256.0
    else:
        raise RuntimeError(f"the fit has not converged in {max_passes} passes")
    if free.size and np.abs(gradient[free]).max() > 1e-4:
        raise RuntimeError("the fit has stopped at a point that is no optimum")
    limits = tuple(i for i in range(len(point)) if abs(point[i]) >= bound)
    lost = [i for i in limits if point[i] > 0 or i not in vanishing]
    if lost:
        raise RuntimeError(f"no finite optimum: parameters {lost} (counted from 0) went to a bound")
    return Fit(np.exp(point), value, gradient, limits, passes)
