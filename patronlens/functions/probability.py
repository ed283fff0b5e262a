"""Arrow UDFs for p-values and quantiles; they run on one row per test; only ``score_sums`` runs on data rows, a batch at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import special


def _apply(fn, *series: pd.Series) -> pd.Series:
    """``fn`` once for each different row of the batch."""
    rows = np.column_stack([s.to_numpy(dtype=float, na_value=np.nan) for s in series])
    unique, back = np.unique(rows, axis=0, return_inverse=True)
    values = np.array([np.nan if np.isnan(r).any() else fn(*r) for r in unique.tolist()], dtype=object)
    return pd.Series(pd.to_numeric(pd.Series(values[back.ravel()])), dtype="float64") if len(rows) else pd.Series([], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_upper(z: pd.Series) -> pd.Series:
    return _apply(lambda v: float(special.normal_sf(v)), z)


@F.pandas_udf(T.DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(special.t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_upper(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _apply(special.f_upper, f, df1, df2)


@F.pandas_udf(T.DoubleType())
def t_quantile(p: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(lambda q, d: special.t_quantile(q, d) if d > 0 else np.nan, p, df)


@F.pandas_udf(T.StructType().add("once", "double").add("square", "double"))
def score_sums(before: pd.Series, count: pd.Series, n: pd.Series) -> pd.DataFrame:
    once, square = special.normal_score_sums(before.to_numpy(), count.to_numpy(), n.to_numpy())
    return pd.DataFrame({"once": once, "square": square})


@F.pandas_udf(T.StructType().add("statistic", "double").add("p_value", "double"))
def shapiro(sums: pd.DataFrame) -> pd.DataFrame:
    rows = [special.shapiro_from_sums(*r) for r in sums.itertuples(index=False)]
    return pd.DataFrame(rows, columns=["statistic", "p_value"])
