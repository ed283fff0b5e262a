"""Probabilistic lifetime value: BG/NBD purchases, Gamma-Gamma spend, discounted value.

Formulas: Fader, Hardie, Lee (2005), "Counting Your Customers" the Easy Way;
Fader, Hardie (2013), The Gamma-Gamma Model of Monetary Value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import elapsed_days, weeks
from ..functions.special import hyp2f1, log_gamma, polygamma
from ..operators.binning import minmax, qcut
from ..session import materialise
from .fitting import Derivatives, fit, likelihood_sums
from .rfm import analysis_date

WEEKS_PER_MONTH = 4.345
FORECAST_WEEKS_PER_MONTH = 4
#: Where fits begin: (r, alpha, a, b) for scaled ages, and (p, q, v).
PURCHASE_STARTS = [(r, al, a, b) for r in (0.3, 1.0, 3.0) for al in (0.3, 1.0, 4.0) for a in (0.1, 0.7) for b in (1.0, 4.0)]
SPEND_STARTS = [(p, q, v) for p in (0.5, 2.0, 6.0) for q in (0.5, 1.0, 4.0) for v in (0.5, 4.0, 30.0)]


@dataclass(frozen=True)
class BgNbd:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGamma:
    p: float
    q: float
    v: float


def clv_summary(
    lines: DataFrame,
    today: Column | None = None,
    recency: str = "span",
    count: str = "total",
    monetary: str = "per_order",
) -> DataFrame:
    """(customer_id, recency, t, frequency, monetary_avg, recency_weekly, t_weekly).

    ``recency``: 'span' first to last purchase, or 'since_last'. ``count``: 'total'
    invoices or 'repeat' invoices. ``monetary``: 'per_order' total, or the
    'mean_of_means' of each invoice's line average. Lines are summed per invoice
    first, so no customer is brought together whole.
    """
    ts = F.col("invoice_date").cast("timestamp")
    invoices = (
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice")
        .agg(
            F.min(ts).alias("_first"), F.max(ts).alias("_last"),
            F.sum("total_price").alias("_sum"), F.avg("total_price").alias("_mean"),
        )
    )
    customers = materialise(invoices.groupBy("customer_id").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.count("invoice").alias("_orders"), F.sum("_sum").alias("_sum"), F.avg("_mean").alias("_mean"),
    ))
    if today is None:
        latest = customers.agg(analysis_date(F.max("_last")).alias("_today"))
        customers, today = customers.crossJoin(F.broadcast(latest)), F.col("_today")
    since = elapsed_days(F.col("_last"), F.col("_first")) if recency == "span" else elapsed_days(today, F.col("_last"))
    spend = F.try_divide(F.col("_sum"), F.col("_orders")) if monetary == "per_order" else F.col("_mean")
    return customers.select(
        "customer_id",
        since.alias("recency"),
        elapsed_days(today, F.col("_first")).alias("t"),
        (F.col("_orders") if count == "total" else F.col("_orders") - 1).alias("frequency"),
        spend.alias("monetary_avg"),
    ).withColumns({"recency_weekly": weeks("recency"), "t_weekly": weeks("t")})


def model_input(summary: DataFrame, min_frequency: int = 1) -> DataFrame:
    """Customers with positive spend and more than ``min_frequency`` purchases."""
    return summary.where((F.col("monetary_avg") > 0) & (F.col("frequency") > min_frequency))


def bgnbd_model(params: np.ndarray, data: dict[str, np.ndarray]) -> Derivatives:
    """Log-likelihood of (r, alpha, a, b) per customer, with its gradient and second derivatives.

    Two ways lead to a history: the customer is alive, or has gone after the last purchase. The derivatives of their
    sum weigh those of both by the chance of each.
    """
    r, alpha, a, b = params
    x, tx, t = data["x"], data["tx"], data["t"]
    later = b + np.maximum(x, 1.0) - 1.0
    alive = -(r + x) * np.log(alpha + t)
    gone = np.where(x > 0, math.log(a) - np.log(later) - (r + x) * np.log(alpha + tx), -np.inf)
    either = np.logaddexp(alive, gone)
    left = np.exp(gone - either)
    counts = log_gamma(r + x) - log_gamma(r) + r * math.log(alpha)
    dropout = log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)

    (rx, rx2), (r1, r2) = polygamma(r + x), polygamma(r)
    (ab, ab2), (bx, bx2), (b1, b2), (abx, abx2) = polygamma(a + b), polygamma(b + x), polygamma(b), polygamma(a + b + x)
    none = np.zeros_like(x)
    if_alive = np.stack([-np.log(alpha + t), -(r + x) / (alpha + t), none, none])
    if_gone = np.stack([-np.log(alpha + tx), -(r + x) / (alpha + tx), none + 1.0 / a, -1.0 / later])
    slope = (1.0 - left) * if_alive + left * if_gone
    slope += np.stack([rx - r1 + math.log(alpha), none + r / alpha, ab - abx, ab + bx - b1 - abx])

    apart = if_alive - if_gone
    bend = left * (1.0 - left) * apart[:, None] * apart[None, :]
    bend[0, 0] += rx2 - r2
    mixed = 1.0 / alpha - (1.0 - left) / (alpha + t) - left / (alpha + tx)
    bend[0, 1] += mixed
    bend[1, 0] += mixed
    bend[1, 1] += (1.0 - left) * (r + x) / (alpha + t) ** 2 + left * (r + x) / (alpha + tx) ** 2 - r / alpha**2
    bend[2, 2] += ab2 - abx2 - left / a**2
    bend[2, 3] += ab2 - abx2
    bend[3, 2] += ab2 - abx2
    bend[3, 3] += ab2 + bx2 - b2 - abx2 + left / later**2
    return counts + dropout + either, slope, bend


def fit_bgnbd(
    summary: DataFrame,
    penalizer: float = 0.0,
    frequency: str = "frequency",
    recency: str = "recency_weekly",
    age: str = "t_weekly",
    scaled_age: float | None = 10.0,
) -> BgNbd:
    """Fit (r, alpha, a, b).

    Customers with equal history are counted together. Times are scaled so that the highest age is ``scaled_age`` while
    fitting: the penalty then does not depend on the time unit. ``None`` leaves them as they are. Where nobody ever drops
    out, a goes to 0, a limit of the model; any other parameter without a finite optimum is an error.
    """
    table = materialise(bgnbd_histories(summary, frequency, recency, age))
    scale = 1.0
    if scaled_age:
        oldest = table.agg(F.max("t")).first()[0]
        scale = scaled_age / oldest if oldest else 1.0
    scaled = table.select("x", (F.col("tx") * scale).alias("tx"), (F.col("t") * scale).alias("t"), "w")
    r, alpha, a, b = fit(scaled, bgnbd_model, PURCHASE_STARTS, penalizer, vanishing=[2]).params
    return BgNbd(float(r), float(alpha / scale), float(a), float(b))


def bgnbd_histories(summary: DataFrame, frequency: str = "frequency", recency: str = "recency_weekly", age: str = "t_weekly") -> DataFrame:
    """(x, tx, t, w): histories and the number of customers with each.

    With recency and age in days their number depends on the length of the period, not on the customers.
    """
    return summary.groupBy(
        F.col(frequency).cast("double").alias("x"), F.col(recency).cast("double").alias("tx"), F.col(age).cast("double").alias("t")
    ).agg(F.count(F.lit(1)).cast("double").alias("w"))


def gamma_gamma_model(params: np.ndarray, data: dict[str, np.ndarray]) -> Derivatives:
    """Log-likelihood of (p, q, v) per customer, with its gradient and second derivatives."""
    p, q, v = params
    x, m = data["x"], data["m"]
    px, spent = p * x, x * m + v
    value = (
        log_gamma(px + q) - log_gamma(px) - log_gamma(q)
        + q * math.log(v) + (px - 1.0) * np.log(m) + px * np.log(x) - (px + q) * np.log(spent)
    )
    (both, both2), (px1, px2), (q1, q2) = polygamma(px + q), polygamma(px), polygamma(q)
    slope = np.stack([
        x * (both - px1 + np.log(m) + np.log(x) - np.log(spent)),
        both - q1 + math.log(v) - np.log(spent),
        q / v - (px + q) / spent,
    ])
    bend = np.empty((3, 3, len(x)))
    bend[0, 0] = x * x * (both2 - px2)
    bend[0, 1] = bend[1, 0] = x * both2
    bend[0, 2] = bend[2, 0] = -x / spent
    bend[1, 1] = both2 - q2
    bend[1, 2] = bend[2, 1] = 1.0 / v - 1.0 / spent
    bend[2, 2] = (px + q) / spent**2 - q / v**2
    return value, slope, bend


def fit_gamma_gamma(
    summary: DataFrame, penalizer: float = 0.01, frequency: str = "frequency", monetary: str = "monetary_avg"
) -> GammaGamma:
    """Fit (p, q, v); q may be below 1."""
    table = materialise(spend_histories(summary, frequency, monetary))
    p, q, v = fit(table, gamma_gamma_model, SPEND_STARTS, penalizer).params
    return GammaGamma(float(p), float(q), float(v))


def spend_histories(summary: DataFrame, frequency: str = "frequency", monetary: str = "monetary_avg") -> DataFrame:
    """(x, m, w) of the customers with orders and positive spend."""
    usable = summary.where((F.col(frequency) > 0) & (F.col(monetary) > 0))
    return usable.select(F.col(frequency).cast("double").alias("x"), F.col(monetary).cast("double").alias("m"), F.lit(1.0).alias("w"))


def likelihood_report(model: BgNbd | GammaGamma, summary: DataFrame) -> DataFrame:
    """(parameter, value, log_likelihood, gradient), one row per parameter: how a model fits a table.

    log_likelihood and gradient are means per customer. Where a fit without penalty has converged, the gradient is 0.
    """
    params = vars(model)
    if isinstance(model, BgNbd):
        table, kernel = bgnbd_histories(summary), bgnbd_model
    else:
        table, kernel = spend_histories(summary), gamma_gamma_model
    table = materialise(table)
    n = table.agg(F.sum("w")).first()[0]
    if not n:
        raise ValueError("no customers to compare the model with")
    value, slope, _ = likelihood_sums(table, kernel, [np.array(list(params.values()))])[0]
    rows = [(name, float(v), float(value / n), float(g / n)) for (name, v), g in zip(params.items(), slope)]
    return summary.sparkSession.createDataFrame(rows, "parameter string, value double, log_likelihood double, gradient double")


def expected_values(model: BgNbd, x, tx, t, horizons: Sequence[float]) -> np.ndarray:
    """Expected purchases within each horizon, shape (customers, horizons).

    The power of the survival ratio is folded into the hypergeometric factor
    (Euler's transformation), which stays in range for customers with many purchases.
    """
    r, alpha, a, b = model.r, model.alpha, model.a, model.b
    x, tx, t = (np.asarray(v, dtype=float) for v in (x, tx, t))
    with np.errstate(over="ignore"):
        odds = np.where(
            x > 0, a / (b + np.maximum(x, 1.0) - 1.0) * np.exp((r + x) * np.log((alpha + t) / (alpha + tx))), 0.0
        )
    out = np.zeros((len(x), len(horizons)))
    for i, h in enumerate(horizons):
        z = h / (alpha + t + h)
        lost = np.exp((a - 1.0) * np.log1p(-z)) * hyp2f1(a + b - 1.0 - r, a - 1.0, a + b + x - 1.0, z)
        out[:, i] = (a + b + x - 1.0) / (a - 1.0) * (1.0 - lost) / (1.0 + odds)
    return out


def expected_purchases(
    model: BgNbd, horizons: Sequence[float], frequency="frequency", recency="recency_weekly", age="t_weekly"
) -> Column:
    """Array column: expected purchases within each horizon, one Arrow call for all of them."""
    horizons = [float(h) for h in horizons]

    @F.pandas_udf("array<double>")
    def forecast(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(list(expected_values(model, x, tx, t, horizons)))

    return forecast(F.col(frequency).cast("double"), F.col(recency).cast("double"), F.col(age).cast("double"))


def expected_profit(model: GammaGamma, frequency="frequency", monetary="monetary_avg") -> Column:
    """Expected average profit per order; NULL where the mean does not exist."""
    p, q, v = F.lit(model.p), F.lit(model.q), F.lit(model.v)
    below = p * F.col(frequency) + q - 1.0
    return F.when(below > 0, F.try_divide(p * (v + F.col(frequency) * F.col(monetary)), below))


def discounted_value(expected: Column, first: int, months: int, profit: Column, rate: float) -> Column:
    """Sum over months of profit times new purchases, discounted monthly.

    ``expected[first + i]`` holds the purchases expected up to the end of month i + 1.
    """
    total = F.lit(0.0)
    for i in range(months):
        so_far = expected[first + i]
        new = so_far if i == 0 else so_far - expected[first + i - 1]
        total = total + new / F.lit((1.0 + rate) ** (i + 1))
    return profit * total


def with_forecast(
    summary: DataFrame,
    purchases: BgNbd,
    spend: GammaGamma,
    months: Sequence[int] = (6,),
    sales_months: Sequence[int] = (1, 3),
    rate: float = 0.01,
    weeks_per_month: float = WEEKS_PER_MONTH,
) -> DataFrame:
    """Add expected sales, expected profit and the value ``clv_<months>`` of each horizon."""
    sales = [m * FORECAST_WEEKS_PER_MONTH for m in sales_months]
    ends = [weeks_per_month * (i + 1) for i in range(max(months))]
    out = summary.withColumn("_e", expected_purchases(purchases, sales + ends)).withColumn(
        "expected_average_profit", expected_profit(spend)
    )
    e, profit = F.col("_e"), F.col("expected_average_profit")
    made = {f"exp_sales_{m}_month": e[i] for i, m in enumerate(sales_months)}
    made |= {f"clv_{m}": discounted_value(e, len(sales), m, profit, rate) for m in months}
    return out.withColumns(made).drop("_e")


def clv_table(
    lines: DataFrame,
    months: int = 6,
    today: Column | None = None,
    penalizer: float = 0.01,
    spend_penalizer: float = 0.01,
    labels: Sequence[str] = ("C", "B", "A"),
) -> DataFrame:
    """Cleaned lines to predicted value per customer: forecast, scale 1..100, segment."""
    summary = materialise(model_input(clv_summary(lines, today)))
    purchases, spend = fit_bgnbd(summary, penalizer), fit_gamma_gamma(summary, spend_penalizer)
    scored = materialise(with_forecast(summary, purchases, spend, (months,)))  # read again by scaling and binning
    scaled = minmax(scored, {"cltv_p": f"clv_{months}"}, 1.0, 100.0)
    return qcut(scaled, {"cltv_p_segment": ("cltv_p", list(labels))})


def clv_horizons(
    summary: DataFrame, purchases: BgNbd, spend: GammaGamma, months: Sequence[int] = (1, 6, 12), rate: float = 0.01
) -> DataFrame:
    """(customer_id, horizon_months, clv): all horizons from one pass."""
    scored = with_forecast(summary, purchases, spend, months, rate=rate)
    cells = F.array(
        *[F.struct(F.lit(m).alias("horizon_months"), F.col(f"clv_{m}").alias("clv")) for m in months]
    )
    return scored.select("customer_id", F.explode(cells).alias("cell")).select("customer_id", "cell.*")
