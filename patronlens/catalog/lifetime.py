"""Probabilistic lifetime value over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordering import top_share_flag
from ..plans import basket
from ..plans import clv_forecast as clv
from ..session import materialise
from ..sources.retail import table
from .customers import CLEAN_SQL, TODAY_SQL, _clean, bins_sql
from .registry import query

# Published parameters of one fitted pair of models; queries that check formulas use them as given.
BGNBD = clv.BgNbd(r=2.21, alpha=11.66, a=0.12, b=2.51)
GAMMA_GAMMA = clv.GammaGamma(p=3.54, q=1.00, v=3.25)

SUMMARY_SQL = f"""{CLEAN_SQL},
inv AS (SELECT customer_id, invoice, min(invoice_date) AS f, max(invoice_date) AS l, sum(total_price) AS s, avg(total_price) AS m FROM clean GROUP BY 1, 2),
cust AS (SELECT customer_id, min(f) AS f, max(l) AS l, count(*) AS orders, sum(s) AS s, avg(m) AS m FROM inv GROUP BY 1),
today AS (SELECT {TODAY_SQL.format(c='l')} AS today FROM cust),
summary AS (
  SELECT customer_id, CAST(floor((epoch(l) - epoch(f)) / 86400) AS BIGINT) AS recency, CAST(floor((epoch(today) - epoch(f)) / 86400) AS BIGINT) AS t,
         orders AS frequency, s / orders AS monetary_avg, floor((epoch(l) - epoch(f)) / 86400) / 7 AS recency_weekly, floor((epoch(today) - epoch(f)) / 86400) / 7 AS t_weekly,
         CAST(floor((epoch(today) - epoch(l)) / 86400) AS BIGINT) AS since_last, m AS mean_of_means FROM cust, today),
input AS (SELECT * FROM summary WHERE monetary_avg > 0 AND frequency > 1)"""


def _expected_sql(h: str) -> str:
    """Expected purchases within ``h`` weeks: the published series with all-positive terms."""
    m, x, z = BGNBD, "frequency", f"({h} / ({BGNBD.alpha} + t_weekly + {h}))"
    series = (
        f"list_sum(list_transform(range(0, 400), lambda k: exp(lgamma({m.r} + {x} + k) - lgamma({m.r} + {x}) + lgamma({m.b} + {x} + k) - lgamma({m.b} + {x})"
        f" - lgamma({m.a} + {m.b} + {x} - 1 + k) + lgamma({m.a} + {m.b} + {x} - 1) - lgamma(k + 1) + k * ln({z}))))"
    )
    top = f"({m.a} + {m.b} + {x} - 1) / ({m.a} - 1) * (1 - pow(({m.alpha} + t_weekly) / ({m.alpha} + t_weekly + {h}), {m.r} + {x}) * {series})"
    return f"{top} / (1 + {m.a} / ({m.b} + {x} - 1) * pow(({m.alpha} + t_weekly) / ({m.alpha} + recency_weekly), {m.r} + {x}))"


_PROFIT_SQL = f"{GAMMA_GAMMA.p} * ({GAMMA_GAMMA.v} + frequency * monetary_avg) / ({GAMMA_GAMMA.p} * frequency + {GAMMA_GAMMA.q} - 1)"


def _value_sql(months: int) -> str:
    steps = [_expected_sql(str(clv.WEEKS_PER_MONTH * (i + 1))) for i in range(months)]
    cols = ", ".join(f"{s} AS e{i + 1}" for i, s in enumerate(steps))
    terms = " + ".join(f"(e{i} - {f'e{i - 1}' if i > 1 else '0'}) / pow(1.01, {i})" for i in range(1, months + 1))
    return f"WITH {SUMMARY_SQL}, e AS (SELECT *, {cols} FROM input) SELECT customer_id, {_PROFIT_SQL} * ({terms}) AS clv FROM e"


def _summary(spark, d, **options):
    return clv.clv_summary(_clean(spark, d), **options)


def _input(spark, d):
    return clv.model_input(_summary(spark, d))


@query(
    "k15_purchase_history",
    "customer_id:long, recency:long, t:long, frequency:long, monetary_avg:double7, recency_weekly:double6, t_weekly:double6",
    f"WITH {SUMMARY_SQL} SELECT * FROM input",
)
def k15(spark, d):
    return _input(spark, d)


@query(
    "k15_repeat_history",
    "customer_id:long, recency:long, t:long, frequency:long",
    f"WITH {SUMMARY_SQL} SELECT customer_id, recency, t, frequency - 1 AS frequency FROM summary",
)
def k15_repeat(spark, d):
    return _summary(spark, d, count="repeat")


@query(
    "k16_since_last_history",
    "customer_id:long, recency:long, t:long, frequency:long, monetary_avg:double7",
    f"WITH {SUMMARY_SQL} SELECT customer_id, since_last AS recency, t, frequency, mean_of_means AS monetary_avg FROM summary",
)
def k16(spark, d):
    return _summary(spark, d, recency="since_last", monetary="mean_of_means")


def _report_sql(model, loglik: str, rows: str) -> str:
    """Mean log-likelihood and its differences by each parameter over a step of a thousandth; lgamma is built in, its slope is not."""
    params = vars(model)
    parts = []
    for name, v in params.items():
        h = v / 1000
        sides = [loglik.format(**(params | {name: v + k * h})) for k in (-2, -1, 1, 2)]
        slope = f"(({sides[0]}) - 8 * ({sides[1]}) + 8 * ({sides[2]}) - ({sides[3]})) / {12 * h}"
        parts.append(f"SELECT '{name}' AS parameter, {v} AS value, avg({loglik.format(**params)}) AS log_likelihood, avg({slope}) AS gradient FROM {rows}")
    return f"WITH {SUMMARY_SQL} " + " UNION ALL ".join(parts)


_BGNBD_LOGLIK = (
    "lgamma({r} + frequency) - lgamma({r}) + {r} * ln({alpha}) + lgamma({a} + {b}) + lgamma({b} + frequency) - lgamma({b}) - lgamma({a} + {b} + frequency)"
    " - ({r} + frequency) * ln({alpha} + t_weekly) + ln(1 + {a} / ({b} + frequency - 1) * pow(({alpha} + t_weekly) / ({alpha} + recency_weekly), {r} + frequency))"
)
_GAMMA_GAMMA_LOGLIK = (
    "lgamma({p} * frequency + {q}) - lgamma({p} * frequency) - lgamma({q}) + {q} * ln({v}) + ({p} * frequency - 1) * ln(monetary_avg)"
    " + {p} * frequency * ln(frequency) - ({p} * frequency + {q}) * ln(frequency * monetary_avg + {v})"
)
_REPORT = "parameter:str, value:double4, log_likelihood:double6, gradient:double5"


@query("m01_bgnbd_likelihood", _REPORT, _report_sql(BGNBD, _BGNBD_LOGLIK, "input"))
def m01_likelihood(spark, d):
    return clv.likelihood_report(BGNBD, _input(spark, d))


@query("m03_gamma_gamma_likelihood", _REPORT, _report_sql(GAMMA_GAMMA, _GAMMA_GAMMA_LOGLIK, "input"))
def m03_likelihood(spark, d):
    return clv.likelihood_report(GAMMA_GAMMA, _input(spark, d))


@query("m01_bgnbd_fit", "r:double3, alpha:double3, a:double3, b:double3")
def m01(spark, d):
    return spark.createDataFrame([vars(clv.fit_bgnbd(_input(spark, d), 0.001))])


@query(
    "m02_expected_purchases",
    "customer_id:long, weeks_1:double6, weeks_4:double6, weeks_12:double6",
    f"WITH {SUMMARY_SQL} SELECT customer_id, {_expected_sql('1.0')} AS weeks_1, {_expected_sql('4.0')} AS weeks_4, {_expected_sql('12.0')} AS weeks_12 FROM input",
)
def m02(spark, d):
    e = _input(spark, d).withColumn("e", clv.expected_purchases(BGNBD, [1, 4, 12]))
    return e.select("customer_id", *[F.col("e")[i].alias(f"weeks_{w}") for i, w in enumerate((1, 4, 12))])


@query("d19_total_forecast", "month_1:double3, month_3:double3",
       f"WITH {SUMMARY_SQL} SELECT sum({_expected_sql('4.0')}) AS month_1, sum({_expected_sql('12.0')}) AS month_3 FROM input")
def d19(spark, d):
    e = _input(spark, d).withColumn("e", clv.expected_purchases(BGNBD, [4, 12]))
    return e.agg(F.sum(F.col("e")[0]).alias("month_1"), F.sum(F.col("e")[1]).alias("month_3"))


@query("m03_gamma_gamma_fit", "p:double3, q:double3, v:double3")
def m03(spark, d):
    return spark.createDataFrame([vars(clv.fit_gamma_gamma(_input(spark, d), 0.01))])


@query("m04_expected_profit", "customer_id:long, expected_average_profit:double7", f"WITH {SUMMARY_SQL} SELECT customer_id, {_PROFIT_SQL} AS expected_average_profit FROM input")
def m04(spark, d):
    return _input(spark, d).withColumn("expected_average_profit", clv.expected_profit(GAMMA_GAMMA))


@query("m05_discounted_value", "customer_id:long, clv:double3", _value_sql(3))
def m05(spark, d):
    return clv.with_forecast(_input(spark, d), BGNBD, GAMMA_GAMMA, (3,)).withColumnRenamed("clv_3", "clv")


@query("m06_top_by_forecast", "customer_id:long, weeks_4:double6",
       f"WITH {SUMMARY_SQL}, e AS (SELECT customer_id, {_expected_sql('4.0')} AS weeks_4 FROM input) SELECT * FROM e ORDER BY round(weeks_4, 9) DESC, customer_id LIMIT 10")
def m06(spark, d):
    e = _input(spark, d).select("customer_id", clv.expected_purchases(BGNBD, [4])[0].alias("weeks_4"))
    return e.orderBy(F.round("weeks_4", 9).desc(), "customer_id").limit(10)


@query("m07_spend_recency_independence", "r:double6", f"WITH {SUMMARY_SQL} SELECT corr(monetary_avg, recency_weekly) AS r FROM input")
def m07(spark, d):
    return _input(spark, d).agg(F.corr("monetary_avg", "recency_weekly").alias("r"))


@query(
    "k17_predicted_value",
    "customer_id:long, exp_sales_1_month:double4, exp_sales_3_month:double4, expected_average_profit:double2, cltv_p:double4, cltv_p_segment:str",
)
def k17(spark, d):
    return clv.clv_table(_clean(spark, d))


@query("k18_value_by_horizon", "customer_id:long, horizon_months:int, clv:double2")
def k18(spark, d):
    summary = materialise(_input(spark, d))
    purchases, spend = clv.fit_bgnbd(summary, 0.001), clv.fit_gamma_gamma(summary, 0.01)
    return clv.clv_horizons(summary, purchases, spend)


@query("k19_top_share_by_value", "customer_id:long, clv:double3, top_flag:int",
       f"""WITH v AS ({_value_sql(3)}), r AS (SELECT customer_id, round(clv, 3) AS clv FROM v)
           SELECT *, CASE WHEN row_number() OVER (ORDER BY clv DESC, customer_id) <= ceil(0.2 * (SELECT count(*) FROM r)) THEN 1 ELSE 0 END AS top_flag FROM r""")
def k19(spark, d):
    valued = m05(spark, d).select("customer_id", F.round("clv", 3).alias("clv"))
    return top_share_flag(valued, [F.col("clv").desc_nulls_last(), F.col("customer_id").asc()], 0.2)


# Predicted value to segments, their rules and a product for the customers of one country, with the parameters as given.
CHAIN_SQL = f"""WITH v AS ({_value_sql(6)}), r AS (SELECT customer_id, round(clv, 3) AS clv FROM v),
x AS (SELECT customer_id, (clv - (SELECT min(clv) FROM r)) / (SELECT max(clv) - min(clv) FROM r) * 99 + 1 AS clv FROM r),
tiers AS (SELECT customer_id, clv, {bins_sql('clv', 3, ['C', 'B', 'A'], 'x')} AS tier FROM x),
{CLEAN_SQL},
bought AS (SELECT DISTINCT t.tier, s.invoice AS basket, p_type AS item FROM clean s JOIN tiers t USING (customer_id) JOIN part ON CAST(p_partkey AS VARCHAR) = s.stock_code),
nb AS (SELECT tier, count(DISTINCT basket) AS n FROM bought GROUP BY tier),
lists AS (SELECT tier, basket, list(item ORDER BY item) AS items FROM bought GROUP BY tier, basket),
kinds AS (SELECT list(DISTINCT item ORDER BY item) AS all_items FROM bought),
subsets AS (SELECT list_filter(all_items, lambda x, i: (m // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS items FROM kinds, range(1, 64) r(m)),
support AS (SELECT b.tier, s.items, count(*) / any_value(nb.n) AS s FROM subsets s JOIN lists b ON list_has_all(b.items, s.items)
            JOIN nb ON nb.tier = b.tier GROUP BY b.tier, s.items HAVING count(*) >= 0.01 * any_value(nb.n)),
split AS (SELECT u.tier, u.s, a.items AS antecedents, a.s AS sa, list_filter(u.items, lambda x: NOT list_contains(a.items, x)) AS consequents
          FROM support u JOIN support a ON u.tier = a.tier AND list_has_all(u.items, a.items) AND len(a.items) < len(u.items)),
ranked AS (SELECT q.tier, q.consequents, row_number() OVER (PARTITION BY q.tier ORDER BY round(q.s / sa / c.s, 9) DESC, q.s DESC, q.antecedents, q.consequents) AS rn
           FROM split q JOIN support c ON c.tier = q.tier AND c.items = q.consequents),
locals AS (SELECT DISTINCT customer_id FROM clean WHERE country = 'NATION_7')
SELECT t.customer_id, t.clv AS value, t.tier AS segment, CASE WHEN l.customer_id IS NOT NULL THEN coalesce(p.consequents[1], '') ELSE '' END AS recommended_product
FROM tiers t LEFT JOIN locals l USING (customer_id) LEFT JOIN ranked p ON p.tier = t.tier AND rn = 1"""


@query("k21_value_recommendation", "customer_id:long, value:double3, segment:str, recommended_product:str", CHAIN_SQL)
def k21_value(spark, d):
    lines = materialise(_clean(spark, d, ["stock_code", "country"]))
    values = clv.with_forecast(clv.model_input(clv.clv_summary(lines)), BGNBD, GAMMA_GAMMA, (6,))
    part = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("stock_code"), "p_type")
    typed = lines.join(part, "stock_code", "left")
    valued = values.select("customer_id", F.round("clv_6", 3).alias("clv"))
    return basket.recommend_by_value(typed, valued, "NATION_7", item="p_type").withColumnRenamed("clv", "value")
