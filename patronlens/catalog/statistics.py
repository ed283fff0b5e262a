"""Profiles, outliers, bins, encoders and hypothesis tests over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import binning, encoding, impute, outliers, profile
from ..plans import abtest, pricing
from ..sources.retail import RETAIL_SQL, retail_lines, table
from .customers import _levels, bins_sql, LEVELS_SQL
from .registry import query

# --- profiles ------------------------------------------------------------------------------------

ORDERS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "j01_table_profile",
    "column_name:str, data_type:str, n_rows:long, n_null:long, q00:double4, q05:double4, q50:double4, q95:double4, q99:double4, q100:double4",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        + ", ".join(f"{f'quantile_cont({c}, {p})' if t in ('bigint', 'int', 'double') else 'NULL'} AS {n}" for n, p in
                    (("q00", 0), ("q05", 0.05), ("q50", 0.5), ("q95", 0.95), ("q99", 0.99), ("q100", 1)))
        + " FROM part"
        for c, t in (("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double"))
    ),
)
def j01(spark, d):
    return profile.table_profile(table(spark, d, "part"))


@query(
    "j02_missing_table",
    "column_name:str, n_miss:long, ratio:double2",
    f"""WITH {RETAIL_SQL} SELECT 'description' AS column_name, count(*) - count(description) AS n_miss, 100.0 * (count(*) - count(description)) / count(*) AS ratio FROM retail
        UNION ALL SELECT 'customer_id', count(*) - count(customer_id), 100.0 * (count(*) - count(customer_id)) / count(*) FROM retail""",
)
def j02(spark, d):
    return profile.missing_table(retail_lines(spark, d))


@query(
    "j03_column_roles",
    "column_name:str, n_distinct:long, role:str",
    """WITH n AS (SELECT unnest(['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice']) AS column_name,
         unnest([count(DISTINCT p_partkey), count(DISTINCT p_name), count(DISTINCT p_brand), count(DISTINCT p_type), count(DISTINCT p_size), count(DISTINCT p_retailprice)]) AS n_distinct FROM part)
       SELECT *, CASE WHEN column_name IN ('p_partkey', 'p_size', 'p_retailprice') THEN CASE WHEN n_distinct < 10 THEN 'num_but_cat' ELSE 'num' END
                      WHEN n_distinct > 20 THEN 'cat_but_car' ELSE 'cat' END AS role FROM n""",
)
def j03(spark, d):
    return profile.role_table(table(spark, d, "part"))


@query(
    "j04_category_summary",
    "column_name:str, value:str, n:long, ratio:double4",
    """SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS n, 100.0 * count(*) / (SELECT count(*) FROM part) AS ratio FROM part GROUP BY 2
       UNION ALL SELECT 'p_type', p_type, count(*), 100.0 * count(*) / (SELECT count(*) FROM part) FROM part GROUP BY 2""",
)
def j04(spark, d):
    return profile.category_summary(table(spark, d, "part"), ["p_brand", "p_type"])


@query(
    "j05_numeric_summary",
    "column_name:str, n:long, mean:double4, std:double4, q05:double6, q50:double6, q95:double6",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, quantile_cont({c}, 0.05) AS q05, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.95) AS q95 FROM {t}"
        for c, t in (("c_acctbal", "customer"), ("c_nationkey", "customer"))
    ),
)
def j05(spark, d):
    out = profile.describe(table(spark, d, "customer"), ["c_acctbal", "c_nationkey"], [0.05, 0.5, 0.95])
    return out.withColumns({"q05": F.col("q")[0], "q50": F.col("q")[1], "q95": F.col("q")[2]})


@query(
    "j06_target_by_category",
    "column_name:str, value:str, n:long, target_mean:double4",
    """SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS n, avg(p_retailprice) AS target_mean FROM part GROUP BY 2
       UNION ALL SELECT 'p_type', p_type, count(*), avg(p_retailprice) FROM part GROUP BY 2""",
)
def j06(spark, d):
    return profile.target_by_category(table(spark, d, "part"), ["p_brand", "p_type"], "p_retailprice")


@query(
    "j07_rare_report",
    "column_name:str, value:str, n:long, ratio:double6, target_mean:double4",
    """WITH t AS (SELECT 'p_name' AS column_name, p_name AS value, count(*) AS n, avg(p_retailprice) AS target_mean FROM part GROUP BY 2
         UNION ALL SELECT 'p_type', p_type, count(*), avg(p_retailprice) FROM part GROUP BY 2),
       r AS (SELECT *, n / (SELECT count(*) FROM part) AS ratio FROM t)
       SELECT * FROM r WHERE column_name IN (SELECT column_name FROM r WHERE ratio < 0.012)""",
)
def j07(spark, d):
    return profile.rare_report(table(spark, d, "part"), ["p_name", "p_type"], "p_retailprice", 0.012)


@query(
    "j08_target_correlations",
    "column_name:str, r:double8, is_high:bool",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, corr({c}, l_extendedprice) AS r, abs(corr({c}, l_extendedprice)) > 0.6 AS is_high FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def j08(spark, d):
    return profile.target_correlations(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_extendedprice"], "l_extendedprice")


@query(
    "j09_shape_and_types",
    "column_name:str, data_type:str, n_rows:long, n_columns:int",
    """SELECT unnest(['l_orderkey', 'l_quantity', 'l_returnflag', 'l_shipdate']) AS column_name, unnest(['bigint', 'double', 'string', 'timestamp_ntz']) AS data_type,
       count(*) AS n_rows, 4 AS n_columns FROM lineitem""",
)
def j09(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate")
    fields = [(f.name, f.dataType.simpleString()) for f in lines.schema]
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in fields])
    counted = lines.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.lit(len(fields)).alias("n_columns"), F.explode(cells).alias("c")).select("c.*", "n_rows", "n_columns")


# --- bins, scales, encoders, fills, outliers -----------------------------------------------------


@query(
    "i01_age_bands",
    "age:int, age_cat:str, n:long",
    f"WITH {LEVELS_SQL} SELECT age, age_cat, count(*) AS n FROM named GROUP BY 1, 2",
)
def i01(spark, d):
    return _levels(spark, d).groupBy("age", "age_cat").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i02_quantile_bins",
    "o_orderkey:long, third:str, quarter:str",
    f"""SELECT o_orderkey, {bins_sql('o_totalprice', 3, ['small', 'normal', 'big'], 'orders')} AS third,
        {bins_sql('o_totalprice', 4, ['D', 'C', 'B', 'A'], 'orders')} AS quarter FROM orders""",
)
def i02(spark, d):
    return binning.qcut(
        table(spark, d, "orders"),
        {"third": ("o_totalprice", ["small", "normal", "big"]), "quarter": ("o_totalprice", ["D", "C", "B", "A"])},
    )


@query(
    "i03_reversed_labels",
    "c_custkey:long, score:int, reversed:int",
    f"SELECT c_custkey, {bins_sql('c_acctbal', 5, [1, 2, 3, 4, 5], 'customer')} AS score, {bins_sql('c_acctbal', 5, [5, 4, 3, 2, 1], 'customer')} AS reversed FROM customer",
)
def i03(spark, d):
    return binning.qcut(table(spark, d, "customer"), {"score": ("c_acctbal", [1, 2, 3, 4, 5]), "reversed": ("c_acctbal", [5, 4, 3, 2, 1])})


@query(
    "i04_scale_1_to_100",
    "o_orderkey:long, scaled:double6",
    "SELECT o_orderkey, 1 + 99 * (o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders) AS scaled FROM orders",
)
def i04(spark, d):
    return binning.minmax(table(spark, d, "orders"), {"scaled": "o_totalprice"}, 1.0, 100.0)


@query(
    "i05_scale_0_to_1",
    "p_partkey:long, p_size:double8, p_retailprice:double8, constant:double8",
    """SELECT p_partkey, (p_size - (SELECT min(p_size) FROM part)) / (SELECT max(p_size) - min(p_size) FROM part) AS p_size,
       (p_retailprice - (SELECT min(p_retailprice) FROM part)) / (SELECT max(p_retailprice) - min(p_retailprice) FROM part) AS p_retailprice, 0 AS constant FROM part""",
)
def i05(spark, d):
    part = table(spark, d, "part").withColumn("constant", F.lit(7))
    return binning.minmax(part, {c: c for c in ("p_size", "p_retailprice", "constant")})


@query(
    "i06_standard_scale",
    "c_custkey:long, z:double8",
    "SELECT c_custkey, (c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer) AS z FROM customer",
)
def i06(spark, d):
    return binning.standardise(table(spark, d, "customer"), {"z": "c_acctbal"})


@query(
    "i07_label_encode",
    "p_partkey:long, p_type:int, p_brand:int",
    """SELECT p_partkey, (SELECT count(DISTINCT p_type) FROM part b WHERE b.p_type < a.p_type) AS p_type,
       (SELECT count(DISTINCT p_brand) FROM part b WHERE b.p_brand < a.p_brand) AS p_brand FROM part a""",
)
def i07(spark, d):
    return encoding.label_encode(table(spark, d, "part"), ["p_type", "p_brand"])


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "i08_one_hot",
    "p_partkey:long, " + ", ".join(f"p_type_{t}:int" for t in TYPES),
    "SELECT p_partkey, " + ", ".join(f"CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS p_type_{t}" for t in TYPES) + " FROM part",
)
def i08(spark, d):
    return encoding.one_hot(table(spark, d, "part"), ["p_type"])


@query(
    "i09_rare_encode",
    "p_partkey:long, p_name:str",
    """WITH f AS (SELECT p_name, count(*) AS n FROM part WHERE p_name <> 'red ring' GROUP BY 1)
       SELECT p_partkey, CASE WHEN p_name = 'red ring' THEN NULL WHEN n / (SELECT count(*) FROM part) < 0.015 THEN 'Rare' ELSE p_name END AS p_name
       FROM part LEFT JOIN f USING (p_name)""",
)
def i09(spark, d):
    part = table(spark, d, "part").withColumn("p_name", F.when(F.col("p_name") != "red ring", F.col("p_name")))
    return encoding.rare_encode(part, ["p_name"], 0.015)


def _limits_sql(c: str, source: str, low: float = 0.01, high: float = 0.99) -> str:
    lo, hi = f"quantile_cont({c}, {low})", f"quantile_cont({c}, {high})"
    return f"SELECT '{c}' AS column_name, {lo} - 1.5 * ({hi} - {lo}) AS low_limit, {hi} + 1.5 * ({hi} - {lo}) AS up_limit FROM {source}"


@query(
    "i10_outlier_limits",
    "column_name:str, low_limit:double6, up_limit:double6",
    f"{_limits_sql('l_quantity', 'lineitem')} UNION ALL {_limits_sql('l_extendedprice', 'lineitem')}",
)
def i10(spark, d):
    return outliers.outlier_limits(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])


@query(
    "i11_capped_values",
    "event_id:long, value:double6",
    f"WITH l AS ({_limits_sql('value', 'events', 0.25, 0.75)}) SELECT event_id, CASE WHEN value > up_limit THEN up_limit ELSE value END AS value FROM events, l",
)
def i11(spark, d):
    return outliers.cap_upper(table(spark, d, "events"), ["value"], 0.25, 0.75)


@query(
    "i12_has_outlier",
    "column_name:str, has_outlier:bool",
    f"""WITH a AS ({_limits_sql('l_quantity', 'lineitem')}), p AS (SELECT l_extendedprice / l_quantity AS price FROM lineitem), b AS ({_limits_sql('price', 'p')})
        SELECT a.column_name, (SELECT bool_or(l_quantity < a.low_limit OR l_quantity > a.up_limit) FROM lineitem) AS has_outlier FROM a
        UNION ALL SELECT b.column_name, (SELECT bool_or(price < b.low_limit OR price > b.up_limit) FROM p) FROM b""",
)
def i12(spark, d):
    lines = table(spark, d, "lineitem").select("l_quantity", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return outliers.has_outlier(lines, ["l_quantity", "price"])


@query(
    "i13_outlier_rows",
    "event_id:long, event_type:str, value:double2",
    f"WITH l AS ({_limits_sql('value', 'events', 0.25, 0.75)}) SELECT event_id, event_type, value FROM events, l WHERE value < low_limit OR value > up_limit",
)
def i13(spark, d):
    return outliers.outlier_rows(table(spark, d, "events"), "value", 0.25, 0.75)


_HOLES = "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg FROM customer"


def _holes(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"),
    )


@query(
    "i14_fill_mean_and_median",
    "c_custkey:long, mean_filled:double4, bal:double4",
    f"WITH h AS ({_HOLES}) SELECT c_custkey, coalesce(bal, (SELECT avg(bal) FROM h)) AS mean_filled, coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM h)) AS bal FROM h",
)
def i14(spark, d):
    holes = _holes(spark, d).withColumn("mean_filled", F.col("bal"))
    return impute.fill_median(impute.fill_mean(holes, ["mean_filled"]), ["bal"])


@query(
    "i15_fill_mode",
    "c_custkey:long, seg:str",
    f"WITH h AS ({_HOLES}) SELECT c_custkey, coalesce(seg, (SELECT seg FROM h WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1)) AS seg FROM h",
)
def i15(spark, d):
    return impute.fill_mode(_holes(spark, d), ["seg"])


# --- hypothesis tests: group = parity of the user, metric = value --------------------------------

_EV = "SELECT CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'test' END AS grp, event_type, value FROM events"


def groups(spark, d):
    grp = F.when(F.col("user_id") % 2 == 0, "control").otherwise("test")
    return table(spark, d, "events").select(grp.alias("grp"), "event_type", "value")


# p of Student's t for large samples: incomplete-beta series in t^2 / (df + t^2); p of the normal by its series.
def _t_p_sql(t: str, df: str) -> str:
    x = f"({t} * {t} / ({df} + {t} * {t}))"
    series = (
        f"list_sum(list_transform(range(0, 400), lambda k: exp(lgamma(0.5 + {df} / 2 + k) + lgamma(1.5) "
        f"- lgamma(0.5 + {df} / 2) - lgamma(1.5 + k) + k * ln({x}))))"
    )
    front = f"exp(lgamma(0.5 + {df} / 2) - lgamma(0.5) - lgamma({df} / 2) + 0.5 * ln({x}) + {df} / 2 * ln(1 - {x})) / 0.5"
    return f"(1 - {front} * {series})"


def _normal_upper_sql(z: str) -> str:
    series = (
        f"list_sum(list_transform(range(0, 200), lambda k: exp((2 * k + 1) * ln({z}) - k * ln(2) - ln(sqrt(2)) "
        f"- lgamma(k + 1.5) + ln(sqrt(pi())) - ln(2) + ln(sqrt(2)))))"
    )
    return f"CASE WHEN {z} = 0 THEN 0.5 ELSE 0.5 - exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {series} END"


# 0.975 quantile of Student's t by its expansion around the normal quantile, exact to 1e-9 above 500 degrees of freedom
_Z = "1.959963984540054"
_T_SQL = (
    f"({_Z} + (pow({_Z}, 3) + {_Z}) / (4 * (n - 1)) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96 * pow(n - 1, 2))"
    f" + (3 * pow({_Z}, 7) + 19 * pow({_Z}, 5) + 17 * pow({_Z}, 3) - 15 * {_Z}) / (384 * pow(n - 1, 3)))"
)


def _interval_sql(by: str, source: str) -> str:
    return f"""WITH s AS (SELECT {by}, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std FROM {source} GROUP BY 1)
        SELECT *, mean - {_T_SQL} * std / sqrt(n) AS low, mean + {_T_SQL} * std / sqrt(n) AS high FROM s"""


@query("l01_mean_intervals", "grp:str, n:long, mean:double4, std:double4, low:double4, high:double4", _interval_sql("grp", f"({_EV})"))
def l01(spark, d):
    return abtest.mean_intervals(groups(spark, d), "grp", "value")


@query("l02_normality_shapiro", "event_type:str, statistic:double6, p_value:double6, method:str")
def l02(spark, d):
    return abtest.shapiro_normality(table(spark, d, "events"), "event_type", "value")


@query(
    "l02_normality_moments",
    "event_type:str, n:long, skew:double6, excess:double6, statistic:double3, p_value:double6",
    """WITH c AS (SELECT event_type, value - avg(value) OVER (PARTITION BY event_type) AS z FROM events),
       m AS (SELECT event_type, count(*) AS n, avg(z * z) AS m2, avg(z * z * z) AS m3, avg(z * z * z * z) AS m4 FROM c GROUP BY 1),
       s AS (SELECT event_type, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) - 3 AS excess FROM m)
       SELECT *, n / 6.0 * (skew * skew + excess * excess / 4) AS statistic, exp(-n / 12.0 * (skew * skew + excess * excess / 4)) AS p_value FROM s""",
)
def l02_moments(spark, d):
    return abtest.moment_normality(table(spark, d, "events"), "event_type", "value")


@query(
    "l03_levene",
    "groups:long, n:long, statistic:double6, p_value:double6",
    f"""WITH e AS ({_EV}), m AS (SELECT grp, quantile_cont(value, 0.5) AS med FROM e GROUP BY 1), z AS (SELECT grp, abs(value - med) AS z FROM e JOIN m USING (grp)),
        g AS (SELECT grp, count(*) AS n, avg(z) AS zm, var_pop(z) AS zv FROM z GROUP BY 1), t AS (SELECT count(*) AS groups, sum(n) AS n, sum(n * zm) / sum(n) AS gm FROM g),
        f AS (SELECT groups, t.n, (t.n - groups) / (groups - 1) * (SELECT sum(g.n * (zm - gm) * (zm - gm)) / sum(g.n * zv) FROM g) AS statistic, sqrt((t.n - 2) * (SELECT sum(g.n * (zm - gm) * (zm - gm)) / sum(g.n * zv) FROM g)) AS root FROM t)
        SELECT groups, n, statistic, {_t_p_sql('root', '(n - 2)')} AS p_value FROM f""",
)
def l03(spark, d):
    return abtest.levene(groups(spark, d), "grp", "value")


@query(
    "l04_t_test",
    "n1:long, n2:long, mean1:double4, mean2:double4, statistic:double6, p_value:double6",
    f"""WITH e AS ({_EV}), a AS (SELECT count(*) AS n1, avg(value) AS mean1, var_samp(value) AS v1 FROM e WHERE grp = 'control'),
        b AS (SELECT count(*) AS n2, avg(value) AS mean2, var_samp(value) AS v2 FROM e WHERE grp = 'test'),
        s AS (SELECT n1, n2, mean1, mean2, (mean1 - mean2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS statistic FROM a, b)
        SELECT *, {_t_p_sql('statistic', '(n1 + n2 - 2)')} AS p_value FROM s""",
)
def l04(spark, d):
    return abtest.t_test(groups(spark, d), "grp", "value", "control", "test")


def _mw_sql(source: str, group: str, a: str, b: str) -> str:
    return f"""
      r AS (SELECT {group} AS g, value, (rank() OVER (PARTITION BY pair ORDER BY value)) + (count(*) OVER (PARTITION BY pair, value) - 1) / 2.0 AS avg_rank,
                   count(*) OVER (PARTITION BY pair, value) AS t, pair, first, second FROM {source}),
      s AS (SELECT pair, first, second, count(*) FILTER (WHERE g = first) AS n1, count(*) FILTER (WHERE g = second) AS n2,
                   sum(avg_rank) FILTER (WHERE g = first) AS r1, sum(t * t - 1.0) AS ties FROM r GROUP BY ALL),
      u AS (SELECT first, second, n1, n2, least(r1 - n1 * (n1 + 1) / 2.0, n1 * n2 - r1 + n1 * (n1 + 1) / 2.0) AS statistic,
                   sqrt(n1 * n2 / 12.0 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1.0)))) AS sd FROM s),
      w AS (SELECT *, greatest((n1 * n2 / 2.0 - statistic - 0.5) / sd, 0) AS z FROM u)"""


@query(
    "l05_mann_whitney",
    "n1:long, n2:long, statistic:double1, z:double6, p_one_sided:double6, p_two_sided:double6",
    f"""WITH e AS ({_EV}), pairs AS (SELECT 1 AS pair, 'control' AS first, 'test' AS second, grp, value FROM e), {_mw_sql('pairs', 'grp', 'control', 'test')},
        p AS (SELECT *, {_normal_upper_sql('z')} AS p_one_sided FROM w) SELECT *, least(2 * p_one_sided, 1) AS p_two_sided FROM p""",
)
def l05(spark, d):
    return abtest.mann_whitney(groups(spark, d), "grp", "value", "control", "test")


_PAIRS = """k AS (SELECT DISTINCT event_type FROM events),
 pr AS (SELECT a.event_type AS first, b.event_type AS second, a.event_type || '/' || b.event_type AS pair FROM k a JOIN k b ON a.event_type < b.event_type),
 pairs AS (SELECT pair, first, second, event_type, value FROM pr JOIN events ON event_type = first OR event_type = second)"""
_PAIR_P = f"""{_PAIRS}, {_mw_sql('pairs', 'event_type', '', '')},
 p AS (SELECT *, {_normal_upper_sql('z')} AS p_one_sided FROM w)"""


@query(
    "l06_pairwise_mann_whitney",
    "first:str, second:str, n1:long, n2:long, statistic:double1, p_one_sided:double6, rejected:bool",
    f"WITH {_PAIR_P} SELECT *, p_one_sided < 0.05 AS rejected FROM p",
)
def l06(spark, d):
    return abtest.pairwise_mann_whitney(table(spark, d, "events"), "event_type", "value")


@query("l07_chosen_test", "test:str, normality_p:double6, variance_p:double6, statistic:double4, p_value:double6, rejected:bool")
def l07(spark, d):
    return abtest.choose_test(groups(spark, d), "grp", "value", "control", "test")


@query(
    "k22_conversion_rate",
    "user_id:long, clicks:long, purchases:long, conversion_rate:double6",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       100.0 * count(*) FILTER (WHERE event_type = 'purchase') / nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS conversion_rate FROM events GROUP BY 1""",
)
def k22(spark, d):
    counts = table(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    return abtest.conversion_rate(counts, "purchases", "clicks")


@query(
    "k23_fixed_price",
    "n_categories:long, fixed_price:double6",
    f"""WITH {_PAIR_P}, alike AS (SELECT first AS event_type FROM p WHERE p_one_sided >= 0.05 UNION SELECT second FROM p WHERE p_one_sided >= 0.05),
        med AS (SELECT event_type, quantile_cont(value, 0.5) AS m FROM events SEMI JOIN alike USING (event_type) GROUP BY 1)
        SELECT count(*) AS n_categories, avg(m) AS fixed_price FROM med""",
)
def k23(spark, d):
    return pricing.fixed_price(table(spark, d, "events"), "event_type", "value")


@query("k24_price_bands", "event_type:str, n:long, mean:double4, low:double4, high:double4", _interval_sql("event_type", "events"))
def k24(spark, d):
    return pricing.price_bands(table(spark, d, "events"), "event_type", "value")


CANDIDATES = [5.0, 10.0, 25.0, 50.0, 100.0, 200.0]


@query(
    "k25_price_scenarios",
    "event_type:str, candidate:double2, buyers:long, income:double2",
    f"""SELECT event_type, p AS candidate, count(*) FILTER (WHERE value >= p) AS buyers, p * count(*) FILTER (WHERE value >= p) AS income
        FROM events, unnest({CANDIDATES}) c(p) GROUP BY 1, 2""",
)
def k25(spark, d):
    return pricing.price_scenarios(table(spark, d, "events"), "event_type", "value", CANDIDATES)


@query(
    "k25_price_table",
    "event_type:str, candidate:double2, buyers:long, income:double2",
    """WITH c AS (SELECT DISTINCT event_type, floor(value) AS p FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL),
       s AS (SELECT event_type, floor(value) AS p, count(*) AS n FROM events GROUP BY ALL)
       SELECT c.event_type, c.p AS candidate, sum(s.n) AS buyers, c.p * sum(s.n) AS income
       FROM c JOIN s ON s.event_type = c.event_type AND s.p >= c.p GROUP BY 1, 2""",
)
def k25_table(spark, d):
    events = table(spark, d, "events")
    whole = events.select("event_type", F.floor("value").cast("double").alias("candidate"))
    return pricing.price_table_scenarios(events, "event_type", "value", whole)
