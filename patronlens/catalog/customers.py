"""Customer-analytics queries: cleaning, RFM, lifetime value, cohorts, personas, baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import basket, cltv, cohort, persona, rfm
from ..sources.retail import RETAIL_SQL, retail_lines, table
from .registry import query

RFM_COLUMNS = ["invoice", "description", "quantity", "invoice_date", "price", "customer_id"]

SALES_SQL = f"""{RETAIL_SQL},
sales AS (
  SELECT *, quantity * price AS total_price FROM retail
  WHERE NOT contains(invoice, 'C') AND description IS NOT NULL AND customer_id IS NOT NULL)"""

CLEAN_SQL = f"""{RETAIL_SQL},
kept AS (
  SELECT * FROM retail
  WHERE NOT contains(invoice, 'C') AND description IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0),
lim AS (
  SELECT quantile_cont(quantity, 0.99) + 1.5 * (quantile_cont(quantity, 0.99) - quantile_cont(quantity, 0.01)) AS qup,
         quantile_cont(price, 0.99) + 1.5 * (quantile_cont(price, 0.99) - quantile_cont(price, 0.01)) AS pup FROM kept),
clean AS (
  SELECT k.* REPLACE (CASE WHEN quantity > qup THEN qup ELSE quantity END AS quantity,
                      CASE WHEN price > pup THEN pup ELSE price END AS price),
         (CASE WHEN quantity > qup THEN qup ELSE quantity END) * (CASE WHEN price > pup THEN pup ELSE price END) AS total_price
  FROM kept k, lim)"""

TODAY_SQL = "date_trunc('day', max({c})) + INTERVAL 2 DAY"

METRICS_SQL = f"""{SALES_SQL},
base AS (SELECT customer_id, max(invoice_date) AS last_purchase, count(*) AS frequency, sum(total_price) AS monetary
         FROM sales GROUP BY customer_id),
metrics AS (
  SELECT customer_id,
         CAST(floor((epoch((SELECT {TODAY_SQL.format(c='last_purchase')} FROM base)) - epoch(last_purchase)) / 86400) AS BIGINT) AS recency,
         frequency, monetary
  FROM base WHERE monetary > 0 AND frequency > 0)"""


def bins_sql(column: str, k: int, labels: list, source: str) -> str:
    """CASE over interpolated quantiles, right-closed."""
    quote = [str(v) if isinstance(v, int) else f"'{v}'" for v in labels]
    whens = " ".join(
        f"WHEN {column} <= (SELECT quantile_cont({column}, {(i + 1) / k!r}) FROM {source}) THEN {quote[i]}" for i in range(k - 1)
    )
    return f"CASE WHEN {column} IS NULL THEN NULL {whens} ELSE {quote[-1]} END"


SCORES_SQL = f"""{METRICS_SQL},
scored AS (
  SELECT *, {bins_sql('recency', 5, [5, 4, 3, 2, 1], 'metrics')} AS recency_score,
         {bins_sql('frequency', 5, [1, 2, 3, 4, 5], 'metrics')} AS frequency_score,
         {bins_sql('monetary', 5, [1, 2, 3, 4, 5], 'metrics')} AS monetary_score
  FROM metrics)"""

_R, _F = "recency_score", "frequency_score"
SEGMENTS_SQL = f"""{SCORES_SQL},
segments AS (
  SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR) AS rfm_score,
    CASE WHEN {_R} <= 2 AND {_F} <= 2 THEN 'Hibernating' WHEN {_R} <= 2 AND {_F} <= 4 THEN 'At_Risk'
         WHEN {_R} <= 2 THEN 'Cant_Loose' WHEN {_R} = 3 AND {_F} <= 2 THEN 'About_to_Sleep'
         WHEN {_R} = 3 AND {_F} = 3 THEN 'Need_Attention' WHEN {_R} IN (3, 4) AND {_F} >= 4 THEN 'Loyal_Customers'
         WHEN {_R} = 4 AND {_F} = 1 THEN 'Promising' WHEN {_R} = 5 AND {_F} = 1 THEN 'New_Customers'
         WHEN {_F} IN (2, 3) THEN 'Potential_Loyalists' ELSE 'Champions' END AS segment
  FROM scored)"""


def _sales(spark, d, extra=()):
    return rfm.sales_lines(retail_lines(spark, d, [*RFM_COLUMNS, *extra]))


def _clean(spark, d, extra=()):
    return rfm.clean_retail(retail_lines(spark, d, [*RFM_COLUMNS, *extra]))


@query(
    "k01_retail_clean",
    "invoice:str, stock_code:str, quantity:double, price:double8, total_price:double2, customer_id:long, country:str",
    f"WITH {CLEAN_SQL} SELECT * FROM clean",
)
def k01(spark, d):
    return rfm.clean_retail(retail_lines(spark, d))


@query("k02_rfm_metrics", "customer_id:long, recency:long, frequency:long, monetary:double2", f"WITH {METRICS_SQL} SELECT * FROM metrics")
def k02(spark, d):
    return rfm.rfm_metrics(_sales(spark, d))


@query(
    "k03_rfm_scores",
    "customer_id:long, recency_score:int, frequency_score:int, monetary_score:int, rfm_score:str",
    f"WITH {SEGMENTS_SQL} SELECT * FROM segments",
)
def k03(spark, d):
    return rfm.rfm_scores(rfm.rfm_metrics(_sales(spark, d)))


@query("k04_rfm_segments", "customer_id:long, rfm_score:str, segment:str", f"WITH {SEGMENTS_SQL} SELECT * FROM segments")
def k04(spark, d):
    return rfm.rfm_table(_sales(spark, d).drop("total_price"))


@query(
    "k05_rfm_segment_profile",
    "segment:str, recency_mean:double, recency_count:long, frequency_mean:double, frequency_count:long, monetary_mean:double6, monetary_count:long",
    f"""WITH {SEGMENTS_SQL} SELECT segment, avg(recency) AS recency_mean, count(recency) AS recency_count,
        avg(frequency) AS frequency_mean, count(frequency) AS frequency_count, avg(monetary) AS monetary_mean,
        count(monetary) AS monetary_count FROM segments GROUP BY segment""",
)
def k05(spark, d):
    return rfm.segment_profile(rfm.rfm_table(retail_lines(spark, d, RFM_COLUMNS)), "segment", ["recency", "frequency", "monetary"])


@query(
    "k06_segment_export",
    "segment:str, customer_id:long",
    f"WITH {SEGMENTS_SQL} SELECT segment, customer_id FROM segments",
)
def k06(spark, d):
    from ..sources.sinks import write_table
    from .tables import _path

    path = _path(spark, "segments")
    segments = rfm.rfm_table(retail_lines(spark, d, RFM_COLUMNS)).select("segment", "customer_id")
    write_table(segments, path, ["segment"])  # a folder of keys for each segment
    return spark.read.schema("customer_id long, segment string").parquet(path)


@query(
    "k07_best_sellers",
    "description:str, units:double2",
    f"""WITH {RETAIL_SQL} SELECT description, sum(quantity) AS units FROM retail WHERE description IS NOT NULL
        GROUP BY description ORDER BY units DESC, description LIMIT 5""",
)
def k07(spark, d):
    return cltv.best_sellers(retail_lines(spark, d, ["description", "quantity"]), 5)


@query(
    "k07_revenue_by_country",
    "country:str, revenue:double2",
    f"""WITH {RETAIL_SQL} SELECT country, sum(quantity * price) AS revenue FROM retail
        WHERE NOT contains(invoice, 'C') GROUP BY country""",
)
def k07_country(spark, d):
    lines = rfm.drop_cancelled(retail_lines(spark, d, ["invoice", "quantity", "price", "country"]))
    return cltv.revenue_by_country(rfm.with_total_price(lines))


CLTV_SQL = f"""{SALES_SQL},
per_customer AS (SELECT customer_id, count(DISTINCT invoice) AS total_transaction, sum(quantity) AS total_unit, sum(total_price) AS total_price
                 FROM sales WHERE quantity > 0 GROUP BY customer_id),
shares AS (SELECT count(*) AS n, 1 - count(*) FILTER (WHERE total_transaction > 1) / count(*) AS churn FROM per_customer),
formula AS (
  SELECT p.*, total_price / total_transaction AS avg_order_value, total_transaction / n AS purchase_frequency,
         total_price * 0.05 AS profit_margin,
         (total_price / total_transaction) * (total_transaction / n) / nullif(churn, 0) AS cv,
         (total_price / total_transaction) * (total_transaction / n) / nullif(churn, 0) * total_price * 0.05 AS cltv
  FROM per_customer p, shares)"""


def _formula(spark, d, transactions="invoices"):
    return cltv.cltv_formula(cltv.cltv_lines(retail_lines(spark, d, RFM_COLUMNS)), transactions)


@query(
    "k08_cltv_formula",
    "customer_id:long, total_transaction:long, total_unit:double2, total_price:double2, avg_order_value:double7, "
    "purchase_frequency:double8, profit_margin:double, cv:double, cltv:double-3",
    f"WITH {CLTV_SQL} SELECT * FROM formula",
)
def k08(spark, d):
    return _formula(spark, d)


@query(
    "k08_cltv_line_counts",
    "customer_id:long, total_transaction:long, avg_order_value:double7, purchase_frequency:double8, cltv:double-3",
    f"""WITH {SALES_SQL}, p AS (SELECT customer_id, count(*) AS total_transaction, sum(total_price) AS total_price
          FROM sales WHERE quantity > 0 GROUP BY customer_id),
        s AS (SELECT count(*) AS n, 1 - count(*) FILTER (WHERE total_transaction > 1) / count(*) AS churn FROM p)
        SELECT customer_id, total_transaction, total_price / total_transaction AS avg_order_value,
               total_transaction / n AS purchase_frequency, total_price / n / nullif(churn, 0) * total_price * 0.05 AS cltv FROM p, s""",
)
def k08_lines(spark, d):
    return _formula(spark, d, "lines")


SCALED_SQL = f"""{CLTV_SQL},
scaled AS (SELECT *, 1 + 99 * (cltv - (SELECT min(cltv) FROM formula)) / ((SELECT max(cltv) FROM formula) - (SELECT min(cltv) FROM formula)) AS scaled_cltv FROM formula),
binned AS (SELECT *, {bins_sql('scaled_cltv', 4, ['D', 'C', 'B', 'A'], 'scaled')} AS segment FROM scaled)"""


@query("k09_cltv_segments", "customer_id:long, scaled_cltv:double6, segment:str", f"WITH {SCALED_SQL} SELECT * FROM binned")
def k09(spark, d):
    return cltv.cltv_segments(_formula(spark, d))


@query(
    "k09_cltv_segment_summary",
    "segment:str, total_transaction_mean:double, total_unit_sum:double2, total_price_sum:double2, total_price_count:long, "
    "cltv_mean:double-3, scaled_cltv_mean:double6",
    f"""WITH {SCALED_SQL} SELECT segment, avg(total_transaction) AS total_transaction_mean, sum(total_unit) AS total_unit_sum,
        sum(total_price) AS total_price_sum, count(total_price) AS total_price_count, avg(cltv) AS cltv_mean,
        avg(scaled_cltv) AS scaled_cltv_mean FROM binned GROUP BY segment""",
)
def k09_summary(spark, d):
    return cltv.cltv_segment_summary(cltv.cltv_segments(_formula(spark, d)))


@query(
    "k10_repeat_rate",
    "n_customers:long, repeat_rate:double8, churn_rate:double8",
    f"""WITH {RETAIL_SQL}, o AS (SELECT customer_id, count(DISTINCT invoice) AS n FROM retail WHERE customer_id IS NOT NULL GROUP BY 1)
        SELECT count(*) AS n_customers, avg(CASE WHEN n > 1 THEN 1.0 ELSE 0 END) AS repeat_rate,
               1 - avg(CASE WHEN n > 1 THEN 1.0 ELSE 0 END) AS churn_rate FROM o""",
)
def k10(spark, d):
    return cltv.repeat_rate(retail_lines(spark, d, ["invoice", "customer_id"]))


COHORT_SQL = f"""{RETAIL_SQL},
months AS (SELECT DISTINCT customer_id, date_trunc('month', invoice_date) AS order_month FROM retail WHERE customer_id IS NOT NULL),
firsts AS (SELECT customer_id, min(order_month) AS cohort FROM months GROUP BY customer_id),
cohorts AS (
  SELECT cohort, order_month, count(DISTINCT customer_id) AS n_customers,
         (year(order_month) - year(cohort)) * 12 + month(order_month) - month(cohort) AS period_number
  FROM months JOIN firsts USING (customer_id) GROUP BY cohort, order_month)"""


def _cohorts(spark, d):
    return cohort.cohort_table(retail_lines(spark, d, ["customer_id", "invoice_date"]))


@query("k11_cohort_table", "cohort:date, order_month:date, n_customers:long, period_number:int", f"WITH {COHORT_SQL} SELECT * FROM cohorts")
def k11(spark, d):
    return _cohorts(spark, d)


@query(
    "k12_retention_matrix",
    "cohort:date, period_number:int, n_customers:long, retention:double6",
    f"""WITH {COHORT_SQL} SELECT c.*, c.n_customers / b.n_customers AS retention FROM cohorts c
        JOIN (SELECT cohort, n_customers FROM cohorts WHERE period_number = 0) b USING (cohort)""",
)
def k12(spark, d):
    return cohort.retention(_cohorts(spark, d))


# Personas: a user's device is the market segment, gender and age follow from name and balance.
_USERS_SQL = """
users AS (SELECT c_custkey AS uid, c_mktsegment AS device, n_name AS country,
                 CASE WHEN right(c_name, 1) IN ('0', '2', '4', '6', '8') THEN 'F' ELSE 'M' END AS gender,
                 CAST(15 + floor((c_acctbal + 1000) / 180) AS INTEGER) AS age
          FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
LEVELS_SQL = f"""{_USERS_SQL},
levels AS (SELECT country, device, gender, age, sum(o_totalprice) AS price FROM orders JOIN users ON o_custkey = uid GROUP BY ALL),
banded AS (
  SELECT *, CASE WHEN age <= 0 THEN NULL WHEN age <= 19 THEN '0_18' WHEN age <= 24 THEN '19_23' WHEN age <= 31 THEN '24_30'
                 WHEN age <= 41 THEN '31_40' ELSE '41_' || (SELECT max(age) FROM levels) END AS age_cat FROM levels),
named AS (SELECT *, country || '_' || upper(device) || '_' || gender || '_' || age_cat AS customers_level_based FROM banded)"""


def users(spark, d):
    home = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return home.select(
        F.col("c_custkey").alias("uid"),
        F.col("c_mktsegment").alias("device"),
        F.col("n_name").alias("country"),
        F.when(F.right("c_name", F.lit(1)).isin("0", "2", "4", "6", "8"), "F").otherwise("M").alias("gender"),
        (15 + F.floor((F.col("c_acctbal") + 1000) / 180)).cast("int").alias("age"),
    )


def purchases(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("uid"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("date")
    )


def _levels(spark, d):
    return persona.persona_revenue(users(spark, d), purchases(spark, d))


@query(
    "k13_persona_revenue",
    "country:str, device:str, gender:str, age:int, price:double2, age_cat:str, customers_level_based:str",
    f"WITH {LEVELS_SQL} SELECT * FROM named",
)
def k13(spark, d):
    return _levels(spark, d)


@query(
    "k14_persona_segments",
    "customers_level_based:str, age:int, price:double2, segment:str",
    f"WITH {LEVELS_SQL} SELECT *, {bins_sql('price', 4, ['D', 'C', 'B', 'A'], 'named')} AS segment FROM named",
)
def k14(spark, d):
    return persona.persona_segments(_levels(spark, d))


@query(
    "k14_persona_totals",
    "customers_level_based:str, price:double2, segment:str",
    f"""WITH {LEVELS_SQL}, rolled AS (SELECT customers_level_based, sum(price) AS price FROM named GROUP BY 1)
        SELECT *, {bins_sql('price', 4, ['D', 'C', 'B', 'A'], 'rolled')} AS segment FROM rolled""",
)
def k14_totals(spark, d):
    return persona.persona_totals(_levels(spark, d))


@query(
    "k14_new_user_lookup",
    "customers_level_based:str, age:int, segment:str",
    f"""WITH {LEVELS_SQL}, s AS (SELECT *, {bins_sql('price', 4, ['D', 'C', 'B', 'A'], 'named')} AS segment FROM named)
        SELECT * FROM s WHERE customers_level_based = 'NATION_3_BUILDING_F_41_' || (SELECT max(age) FROM levels)""",
)
def k14_lookup(spark, d):
    segmented = persona.persona_segments(_levels(spark, d))
    oldest = segmented.agg(F.max("age").alias("_oldest"))
    wanted = F.concat(F.lit("NATION_3_BUILDING_F_41_"), F.col("_oldest").cast("string"))
    return segmented.crossJoin(F.broadcast(oldest)).where(F.col("customers_level_based") == wanted)


@query(
    "k20_segment_lines",
    "invoice:str, customer_id:long, segment:str, total_price:double2",
    f"""WITH {SEGMENTS_SQL} SELECT s.invoice, s.customer_id, g.segment, s.total_price FROM sales s JOIN segments g USING (customer_id)""",
)
def k20(spark, d):
    lines = _sales(spark, d)
    segments = rfm.rfm_table(lines.drop("total_price")).select("customer_id", "segment")
    return lines.join(segments, "customer_id")


# --- baskets and rules: item = brand of the part -------------------------------------------------

BASKET_SQL = """
net AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey AS basket, {item} AS item,
               sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS net
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag <> 'R' GROUP BY 1, 2),
held AS (SELECT basket, item FROM net WHERE net > 0),
n AS (SELECT count(DISTINCT basket) AS n FROM net)"""
BRAND_SQL = BASKET_SQL.format(item="p_brand")


def basket_lines(spark, d, item="p_brand"):
    lines = table(spark, d, "lineitem").where(F.col("l_returnflag") != "R")
    return lines.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("invoice"), F.col(item).alias("item"), F.col("l_quantity").alias("quantity")
    )


def _items(spark, d, item="p_brand"):
    return basket.basket_items(basket_lines(spark, d, item), "item")


@query("g04_basket_sets", "basket:str, items:str", f"WITH {BRAND_SQL} SELECT basket, string_agg(item, '|' ORDER BY item) AS items FROM held GROUP BY basket")
def g04(spark, d):
    return basket.basket_sets(_items(spark, d)).withColumn("items", F.array_join("items", "|"))


@query("d18_item_support", "item:str, n_baskets:long", f"WITH {BRAND_SQL} SELECT item, count(*) AS n_baskets FROM held GROUP BY item")
def d18(spark, d):
    return basket.item_support(_items(spark, d))


@query("d18_basket_sizes", "basket:str, n_items:long", f"WITH {BRAND_SQL} SELECT basket, count(*) FILTER (WHERE net > 0) AS n_items FROM net GROUP BY basket")
def d18_sizes(spark, d):
    return basket.basket_sizes(_items(spark, d))


_TYPES = ["PROMO", "SMALL", "LARGE", "STANDARD", "ECONOMY", "MEDIUM"]


@query(
    "g03_basket_matrix",
    "basket:str, " + ", ".join(f"{t}:int" for t in _TYPES),
    f"""WITH {BASKET_SQL.format(item='p_type')} SELECT basket, {', '.join(
        f"max(CASE WHEN item = '{t}' AND net > 0 THEN 1 ELSE 0 END) AS {t}" for t in _TYPES)}
        FROM net GROUP BY basket""",
)
def g03(spark, d):
    return basket.basket_matrix(_items(spark, d, "p_type"), _TYPES)


@query(
    "g03_basket_cells",
    "basket:str, cells:str",
    f"""WITH {BASKET_SQL.format(item='p_brand')} SELECT basket, string_agg(item || '=' || CASE WHEN net > 0 THEN 1 ELSE 0 END, '|' ORDER BY item) AS cells
        FROM net GROUP BY basket""",
)
def g03_cells(spark, d):
    cells = basket.basket_cells(_items(spark, d, "p_brand"))
    return cells.withColumn("cells", F.expr("array_join(transform(cells, x -> concat(x.level, '=', x.value)), '|')"))


ITEMSETS_SQL = f"""{BRAND_SQL},
one AS (SELECT item, count(*) AS f FROM held GROUP BY item HAVING count(*) >= 0.01 * (SELECT n FROM n)),
freq AS (SELECT basket, item FROM held SEMI JOIN one USING (item)),
two AS (SELECT a.item AS i, b.item AS j, count(*) AS f FROM freq a JOIN freq b ON a.basket = b.basket AND a.item < b.item
        GROUP BY 1, 2 HAVING count(*) >= 0.01 * (SELECT n FROM n)),
three AS (SELECT a.item AS i, b.item AS j, c.item AS k, count(*) AS f FROM freq a JOIN freq b ON a.basket = b.basket AND a.item < b.item
          JOIN freq c ON a.basket = c.basket AND b.item < c.item GROUP BY 1, 2, 3 HAVING count(*) >= 0.01 * (SELECT n FROM n)),
four AS (SELECT a.item AS i, b.item AS j, c.item AS k, e.item AS l, count(*) AS f FROM freq a JOIN freq b ON a.basket = b.basket AND a.item < b.item
         JOIN freq c ON a.basket = c.basket AND b.item < c.item JOIN freq e ON a.basket = e.basket AND c.item < e.item
         GROUP BY ALL HAVING count(*) >= 0.01 * (SELECT n FROM n)),
sets AS (SELECT [item] AS items, f FROM one UNION ALL SELECT [i, j], f FROM two UNION ALL SELECT [i, j, k], f FROM three
         UNION ALL SELECT [i, j, k, l], f FROM four)"""


@query(
    "n01_frequent_itemsets",
    "items:str, freq:long, support:double8",
    f"WITH {ITEMSETS_SQL} SELECT array_to_string(items, '|') AS items, f AS freq, f / (SELECT n FROM n) AS support FROM sets",
)
def n01(spark, d):
    return basket.frequent_itemsets(_items(spark, d)).with_support().withColumn("items", F.array_join("items", "|"))


def _measures_sql(where: str = "") -> str:
    return f"""rules AS (
  SELECT x.i AS antecedents, x.j AS consequents, a.f / n AS antecedent_support, c.f / n AS consequent_support, x.f / n AS support
  FROM (SELECT i, j, f FROM two UNION ALL SELECT j, i, f FROM two) x JOIN one a ON a.item = x.i JOIN one c ON c.item = x.j, n),
measured AS (
  SELECT *, support / antecedent_support AS confidence, support / antecedent_support / consequent_support AS lift,
         support - antecedent_support * consequent_support AS leverage,
         (1 - consequent_support) / nullif(1 - support / antecedent_support, 0) AS conviction FROM rules)"""


RULE_SPEC = (
    "antecedents:str, consequents:str, antecedent_support:double8, consequent_support:double8, support:double8, "
    "confidence:double8, lift:double8, leverage:double8, conviction:double8"
)


def _as_text(rules):
    return rules.withColumns({c: F.array_join(c, "|") for c in ("antecedents", "consequents")})


def _all_rules(spark, d, item="p_brand"):
    return basket.association_rules(basket.frequent_itemsets(_items(spark, d, item)))


@query("n02_association_rules", RULE_SPEC, f"WITH {ITEMSETS_SQL}, {_measures_sql()} SELECT * FROM measured")
def n02(spark, d):
    return _as_text(_all_rules(spark, d))


# Rules with several items on either side: six part types give itemsets of up to six items.
TYPES_SQL = f"""{BASKET_SQL.format(item='p_type')},
masks AS (SELECT basket, list(item ORDER BY item) AS items FROM held GROUP BY basket),
kinds AS (SELECT list(DISTINCT item ORDER BY item) AS all_items FROM held),
subsets AS (SELECT list_filter(all_items, lambda x, i: (m // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS items FROM kinds, range(1, 64) r(m)),
support AS (SELECT s.items, count(*) AS f FROM subsets s JOIN masks b ON list_has_all(b.items, s.items) GROUP BY s.items
            HAVING count(*) >= 0.01 * (SELECT n FROM n)),
split AS (SELECT u.f, a.items AS antecedents, a.f AS af, list_filter(u.items, lambda x: NOT list_contains(a.items, x)) AS consequents
          FROM support u JOIN support a ON list_has_all(u.items, a.items) AND len(a.items) < len(u.items)),
measured AS (
  SELECT array_to_string(s.antecedents, '|') AS antecedents, array_to_string(s.consequents, '|') AS consequents,
         af / n AS antecedent_support, c.f / n AS consequent_support, s.f / n AS support, s.f / af AS confidence,
         s.f / af / (c.f / n) AS lift, s.f / n - af / n * c.f / n AS leverage,
         (1 - c.f / n) / nullif(1 - s.f / af, 0) AS conviction
  FROM split s JOIN support c ON c.items = s.consequents, n)"""


@query("n03_rule_measures", RULE_SPEC, f"WITH {TYPES_SQL} SELECT * FROM measured")
def n03(spark, d):
    return _as_text(_all_rules(spark, d, "p_type"))


@query(
    "n05_top_rules_by_lift",
    RULE_SPEC,
    f"WITH {TYPES_SQL} SELECT * FROM measured ORDER BY round(lift, 9) DESC, support DESC, antecedents, consequents LIMIT 5",
)
def n05(spark, d):
    return _as_text(basket.top_rules(_all_rules(spark, d, "p_type"), 5))


SEGMENT_BASKET_SQL = f"""{SEGMENTS_SQL},
tiers AS (SELECT customer_id, CASE WHEN monetary_score >= 4 THEN 'A' WHEN monetary_score >= 2 THEN 'B' ELSE 'C' END AS tier FROM segments),
bought AS (SELECT DISTINCT t.tier, s.invoice AS basket, p_type AS item FROM sales s JOIN tiers t USING (customer_id)
           JOIN part ON CAST(p_partkey AS VARCHAR) = s.stock_code),
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
products AS (SELECT tier, consequents[1] AS product FROM ranked WHERE rn = 1)"""


def _tiered(spark, d):
    from ..session import materialise

    lines = materialise(_sales(spark, d, ["stock_code", "country"]))
    scored = rfm.rfm_scores(rfm.rfm_metrics(lines))
    score = F.col("monetary_score")
    tiers = materialise(
        scored.select("customer_id", F.when(score >= 4, "A").when(score >= 2, "B").otherwise("C").alias("segment"))
    )
    part = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("stock_code"), "p_type")
    return lines, tiers, lines.join(tiers, "customer_id").join(part, "stock_code")


@query("n06_segment_products", "segment:str, recommended_product:str", f"WITH {SEGMENT_BASKET_SQL} SELECT tier AS segment, product AS recommended_product FROM products")
def n06(spark, d):
    return basket.segment_products(_tiered(spark, d)[2], item="p_type")


@query(
    "k21_segment_recommendation",
    "customer_id:long, segment:str, recommended_product:str",
    f"""WITH {SEGMENT_BASKET_SQL}, locals AS (SELECT DISTINCT customer_id FROM sales WHERE country = 'NATION_7')
        SELECT t.customer_id, t.tier AS segment,
               CASE WHEN l.customer_id IS NOT NULL THEN coalesce(p.product, '') ELSE '' END AS recommended_product
        FROM tiers t LEFT JOIN locals l USING (customer_id) LEFT JOIN products p ON p.tier = t.tier""",
)
def k21(spark, d):
    lines, tiers, full = _tiered(spark, d)
    products = basket.segment_products(full, item="p_type")
    return basket.recommend(tiers, products, lines, "NATION_7")


@query(
    "n04_segment_rules",
    "segment:str, " + RULE_SPEC,
    f"""WITH {SEGMENT_BASKET_SQL}
        SELECT q.tier AS segment, array_to_string(q.antecedents, '|') AS antecedents, array_to_string(q.consequents, '|') AS consequents,
               sa AS antecedent_support, c.s AS consequent_support, q.s AS support, q.s / sa AS confidence, q.s / sa / c.s AS lift,
               q.s - sa * c.s AS leverage, (1 - c.s) / nullif(1 - q.s / sa, 0) AS conviction
        FROM split q JOIN support c ON c.tier = q.tier AND c.items = q.consequents""",
)
def n04_segments(spark, d):
    return _as_text(basket.segment_rules(_tiered(spark, d)[2], item="p_type"))


@query(
    "n04_country_rules",
    RULE_SPEC,
    f"""WITH {RETAIL_SQL}, bought AS (SELECT DISTINCT invoice AS basket, p_type AS item FROM retail JOIN part ON CAST(p_partkey AS VARCHAR) = stock_code
          WHERE country = 'NATION_7' AND NOT contains(invoice, 'C')),
        nb AS (SELECT count(DISTINCT basket) AS n FROM bought),
        lists AS (SELECT basket, list(item ORDER BY item) AS items FROM bought GROUP BY basket),
        kinds AS (SELECT list(DISTINCT item ORDER BY item) AS all_items FROM bought),
        subsets AS (SELECT list_filter(all_items, lambda x, i: (m // CAST(pow(2, i - 1) AS BIGINT)) % 2 = 1) AS items FROM kinds, range(1, 64) r(m)),
        support AS (SELECT s.items, count(*) AS f FROM subsets s JOIN lists b ON list_has_all(b.items, s.items) GROUP BY s.items
                    HAVING count(*) >= 0.01 * (SELECT n FROM nb)),
        split AS (SELECT u.f, a.items AS antecedents, a.f AS af, list_filter(u.items, lambda x: NOT list_contains(a.items, x)) AS consequents
                  FROM support u JOIN support a ON list_has_all(u.items, a.items) AND len(a.items) < len(u.items))
        SELECT array_to_string(s.antecedents, '|') AS antecedents, array_to_string(s.consequents, '|') AS consequents,
               af / n AS antecedent_support, c.f / n AS consequent_support, s.f / n AS support, s.f / af AS confidence,
               s.f / af / (c.f / n) AS lift, s.f / n - af / n * c.f / n AS leverage, (1 - c.f / n) / nullif(1 - s.f / af, 0) AS conviction
        FROM split s JOIN support c ON c.items = s.consequents, nb""",
)
def n04(spark, d):
    lines = rfm.drop_cancelled(retail_lines(spark, d, ["invoice", "stock_code", "quantity", "country"]))
    part = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("stock_code"), "p_type")
    return _as_text(basket.create_rules(lines.join(part, "stock_code"), "NATION_7", "p_type"))


@query("n07_description_baskets", "basket:str, n_items:long", f"""WITH {RETAIL_SQL}, net AS (SELECT invoice AS basket, description, sum(quantity) AS q
       FROM retail WHERE description IS NOT NULL GROUP BY 1, 2) SELECT basket, count(*) FILTER (WHERE q > 0) AS n_items FROM net GROUP BY basket""")
def n07(spark, d):
    return basket.basket_sizes(basket.basket_items(retail_lines(spark, d, ["invoice", "description", "quantity"]), "description"))
