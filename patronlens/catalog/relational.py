"""One small query per relational step: projections, filters, joins, aggregates, windows, sorts, reshaping, scalars."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import ordering, profile
from ..operators.quantiles import exact_quantiles
from ..operators.reshaping import sparse_cells
from ..plans import cohort, rfm
from ..sources.retail import RETAIL_SQL, retail_lines, table
from .customers import SALES_SQL, SEGMENTS_SQL, _USERS_SQL, _sales, purchases, users
from .registry import query


def retail(sql: str) -> str:
    return f"WITH {RETAIL_SQL} {sql}"


# --- projections, filters, predicates ------------------------------------------------------------


@query("b01_column_subset", "invoice:str, quantity:double", retail("SELECT invoice, quantity FROM retail"))
def b01(spark, d):
    return retail_lines(spark, d).select("invoice", "quantity")


@query("b02_total_price", "invoice:str, stock_code:str, total_price:double2", retail("SELECT invoice, stock_code, quantity * price AS total_price FROM retail"))
def b02(spark, d):
    return rfm.with_total_price(retail_lines(spark, d, ["invoice", "stock_code", "quantity", "price"]))


@query("b03_rename_columns", "uid:long, country:str, level:str", "SELECT c_custkey AS uid, n_name AS country, c_mktsegment AS level FROM customer JOIN nation ON c_nationkey = n_nationkey")
def b03(spark, d):
    return users(spark, d).select("uid", "country", "device").withColumnsRenamed({"device": "level"})


@query("b04_upper_case_names", "P_PARTKEY:long, P_NAME:str, P_BRAND:str, P_TYPE:str, P_SIZE:int, P_RETAILPRICE:double", "SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, p_type AS P_TYPE, p_size AS P_SIZE, p_retailprice AS P_RETAILPRICE FROM part")
def b04(spark, d):
    part = table(spark, d, "part")
    return part.toDF(*[c.upper() for c in part.columns])


@query("b05_drop_columns", "p_partkey:long, p_type:str, p_retailprice:double", "SELECT p_partkey, p_type, p_retailprice FROM part")
def b05(spark, d):
    return table(spark, d, "part").drop("p_name", "p_brand", "p_size")


@query("b06_cancelled_filter", "invoice:str, stock_code:str, quantity:double", retail("SELECT invoice, stock_code, quantity FROM retail WHERE NOT coalesce(contains(invoice, 'C'), false)"))
def b06(spark, d):
    return rfm.drop_cancelled(retail_lines(spark, d, ["invoice", "stock_code", "quantity"]))


@query("b07_positive_quantity", "invoice:str, quantity:double", retail("SELECT invoice, quantity FROM retail WHERE quantity > 0"))
def b07(spark, d):
    return retail_lines(spark, d, ["invoice", "quantity"]).where(F.col("quantity") > 0)


@query("b08_conjunction_filter", "customer_id:long, frequency:long, monetary:double2",
       retail("""SELECT customer_id, count(*) AS frequency, sum(quantity * price) AS monetary FROM retail WHERE customer_id IS NOT NULL
                 GROUP BY customer_id HAVING sum(quantity * price) > 0 AND count(*) > 0"""))
def b08(spark, d):
    lines = rfm.with_total_price(retail_lines(spark, d, ["customer_id", "quantity", "price"]))
    totals = lines.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("frequency"), F.sum("total_price").alias("monetary")
    )
    return totals.where((F.col("monetary") > 0) & (F.col("frequency") > 0))


@query("b09_one_country", "invoice:str, country:str, price:double8", retail("SELECT invoice, country, price FROM retail WHERE country = 'NATION_7'"))
def b09(spark, d):
    return retail_lines(spark, d, ["invoice", "country", "price"]).where(F.col("country") == "NATION_7")


@query("b10_complete_rows", "invoice:str, description:str, customer_id:long", retail("SELECT invoice, description, customer_id FROM retail WHERE description IS NOT NULL AND customer_id IS NOT NULL"))
def b10(spark, d):
    return retail_lines(spark, d).na.drop("any")


@query("b11_known_customers", "invoice:str, customer_id:long, description:str", retail("SELECT invoice, customer_id, description FROM retail WHERE customer_id IS NOT NULL"))
def b11(spark, d):
    return retail_lines(spark, d, ["invoice", "customer_id", "description"]).na.drop(subset=["customer_id"])


@query("b12_split_by_null", "side:str, n:long, units:double2", retail("SELECT CASE WHEN customer_id IS NOT NULL THEN 'known' ELSE 'unknown' END AS side, count(*) AS n, sum(quantity) AS units FROM retail GROUP BY 1"))
def b12(spark, d):
    lines = retail_lines(spark, d, ["customer_id", "quantity"])
    known, unknown = lines.where(F.col("customer_id").isNotNull()), lines.where(F.col("customer_id").isNull())
    total = [F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units")]
    return known.agg(F.lit("known").alias("side"), *total).unionByName(unknown.agg(F.lit("unknown").alias("side"), *total))


@query("b13_conditional_assignment", "c_custkey:long, band:str",
       """SELECT c_custkey, CASE WHEN c_acctbal > 7500 THEN 'top' WHEN c_acctbal > 2500 THEN 'middle' WHEN c_acctbal <= 3000 THEN 'low' END AS band FROM customer""")
def b13(spark, d):
    bal = F.col("c_acctbal")
    return table(spark, d, "customer").withColumn(
        "band", C.last_match([(bal <= 3000, "low"), (bal > 2500, "middle"), (bal > 7500, "top")])
    )


@query("b14_key_lookup", "c_custkey:long, c_name:str, c_acctbal:double2", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 97")
def b14(spark, d):
    return table(spark, d, "customer").where(F.col("c_custkey") == 97)


@query("b15_product_names", "stock_code:str, description:str", retail("SELECT stock_code, min(description) AS description FROM retail WHERE description IS NOT NULL GROUP BY stock_code"))
def b15(spark, d):
    known = retail_lines(spark, d, ["stock_code", "description"]).where(F.col("description").isNotNull())
    return known.groupBy("stock_code").agg(F.min("description").alias("description"))


@query("b16_type_cast", "invoice:str, invoice_number:long, quantity_text:str, stock_number:int",
       retail("SELECT invoice, TRY_CAST(invoice AS BIGINT) AS invoice_number, CAST(CAST(quantity AS INTEGER) AS VARCHAR) AS quantity_text, CAST(stock_code AS INTEGER) AS stock_number FROM retail"))
def b16(spark, d):
    return retail_lines(spark, d, ["invoice", "quantity", "stock_code"]).select(
        "invoice",
        F.col("invoice").try_cast("long").alias("invoice_number"),
        F.col("quantity").cast("int").cast("string").alias("quantity_text"),
        F.col("stock_code").cast("int").alias("stock_number"),
    )


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("b17_columns_by_levels", "column_name:str",
       "SELECT column_name FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n FROM orders" for c in _ORDER_COLUMNS) + ") WHERE n BETWEEN 3 AND 10")
def b17(spark, d):
    found = profile.distinct_counts(table(spark, d, "orders"), _ORDER_COLUMNS)
    return found.where(F.col("n_levels").between(3, 10)).select("column_name")


@query("b18_constant_fill", "invoice:str, description:str, customer_id:long", retail("SELECT invoice, coalesce(description, 'unknown') AS description, coalesce(customer_id, 0) AS customer_id FROM retail"))
def b18(spark, d):
    return retail_lines(spark, d, ["invoice", "description", "customer_id"]).na.fill({"description": "unknown", "customer_id": 0})


@query("b19_zero_to_null", "l_orderkey:long, l_linenumber:int, l_discount:double", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount FROM lineitem")
def b19(spark, d):
    return table(spark, d, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))


@query("b20_default_column", "c_custkey:long, recommended_product:str, top_flag:int", "SELECT c_custkey, '' AS recommended_product, 0 AS top_flag FROM customer")
def b20(spark, d):
    return table(spark, d, "customer").withColumns({"recommended_product": F.lit(""), "top_flag": F.lit(0)})


# --- joins ---------------------------------------------------------------------------------------


@query("c01_purchases_with_users", "uid:long, price:double2, country:str, device:str, gender:str, age:int",
       f"WITH {_USERS_SQL} SELECT uid, o_totalprice AS price, country, device, gender, age FROM orders JOIN users ON o_custkey = uid")
def c01(spark, d):
    return purchases(spark, d).join(users(spark, d), "uid", "inner")


@query("c02_left_join_totals", "c_custkey:long, monetary:double2",
       f"WITH {SALES_SQL} SELECT c_custkey, monetary FROM customer LEFT JOIN (SELECT customer_id, sum(total_price) AS monetary FROM sales GROUP BY 1) ON c_custkey = customer_id")
def c02(spark, d):
    spent = _sales(spark, d).groupBy("customer_id").agg(F.sum("total_price").alias("monetary"))
    return table(spark, d, "customer").join(spent.withColumnRenamed("customer_id", "c_custkey"), "c_custkey", "left")


@query("c03_semi_join_segment", "invoice:str, customer_id:long, total_price:double2",
       f"WITH {SEGMENTS_SQL} SELECT invoice, customer_id, total_price FROM sales SEMI JOIN (SELECT customer_id FROM segments WHERE segment = 'Champions') USING (customer_id)")
def c03(spark, d):
    lines = _sales(spark, d)
    champions = rfm.rfm_table(lines.drop("total_price")).where(F.col("segment") == "Champions").select("customer_id")
    return lines.join(champions, "customer_id", "left_semi")


@query("c04_keys_contained", "missing_keys:long, all_contained:bool",
       "SELECT count(*) AS missing_keys, count(*) = 0 AS all_contained FROM (SELECT o_custkey FROM orders ANTI JOIN customer ON o_custkey = c_custkey)")
def c04(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    missing = keys.join(table(spark, d, "customer"), "c_custkey", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("missing_keys")).withColumn("all_contained", F.col("missing_keys") == 0)


@query("c05_aligned_assignment", "c_custkey:long, tier:str, discount:double",
       "SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN 'A' ELSE 'B' END AS tier, CASE WHEN c_acctbal >= 5000 THEN 0.1 ELSE 0.05 END AS discount FROM customer")
def c05(spark, d):
    tiered = table(spark, d, "customer").withColumn("tier", F.when(F.col("c_acctbal") >= 5000, "A").otherwise("B"))
    return tiered.withColumn("discount", F.when(F.col("tier") == "A", 0.1).otherwise(0.05))


@query("c06_side_by_side", "position:long, first_value:double, second_value:double",
       """WITH a AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS position, value FROM events WHERE event_type = 'click'),
          b AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS position, value FROM events WHERE event_type = 'view')
          SELECT coalesce(a.position, b.position) AS position, a.value AS first_value, b.value AS second_value FROM a FULL JOIN b ON a.position = b.position""")
def c06(spark, d):
    from ..plans.abtest import side_by_side

    return side_by_side(table(spark, d, "events"), "event_type", "value", [F.col("ts").asc(), F.col("event_id").asc()], "click", "view")


@query("c07_category_pairs", "first:str, second:str",
       "WITH k AS (SELECT DISTINCT p_brand FROM part) SELECT a.p_brand AS first, b.p_brand AS second FROM k a JOIN k b ON a.p_brand < b.p_brand")
def c07(spark, d):
    brands = table(spark, d, "part").select("p_brand").where("p_brand IS NOT NULL").distinct()
    left, right = brands.withColumnRenamed("p_brand", "first"), brands.withColumnRenamed("p_brand", "second")
    return left.join(right, F.col("first") < F.col("second"))  # the pairs are the result


@query("c08_scalar_into_rows", "c_custkey:long, share:double8, above_mean:bool",
       "SELECT c_custkey, c_acctbal / (SELECT count(*) FROM customer) AS share, c_acctbal > (SELECT avg(c_acctbal) FROM customer) AS above_mean FROM customer")
def c08(spark, d):
    customers = table(spark, d, "customer")
    whole = customers.agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean"))
    return customers.crossJoin(F.broadcast(whole)).select(
        "c_custkey", C.ratio("c_acctbal", "n").alias("share"), (F.col("c_acctbal") > F.col("mean")).alias("above_mean")
    )


# --- aggregates ----------------------------------------------------------------------------------


@query("d01_orders_per_customer", "customer_id:long, n_orders:long", retail("SELECT customer_id, count(DISTINCT invoice) AS n_orders FROM retail WHERE customer_id IS NOT NULL GROUP BY 1"))
def d01(spark, d):
    known = retail_lines(spark, d, ["customer_id", "invoice"]).where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(F.count_distinct("invoice").alias("n_orders"))


@query("d02_units_per_description", "description:str, country:str, units:double2", retail("SELECT description, country, coalesce(sum(quantity), 0) AS units FROM retail WHERE description IS NOT NULL GROUP BY 1, 2"))
def d02(spark, d):
    known = retail_lines(spark, d, ["description", "country", "quantity"]).where(F.col("description").isNotNull())
    return known.groupBy("description", "country").agg(F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("units"))


@query("d03_line_counts", "customer_id:long, n_lines:long", retail("SELECT customer_id, count(*) AS n_lines FROM retail WHERE customer_id IS NOT NULL GROUP BY 1"))
def d03(spark, d):
    return retail_lines(spark, d, ["customer_id"]).where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query("d04_count_and_mean", "country:str, n_described:long, n_customers:long, price_mean:double2", retail("SELECT country, count(description) AS n_described, count(customer_id) AS n_customers, avg(price) AS price_mean FROM retail GROUP BY 1"))
def d04(spark, d):
    return retail_lines(spark, d, ["country", "description", "customer_id", "price"]).groupBy("country").agg(
        F.count("description").alias("n_described"), F.count("customer_id").alias("n_customers"), F.avg("price").alias("price_mean")
    )


@query("d05_category_price_table", "event_type:str, mean:double, median:double6, n:long, n_unique:long",
       "SELECT event_type, avg(value) AS mean, quantile_cont(value, 0.5) AS median, count(value) AS n, count(DISTINCT value) AS n_unique FROM events GROUP BY 1")
def d05(spark, d):
    from ..plans.pricing import category_prices

    return category_prices(table(spark, d, "events"), "event_type", "value")


@query("d06_segment_statistics", "c_mktsegment:str, c_acctbal_mean:double, c_acctbal_count:long, c_acctbal_sum:double2, c_nationkey_mean:double",
       "SELECT c_mktsegment, avg(c_acctbal) AS c_acctbal_mean, count(c_acctbal) AS c_acctbal_count, sum(c_acctbal) AS c_acctbal_sum, avg(c_nationkey) AS c_nationkey_mean FROM customer GROUP BY 1")
def d06(spark, d):
    return rfm.segment_profile(table(spark, d, "customer"), "c_mktsegment", ["c_acctbal", "c_nationkey"], ("mean", "count", "sum"))


@query("d07_global_scalars", "last_order:date, n_customers:long, mean_price:double2, n_orders:long, median_price:double4",
       "SELECT max(o_orderdate) AS last_order, count(DISTINCT o_custkey) AS n_customers, avg(o_totalprice) AS mean_price, count(*) AS n_orders, quantile_cont(o_totalprice, 0.5) AS median_price FROM orders")
def d07(spark, d):
    orders = table(spark, d, "orders")
    one = orders.agg(
        F.max("o_orderdate").alias("last_order"), F.count_distinct("o_custkey").alias("n_customers"),
        F.avg("o_totalprice").alias("mean_price"), F.count(F.lit(1)).alias("n_orders"),
    )
    median = exact_quantiles(orders, ["o_totalprice"], [0.5]).select(F.col("q")[0].alias("median_price"))
    return one.crossJoin(F.broadcast(median))  # both sides are one row


@query("d08_two_level_mean", "customer_id:long, monetary_avg:double7",
       f"WITH {SALES_SQL}, per AS (SELECT customer_id, invoice, avg(total_price) AS m FROM sales GROUP BY 1, 2) SELECT customer_id, avg(m) AS monetary_avg FROM per GROUP BY 1")
def d08(spark, d):
    per_invoice = _sales(spark, d).groupBy("customer_id", "invoice").agg(F.avg("total_price").alias("m"))
    return per_invoice.groupBy("customer_id").agg(F.avg("m").alias("monetary_avg"))


@query("d09_value_counts", "description:str, n:long", retail("SELECT description, count(*) AS n FROM retail WHERE description IS NOT NULL GROUP BY 1"))
def d09(spark, d):
    known = retail_lines(spark, d, ["description"]).where(F.col("description").isNotNull())
    return known.groupBy("description").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "description")


@query("d10_distinct_rows", "customer_id:long, invoice:str, invoice_date:date", retail("SELECT DISTINCT customer_id, invoice, invoice_date FROM retail WHERE customer_id IS NOT NULL"))
def d10(spark, d):
    return retail_lines(spark, d, ["customer_id", "invoice", "invoice_date"]).na.drop(subset=["customer_id"]).dropDuplicates()


@query("d11_null_counts", "column_name:str, n_null:long",
       retail("""SELECT unnest(['invoice', 'stock_code', 'description', 'quantity', 'invoice_date', 'price', 'customer_id', 'country']) AS column_name,
                 unnest([count(*) - count(invoice), count(*) - count(stock_code), count(*) - count(description), count(*) - count(quantity),
                 count(*) - count(invoice_date), count(*) - count(price), count(*) - count(customer_id), count(*) - count(country)]) AS n_null FROM retail"""))
def d11(spark, d):
    return profile.null_counts(retail_lines(spark, d))


@query("d12_zero_counts", "column_name:str, n_zero:long",
       "SELECT unnest(['l_discount', 'l_tax', 'l_quantity']) AS column_name, unnest([count(*) FILTER (WHERE l_discount = 0), count(*) FILTER (WHERE l_tax = 0), count(*) FILTER (WHERE l_quantity = 0)]) AS n_zero FROM lineitem")
def d12(spark, d):
    return profile.zero_counts(table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_quantity"])


def _describe_sql(cols: list[str], source: str, probs: list[float]) -> str:
    parts = []
    for c in cols:
        q = ", ".join(f"quantile_cont({c}, {p!r}) AS q{i}" for i, p in enumerate(probs))
        parts.append(f"SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, {q}, max({c}) AS max FROM {source}")
    return " UNION ALL ".join(parts)


DESCRIBE_PROBS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query("d13_describe", "column_name:str, n:long, mean:double, std:double, min:double, max:double, " + ", ".join(f"q{i}:double" for i in range(9)),
       _describe_sql(["l_quantity", "l_extendedprice", "l_discount"], "lineitem", DESCRIBE_PROBS))
def d13(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], DESCRIBE_PROBS)
    return out.withColumns({f"q{i}": F.col("q")[i] for i in range(9)})


@query("d14_exact_quantiles", "column_name:str, n:long, q01:double6, q50:double6, q99:double6",
       "SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n, quantile_cont(o_totalprice, 0.01) AS q01, quantile_cont(o_totalprice, 0.5) AS q50, quantile_cont(o_totalprice, 0.99) AS q99 FROM orders")
def d14(spark, d):
    q = exact_quantiles(table(spark, d, "orders"), ["o_totalprice"], [0.01, 0.5, 0.99])
    return q.select("column_name", "n", *[F.col("q")[i].alias(name) for i, name in enumerate(("q01", "q50", "q99"))])


@query("d15_churn_by_country", "country:str, n_customers:long, churn:double6",
       retail("""SELECT country, count(*) AS n_customers, avg(CASE WHEN n > 1 THEN 0.0 ELSE 1.0 END) AS churn
                 FROM (SELECT country, customer_id, count(DISTINCT invoice) AS n FROM retail WHERE customer_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""))
def d15(spark, d):
    known = retail_lines(spark, d, ["country", "customer_id", "invoice"]).where(F.col("customer_id").isNotNull())
    orders = known.distinct().groupBy("country", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    return orders.groupBy("country").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg(F.when(F.col("n") > 1, 0.0).otherwise(1.0)).alias("churn")
    )


@query("d16_correlation_pairs", "left_column:str, right_column:str, r:double8",
       """SELECT 'l_quantity' AS left_column, 'l_extendedprice' AS right_column, corr(l_quantity, l_extendedprice) AS r FROM lineitem
          UNION ALL SELECT 'l_quantity', 'l_tax', corr(l_quantity, l_tax) FROM lineitem
          UNION ALL SELECT 'l_extendedprice', 'l_tax', corr(l_extendedprice, l_tax) FROM lineitem""")
def d16(spark, d):
    return profile.correlations(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])


@query("d17_mode", "mode_p_name:str, mode_p_brand:str",
       "SELECT (SELECT p_name FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_p_name, (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode_p_brand")
def d17(spark, d):
    from ..operators.impute import mode_row

    return mode_row(table(spark, d, "part"), ["p_name", "p_brand"])


# --- windows and values of the group on every row ------------------------------------------------


@query("e01_first_purchase_on_rows", "o_orderkey:long, o_custkey:long, first_order:date", "SELECT o_orderkey, o_custkey, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_order FROM orders")
def e01(spark, d):
    return cohort.first_per_key(table(spark, d, "orders"), "o_custkey", "o_orderdate", "first_order")


@query("e02_group_median_fill", "c_custkey:long, c_acctbal:double4",
       """WITH g AS (SELECT c_custkey, CASE WHEN c_nationkey <> 5 THEN c_mktsegment END AS seg, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer),
          m AS (SELECT seg, quantile_cont(bal, 0.5) AS med FROM g WHERE seg IS NOT NULL GROUP BY 1)
          SELECT c_custkey, coalesce(bal, med) AS c_acctbal FROM g LEFT JOIN m USING (seg)""")
def e02(spark, d):
    from ..operators.impute import fill_group_median

    holes = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 5, F.col("c_mktsegment")).alias("seg"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return fill_group_median(holes, "c_acctbal", "seg")


@query("e03_first_period_value", "cohort:date, period_number:int, cohort_size:long",
       """WITH m AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate) AS om FROM orders GROUP BY ALL), f AS (SELECT c, min(om) AS cohort FROM m GROUP BY 1),
          t AS (SELECT cohort, om, count(*) AS n FROM m JOIN f USING (c) GROUP BY 1, 2)
          SELECT cohort, (year(om) - year(cohort)) * 12 + month(om) - month(cohort) AS period_number,
                 max(CASE WHEN om = cohort THEN n END) OVER (PARTITION BY cohort) AS cohort_size FROM t""")
def e03(spark, d):
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("invoice_date"))
    return cohort.retention(cohort.cohort_table(lines))


@query("e04_divide_by_base", "o_orderpriority:str, year:int, n:long, share:double6",
       """WITH t AS (SELECT o_orderpriority, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1, 2)
          SELECT *, n / max(CASE WHEN year = 1995 THEN n END) OVER (PARTITION BY o_orderpriority) AS share FROM t""")
def e04(spark, d):
    counts = table(spark, d, "orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    base = F.max(F.when(F.col("year") == 1995, F.col("n"))).over(W.partitionBy("o_orderpriority"))
    return counts.withColumn("base", base).withColumn("share", C.ratio("n", "base"))


@query("e05_pareto_flag", "customer_id:long, monetary:double2, top_flag:int",
       f"""WITH {SALES_SQL}, t AS (SELECT customer_id, round(sum(total_price), 2) AS monetary FROM sales GROUP BY 1)
           SELECT customer_id, monetary, CASE WHEN row_number() OVER (ORDER BY monetary DESC, customer_id) <= ceil(0.2 * (SELECT count(*) FROM t)) THEN 1 ELSE 0 END AS top_flag FROM t""")
def e05(spark, d):
    spent = _sales(spark, d).groupBy("customer_id").agg(F.round(F.sum("total_price"), 2).alias("monetary"))
    return ordering.top_share_flag(spent, [F.col("monetary").desc_nulls_last(), F.col("customer_id").asc()], 0.2)


@query("e06_row_position", "position:long, o_orderkey:long", "SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position, o_orderkey FROM orders")
def e06(spark, d):
    numbered = ordering.with_row_number(table(spark, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], "n")
    return numbered.withColumn("position", F.col("n") - 1)


# --- sorts and limits ----------------------------------------------------------------------------


@query("f01_sort_descending", "description:str, units:double2", retail("SELECT description, sum(quantity) AS units FROM retail WHERE description IS NOT NULL GROUP BY 1 ORDER BY units DESC NULLS LAST, 1"))
def f01(spark, d):
    known = retail_lines(spark, d, ["description", "quantity"]).where(F.col("description").isNotNull())
    return known.groupBy("description").agg(F.sum("quantity").alias("units")).orderBy(F.col("units").desc_nulls_last(), "description")


@query("f02_top_customers", "o_custkey:long, spent:double2", "SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY 1 ORDER BY round(sum(o_totalprice), 2) DESC, 1 LIMIT 10")
def f02(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"))
    return spent.orderBy(F.round("spent", 2).desc_nulls_last(), "o_custkey").limit(10)


@query("f03_mixed_sort", "p_brand:str, p_size:int, p_partkey:long", "SELECT p_brand, p_size, p_partkey FROM part ORDER BY p_brand, p_size DESC, p_partkey")
def f03(spark, d):
    return table(spark, d, "part").orderBy(F.col("p_brand").asc(), F.col("p_size").desc(), F.col("p_partkey").asc())


@query("f04_top_hundred_export", "customer_id:long, monetary:double2",
       f"WITH {SALES_SQL} SELECT customer_id, sum(total_price) AS monetary FROM sales GROUP BY 1 ORDER BY round(sum(total_price), 2) DESC, 1 LIMIT 100")
def f04(spark, d):
    from .tables import csv_round_trip

    spent = _sales(spark, d).groupBy("customer_id").agg(F.sum("total_price").alias("monetary"))
    best = spent.orderBy(F.round("monetary", 2).desc(), "customer_id").limit(100)
    return csv_round_trip(best, "customer_id long, monetary double")


@query("f05_preview_rows", "side:str, o_orderkey:long", "(SELECT 'head' AS side, o_orderkey FROM orders ORDER BY o_orderkey LIMIT 3) UNION ALL (SELECT 'tail', o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 3)")
def f05(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    head = orders.orderBy("o_orderkey").limit(3).select(F.lit("head").alias("side"), "o_orderkey")
    return head.unionByName(orders.orderBy(F.col("o_orderkey").desc()).limit(3).select(F.lit("tail").alias("side"), "o_orderkey"))


# --- set operations and reshaping ----------------------------------------------------------------


@query("g01_union_different_columns", "key:long, name:str, balance:double2, segment:str",
       "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def g01(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


#: Months that orders can lie apart in the given tables (January 1995 to August 2001).
_PERIODS = range(80)


@query("g02_pivot_retention", "cohort:date, " + ", ".join(f"period_{p}:double6" for p in _PERIODS),
       """WITH m AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate) AS om FROM orders GROUP BY ALL), f AS (SELECT c, min(om) AS cohort FROM m GROUP BY 1),
          t AS (SELECT cohort, (year(om) - year(cohort)) * 12 + month(om) - month(cohort) AS p, count(*) AS n FROM m JOIN f USING (c) GROUP BY 1, 2)
          SELECT cohort, """ + ", ".join(f"max(n) FILTER (WHERE p = {p}) / max(n) FILTER (WHERE p = 0) AS period_{p}" for p in _PERIODS) + " FROM t GROUP BY cohort")
def g02(spark, d):
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("invoice_date"))
    return cohort.retention_matrix(cohort.cohort_table(lines), _PERIODS)


@query("g02_period_cells", "cohort:date, cells:str",
       """WITH m AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate) AS om FROM orders GROUP BY ALL), f AS (SELECT c, min(om) AS cohort FROM m GROUP BY 1),
          t AS (SELECT cohort, (year(om) - year(cohort)) * 12 + month(om) - month(cohort) AS p, count(*) AS n FROM m JOIN f USING (c) GROUP BY 1, 2)
          SELECT cohort, string_agg(p || '=' || n, '|' ORDER BY p) AS cells FROM t GROUP BY cohort""")
def g02_cells(spark, d):
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("invoice_date"))
    cells = sparse_cells(cohort.cohort_table(lines), ["cohort"], "period_number", F.sum("n_customers"))
    return cells.withColumn("cells", F.expr("array_join(transform(cells, x -> concat(x.level, '=', x.value)), '|')"))


@query("g05_flat_aggregate_names", "p_type:str, price_mean:double2, price_max:double2, size_sum:long", "SELECT p_type, avg(p_retailprice) AS price_mean, max(p_retailprice) AS price_max, sum(p_size) AS size_sum FROM part GROUP BY 1")
def g05(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(
        F.avg("p_retailprice").alias("price_mean"), F.max("p_retailprice").alias("price_max"), F.sum("p_size").alias("size_sum")
    )


@query("g06_transposed_summary", "statistic:str, value:double4",
       "SELECT unnest(['n', 'mean', 'min', 'max']) AS statistic, unnest([count(o_totalprice)::DOUBLE, avg(o_totalprice), min(o_totalprice), max(o_totalprice)]) AS value FROM orders")
def g06(spark, d):
    wide = table(spark, d, "orders").agg(
        F.count("o_totalprice").cast("double").alias("n"), F.avg("o_totalprice").alias("mean"),
        F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"),
    )
    return wide.unpivot([], ["n", "mean", "min", "max"], "statistic", "value")


# --- scalar functions ----------------------------------------------------------------------------


@query("h01_substring_test", "p_partkey:long, is_red:bool", "SELECT p_partkey, coalesce(contains(CASE WHEN p_size <> 1 THEN p_name END, 'red'), false) AS is_red FROM part")
def h01(spark, d):
    name = F.when(F.col("p_size") != 1, F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", C.contains_or_false(name, "red").alias("is_red"))


@query("h02_upper_case", "uid:long, device:str", "SELECT c_custkey AS uid, upper(lower(c_mktsegment)) AS device FROM customer")
def h02(spark, d):
    return users(spark, d).select("uid", F.upper(F.lower("device")).alias("device"))


@query("h03_joined_key", "uid:long, persona:str", f"WITH {_USERS_SQL} SELECT uid, country || '_' || upper(device) || '_' || CASE WHEN age > 20 THEN gender END AS persona FROM users")
def h03(spark, d):
    known = F.when(F.col("age") > 20, F.col("gender"))
    return users(spark, d).select("uid", C.joined_key("country", F.upper("device"), known).alias("persona"))


@query("h04_score_digits", "customer_id:long, rfm_score:str", f"WITH {SEGMENTS_SQL} SELECT customer_id, rfm_score FROM segments WHERE rfm_score = '555' OR rfm_score = '111'")
def h04(spark, d):
    scored = rfm.rfm_scores(rfm.rfm_metrics(_sales(spark, d)))
    return scored.where(F.col("rfm_score").isin("555", "111"))


@query("h05_score_to_segment", "code:str, segment:str, n:long",
       """WITH c AS (SELECT CAST(1 + l_linenumber % 5 AS VARCHAR) || CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) AS code FROM lineitem)
          SELECT code, CASE WHEN regexp_full_match(code, '[1-2][1-2]') THEN 'Hibernating' WHEN regexp_full_match(code, '[1-2][3-4]') THEN 'At_Risk'
            WHEN regexp_full_match(code, '[1-2]5') THEN 'Cant_Loose' WHEN regexp_full_match(code, '3[1-2]') THEN 'About_to_Sleep'
            WHEN regexp_full_match(code, '33') THEN 'Need_Attention' WHEN regexp_full_match(code, '[3-4][4-5]') THEN 'Loyal_Customers'
            WHEN regexp_full_match(code, '41') THEN 'Promising' WHEN regexp_full_match(code, '51') THEN 'New_Customers'
            WHEN regexp_full_match(code, '[4-5][2-3]') THEN 'Potential_Loyalists' ELSE 'Champions' END AS segment, count(*) AS n FROM c GROUP BY ALL""")
def h05(spark, d):
    digits = [F.expr("1 + l_linenumber % 5").cast("string"), F.expr("1 + cast(l_quantity as int) % 5").cast("string")]
    codes = table(spark, d, "lineitem").select(F.concat(*digits).alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("segment", rfm.segment_name(F.col("code")))


@query("h06_regex_extract", "doc_id:long, title:str", r"SELECT doc_id, nullif(regexp_extract(text, ' ([A-Za-z]+)\.', 1), '') AS title FROM documents")
def h06(spark, d):
    return table(spark, d, "documents").select("doc_id", C.extracted("text", r" ([A-Za-z]+)\.").alias("title"))


@query("h07_text_length", "doc_id:long, n:long", "SELECT doc_id, length(text) AS n FROM documents")
def h07(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").alias("n"))


@query("h08_word_count", "doc_id:long, n:long", "SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents")
def h08(spark, d):
    return table(spark, d, "documents").select("doc_id", C.word_count("text").alias("n"))


@query("h09_prefix_tokens", "doc_id:long, n:long", r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: starts_with(w, 'Th'))) AS n FROM documents")
def h09(spark, d):
    return table(spark, d, "documents").select("doc_id", C.words_starting_with("text", "Th").alias("n"))


@query("h10_month_of_order", "o_orderkey:long, order_month:date", "SELECT o_orderkey, date_trunc('month', o_orderdate) AS order_month FROM orders")
def h10(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.month_of("o_orderdate").alias("order_month"))


@query("h11_elapsed_days", "event_id:long, days:long", "SELECT event_id, CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts))) / 86400) AS BIGINT) AS days FROM events")
def h11(spark, d):
    today = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return table(spark, d, "events").select("event_id", C.elapsed_days(today, "ts").alias("days"))


@query("h12_analysis_date", "analysis_date:date", "SELECT date_trunc('day', max(ts)) + INTERVAL 2 DAY AS analysis_date FROM events")
def h12(spark, d):
    return table(spark, d, "events").agg(rfm.analysis_date(F.max(F.col("ts").cast("timestamp"))).alias("analysis_date"))


@query("h13_month_distance", "o_orderkey:long, months:int", "SELECT o_orderkey, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS months FROM orders")
def h13(spark, d):
    start = F.lit("1995-01-01").cast("date")
    return table(spark, d, "orders").select("o_orderkey", C.months_apart(C.month_of("o_orderdate"), start).alias("months"))


@query("h14_ratio_columns", "l_orderkey:long, l_linenumber:int, tax_per_discount:double6, unit_price:double8", "SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) AS tax_per_discount, l_extendedprice / l_quantity AS unit_price FROM lineitem")
def h14(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", C.ratio("l_tax", "l_discount").alias("tax_per_discount"), C.ratio("l_extendedprice", "l_quantity").alias("unit_price")
    )


@query("h15_days_to_weeks", "p_partkey:long, weeks:double6", "SELECT p_partkey, p_size / 7.0 AS weeks FROM part")
def h15(spark, d):
    return table(spark, d, "part").select("p_partkey", C.weeks("p_size").alias("weeks"))


@query("h16_log_and_roots", "o_orderkey:long, log_price:double8, back:double4, root:double6, distance:double2", "SELECT o_orderkey, ln(1 + o_totalprice) AS log_price, exp(ln(1 + o_totalprice)) - 1 AS back, sqrt(o_totalprice) AS root, abs(o_totalprice - 100000) AS distance FROM orders")
def h16(spark, d):
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", F.log1p(price).alias("log_price"), F.expm1(F.log1p(price)).alias("back"), F.sqrt(price).alias("root"), F.abs(price - 100000).alias("distance")
    )


@query("h17_value_map", "p_partkey:long, quality:int", "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 5 WHEN 'STANDARD' THEN 4 WHEN 'ECONOMY' THEN 3 END AS quality FROM part")
def h17(spark, d):
    return table(spark, d, "part").select("p_partkey", C.mapped("p_type", {"PROMO": 5, "STANDARD": 4, "ECONOMY": 3}).alias("quality"))


@query("h18_cell_flags", "l_orderkey:long, l_linenumber:int, discounted:int, taxed:int", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS discounted, CASE WHEN l_tax > 0 THEN 1 ELSE 0 END AS taxed FROM lineitem")
def h18(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.positive_flag("l_discount").alias("discounted"), C.positive_flag("l_tax").alias("taxed"))


@query("h19_null_indicator", "invoice:str, stock_code:str, no_customer:int", retail("SELECT invoice, stock_code, CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END AS no_customer FROM retail"))
def h19(spark, d):
    return retail_lines(spark, d, ["invoice", "stock_code", "customer_id"]).withColumn("no_customer", C.null_flag("customer_id"))


@query("h20_first_of_set", "l_orderkey:long, first_brand:str",
       "SELECT l_orderkey, min(p_brand) FILTER (WHERE l_returnflag <> 'R') AS first_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def h20(spark, d):
    kept = F.when(F.col("l_returnflag") != "R", F.col("p_brand"))
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pairs = lines.select("l_orderkey", kept.alias("brand")).distinct()  # at most one row per brand of an order
    return pairs.groupBy("l_orderkey").agg(F.min("brand").alias("first_brand"))
