"""Sources and sinks: each query writes part of the given tables and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import materialise, work_dir
from ..sources import retail as R
from ..sources import sinks
from .customers import purchases, users
from .registry import query


def _path(spark, name: str) -> str:
    return f"{work_dir(spark)}/patronlens/{name}-{uuid.uuid4().hex}"


def csv_round_trip(df, schema: str, sep: str = ",", position_order=None):
    """Write CSV and read it back."""
    path = _path(df.sparkSession, "csv")
    if sep == ",":
        sinks.write_csv(df, path, position_order)
    else:
        df.write.option("header", True).option("sep", sep).csv(path)
    return R.read_csv(df.sparkSession, path, schema, sep)


@query(
    "a01_sheet_scan",
    "invoice:str, stock_code:str, quantity:double, customer_id:long, sheet:str",
    f"""WITH {R.RETAIL_SQL} SELECT *, 'Year ' || year(invoice_date) AS sheet FROM retail WHERE year(invoice_date) = 2000""",
)
def a01(spark, d):
    lines = R.retail_lines(spark, d).withColumn("sheet", F.concat(F.lit("Year "), F.year("invoice_date").cast("string")))
    path = _path(spark, "sheets")
    sinks.write_table(lines, path, ["sheet"])
    return R.read_sheet(spark, path, "Year 2000")


@query(
    "a02_forced_types",
    "CustomerID:str, InvoiceNo:str, InvoiceDate:date",
    f"WITH {R.RETAIL_SQL} SELECT CAST(customer_id AS VARCHAR) AS CustomerID, invoice AS InvoiceNo, invoice_date AS InvoiceDate FROM retail",
)
def a02(spark, d):
    raw = R.retail_lines(spark, d, ["customer_id", "invoice", "invoice_date"]).toDF("CustomerID", "InvoiceNo", "InvoiceDate")
    path = _path(spark, "raw")
    sinks.write_csv(raw, path)
    return R.read_raw_lines(spark, path)


@query(
    "a03_two_groups",
    "grp:str, event_id:long, value:double",
    "SELECT CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'test' END AS grp, event_id, value FROM events",
)
def a03(spark, d):
    events = R.table(spark, d, "events").select("event_id", "value", (F.col("user_id") % 2).alias("side"))
    parts = []
    for side, name in ((0, "control"), (1, "test")):
        path = _path(spark, name)
        sinks.write_table(events.where(F.col("side") == side).drop("side"), path)
        parts.append(spark.read.parquet(path).withColumn("grp", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query(
    "a04_csv_with_header",
    "uid:long, device:str, gender:str, country:str, age:int",
    """SELECT c_custkey AS uid, c_mktsegment AS device, n_name AS country, CAST(15 + floor((c_acctbal + 1000) / 180) AS INTEGER) AS age,
       CASE WHEN right(c_name, 1) IN ('0', '2', '4', '6', '8') THEN 'F' ELSE 'M' END AS gender FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def a04(spark, d):
    people = users(spark, d).select("uid", F.lit("2017-06-29T00:00:00Z").alias("reg_date"), "device", "gender", "country", "age")
    return csv_round_trip(people, R.USERS_SCHEMA)


@query("a05_semicolon_csv", "category_id:long, price:double2", "SELECT user_id AS category_id, value AS price FROM events")
def a05(spark, d):
    prices = R.table(spark, d, "events").select(F.col("user_id").alias("category_id"), F.col("value").alias("price"))
    return csv_round_trip(prices, R.PRICES_SCHEMA, sep=";")


@query(
    "a06_csv_with_position",
    "position:long, customer_id:long",
    "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS position, c_custkey AS customer_id FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def a06(spark, d):
    chosen = sinks.export_keys(R.table(spark, d, "customer"), F.col("c_mktsegment") == "BUILDING", "c_custkey", "customer_id")
    return csv_round_trip(chosen, "position long, customer_id long", position_order=[F.col("customer_id").asc()])


@query("a07_csv_without_position", "date:date, uid:long, price:double2", "SELECT o_orderdate AS date, o_custkey AS uid, o_totalprice AS price FROM orders")
def a07(spark, d):
    bought = purchases(spark, d).select(F.to_date("date").cast("string").alias("date"), "uid", "price")
    return csv_round_trip(bought, R.PURCHASES_SCHEMA)


@query(
    "a08_partitioned_result",
    "o_orderpriority:str, n:long, total:double2",
    "SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1",
)
def a08(spark, d):
    path = _path(spark, "result")
    sinks.write_table(R.table(spark, d, "orders").withColumn("year", F.year("o_orderdate")), path, ["year"])
    kept = spark.read.parquet(path).where(F.col("year") == 1998)
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query(
    "a09_stored_train_and_test",
    "side:str, n:long, balance:double2",
    "SELECT CASE WHEN c_acctbal >= 0 THEN 'train' ELSE 'test' END AS side, count(*) AS n, sum(c_acctbal) AS balance FROM customer GROUP BY 1",
)
def a09(spark, d):
    customers = R.table(spark, d, "customer")
    train, test = materialise(customers.where(F.col("c_acctbal") >= 0)), materialise(customers.where(F.col("c_acctbal") < 0))
    total = [F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("balance")]
    return train.agg(F.lit("train").alias("side"), *total).unionByName(test.agg(F.lit("test").alias("side"), *total))


@query(
    "a10_snapshot",
    "n_before:long, n_after:long",
    "SELECT (SELECT count(*) FROM lineitem) AS n_before, (SELECT count(*) FROM lineitem WHERE l_quantity > 25) AS n_after",
)
def a10(spark, d):
    lines = R.table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    snapshot = materialise(lines)
    changed = lines.where(F.col("l_quantity") > 25)
    return snapshot.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(changed.agg(F.count(F.lit(1)).alias("n_after")))


@query("a11_key_table", "uk_customers:long", "SELECT c_custkey AS uk_customers FROM customer WHERE c_nationkey = 7")
def a11(spark, d):
    return sinks.export_keys(R.table(spark, d, "customer"), F.col("c_nationkey") == 7, "c_custkey", "uk_customers")
