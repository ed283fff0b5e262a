"""Readers, and the retail-line view of the star schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RETAIL_SCHEMA = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("invoice_date", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)
USERS_SCHEMA = "uid long, reg_date string, device string, gender string, country string, age int"
PURCHASES_SCHEMA = "date string, uid long, price double"
PRICES_SCHEMA = "category_id long, price double"

RETAIL_COLUMNS = tuple(RETAIL_SCHEMA.names)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Retail lines stored as one folder per sheet (``sheet=<name>``); a sheet is a pruned partition."""
    schema = T.StructType(RETAIL_SCHEMA.fields + [T.StructField("sheet", T.StringType())])
    lines = spark.read.schema(schema).parquet(path)
    return lines if sheet is None else lines.where(F.col("sheet") == sheet)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV lines whose identifiers stay text and whose dates are parsed."""
    raw = read_csv(spark, path, "CustomerID string, InvoiceNo string, InvoiceDate string")
    return raw.withColumn("InvoiceDate", F.to_timestamp("InvoiceDate"))


def retail_lines(spark: SparkSession, folder: str, columns: Iterable[str] = RETAIL_COLUMNS) -> DataFrame:
    """Retail invoice lines built from lineitem, orders, customer, nation and part.

    Returned lines carry invoice numbers with 'C' and negative quantities; orders
    that are pending and of low priority have no known customer; parts of size 1
    have no description. Only the joins the wanted columns need are made.
    """
    columns = list(columns)
    returned = F.col("l_returnflag") == "R"
    lines = table(spark, folder, "lineitem")
    if {"customer_id", "invoice_date", "country"} & set(columns):
        lines = lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "country" in columns:
        home = (
            table(spark, folder, "customer")
            .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_name")
        )
        lines = lines.join(home, F.col("o_custkey") == F.col("c_custkey"))
    if "description" in columns:
        lines = lines.join(
            table(spark, folder, "part").select("p_partkey", "p_name", "p_size"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    made = {
        "invoice": lambda: F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")),
        "stock_code": lambda: F.col("l_partkey").cast("string"),
        "description": lambda: F.when(F.col("p_size") != 1, F.col("p_name")),
        "quantity": lambda: F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")),
        "invoice_date": lambda: F.col("o_orderdate").cast("timestamp"),
        "price": lambda: F.try_divide("l_extendedprice", "l_quantity"),
        "customer_id": lambda: F.when(
            ~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")), F.col("o_custkey")
        ),
        "country": lambda: F.col("n_name"),
    }
    return lines.select(*[made[c]().alias(c) for c in columns])


#: The same view as a common table expression for the SQL checks.
RETAIL_SQL = """
retail AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         CASE WHEN p_size <> 1 THEN p_name END AS description,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS quantity,
         o_orderdate AS invoice_date,
         l_extendedprice / l_quantity AS price,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN o_custkey END AS customer_id,
         n_name AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey)"""
