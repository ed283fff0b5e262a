"""Tables whose columns come from the data, prices against a table of candidates, and written tables that are removed."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from patronlens.operators import reshaping
from patronlens.plans import basket, cohort, pricing
from patronlens.session import materialise, temporary_tables


def test_a_seventh_item_is_a_column(spark):
    rows = [(str(b), f"i{k}", int((b + k) % 3 == 0)) for b in range(5) for k in range(9) if (b * k) % 4 != 1]
    items = spark.createDataFrame(rows, "basket string, item string, in_basket int")
    got = basket.basket_matrix(items)
    assert got.columns == ["basket", *[f"i{k}" for k in range(9)]]
    held = {(b, i): x for b, i, x in rows}
    for r in got.collect():
        assert [r[i] for i in got.columns[1:]] == [held.get((r.basket, i), 0) for i in got.columns[1:]]
    cells = {r.basket: [(c.level, c.value) for c in r.cells] for r in basket.basket_cells(items).collect()}
    assert cells == {str(b): sorted((i, x) for k, i, x in rows if k == str(b)) for b in range(5)}
    assert basket.basket_matrix(items.limit(0)).columns == ["basket"]


def test_an_81st_month_is_a_column(spark):
    dates = [(1, dt.datetime(2000 + m // 12, m % 12 + 1, 3)) for m in (0, 1, 95)] + [(2, dt.datetime(2000, 1, 9))]
    lines = spark.createDataFrame(dates, "customer_id long, invoice_date timestamp")
    got = cohort.retention_matrix(cohort.cohort_table(lines))
    assert got.columns == ["cohort", "period_0", "period_1", "period_95"]
    assert tuple(got.first())[1:] == (1.0, 0.5, 0.5)


def test_more_levels_than_columns_are_an_error(spark):
    df = spark.range(30).select("id", F.col("id").cast("string").alias("level"))
    with pytest.raises(ValueError, match="sparse_cells"):
        reshaping.wide_cells(df, ["id"], "level", F.count("id"), widest=29)
    assert len(reshaping.levels_of(df.unionByName(spark.sql("SELECT 1L id, CAST(NULL AS STRING) level")), "level", 30)) == 30
    one = reshaping.sparse_cells(df.withColumn("id", F.lit(1)), ["id"], "level", F.count("id")).first()
    assert len(one.cells) == 30


def test_prices_against_a_table_of_candidates(spark):
    rng = random.Random(3)
    sales = [(rng.choice("aaab"), rng.choice([None, float("nan"), *range(40)])) for _ in range(2000)] + [(None, 5.0)]
    asked = [(c, p / 8) for c in "abc" for p in range(-8, 400)] * 2 + [("a", None), (None, 1.0)]
    df = spark.createDataFrame([(c, None if p is None else float(p)) for c, p in sales], "kind string, price double")
    got = pricing.price_table_scenarios(df, "kind", "price", spark.createDataFrame(asked, "kind string, candidate double"))
    known = [(c, p) for c, p in sales if c and p is not None and p == p]
    want = {(c, p): sum(1 for k, x in known if k == c and x >= p) for c, p in asked if c and p is not None}
    rows = got.collect()
    assert len(rows) == len(want) and {(r.kind, r.candidate): r.buyers for r in rows} == want
    assert all(r.income == r.buyers * r.candidate for r in rows)
    few = {(r.kind, r.candidate): r.buyers for r in pricing.price_scenarios(df.where("NOT isnan(price)"), "kind", "price", [0.5, 7.0]).collect()}
    assert all(want[k] == n for k, n in few.items())
    assert pricing.price_table_scenarios(df.limit(0), "kind", "price", spark.createDataFrame(asked[:3], "kind string, candidate double")).collect()[0].buyers == 0


def test_written_tables_are_removed(spark):
    outside = materialise(spark.range(3))
    with temporary_tables(spark) as paths:
        assert materialise(spark.range(5)).count() == 5
        with temporary_tables(spark) as inner:
            materialise(spark.range(2))
        assert len(paths) == len(inner) == 1 and os.path.isdir(paths[0]) and not os.path.exists(inner[0])
    assert not os.path.exists(paths[0])
    with pytest.raises(RuntimeError), temporary_tables(spark) as paths:
        materialise(spark.range(5))
        raise RuntimeError
    assert paths and not os.path.exists(paths[0])
    assert outside.count() == 3
