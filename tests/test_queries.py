"""Every named query against its SQL in DuckDB, or against its invariants, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from patronlens.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(name, spark, duck):
    df = QUERIES[name].run(spark, FOLDER)
    cur = duck.execute(QUERIES[name].check_sql())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_has_rows(name, spark):
    rows = QUERIES[name].run(spark, FOLDER).collect()
    assert rows
    for row in rows:
        for column, value in row.asDict().items():
            if column in ("p_value", "normality_p", "variance_p", "precision", "recall", "f1", "accuracy", "auc", "importance"):
                assert value is None or 0.0 <= value <= 1.0, (name, row)


def test_entry_points(spark):
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(QUERIES) <= set(spark_entry.queries())
    assert 0 < spark_entry.entry(spark).count() <= 10


def test_holdout_is_a_partition(spark):
    row = QUERIES["o01_holdout_split"].run(spark, FOLDER).first()
    assert row.n_train + row.n_test == 150 and row.n_shared == 0 and 20 <= row.n_test <= 70


def test_predicted_value_segments(spark):
    rows = QUERIES["k17_predicted_value"].run(spark, FOLDER).collect()
    sizes = [sum(r.cltv_p_segment == s for r in rows) for s in "ABC"]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 2
    assert min(r.cltv_p for r in rows) == 1.0 and max(r.cltv_p for r in rows) == 100.0
    assert all(0 <= r.exp_sales_1_month <= r.exp_sales_3_month for r in rows)
