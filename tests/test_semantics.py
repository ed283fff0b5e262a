"""Hand-made rows for the rules that differ from Spark's defaults."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronlens.functions import columns as C
from patronlens.operators import binning, encoding, impute, outliers, profile
from patronlens.plans import basket, cltv, cohort, persona, recipes, rfm

LINE = "invoice string, stock_code string, description string, quantity double, invoice_date timestamp, price double, customer_id long, country string"
DAY = dt.datetime(2011, 12, 8, 12, 50)


def line(invoice="1", stock="s", text="t", quantity=1.0, date=DAY, price=2.0, customer=1, country="X"):
    return (invoice, stock, text, quantity, date, price, customer, country)


def values(df, column, key):
    return [r[column] for r in df.orderBy(key).collect()]


def test_cancelled_means_contains_c_and_keeps_null(spark):
    lines = spark.createDataFrame([line("C536379"), line("5363C9"), line(None), line("536365")], LINE)
    assert {r.invoice for r in rfm.drop_cancelled(lines).collect()} == {None, "536365"}


def test_cleaning(spark):
    rows = [line(quantity=q) for q in (0.0, -1.0, 1.0)] + [line(customer=None), line(text=None)]
    out = rfm.clean_retail(spark.createDataFrame(rows, LINE)).collect()
    assert len(out) == 1 and out[0].total_price == 2.0


def test_elapsed_days_round_down(spark):
    df = spark.createDataFrame([(DAY, dt.datetime(2011, 12, 11))], "a timestamp, b timestamp")
    assert df.select(C.elapsed_days("b", "a").alias("d")).first().d == 2


def test_rfm_counts_lines_and_default_date(spark):
    lines = spark.createDataFrame([line(), line(), line(customer=2, date=DAY - dt.timedelta(days=5))], LINE)
    got = {r.customer_id: (r.recency, r.frequency, r.monetary) for r in rfm.rfm_metrics(rfm.sales_lines(lines)).collect()}
    assert got == {1: (1, 2, 4.0), 2: (6, 1, 2.0)}


def test_capping_keeps_null_and_low_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,), (-1e6,), (None,)], "x double")
    out = [r.x for r in outliers.cap_upper(df, ["x"], 0.25, 0.75).collect()]
    assert None in out and -1e6 in out and max(v for v in out if v is not None) < 200


def test_quantile_bins_keep_ties_together(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 2, 2, 3, 4, 5, 6])], "i int, x double")
    out = binning.qcut(df, {"b": ("x", [1, 2, 3])})
    by_value = {}
    for r in out.collect():
        by_value.setdefault(r.x, set()).add(r.b)
    assert all(len(b) == 1 for b in by_value.values()) and by_value[1.0] == {1} and by_value[6.0] == {3}


def test_coinciding_edges_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double")
    with pytest.raises(Exception, match="must be unique"):
        binning.qcut(df, {"b": ("x", [1, 2, 3])}).collect()


def test_age_bands_are_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in (0, 19, 20, 24, 31, 41, 75, None)], "age int")
    band = binning.cut("age", persona.AGE_EDGES + [75], persona.AGE_LABELS + ["41_75"])
    got = {r.age: r.b for r in df.select("age", band.alias("b")).collect()}
    assert got == {0: None, 19: "0_18", 20: "19_23", 24: "19_23", 31: "24_30", 41: "31_40", 75: "41_75", None: None}


def test_constant_column_scales_to_lower_bound(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert sorted(values(binning.minmax(df, {"y": "x"}, 1, 100), "y", "x"), key=str) == [1.0, 1.0, None]


def test_last_condition_wins(spark):
    df = spark.createDataFrame([(18.3, 70.0, 100.0, 30.0)], "BMI double, BloodPressure double, Glucose double, Age double")
    row = recipes.patient_bands(df).first()
    assert (row.NEW_BMI, row.NEW_BP, row.NEW_GLUCOSE, row.NEW_AGE) == ("Normal weight", "Normal", "Excellent", "Adult")


def test_sex_band_has_no_band_at_fifty(spark):
    df = spark.createDataFrame([("male", 50.0), ("male", 49.0), ("female", 51.0), ("male", 21.0), ("male", None)], "s string, a double")
    got = [r.b for r in df.select(recipes.sex_band(F.col("s"), F.col("a")).alias("b")).collect()]
    assert got == [None, "maturemale", "seniorfemale", "youngmale", None]


def test_churn_zero_gives_null(spark):
    lines = spark.createDataFrame([line("1"), line("2")], LINE)
    row = cltv.cltv_formula(cltv.cltv_lines(lines), "invoices").first()
    assert row.total_transaction == 2 and row.cltv is None


def test_cohort_gap_is_null_and_year_turns(spark):
    def at(y, m, c):
        return line(date=dt.datetime(y, m, 3), customer=c)

    lines = spark.createDataFrame([at(2010, 12, 1), at(2011, 1, 1), at(2010, 12, 2), at(2011, 3, 2)], LINE)
    row = cohort.retention_matrix(cohort.cohort_table(lines), range(4)).first()
    assert (row.period_0, row.period_1, row.period_2, row.period_3) == (1.0, 0.5, None, 0.5)


def test_basket_nets_quantities_and_rules_split_every_way(spark):
    rows = [line("1", s, quantity=q) for s, q in (("a", 1.0), ("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 1.0), ("d", -1.0))]
    rows += [line("2", s) for s in "abc"] + [line("3", "a")]
    items = basket.basket_items(spark.createDataFrame(rows, LINE))
    found = basket.frequent_itemsets(items, 0.5)
    assert found.n_baskets == 3 and {tuple(r["items"]) for r in found.table.collect()} == {
        ("a",), ("b",), ("c",), ("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")}
    rules = basket.association_rules(found, min_threshold=0.5)
    assert rules.count() == 3 * 2 + 6
    sure = rules.where("antecedents = array('b') AND consequents = array('a')").first()
    assert sure.confidence == 1.0 and sure.conviction is None and sure.lift == pytest.approx(1.0)


def test_no_frequent_items(spark):
    items = basket.basket_items(spark.createDataFrame([line("1", "a", quantity=-1.0)], LINE))
    assert basket.association_rules(basket.frequent_itemsets(items, 0.5)).count() == 0


def test_rule_measures_from_supports(spark):
    df = spark.createDataFrame([(0.010079, 0.112441, 0.040000), (0.010378, 0.011040, 0.010819)], "s double, a double, c double")
    got = df.select(*[e.alias(n) for n, e in basket.rule_measures(F.col("s"), F.col("a"), F.col("c")).items()]).collect()
    assert got[0].confidence == pytest.approx(0.089636, abs=1e-5) and got[0].lift == pytest.approx(2.240896, rel=1e-3)
    assert got[0].leverage == pytest.approx(0.005581, abs=1e-5) and got[0].conviction == pytest.approx(1.054523, abs=1e-4)
    assert got[1].lift == pytest.approx(86.882857, rel=1e-3)


def test_segment_codes_are_covered_once():
    import re

    for r in "12345":
        for f in "12345":
            assert sum(bool(re.fullmatch(p, r + f)) for p, _ in rfm.SEGMENT_PATTERNS) == 1


def test_group_median_leaves_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), (None, None), (None, 5.0)], "g string, x double")
    got = sorted(((r.g, r.x) for r in impute.fill_group_median(df, "x", "g").collect()), key=str)
    assert got == sorted([("a", 1.0), ("a", 3.0), ("a", 2.0), (None, None), (None, 5.0)], key=str)


def test_mode_takes_smallest_tie(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,)], "x string")
    assert [r.x for r in impute.fill_mode(df, ["x"]).collect()].count("a") == 3


def test_levels_count_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    row = profile.distinct_counts(df).first()
    assert (row.n_distinct, row.n_levels) == (2, 3)


def test_level_counts_stop_at_the_limit(spark):
    df = spark.range(5000).selectExpr("id", "id % 21 as edge", "id % 20 as k", "if(id % 3 = 0, null, id % 2) as holes", "cast(null as int) as empty")
    assert profile.distinct_up_to(df, df.columns, 20) == {"id": None, "edge": None, "k": 20, "holes": 2, "empty": 0}
    assert profile.columns_by_levels(df, 3, 10) == ["holes"]
    assert profile.columns_by_levels(df, 21, None, "numeric") == ["id", "edge"]


def test_roles(spark):
    df = spark.createDataFrame([(i, i % 3, f"t{i}", "ab"[i % 2]) for i in range(30)], "n int, k int, free string, kind string")
    roles = profile.column_roles(df)
    assert (roles.categorical, roles.cardinal, roles.numeric, roles.numeric_categorical) == (["k", "kind"], ["free"], ["n"], ["k"])


def test_rare_and_one_hot_use_what_training_showed(spark):
    train = spark.createDataFrame([("a",)] * 50 + [("b",)] * 49 + [("c",)], "x string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    recipe = recipes.Recipe(train).rare_encode(["x"], 0.02).one_hot(["x"])
    out = [tuple(r) for r in recipe(test).select("x_a", "x_b", "x_Rare").collect()]
    assert out == [(1, 0, 0), (0, 0, 1), (0, 0, 0)]
    assert encoding.category_levels(train, ["x"]) == {"x": ["a", "b", "c"]}


def test_product_name_and_recommendation(spark):
    lines = spark.createDataFrame([line("1", "85099B", "BAG", customer=1, country="G"), line("2", "20685", "MAT", customer=2, country="H")], LINE)
    assert basket.product_name(lines, "85099B").first().description == "BAG"
    customers = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "customer_id long, segment string")
    products = spark.createDataFrame([("A", "85099B")], "segment string, recommended_product string")
    got = {r.customer_id: r.recommended_product for r in basket.recommend(customers, products, lines, "G").collect()}
    assert got == {1: "85099B", 2: "", 3: ""}
