"""Itemsets of groups with least counts of their own, against all subsets."""

import random
import time
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from patronlens.plans import basket, itemsets


def all_sets(rows, least):
    baskets = defaultdict(set)
    for g, b, i in rows:
        baskets[g, b].add(i)
    counts = Counter((g, s) for (g, _), items in baskets.items() for k in range(1, len(items) + 1) for s in combinations(sorted(items), k))
    return {k: n for k, n in counts.items() if n >= least[k[0]]}


def some_rows(seed, groups):
    rng = random.Random(seed)
    rows = set()
    for g, (n, width) in groups.items():
        for b in range(n):
            rows |= {(g, f"{g}{b}", "common")} if rng.random() < 0.8 else set()
            rows |= {(g, f"{g}{b}", f"i{int(rng.triangular(0, 12, 2)):02d}") for _ in range(rng.randint(1, width))}
    return sorted(rows)


@pytest.mark.parametrize("small", [1, 7, itemsets.SMALL])
def test_sets_of_each_group_equal_all_subsets(spark, small):
    rows = some_rows(1, {"a": (300, 6), "b": (40, 5), "c": (2, 6), "d": (1, 1)})
    least = {"a": 25, "b": 3, "c": 1, "d": 2}
    got = itemsets.grouped_itemsets(
        spark.createDataFrame(rows, "g string, basket string, item string"), spark.createDataFrame(list(least.items()), "g string, least bigint"), "g", small
    ).collect()
    assert {(r.g, tuple(r["items"])): r.freq for r in got} == all_sets(rows, least)
    assert len(got) == len({(r.g, tuple(r["items"])) for r in got})


def test_sets_of_nothing(spark):
    held = spark.createDataFrame([], "g string, basket string, item string")
    assert itemsets.grouped_itemsets(held, spark.createDataFrame([], "g string, least bigint"), "g").collect() == []


def test_a_tiny_segment_costs_no_more_than_itself(spark):
    """300 baskets of 14 out of 40 items, least count 30, beside 3 baskets of 7, least count 1: mined as if alone."""
    rng = random.Random(3)
    large = [("large", f"l{b}", f"p{i:02d}") for b in range(300) for i in rng.sample(range(40), 14)]
    tiny = [("tiny", f"t{b}", f"p{i:02d}") for b in range(3) for i in rng.sample(range(40), 7)]

    def products(rows):
        lines = spark.createDataFrame([(g, b, i, 1) for g, b, i in rows], "segment string, invoice string, stock_code string, quantity int")
        start = time.time()
        rules = {(r.segment, tuple(r.antecedents), tuple(r.consequents), round(r.lift, 9)) for r in basket.segment_rules(lines, min_support=0.1).collect()}
        return rules, time.time() - start

    products(tiny)
    alone, took = products(large)
    of_tiny, took_tiny = products(tiny)
    both, took_both = products(large + tiny)
    assert both == alone | of_tiny
    assert took_both < 2 * (took + took_tiny) + 10


def test_the_strongest_rule_and_segments_without_one(spark):
    lines = [("a", f"{b}", i, q) for b in range(10) for i, q in (("x", 1), ("y", 2))] + [("a", f"z{b}", "x", 1) for b in range(5)]
    lines += [("b", "1b", "x", 1), ("c", "1c", "x", -1), (None, "1n", "x", 1), ("d", None, "x", 1)]
    df = spark.createDataFrame(lines, "segment string, invoice string, stock_code string, quantity int")
    assert {tuple(r) for r in basket.segment_products(df).collect()} == {("a", "y")}


def test_the_chain_offers_the_segments_product(spark):
    values = spark.createDataFrame([(i, float(i)) for i in range(1, 10)] + [(99, None)], "customer_id bigint, clv double")
    lines = []
    for c in range(1, 10):
        pair = ("p", "q") if c <= 3 else ("r", "s") if c <= 6 else ("t", "u")
        lines += [(c, f"{c}-{k}", i, 1, "here" if c % 2 else "there") for k in range(3) for i in pair]
    df = spark.createDataFrame(lines, "customer_id bigint, invoice string, stock_code string, quantity int, country string")
    got = {r.customer_id: (r.segment, r.recommended_product) for r in basket.recommend_by_value(df, values.where("clv IS NOT NULL"), "here").collect()}
    assert got == {c: (s, p if c % 2 else "") for s, p, cs in (("C", "q", range(1, 4)), ("B", "s", range(4, 7)), ("A", "u", range(7, 10))) for c in cs}
