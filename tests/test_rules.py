from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import rules


def brute_itemsets(baskets, support):
    items = sorted(set().union(*baskets))
    out = {}
    for n in range(1, len(items) + 1):
        for c in combinations(items, n):
            freq = sum(set(c) <= b for b in baskets)
            if freq and freq / len(baskets) >= support:
                out[c] = freq / len(baskets)
    return out


def brute_rules(found, confidence):
    out = {}
    for items, s in found.items():
        for n in range(1, len(items)):
            for a in combinations(items, n):
                c = tuple(sorted(set(items) - set(a)))
                if s / found[a] >= confidence:
                    out[a, c] = (s, s / found[a], s / found[a] / found[c])
    return out


def as_dict(df):
    return {(tuple(r["antecedents"]), tuple(r["consequents"])): (r["support"], r["confidence"], r["lift"]) for r in df.collect()}


def test_hand_example_counts_empty_baskets(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (1, 1, 0), (0, 0, 0)], "a int, b int, c int")
    frequent = rules.itemsets(df, ["a", "b", "c"], 0.1)
    support = {tuple(r["items"]): r["support"] for r in frequent.collect()}
    assert support["a", "b"] == 0.75 and len(support) == 7
    got = as_dict(rules.rules(frequent, 0.6))
    assert got[("a", "b"), ("c",)][1:] == pytest.approx((2 / 3, 4 / 3))
    assert got[("c",), ("a", "b")][1:] == pytest.approx((1.0, 4 / 3))


@pytest.mark.parametrize("n_items", [5, 9, 14])
def test_matches_enumeration(spark, n_items):
    rng = np.random.default_rng(n_items)
    names = [f"i{j:02d}" for j in range(n_items)]
    base = rng.random(n_items) * (0.7 if n_items < 12 else 0.4)
    rows = (rng.random((300, n_items)) < base).astype(int).tolist()
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names))
    baskets = [{n for n, v in zip(names, r) if v} for r in rows]
    want = brute_itemsets(baskets, 0.1) if n_items < 12 else None
    frequent = rules.itemsets(df, names, 0.1)
    got = {tuple(r["items"]): r["support"] for r in frequent.collect()}
    if want is not None:
        assert got == pytest.approx(want)
        got_rules, want_rules = as_dict(rules.rules(frequent, 0.6)), brute_rules(want, 0.6)
        assert got_rules.keys() == want_rules.keys() and len(want_rules) > 0
        assert all(got_rules[k] == pytest.approx(v) for k, v in want_rules.items())
    else:  # the wide path against the same enumeration over its frequent single items
        single = sorted({i for s in got for i in s})
        assert got == pytest.approx(brute_itemsets([b & set(single) for b in baskets], 0.1))


def test_null_flags_are_left_out_and_empty_result(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (0, 0)], "a int, b int")
    assert {tuple(r["items"]): r["support"] for r in rules.itemsets(df, ["a", "b"], 0.1).collect()} == {
        ("a",): 0.5, ("b",): 0.5, ("a", "b"): 0.5}
    none = rules.itemsets(df, ["a", "b"], 1.1)
    found = rules.rules(none)
    assert none.count() == 0 and found.count() == 0
    assert found.columns == ["antecedents", "consequents", "support", "confidence", "lift"]
    assert rules.array_itemsets(spark.createDataFrame([], "items array<string>")).count() == 0


def test_baskets_from_events_and_order_of_top_rules(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x"), (2, "y"), (3, "q")], "k int, item string")
    masks = rules.basket_masks(df, ["k"], "item", ["x", "y"])
    assert {r["k"]: r["mask"] for r in masks.collect()} == {1: 3, 2: 2, 3: 0}
    top = rules.top_rules(rules.rules(rules.mask_itemsets(masks, ["x", "y"], 0.1), 0.1), 1).first()
    assert top["antecedents"] == ["x"] and top["lift"] == pytest.approx(1.5)


def test_expansion_happens_after_collapse(spark):
    masks = spark.range(100000).select((F.col("id") % 16).cast("int").alias("mask"))
    plan = rules.mask_itemsets(masks, ["a", "b", "c", "d"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [mask")  # the root prints first


@pytest.mark.parametrize("block, candidates", [(1 << 16, 1 << 18), (64, 7)])
def test_bitmaps_find_all_sets_of_many_items(spark, monkeypatch, block, candidates):
    monkeypatch.setattr(rules, "BLOCK", block)
    monkeypatch.setattr(rules, "CANDIDATES", candidates)
    rng = np.random.default_rng(5)
    names = [f"i{j:02d}" for j in range(16)]
    baskets = [[n for n, v in zip(names, row) if v] for row in rng.random((700, 16)) < np.linspace(0.7, 0.02, 16)]
    rows = [(b + b[:1],) for b in baskets] + [([],), ([None],), (None,), (["only"],)]
    got = rules.vertical_itemsets(spark.createDataFrame(rows, "items array<string>").repartition(5), 0.15).collect()
    want = brute_itemsets([set(b) for b in baskets] + [set(), set(), {"only"}], 0.15)
    assert {tuple(r["items"]): r["support"] for r in got} == pytest.approx(want) and max(map(len, want)) > 3
    assert all(r["n_items"] == len(r["items"]) for r in got)


def test_thirteenth_item_goes_to_bitmaps(spark):
    rows = [(b, f"v{j:02d}") for b in range(40) for j in range(13) if (b + j) % 3]
    df = spark.createDataFrame(rows, "b int, v string")
    baskets = [{v for k, v in rows if k == b} for b in range(40)]
    got = {tuple(r["items"]): r["support"] for r in rules.basket_itemsets(df, ["b"], "v", 0.5).collect()}
    assert got == pytest.approx(brute_itemsets(baskets, 0.5)) and rules.item_values(df, "v") is None


def test_empty_tables_and_too_many_sets(spark, monkeypatch):
    empty = spark.createDataFrame([], "items array<string>")
    assert rules.vertical_itemsets(empty).count() == 0 and rules.vertical_itemsets(empty).columns == ["items", "freq", "n_items", "support"]
    assert rules.rules(rules.vertical_itemsets(spark.createDataFrame([(["a"],), (["b"],)], "items array<string>"), 0.9)).count() == 0
    monkeypatch.setattr(rules, "MAX_SETS", 3)
    with pytest.raises(ValueError):
        rules.vertical_itemsets(spark.createDataFrame([(["a", "b", "c"],)], "items array<string>"), 0.5)


def test_both_ways_of_splitting_give_the_same_rules(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1, 1, 0), (1, 1, 1, 1), (1, 1, 0, 1), (0, 1, 1, 1), (0, 0, 0, 0)], "a int, b int, c int, d int")
    frequent = rules.itemsets(df, ["a", "b", "c", "d"], 0.2)
    at_once = as_dict(rules.rules(frequent, 0.5))
    monkeypatch.setattr(rules, "MASK_ITEMS", 1)
    assert as_dict(rules.rules(frequent, 0.5)) == at_once and len(at_once) > 10
