import hashlib
import math

import pytest

from riskweave.operators.split import mark_test, quota_table, quotas, split


@pytest.mark.parametrize("counts", [[10], [3, 7], [1, 1, 1], [97, 2, 1], [138, 165], [0, 5], [5]])
def test_quotas_add_up(counts):
    q = quotas(counts, 0.2)
    assert sum(q) == math.ceil(0.2 * sum(counts))
    assert all(0 <= t <= c for t, c in zip(q, counts))


def brute(rows, share):
    total = {}
    for k, c in rows:
        total.setdefault(c, []).append(k)
    classes = sorted(total, key=lambda c: (c is not None, c))
    out = set()
    for c, q in zip(classes, quotas([len(total[c]) for c in classes], share)):
        out |= set(sorted(total[c], key=lambda k: (hashlib.md5(str(k).encode()).hexdigest(), k))[:q])
    return out


def test_stratified_split_matches_ranking(spark):
    rows = [(i, "a" if i % 10 else ("b" if i % 20 else None)) for i in range(777)]
    df = spark.createDataFrame(rows, "k long, c string")
    want = brute(rows, 0.2)
    for parts in (1, 6):
        for rank_rows in (10**6, 2):  # ranked at once, or after splitting hash prefixes
            marked = mark_test(df.repartition(parts), ["k"], 0.2, "c", rank_rows=rank_rows).collect()
            assert {r["k"] for r in marked if r["is_test"]} == want
    train, test = split(df, ["k"], 0.2, "c", seed=42)
    assert test.count() == math.ceil(0.2 * 777) and train.count() + test.count() == 777
    assert train.intersect(test).count() == 0


def test_split_on_text_keys_and_tiny_tables(spark):
    df = spark.createDataFrame([("x",), ("y",)], "k string")
    assert mark_test(df, ["k"]).where("is_test").count() == 1
    assert mark_test(df.where("k = 'none'"), ["k"]).count() == 0


def test_both_ways_of_ranking_classes_agree(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 3), (None, 7), ("c", 1), ("d", 3)], "c string, n long")
    both = [sorted(map(str, map(tuple, quota_table(counts, 0.2, few).collect()))) for few in (True, False)]
    assert both[0] == both[1] and sum(r["q"] for r in quota_table(counts, 0.2, True).collect()) == math.ceil(0.2 * 17)
