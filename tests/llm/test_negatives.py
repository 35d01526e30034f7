import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import negatives


def brute(points, every, k=5, low=80, high=100):
    """``points``: distinct (id, label, whole vector)."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in points:
        if a[0] % every:
            continue
        scored = sorted(((dot(a[2], b[2]), b) for b in points if b != a), key=lambda s: (-s[0], s[1][0]))
        for score, p in [s for s in scored if s[1][1] == a[1]][:k]:
            hard = [s for s in scored if s[1][1] != a[1] and low * score <= 100 * s[0] <= high * score][:k]
            out += [(a[0], p[0], n + 1, h[1][0], score, h[0]) for n, h in enumerate(hard)]
    return sorted(out)


def rows_of(df):
    return sorted((r["anchor"], r["positive"], r["rank"], r["negative"], r["positive_score"], r["negative_score"]) for r in df.collect())


def clustered(seed, n, d, labels=4):
    r = random.Random(seed)
    centres = [[r.randrange(-40, 60) for _ in range(d)] for _ in range(5)]
    return [(i, r.randrange(labels), tuple(c + r.randrange(-4, 5) for c in r.choice(centres))) for i in range(n)]


@pytest.mark.parametrize("block, slab, leaf", [(4096, 16384, 128), (3, 40, 8), (7, 100, 3)])
def test_mining_equals_brute_force(spark, block, slab, leaf):
    points = clustered(block, 240, 6)
    points += [(300 + i, i % 3, points[0][2]) for i in range(60)] + [(500, 0, ()), (510, 1, ()), (520, 0, points[3][2][:2])]
    df = spark.createDataFrame([(i, label, list(x)) for i, label, x in points], "id long, label long, x array<long>").repartition(5)
    got = negatives.mine(df, F.col("id") % 10 == 0, block_rows=block, slab_rows=slab, leaf_rows=leaf)
    assert rows_of(got) == brute(points, 10)


def test_every_row_is_in_one_leaf_of_bounded_size(spark):
    points = [(i, i % 2, (5, 5)) for i in range(500)]  # one vector for all
    df = negatives.materialize(spark.createDataFrame([(i, b, list(x)) for i, b, x in points], "id long, label long, x array<long>"), "points")
    index, width = negatives.build_index(df, 64, 16)
    leaves = index.collect()
    ids = [np.frombuffer(r["ids"], np.int64) for r in leaves]
    assert width == 2 and sorted(np.concatenate(ids).tolist()) == list(range(500)) and max(map(len, ids)) <= 16
    assert len({r["slab"] for r in leaves}) >= 4


def test_boxes_hold_all_scores_and_are_pruned():
    r = np.random.default_rng(4)
    x = (r.normal(size=(600, 3)) * 20 + r.choice([-200, 0, 300], size=(600, 1))).astype(np.int64)
    label, ids = r.integers(0, 3, 600), np.arange(600)
    order = negatives.str_order(x, label, ids, 10)
    tree = negatives.pack_tree([ids[o] for o in order], [label[o] for o in order], [x[o] for o in order], 4)
    assert len(tree.low) > len(order) and (tree.low[-1] == x.min(axis=0)).all() and (tree.high[-1] == x.max(axis=0)).all()
    query = negatives.Queries(ids[:20], label[:20], x[:20], [[(-math.inf, math.inf, 0), (100.0, 5000.0, 1)]] * 20, False, 5)
    found = sorted(negatives.search(tree, query))
    want = []
    for i in range(20):
        score = x @ x[i]
        for window, (a, b) in enumerate([(-math.inf, math.inf), (100, 5000)]):
            fit = [(-int(s), int(j)) for j, s in enumerate(score) if label[j] != label[i] and a <= s <= b]
            want += [(i, window, -s, j) for s, j in sorted(fit)[:5]]
    assert found == sorted(want)


def test_what_takes_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [0.5, -0.001]), (1, 0, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan]), (6, 1, [-inf]),
            (None, 1, [1.0]), (7, 2, []), (8, 2, [1e-9, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"id": F.lit(9), "x": F.lit("clash")})
    got = sorted((r["id"], r["label"], r["x"]) for r in negatives.quantised(df, "vec_id", "label", "embedding", 256).collect())
    assert got == [(1, 0, [128, -1]), (7, 2, []), (8, 2, [0, 768])]
    assert negatives.mine(negatives.quantised(df.limit(0), "vec_id", "label", "embedding", 256), F.lit(True)).count() == 0
    assert rows_of(negatives.mine(negatives.quantised(df, "vec_id", "label", "embedding", 256), F.lit(True))) == brute(got, 1) == [(7, 8, 1, 1, 0, 0)]  # an empty vector scores 0


def test_large_components_stay_exact_or_are_refused():
    big = np.array([[2**30, 1]])
    assert negatives.exact_kind(big, big) is np.int64 and negatives.exact_kind(big, np.array([[3, 4]])) is np.float64
    with pytest.raises(ArithmeticError):
        negatives.exact_kind(big * 4, big * 4)
