import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import forest as R


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(7)
    n = 900
    x = np.column_stack([r.normal(size=n), r.integers(0, 5, n), r.integers(0, 2, n), np.exp(r.normal(size=n) * 3), np.full(n, 4.0)])
    y = ((x[:, 0] + 0.5 * x[:, 1] + r.normal(size=n) * 0.5) > 1).astype(int)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y int").repartition(5).cache()


COLS = ["a", "b", "c", "d", "e"]


def brute(codes, y, w, tree, usable, depth, seed, rows=None, node=1):
    """Nodes of a tree by trying every cut of the features a node may use."""
    rows = np.flatnonzero(w) if rows is None else rows
    n = [int(w[rows][y[rows] == k].sum()) for k in (0, 1)]
    best = None
    if min(n) and node.bit_length() <= depth:
        differ = [f for f in R.feature_order(tree, node, codes.shape[1], seed) if len(set(codes[rows, f])) > 1]
        if usable == codes.shape[1]:
            differ = sorted(differ)
        for f in differ[:usable]:
            for c in sorted(set(codes[rows, f]))[:-1]:
                score = 0.0
                for side in (rows[codes[rows, f] <= c], rows[codes[rows, f] > c]):
                    k = [float(w[side][y[side] == v].sum()) for v in (0, 1)]
                    score += (k[0] * k[0] + k[1] * k[1]) / (k[0] + k[1])
                if best is None or (score, -f, -int(c)) > best[:3]:
                    best = (score, -f, -int(c))
    if best is None:
        return [(tree, node, -1, 0, *n)]
    f, c = -best[1], -best[2]
    left = codes[rows, f] <= c
    return [(tree, node, f, c, *n), *brute(codes, y, w, tree, usable, depth, seed, rows[left], 2 * node),
            *brute(codes, y, w, tree, usable, depth, seed, rows[~left], 2 * node + 1)]


def nodes_of(f):
    return sorted(zip(*[v.tolist() for v in (f.tree, f.node, f.feature, f.code, f.n0, f.n1)]))


def test_cuts_follow_ranks_also_of_long_tails(frame, data):
    x, _ = data
    cuts = R.find_cuts(frame, COLS, 16)
    assert [len(c) for c in cuts[1:3]] == [4, 1] and len(cuts[4]) == 0
    for i in (0, 3):  # the fourth column spans some eight powers of ten
        shares = np.diff(np.concatenate([[0], np.searchsorted(np.sort(x[:, i]), cuts[i], side="right"), [len(x)]])) / len(x)
        assert 12 <= len(cuts[i]) <= 15 and shares.max() < 3 / 16 and set(cuts[i]) <= set(x[:, i])
    codes = R.coded([x[:, i] for i in range(5)], cuts)
    assert (codes[:, 1] == x[:, 1]).all() and codes[:, 4].max() == 0


@pytest.mark.parametrize("local", [0, 60, 10**6])
@pytest.mark.parametrize("trees, depth, usable, bagged", [(1, 5, 5, False), (4, 6, 2, True)])
def test_trees_equal_brute_force(frame, data, local, trees, depth, usable, bagged):
    x, y = data
    f = R.fit_forest(frame, COLS, "y", "id", trees, depth, 32, usable, bagged, 3, local)
    codes = R.coded([x[:, i] for i in range(5)], f.cuts)
    want = []
    for t in range(trees):
        w = R.bag_weights(np.arange(len(y), dtype=np.uint64), t, 3) if bagged else np.ones(len(y), dtype=int)
        want += brute(codes, y, w, t, usable, depth, 3)
    assert nodes_of(f) == sorted(want)


def test_few_open_nodes_at_once_change_nothing(frame, monkeypatch):
    whole = nodes_of(R.fit_forest(frame, COLS, "y", "id", 3, 4, 16, local_rows=0))
    monkeypatch.setattr(R, "HISTOGRAM_BYTES", 1)
    monkeypatch.setattr(R, "BRANCH_BYTES", 1)
    assert nodes_of(R.fit_forest(frame.repartition(2), COLS, "y", "id", 3, 4, 16, local_rows=0)) == whole
    assert nodes_of(R.fit_forest(frame.repartition(2), COLS, "y", "id", 3, 4, 16, local_rows=200)) == whole


def test_unbounded_trees_fit_their_bags_and_predict(frame, data):
    x, y = data
    f = R.fit_forest(frame, COLS, "y", "id", 20, 30, 256)
    assert f.depth > 8
    scored = f.transform(frame).orderBy("id").collect()
    codes = R.coded([x[:, i] for i in range(5)], f.cuts)
    for r in scored[:40]:
        shares = []
        for t in range(20):
            at = int(f.roots[t])
            while f.feature[at] >= 0:
                at = int(f.left[at]) + int(codes[r["id"], f.feature[at]] > f.code[at])
            shares.append(f.n1[at] / (f.n0[at] + f.n1[at]))
        assert r["probability_1"] == pytest.approx(sum(shares) / 20) and r["prediction"] == float(r["probability_1"] > 0.5)
    assert np.mean([r["prediction"] == r["y"] for r in scored]) > 0.95
    weights = dict(zip(COLS, f.importances()))
    assert sum(weights.values()) == pytest.approx(1.0) and weights["e"] == 0 and max(weights, key=weights.get) == "a"


def test_bags_are_poisson_and_draws_spread():
    w = R.bag_weights(np.arange(200_000, dtype=np.uint64), 5, 42)
    for k in range(4):
        assert abs((w == k).mean() - math.exp(-1) / math.factorial(k)) < 0.004
    other = R.bag_weights(np.arange(200_000, dtype=np.uint64), 6, 42)
    assert abs(np.corrcoef(w, other)[0, 1]) < 0.01
    first = [R.feature_order(1, n, 10, 42)[0] for n in range(5000)]
    assert np.bincount(first, minlength=10).min() > 400


def test_edges(spark, frame):
    alone = R.fit_forest(frame.withColumn("y", F.lit(1)), COLS, "y", "id", 3, 5)
    assert nodes_of(alone) == [(t, 1, -1, 0, 0, n) for t, n in enumerate(alone.n1.tolist())] and alone.importances().sum() == 0
    assert alone.transform(frame).where("prediction = 1").count() == 900
    with pytest.raises(ValueError):
        R.fit_tree(frame.limit(0), COLS, "y", "id")
    with pytest.raises(ValueError):
        R.fit_tree(frame, [], "y", "id")
    named = R.fit_tree(frame.withColumn("id", F.col("id").cast("string")), COLS, "y", "id", 2)
    table = {r["node"]: r for r in named.table(spark).collect()}
    root = table[1]
    sides = frame.groupBy((F.col(root["feature"]) <= root["cut"]).alias("s")).count().collect()
    assert {r["s"]: r["count"] for r in sides} == {True: table[2]["n0"] + table[2]["n1"], False: table[3]["n0"] + table[3]["n1"]}


def test_work_of_a_forest_follows_what_it_needs(spark, frame, data, monkeypatch):
    """Values are counted where they lie, nodes count the features they may use, and leaves are neither counted nor dealt to tasks."""
    passes, branches = [], []
    level, deal = R._level, R._branches
    monkeypatch.setattr(R, "_level", lambda *a: passes.append((a[2], a[4])) or level(*a))
    monkeypatch.setattr(R, "_branches", lambda *a: branches.append(a[2]) or deal(*a))
    monkeypatch.setattr(R.F, "inline", lambda *_: pytest.fail("a row per value"))
    wide = frame.select("*", *[(F.col("a") * i + F.col("b")).alias(f"f{i}") for i in range(2, 8)])
    cols = [*COLS, *[f"f{i}" for i in range(2, 8)]]
    f = R.fit_forest(wide, cols, "y", "id", 3, 3, 16, local_rows=400)
    assert f.depth == 3 and not branches
    assert max(n.bit_length() for nodes, _ in passes for _, n in nodes) == 3  # the nodes of the last level are leaves
    assert passes[0][1] == 3 + R.SPARE < len(cols)
    x, y = data
    rows = wide.orderBy("id").select(*cols).collect()
    codes = R.coded([np.array([r[c] for r in rows], dtype=float) for c in cols], f.cuts)
    want = [n for t in range(3) for n in brute(codes, y, R.bag_weights(np.arange(len(y), dtype=np.uint64), t, 42), t, 3, 3, 42)]
    assert nodes_of(f) == sorted(want)


def test_columns_that_do_not_differ_put_no_node_off_for_good(spark, frame, data):
    """Nine of ten columns are constant in all rows or below the first split."""
    same = [F.lit(1.0).alias(f"s{i}") for i in range(5)] + [(F.col("c") * i).alias(f"t{i}") for i in range(1, 5)]
    wide, cols = frame.select("id", "y", "c", *same), ["c", *[f"s{i}" for i in range(5)], *[f"t{i}" for i in range(1, 5)]]
    f = R.fit_forest(wide, cols, "y", "id", 4, 6, 16, local_rows=0)
    rows = wide.orderBy("id").collect()
    codes = R.coded([np.array([r[c] for r in rows], dtype=float) for c in cols], f.cuts)
    y = data[1]
    want = [n for t in range(4) for n in brute(codes, y, R.bag_weights(np.arange(len(y), dtype=np.uint64), t, 42), t, 3, 6, 42)]
    assert nodes_of(f) == sorted(want)


def test_cells_count_every_value(spark):
    rows = [(float(v),) for v in (3, 3, -1, 0.5, 7, 7, 7)] + [(None,), (float("inf"),)]
    df = spark.createDataFrame(rows, "x0 double").repartition(3)
    got = sorted((r["g"], r["cell"], r["n"], r["least"], r["most"]) for r in R._count_cells(df, [(0, -1.0, 7.0), (0, 3.0, 3.0)], 4))
    assert got == [(0, 0, 2, -1.0, 0.5), (0, 2, 2, 3.0, 3.0), (0, 3, 3, 7.0, 7.0), (1, 0, 2, 3.0, 3.0)]
    odd = spark.createDataFrame([(float(i), float("nan") if i == 5 else float(i), None) for i in range(50)], "a double, b double, c double")
    cuts = R.find_cuts(odd, ["a", "b", "c"], 8)
    assert len(cuts[0]) == 7 and not len(cuts[1]) and not len(cuts[2])


def test_labels_that_are_null_are_an_error(frame):
    with pytest.raises(Exception, match="(?i)null"):
        R.fit_tree(frame.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), COLS, "y", "id", 2)
