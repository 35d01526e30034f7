"""Cases beyond the given tables: wide, skewed, far from the origin, or started from elsewhere."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import cluster, features, rules
from riskweave.operators.split import mark_test
from riskweave.sources import files


def test_more_classes_than_any_bound(spark):
    df = spark.range(3003).select("id", (F.col("id") % 1001).alias("c"))
    marked = mark_test(df, ["id"], 0.2, "c")
    assert marked.where("is_test").count() == 601 and marked.count() == 3003
    assert marked.groupBy("c").agg(F.count_if("is_test").alias("n")).where("n > 1").count() == 0


def test_more_categories_than_columns_can_take(spark):
    df = spark.range(2002).select("id", F.concat(F.lit("v"), F.col("id") % 1001).alias("c"))
    assert len(features.fit_one_hot(df, ["c"])["c"]) == 1001
    placed = features.index_categories(df, "c", "place")
    assert placed.agg(F.min("place"), F.max("place"), F.count_distinct("c", "place")).first()[:] == (0, 1000, 1001)


def test_both_itemset_paths_round_alike(spark):
    df = spark.range(100).select((F.col("id") < 7).cast("int").alias("a"), (F.col("id") < 7).cast("int").alias("b"))
    by_mask = rules.itemsets(df, ["a", "b"], 0.07)
    arrays = df.select(F.array_compact(F.array(F.when(F.col("a") == 1, "a"), F.when(F.col("b") == 1, "b"))).alias("items"))
    found = lambda x: sorted((tuple(r["items"]), r["freq"]) for r in x.collect())
    assert found(by_mask) == found(rules.array_itemsets(arrays, 0.07)) == [(("a",), 7), (("a", "b"), 7), (("b",), 7)]


def test_rules_of_an_itemset_of_40_items(spark):
    names = [f"i{k:02}" for k in range(40)]
    rows = [(names, 10, 40, 0.1)] + [([n], 50, 1, 0.5) for n in names]
    rows += [([n for n in names if n != m], 10 if m == "i00" else 60, 39, 0.1 if m == "i00" else 0.6) for m in names]
    found = rules.rules(spark.createDataFrame(rows, rules.ITEMSET_SCHEMA), 0.9).collect()
    assert [(r["consequents"], len(r["antecedents"]), r["confidence"]) for r in found] == [(["i00"], 39, 1.0)]


def test_item_values_come_from_the_data(spark):
    df = spark.createDataFrame([("x",), ("new",), (None,)], "v string")
    assert rules.item_values(df, "v") == ["new", "x"]
    assert rules.item_values(spark.range(20).select(F.col("id").cast("string").alias("v")), "v") is None  # bitmaps take over


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8])
def test_kmeans_cost_far_from_the_origin(spark, offset):
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(0, 1, (100, 2)), r.normal(8, 1, (100, 2))]).round(6)
    points = spark.createDataFrame([((row + offset).tolist(),) for row in x], "x array<double>")
    centers = np.array([[0.0, 0.0], [8.0, 8.0]]) + offset
    want = min_dist = (((x[:, None] - (centers - offset)) ** 2).sum(axis=2)).min(axis=1).sum()
    got = cluster.assignment_table(points, centers).agg(F.sum("wcss")).first()[0]
    assert got == pytest.approx(want, rel=1e-6) and min_dist > 0
    fit = cluster.fit_kmeans(points, 2, restarts=2)
    assert sorted((fit.centers - offset).round(0).tolist()) == [[0.0, 0.0], [8.0, 8.0]]


def test_kmeans_counts_copies_and_draws_from_all_points(spark):
    many = spark.range(40_000).select((F.col("id") % 4000).alias("k"))
    points = many.select(F.array((F.col("k") % 8 * 100).cast("double"), (F.col("k") / 4000.0)).alias("x"))
    stored = cluster.weighted_points(points)
    assert stored.count() == 4000 and stored.agg(F.sum("w")).first()[0] == 40_000
    fit = cluster.fit_kmeans(points, 8, restarts=2)
    assert sorted(round(c[0]) for c in fit.centers) == [100 * i for i in range(8)]


@pytest.mark.parametrize("bad", [[[1.0, None], [2.0, 3.0]], [[1.0, 2.0, 3.0], [1.0]], [[float("nan"), 1.0], [1.0, 1.0]]])
def test_kmeans_refuses_broken_points(spark, bad):
    with pytest.raises(ValueError):
        cluster.fit_kmeans(spark.createDataFrame([(x,) for x in bad], "x array<double>"), 2)


def test_every_cluster_has_a_label(spark):
    rows = [(c, int(i < c)) for c in range(4) for i in range(5)]
    for n, want in ((4, ["Low", "Medium", "Medium", "High"]), (2, ["Low", "High"])):
        df = spark.createDataFrame([r for r in rows if r[0] < n], "cluster int, y int")
        labelled = cluster.label_clusters(df, "cluster", "y", ["Low", "Medium", "High"])
        got = {r["cluster"]: r["risk_label"] for r in labelled.distinct().collect()}
        assert [got[c] for c in range(n)] == want
        assert cluster.label_profile(labelled, "y", ["Low", "Medium", "High"]).agg(F.sum("row_count")).first()[0] == 5 * n


def test_anova_far_from_the_origin_and_with_one_class(spark):
    r = np.random.default_rng(2)
    values = [(int(i % 4), float(v)) for i, v in enumerate((r.normal(0, 1, 2000) + np.arange(2000) % 4).round(6))]
    near = spark.createDataFrame(values, "y int, v double")
    scores = [features.anova_f(near.withColumn("v", F.col("v") + off), ["v"], "y").first()["f_score"] for off in (0.0, 1e9)]
    assert scores[1] == pytest.approx(scores[0], rel=1e-4)
    assert features.anova_f(near.where("y = 0"), ["v"], "y").first()["f_score"] is None


def test_zscore_of_small_numbers_and_saving_an_empty_column(spark, tmp_path):
    df = spark.range(10).select((F.col("id") * 1e-12).alias("v"), F.lit(None).cast("double").alias("none"), F.lit(0.1).alias("same"))
    stats = features.fit_zscore(df, ["v", "none", "same"])
    z = [r["v"] for r in features.apply_zscore(df, stats).orderBy("v").collect()]
    assert z[-1] == pytest.approx(4.5 / np.std(range(10)), rel=1e-9) and stats["same"][1] == 0.0
    files.save_scaler(spark, stats, str(tmp_path / "scaler"))
    assert files.load_scaler(spark, str(tmp_path / "scaler"))["none"] == (None, None)
    assert features.collapsed_columns(stats) == ["v", "none", "same"]


def test_files_of_different_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿a,b\r\n1,2\r\n".encode())
    (tmp_path / "b.csv").write_text('b,"a",c\n20,10,x\n')
    got = files.read_delimited(spark, str(tmp_path), {"a": "int", "b": "int"})
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (10, 20)]


def test_a_fraction_is_no_whole_number(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1.0\n1.7\n")
    with pytest.raises(Exception, match="no whole number"):
        files.read_delimited(spark, str(tmp_path), {"a": "int"}).collect()


def test_executors_import_the_package_from_anywhere(tmp_path):
    """K-means and the forest run in a process started from an empty folder without PYTHONPATH."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from riskweave.session import get_session
from riskweave.operators import cluster, outliers
from pyspark.sql import functions as F
spark = get_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": {str(tmp_path)!r}}})
df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"))
print("MODELS", cluster.elbow(cluster.as_points(df, ["a", "b"]), range(2, 4), 1).count())
print("MARKED", outliers.mark_outliers(df, ["a", "b"], "id", trees=4, psi=32).where("is_inlier").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "MODELS 2" in done.stdout and "MARKED" in done.stdout, done.stderr[-3000:]


def test_copies_of_a_scope_are_deleted(spark, tmp_path):
    from riskweave.session import materialize, scratch_scope

    with scratch_scope(spark):
        kept = materialize(spark.range(5), "scoped")
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
