import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import outliers


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 3))
    x[:20] += 9.0
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")


def test_share_and_planted_outliers(frame):
    marked = outliers.mark_outliers(frame, ["a", "b", "c"], "id", trees=50)
    out = {r["id"] for r in marked.where("not is_inlier").collect()}
    assert len(out) == 50 and set(range(20)) <= out
    assert outliers.drop_outliers(marked).count() == 950
    low, high = marked.agg(F.min("anomaly"), F.max("anomaly")).first()
    assert 0.0 < low < 0.5 < high < 1.0


def test_same_forest_for_any_partitioning(frame):
    one = outliers.fit_iforest(frame.repartition(1), ["a", "b", "c"], "id", trees=10)
    many = outliers.fit_iforest(frame.repartition(9), ["a", "b", "c"], "id", trees=10)
    assert one.nodes.equals(many.nodes)
    per_tree = one.nodes.groupby("tree").size()
    assert len(per_tree) == 10 and per_tree.max() <= 2 * 256 - 1


@pytest.mark.parametrize("rows, share", [(300, None), (60000, None), (60000, 1e-9)])
def test_samples_are_the_rows_of_smallest_draw(spark, rows, share, monkeypatch):
    df = spark.range(rows).withColumn("a", F.col("id") / 7).repartition(5)
    found = outliers.tree_samples(df, ["a"], "id", 20, 64, 7, rows if share is None else int(rows / share)).collect()
    keys = np.arange(rows, dtype=np.uint64)
    for t in range(20):
        z = outliers.draw64(keys, 7 * 1000 + t + 1)
        assert {r["k"] for r in found if r["tree"] == t} == set(np.argsort(z)[:64].tolist())
    assert all(r["x0"] == r["k"] / 7 for r in found) and len(found) == 20 * 64


def test_constant_column_and_tiny_table(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "id long, a double")
    marked = outliers.mark_outliers(df, ["a"], "id", trees=5)
    assert marked.where("is_inlier").count() == 3  # ties with the threshold stay


def test_average_path_grows_with_size():
    assert outliers.average_path(1) == 0.0 and outliers.average_path(2) == 1.0
    assert outliers.average_path(256) == pytest.approx(10.2448, abs=1e-3)
