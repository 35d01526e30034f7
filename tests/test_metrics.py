import numpy as np
import pytest

from riskweave.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, p int")


def test_binary_metrics(spark):
    df = frame(spark, [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4)
    row = metrics.binary_metrics(df, "y", "p", "m").first()
    assert tuple(row) == ("m", 0.7, 0.6, 0.75, pytest.approx(2 / 3))


def test_no_predicted_positives(spark):
    assert tuple(metrics.binary_metrics(frame(spark, [(1, 0), (0, 0)]), "y", "p").first()) == (0.5, 0.0, 0.0, 0.0)


def test_class_report(spark):
    df = frame(spark, [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4)
    got = {r["class"]: tuple(r)[1:] for r in metrics.class_report(df, "y", "p", {0: "No", 1: "Yes"}).collect()}
    assert got["Yes"] == (0.6, 0.75, pytest.approx(2 / 3), 4)
    assert got["No"] == (0.8, pytest.approx(2 / 3), pytest.approx(8 / 11), 6)
    assert got["accuracy"][0] == 0.7 and got["accuracy"][3] == 10
    assert got["macro avg"][0] == pytest.approx(0.7)
    assert got["weighted avg"][0] == pytest.approx(0.72)


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    mse = ((y - p) ** 2).mean()
    assert tuple(row) == pytest.approx((mse, np.sqrt(mse), 1 - mse / y.var()))


def test_best_model_and_counts(spark):
    df = spark.createDataFrame([("a", 0.5, 0.9), ("b", 0.7, 0.8), ("c", 0.7, 0.1)], "model string, f1 double, accuracy double")
    assert tuple(metrics.best_model(df).first()) == ("b", 0.7, "a", 0.9)
    rows = spark.createDataFrame([("x", 1), ("x", 0), (None, 1)], "b string, y int")
    assert [tuple(r) for r in metrics.value_counts(rows, "b", ["x", "z"]).collect()] == [("x", 2), ("z", 0)]
    assert [tuple(r) for r in metrics.band_summary(rows, "b", "y", ["x", "z"]).collect()] == [(0, "x", 2, 0.5), (1, "z", 0, None)]
