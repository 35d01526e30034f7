import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import linear, logistic, models, pca


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5] + [0.0, 5.0, -1.0]
    y = 1.5 + x @ [2.0, -0.5, 0.0] + rng.normal(size=400) * 0.1
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(*map(float, a), float(b), int(b > 0)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, target int")


def test_regressions_match_least_squares(frame, data):
    x, y = data
    want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    vectors = models.assemble(frame, ["a", "b", "c"], "y")
    model, quality = models.multiple_regression(vectors, vectors)
    assert [model.intercept, *model.coefficients] == pytest.approx(want.tolist(), abs=1e-9)
    assert quality.first()["r2"] > 0.99
    fit = models.simple_regression(frame, "b", "y")
    assert [fit["slope"], fit["intercept"]] == pytest.approx(np.polyfit(x[:, 1], y, 1).tolist())
    table = models.weights_table(frame.sparkSession, model.coefficients.toArray(), ["a", "b", "c"], "w")
    assert models.top_weights(table, "w", 1).first()["feature"] == "a"
    assert models.top_weights(table, "w", 1, largest=False).first()["feature"] == "b"


def test_logistic_penalty_is_one_on_the_summed_loss(frame, data):
    x, y = data
    t = (y > 0).astype(float)
    model = models.logistic_regression(len(x)).fit(models.assemble(frame, ["a", "b", "c"], "target"))
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # At the optimum the summed gradient equals minus the weights; the intercept is free.
    assert x.T @ (p - t) + w == pytest.approx(np.zeros(3), abs=2e-2)
    assert (p - t).sum() == pytest.approx(0.0, abs=2e-2)


def test_trees_and_comparison(spark, frame):
    vectors = models.assemble(frame, ["a", "b", "c"], "target")
    tree, tree_row = models.evaluate("Decision Tree", models.decision_tree(), vectors, vectors)
    forest, forest_row = models.evaluate("Random Forest", models.random_forest(10, 5), vectors, vectors)
    assert tree.depth <= 5
    table = models.compare([tree_row, forest_row]).collect()
    assert [r["model"] for r in table] == ["Decision Tree", "Random Forest"]
    assert min(r["accuracy"] for r in table) > 0.9
    top = models.importance_table(spark, forest, ["a", "b", "c"], 2).collect()
    assert top[0]["feature"] == "a" and len(top) == 2
    p = models.probability_of_one(forest.transform(vectors)).select(F.min("probability_1"), F.max("probability_1")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0


def test_pca_matches_eigenvectors(spark, frame, data):
    x, _ = data
    values, vectors = np.linalg.eigh(np.cov(x.T))
    loadings, means, ratios = pca.fit_pca(frame, ["a", "b", "c"], 2)
    assert ratios == pytest.approx((values[::-1] / values.sum())[:2].tolist())
    assert np.abs(loadings) == pytest.approx(np.abs(vectors[:, ::-1].T[:2]), abs=1e-9)
    coords, _ = pca.pca_2d(frame, ["a", "b", "c"])
    assert coords.agg(F.avg("pc1"), F.avg("pc2")).first() == pytest.approx((0.0, 0.0), abs=1e-9)


def test_covariance_and_gram(frame, data):
    x, _ = data
    cov = {(r["row"], r["col"]): r["value"] for r in models.covariance_matrix(frame, ["a", "b"]).collect()}
    assert cov["a", "b"] == pytest.approx(np.cov(x.T)[0, 1])
    gram = {(r["row"], r["col"]): r["value"] for r in models.gram_matrix(frame, ["a", "b"]).collect()}
    assert gram["b", "b"] == pytest.approx(((x[:, 1] - x[:, 1].mean()) ** 2).sum())


def test_block_iteration_of_a_wide_table(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(300, 40)) @ np.diag(np.linspace(5, 0.1, 40)) @ r.normal(size=(40, 40))
    names = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(map(float, row)) for row in x], ", ".join(f"{c} double" for c in names)).repartition(4)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for block in (64, 4):
        loadings, means, ratios = pca.fit_pca(df, names, 3, block=block)
        assert ratios == pytest.approx((values[::-1] / values.sum())[:3].tolist(), abs=1e-9)
        assert np.abs(loadings) == pytest.approx(np.abs(vectors[:, ::-1].T[:3]), abs=1e-5)
        assert means == pytest.approx(x.mean(axis=0)) and (loadings.max(axis=1) >= -loadings.min(axis=1)).all()
    with pytest.raises(ValueError):
        pca.fit_pca(df.withColumn("c0", F.when(F.col("c0") > 0, F.col("c0"))), names, 2)


def test_newton_meets_the_optimum_and_refuses_one_class(spark, frame, data):
    x, y = data
    t = (y > 0).astype(float)
    fit = logistic.fit_logistic(frame, ["a", "b", "c"], "target")
    p = 1 / (1 + np.exp(-(x @ fit.weights + fit.intercept)))
    assert x.T @ (p - t) + fit.weights == pytest.approx(np.zeros(3), abs=1e-6) and (p - t).sum() == pytest.approx(0.0, abs=1e-6)
    assert fit.steps < 15
    zero = [r["gradient"] for r in logistic.gradient(frame, fit, "target").collect()]
    assert zero == pytest.approx([0.0] * 4, abs=1e-6)
    scored = fit.transform(frame).select("probability_1", "prediction").collect()
    assert sorted(r["probability_1"] for r in scored) == pytest.approx(sorted(p.tolist()))
    constant = logistic.fit_logistic(frame.withColumn("k", F.lit(1.0)), ["a", "k"], "target")
    assert constant.weights[1] == pytest.approx(0.0, abs=1e-6)  # the free intercept does a constant's work
    with pytest.raises(ValueError):
        logistic.fit_logistic(frame.where("target = 1"), ["a"], "target")


def test_separable_classes_have_finite_weights(spark):
    df = spark.createDataFrame([(float(i), int(i >= 50)) for i in range(100)], "x double, y int")
    fit = logistic.fit_logistic(df, ["x"], "y")
    assert 0 < fit.weights[0] < 100 and fit.transform(df).where("prediction = y").count() == 100


def test_least_squares_with_dependent_columns(frame, data):
    x, y = data
    more = frame.withColumn("twice", 2 * F.col("a")).withColumn("k", F.lit(3.0))
    fit = linear.fit_linear(more, ["a", "b", "c", "twice", "k"], "y")
    wide = np.column_stack([x, 2 * x[:, 0], np.full(len(x), 3.0)])
    want = np.linalg.lstsq(wide - wide.mean(axis=0), y - y.mean(), rcond=1e-10)[0]
    assert fit.weights == pytest.approx(want, abs=1e-9)
    got = sorted(r["prediction"] for r in fit.transform(more).collect())
    assert got == pytest.approx(sorted((wide - wide.mean(axis=0)) @ want + y.mean()))
    with pytest.raises(ValueError):
        linear.fit_linear(frame.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), ["a"], "y")
