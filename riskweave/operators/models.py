"""Classifiers and regressions on MLlib, compared on one common split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.integrate import union_all
from riskweave.operators.metrics import binary_metrics, regression_metrics

SEED = 42


def assemble(df: DataFrame, features: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector column ``features`` and double column ``label``."""
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(
        df.select(*dict.fromkeys([*features, *([label] if label else []), *keep]))
    )
    cols = ["features", *keep]
    return out.select(*cols, *([F.col(label).cast("double").alias("label")] if label else []))


def logistic_regression(train_rows: int, max_iter: int = 1000) -> LogisticRegression:
    """L2 penalty of strength one on the summed loss, which is 1/n on the averaged loss."""
    return LogisticRegression(
        maxIter=max_iter, regParam=1.0 / max(1, train_rows), elasticNetParam=0.0, standardization=False
    )


def decision_tree(max_depth: int = 5, max_bins: int = 128) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, impurity="gini", maxBins=max_bins, seed=SEED)


def random_forest(num_trees: int = 100, max_depth: int = 30, max_bins: int = 64) -> RandomForestClassifier:
    """Bootstrap forest. MLlib limits the depth to 30; smaller depths need fewer passes.

    The larger aggregation buffer lets one pass over the data split more nodes.
    """
    return RandomForestClassifier(
        numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, impurity="gini",
        featureSubsetStrategy="sqrt", maxMemoryInMB=512, seed=SEED,
    )


def evaluate(name: str, estimator: Estimator, train: DataFrame, test: DataFrame) -> tuple[Model, DataFrame]:
    """Fit on ``train`` and measure on ``test``: (model, one row of metrics)."""
    model = estimator.fit(train)
    return model, binary_metrics(model.transform(test), "label", "prediction", name)


def compare(metrics: Sequence[DataFrame]) -> DataFrame:
    """One table of the metric rows of several models."""
    return union_all(*metrics)


def probability_of_one(scored: DataFrame, name: str = "probability_1") -> DataFrame:
    """Add P(class 1) as a double column."""
    return scored.withColumn(name, vector_to_array("probability")[1])


def weights_table(spark: SparkSession, weights: Sequence[float], names: Sequence[str], value: str) -> DataFrame:
    """Rows (feature, value) of a fitted vector."""
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return spark.createDataFrame(rows, f"feature string, {value} double")


def importance_table(spark: SparkSession, model: Model, names: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` features with the highest impurity importance."""
    table = weights_table(spark, model.featureImportances.toArray(), names, "importance")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def top_weights(table: DataFrame, value: str, k: int = 5, largest: bool = True) -> DataFrame:
    """The ``k`` rows with the largest, or the smallest, value."""
    return table.orderBy(F.desc(value) if largest else F.asc(value), "feature").limit(k)


def simple_regression(train: DataFrame, x: str, y: str) -> Mapping[str, float]:
    """slope, intercept and training r2 of y on x, from one aggregation."""
    return train.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    ).first().asDict()


def predict_simple(df: DataFrame, fitted: Mapping[str, float], x: str, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, F.lit(fitted["intercept"]) + F.lit(fitted["slope"]) * F.col(x))


def multiple_regression(train: DataFrame, test: DataFrame, name: str = "multiple") -> tuple[Model, DataFrame]:
    """Least squares on all features by the normal equations: (model, one row of metrics)."""
    model = LinearRegression(regParam=0.0, solver="normal").fit(train)
    return model, regression_metrics(model.transform(test), "label", "prediction", name)


def gram_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (row, col, value) of the centred cross products, from one pass."""
    return _pairs(df, cols, F.covar_pop, lambda c: c * F.count("*"))


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (row, col, value) of the sample covariance matrix, from one pass."""
    return _pairs(df, cols, F.covar_samp, lambda c: c)


def _pairs(df: DataFrame, cols: Sequence[str], fn, scale) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[scale(fn(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"p{i}").alias("value"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))
