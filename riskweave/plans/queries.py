"""Registered queries: each maps (session, data folder) to a DataFrame.

All of them read whole tables. Floating-point results are rounded, because sums
depend on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions import columns as C
from riskweave.operators import clean, cluster, features, forest, integrate, linear, logistic, metrics, models, outliers, pca, rules, scoring
from riskweave.operators.split import mark_test, split
from riskweave.operators.warehouse import build_star, load_star, rollup_query, save_star
from riskweave.plans import orders as O
from riskweave.session import materialize, scratch_path
from riskweave.sources import files
from riskweave.streaming.score import read_records, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SMALL_IFOREST = {"trees": 12, "psi": 100, "seed": 7}
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FOREST = {"trees": 100, "max_depth": 10}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def r(col: Column | str, digits: int = 6) -> Column:
    """Rounded column; adding 0.0 turns a rounded -0.0 into 0.0."""
    return C.round_half_even(col, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[r(f"`{c}`", digits).alias(c) if kinds[c] == "double" else F.col(f"`{c}`") for c in df.columns])


# --- sources and sinks ----------------------------------------------------------------


@query
def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return files.source_counts({t: O.load(spark, sf, t) for t in ("lineitem", "orders", "events")})


@query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as semicolon text and read back by column name."""
    text = O.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    path = files.write_table(text, scratch_path(spark, "orders-csv"), "csv", ";")
    wanted = {"o_orderpriority": "string", "o_totalprice": "double", "o_orderkey": "bigint", "o_custkey": "int"}
    return files.read_delimited(spark, path, wanted, ";")


@query
def csv_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written into one folder as files of two column orders, one with a column more, and read back by name."""
    rows = O.load(spark, sf, "customer")
    path = scratch_path(spark, "mixed-csv")
    files.write_table(rows.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_acctbal"), f"{path}/even", "csv")
    files.write_table(rows.where("c_custkey % 2 = 1").select("c_acctbal", "c_mktsegment", "c_custkey", "c_name"), f"{path}/odd", "csv")
    return files.read_delimited(spark, path, {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double"})


@query
def feature_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_table(O.order_features(spark, sf), scratch_path(spark, "feature-table"))
    return rounded(files.read_table(spark, path), 8)


@query
def scaler_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders standardised with a scaler that was saved and loaded again."""
    table, path = O.load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), scratch_path(spark, "scaler")
    files.save_scaler(spark, features.fit_zscore(table, ["o_totalprice"]), path)
    return rounded(features.apply_zscore(table, files.load_scaler(spark, path)))


# --- integration and cleaning ---------------------------------------------------------


@query
def integrate_sources(spark: SparkSession, sf: str) -> DataFrame:
    return O.records(spark, sf)


@query
def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.dedup_wide(O.load(spark, sf, "lineitem")).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query
def dedup_documents(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.dedup_wide(O.load(spark, sf, "documents"))


@query
def dedup_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of which every third has a copy and every fifth has two: copies removed, unique lines left where they are."""
    lines = O.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    twice = lines.unionAll(lines.where("l_orderkey % 3 = 0")).unionAll(lines.where("l_orderkey % 5 = 0"))
    return integrate.dedup_wide(twice)


@query
def dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.records(spark, sf)
    return integrate.dedup_stats(rows, integrate.dedup(rows))


@query
def null_audit(spark: SparkSession, sf: str) -> DataFrame:
    return clean.null_counts(O.records(spark, sf))


@query
def null_total_after_impute(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.records(spark, sf)
    fill = clean.fit_impute(rows, O.RECORD_MEANS, O.RECORD_MODES)
    return clean.total_nulls(clean.apply_impute(rows, fill))


@query
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    means = clean.column_means(O.records(spark, sf), O.RECORD_MEANS)
    return rounded(spark.createDataFrame(list(means.items()), "feature string, fill double"), 7)


@query
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    modes = clean.column_modes(O.records(spark, sf), O.RECORD_MODES)
    return spark.createDataFrame(list(modes.items()), "feature string, fill int")


@query
def mode_many(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent values of columns of many values."""
    columns = ["l_partkey", "l_suppkey", "l_orderkey"]
    modes = clean.column_modes(O.load(spark, sf, "lineitem"), columns)
    return spark.createDataFrame([(c, modes[c]) for c in columns], "feature string, fill bigint")


@query
def impute_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated records with every gap filled."""
    rows = materialize(integrate.dedup(O.records(spark, sf)), "records")
    given = {f"_{c}": F.col(c) for c in O.RECORD_MEANS}
    filled = clean.apply_impute(rows.withColumns(given), clean.fit_impute(rows, O.RECORD_MEANS, O.RECORD_MODES))
    shown = {c: F.coalesce(F.col(f"_{c}"), r(c, 7)) for c in O.RECORD_MEANS}  # only filled cells depend on the order of sums
    return filled.withColumns(shown).drop(*given)


@query
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean.describe_exact(O.load(spark, sf, "lineitem"), MEASURES), 7)


# --- features -------------------------------------------------------------------------


@query
def one_hot_drop_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return features.apply_one_hot(rows, features.fit_one_hot(rows, ["o_orderpriority", "o_orderstatus"]))


@query
def one_hot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of orders as a sparse one-hot code."""
    return features.sparse_one_hot(O.load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query
def zscore(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return rounded(features.apply_zscore(rows, features.fit_zscore(rows, MEASURES)))


@query
def anova_f(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.anova_f(O.load(spark, sf, "lineitem"), MEASURES, "l_returnflag"))


@query
def select_k_best(spark: SparkSession, sf: str) -> DataFrame:
    """The three order measures that separate the target best."""
    best = features.select_k_best(materialize(O.clean_features(spark, sf), "select"), O.NUMERIC, "target", 3)
    return spark.createDataFrame([(c,) for c in best], "feature string")


# --- warehouse ------------------------------------------------------------------------


@query
def star_fact(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(O.star(spark, sf)["order_fact"])


@query
def dim_party(spark: SparkSession, sf: str) -> DataFrame:
    return O.star(spark, sf)["dim_party"]


@query
def dim_order(spark: SparkSession, sf: str) -> DataFrame:
    return O.star(spark, sf)["dim_order"]


@query
def dim_value(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(O.star(spark, sf)["dim_value"], 4)


@query
def star_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the warehouse after saving and loading it."""
    tables, path = O.star(spark, sf), scratch_path(spark, "warehouse")
    save_star(tables, path)
    return files.source_counts(load_star(spark, path, list(tables)))


@query
def olap_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    O.star(spark, sf)
    return spark.sql(O.OLAP["olap_by_segment"])


@query
def olap_by_status(spark: SparkSession, sf: str) -> DataFrame:
    O.star(spark, sf)
    return spark.sql(O.OLAP["olap_by_status"])


@query
def olap_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """The same kind of roll-up through the DataFrame API."""
    tables = O.star(spark, sf)
    aggs = {"return_rate": F.avg("target"), "order_count": F.count("*")}
    return rollup_query(tables["order_fact"], tables["dim_order"], "detail_id", "priority", aggs, 4)


@query
def olap_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The three roll-ups over a warehouse stored in buckets of the shared key: fact and dimensions are joined where they lie."""
    tables = O.stored_star(spark, sf)
    aggs = {"return_rate": F.avg("target"), "order_count": F.count(F.lit(1)), "avg_risk_score": F.avg("risk_score")}
    levels = (("dim_party", "party_id", "segment"), ("dim_party", "party_id", "nation"), ("dim_order", "detail_id", "status"),
              ("dim_order", "detail_id", "priority"))
    parts = []
    for dim, key, by in levels:
        fact = tables[O.FACT].select(F.col("fact_id").alias(key), "target", "risk_score")  # all tables share the key
        rolled = rollup_query(fact, tables[dim], key, by, aggs, 4)
        parts.append(rolled.select(F.lit(by).alias("level"), F.col(by).cast("string").alias("value"), *aggs))
    return integrate.union_all(*parts)


# --- splits and metrics ---------------------------------------------------------------


@query
def split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return mark_test(rows, ["o_orderkey"], 0.2, "o_orderstatus")


@query
def split_plain(spark: SparkSession, sf: str) -> DataFrame:
    return mark_test(O.load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2)


@query
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.value_counts(O.order_features(spark, sf), "target", [0, 1])


def _rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = O.load(spark, sf, "documents").select("doc_id", "lang", "n_chars"), O.load(spark, sf, "labels")
    as_int = lambda cond: cond.cast("int")
    return labels.join(docs, "doc_id").select(
        "quality", "toxic", as_int(F.col("n_chars") >= 500).alias("long"),
        as_int(F.col("n_chars") >= 3000).alias("very_long"), as_int(F.col("lang") == "en").alias("english"))


def _rule_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.compare_predictions(_rule_predictions(spark, sf), "quality", ["long", "very_long", "english"])


@query
def classify_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_rule_metrics(spark, sf))


@query
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    names = {0: "Poor", 1: "Good"}
    return rounded(metrics.class_report(_rule_predictions(spark, sf), "quality", "english", names))


@query
def best_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.best_model(_rule_metrics(spark, sf)))


# --- models ---------------------------------------------------------------------------


def _dealt(vectors: DataFrame) -> DataFrame:
    """Rows dealt and sorted by their key: MLlib draws per partition, so its models
    depend on ``spark.sql.shuffle.partitions`` but not on the cores or files at hand."""
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(vectors, "train").repartition(n, "order_id").sortWithinPartitions("order_id")


def _scaled_training(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    table, names = O.model_features(spark, sf)
    train, test = split(table, ["order_id"], stratify="target")
    return materialize(train, "train"), test, names


@query
def classify_lr(spark: SparkSession, sf: str) -> DataFrame:
    train, test, names = _scaled_training(spark, sf)
    return rounded(_quality("Logistic Regression", logistic.fit_logistic(train, names, "target"), test))


@query
def logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the penalised loss at the fitted weights of all features: 0 at the one optimum of a convex loss."""
    train, _, names = _scaled_training(spark, sf)
    fit = logistic.fit_logistic(train, names, "target")
    return rounded(logistic.gradient(train, fit, "target"), 4)


@query
def logistic_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights and intercept of the target on lines and quantity."""
    train, _, _ = _tree_training(spark, sf)
    scaled = train.select((F.col("n_lines") / 4).alias("lines"), (F.col("qty") / 100).alias("quantity"), "target")
    fit = logistic.fit_logistic(materialize(scaled, "weights"), ["lines", "quantity"], "target")
    return rounded(models.weights_table(spark, [*fit.weights, fit.intercept], ["lines", "quantity", "intercept"], "weight"))


def _tree_training(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    table, names = O.tree_features(spark, sf)
    train, test = split(table, ["order_id"], stratify="target")
    return materialize(train, "train"), test, names


def _quality(name: str, fitted: forest.Forest | logistic.Logistic, test: DataFrame) -> DataFrame:
    return metrics.binary_metrics(fitted.transform(test), "target", "prediction", name)


@query
def classify_dt(spark: SparkSession, sf: str) -> DataFrame:
    train, test, names = _tree_training(spark, sf)
    return rounded(_quality("Decision Tree", forest.fit_tree(train, names, "target", "order_id"), test))


@query
def decision_tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of the decision tree with its cut and its training rows of both classes."""
    train, _, names = _tree_training(spark, sf)
    return rounded(forest.fit_tree(train, names, "target", "order_id").table(spark))


@query
def dt_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Impurity importances of the decision tree."""
    train, _, names = _tree_training(spark, sf)
    fitted = forest.fit_tree(train, names, "target", "order_id")
    return rounded(models.weights_table(spark, fitted.importances(), names, "importance"))


#: A forest small enough for SQL to grow again.
SMALL_FOREST = {"trees": 6, "max_depth": 3}


@query
def forest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of a small forest: hashed bags, hashed choice of features, cuts and counts."""
    train, _, names = _tree_training(spark, sf)
    return rounded(forest.fit_forest(train, names, "target", "order_id", **SMALL_FOREST).table(spark))


@query
def forest_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Probability and class of every held-out order by the small forest."""
    train, test, names = _tree_training(spark, sf)
    scored = forest.fit_forest(train, names, "target", "order_id", **SMALL_FOREST).transform(test)
    return scored.select("order_id", r("probability_1").alias("probability"), F.col("prediction").cast("int").alias("prediction"))


@query
def classify_rf(spark: SparkSession, sf: str) -> DataFrame:
    train, test, names = _tree_training(spark, sf)
    return _quality("Random Forest", forest.fit_forest(train, names, "target", "order_id", **FOREST), test)


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression, decision tree and forest on one split; the best one is marked."""
    train, test, names = _scaled_training(spark, sf)
    fitted = {
        "Logistic Regression": logistic.fit_logistic(train, names, "target"),
        "Decision Tree": forest.fit_tree(train, names, "target", "order_id"),
        "Random Forest": forest.fit_forest(train, names, "target", "order_id", **FOREST),
    }
    return metrics.best_model(models.compare([_quality(n, m, test) for n, m in fitted.items()]))


@query
def rf_importance_top10(spark: SparkSession, sf: str) -> DataFrame:
    train, _, names = _tree_training(spark, sf)
    fitted = forest.fit_forest(train, names, "target", "order_id", **FOREST)
    return models.top_weights(models.weights_table(spark, fitted.importances(), names, "importance"), "importance", 10)


def _order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """All orders; those without lines have the means."""
    table = materialize(O.order_features(spark, sf).select("order_id", "qty", "price", "n_lines"), "lines")
    return clean.apply_impute(table, clean.fit_impute(table, ["qty", "price", "n_lines"], []))


@query
def regress_simple(spark: SparkSession, sf: str) -> DataFrame:
    """Order price by quantity: fitted line and its error on the held-out fifth."""
    train, test = split(_order_lines(spark, sf), ["order_id"])
    fit = models.simple_regression(train, "qty", "price")
    quality = metrics.regression_metrics(models.predict_simple(test, fit, "qty"), "price", "prediction")
    return quality.select(
        r(F.lit(fit["slope"]), 4).alias("slope"), r(F.lit(fit["intercept"]), 3).alias("intercept"),
        r("rmse", 3).alias("rmse"), r("r2").alias("r2"))


@query
def regress_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Order price by quantity and number of lines."""
    train, test = split(_order_lines(spark, sf), ["order_id"])
    vectors = [models.assemble(p, ["qty", "n_lines"], "price") for p in (train, test)]
    model, quality = models.multiple_regression(*vectors)
    return quality.select(
        r(F.lit(float(model.coefficients[0])), 3).alias("b_qty"), r(F.lit(float(model.coefficients[1])), 2).alias("b_lines"),
        r(F.lit(float(model.intercept)), 2).alias("intercept"), r("rmse", 3).alias("rmse"), r("r2").alias("r2"))


def _all_features(spark: SparkSession, sf: str) -> tuple[linear.Linear, DataFrame]:
    """Order price on all other features: (fit, training rows)."""
    table, names = O.model_features(spark, sf)
    train, _ = split(table, ["order_id"])
    return linear.fit_linear(train, [n for n in names if n != "totalprice"], "totalprice"), train


def _all_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    fit, _ = _all_features(spark, sf)
    return models.weights_table(spark, fit.weights, fit.features, "coefficient")


@query
def regress_normal(spark: SparkSession, sf: str) -> DataFrame:
    """The normal equations of the regression on all features: error times every feature, summed over the training rows, is 0."""
    fit, train = _all_features(spark, sf)
    used, error = fit.features, fit.line() - F.col("totalprice")
    sums = train.agg(F.sum(error).alias("intercept"), *[F.sum(error * F.col(f"`{c}`")).alias(f"g{i}") for i, c in enumerate(used)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"g{i}").alias("residual")) for i, c in enumerate(used)]
    return rounded(sums.select(F.inline(F.array(F.struct(F.lit("intercept").alias("feature"), F.col("intercept").alias("residual")), *rows))), 4)


@query
def regress_top_positive(spark: SparkSession, sf: str) -> DataFrame:
    return models.top_weights(_all_coefficients(spark, sf), "coefficient")


@query
def regress_top_negative(spark: SparkSession, sf: str) -> DataFrame:
    return models.top_weights(_all_coefficients(spark, sf), "coefficient", largest=False)


@query
def regress_gram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(models.gram_matrix(O.load(spark, sf, "lineitem"), MEASURES), 2)


@query
def pca_cov(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(models.covariance_matrix(O.load(spark, sf, "lineitem"), MEASURES), 4)


def _pca_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _order_lines(spark, sf).select("order_id", "qty", (F.col("n_lines") * 10).alias("lines10"))


@query
def pca_2d(spark: SparkSession, sf: str) -> DataFrame:
    coords, _ = pca.pca_2d(_pca_rows(spark, sf), ["qty", "lines10"])
    return coords.select("order_id", r("pc1", 4).alias("pc1"), r("pc2", 4).alias("pc2"))


@query
def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pca.pca_2d(_pca_rows(spark, sf), ["qty", "lines10"])[1])


@query
def pca_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Explained variance of two components of all standardised order measures."""
    return rounded(pca.pca_2d(O.model_features(spark, sf)[0], O.NUMERIC)[1])


@query
def pca_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Explained variance of the two first components of all embeddings."""
    wide = O.load(spark, sf, "embeddings").select(*[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(64)])
    stored = materialize(wide, "embeddings")
    shares = pca.fit_pca(stored, stored.columns, 2)[2]
    return rounded(spark.createDataFrame([(f"pc{i + 1}", v) for i, v in enumerate(shares)], "component string, explained_ratio double"))


# --- clusters -------------------------------------------------------------------------


def _class_means(rows: DataFrame) -> np.ndarray:
    """Mean vector of each label, in label order: classes x dimensions numbers."""
    d = rows.agg(F.max(F.size("x")).alias("d")).first()["d"]
    means = rows.groupBy("label").agg(*[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(d)]).orderBy("label").collect()
    return np.array([[m[f"m{i}"] for i in range(d)] for m in means])


def _labelled_points(spark: SparkSession, sf: str) -> DataFrame:
    return O.load(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query
def kmeans_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest of the ten class means for every embedding."""
    rows = _labelled_points(spark, sf)
    near = cluster.assign(rows, F.col("x"), _class_means(rows))
    return near.select("vec_id", "cluster", r("sq_dist").alias("sq_dist"))


@query
def kmeans_step(spark: SparkSession, sf: str) -> DataFrame:
    """Size and squared distance of each cluster after one pass from the class means."""
    rows = _labelled_points(spark, sf)
    return rounded(cluster.assignment_table(rows.select("x"), _class_means(rows)))


@query
def cluster_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Order statuses as clusters, labelled by their rate of returns."""
    rows = O.order_features(spark, sf).select("status", "target")
    labelled = cluster.label_clusters(materialize(rows, "labels"), "status", "target", S.RISK_LABELS)
    return rounded(cluster.label_profile(labelled, "target", S.RISK_LABELS), 4)


@query
def high_risk_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the cluster labelled as the highest risk."""
    rows = materialize(O.order_features(spark, sf).select("order_id", "status", "target"), "labels")
    labelled = cluster.label_clusters(rows, "status", "target", S.RISK_LABELS)
    return labelled.where(F.col("risk_label") == S.RISK_LABELS[-1]).select("order_id", "status", "risk_label")


@query
def kmeans_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Three clusters of standardised orders, labelled by their rate of returns."""
    table, _ = O.model_features(spark, sf)
    fit = cluster.fit_kmeans(cluster.as_points(table, O.NUMERIC), 3)
    labelled = cluster.label_clusters(
        cluster.assign(table, O.NUMERIC, fit.centers), "cluster", "target", S.RISK_LABELS)
    return cluster.label_profile(labelled, "target", S.RISK_LABELS)


@query
def centroids(spark: SparkSession, sf: str) -> DataFrame:
    table, _ = O.model_features(spark, sf)
    fit = cluster.fit_kmeans(cluster.as_points(table, O.NUMERIC), 3)
    rates = cluster.cluster_rates(cluster.assign(table, O.NUMERIC, fit.centers), "cluster", "target")
    return rounded(cluster.centroid_table(table, fit, O.NUMERIC, cluster.rank_labels(rates, "cluster", S.RISK_LABELS)))


@query
def elbow(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.elbow(_labelled_points(spark, sf).select("x"))


# --- rules ----------------------------------------------------------------------------

def _event_itemsets(spark: SparkSession, sf: str, support: float = 0.1) -> DataFrame:
    """Event types seen per user and day."""
    visits = O.load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    return rules.basket_itemsets(visits, ["user_id", "day"], "event_type", support)


def _text_items(df: DataFrame, *cols: str) -> DataFrame:
    return rounded(df.withColumns({c: F.array_join(c, ",") for c in cols}))


@query
def itemsets_events(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(_event_itemsets(spark, sf), "items")


@query
def rules_events(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(rules.rules(_event_itemsets(spark, sf, 0.0005), 0.01), "antecedents", "consequents")


@query
def itemsets_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Part types bought together in one order."""
    lines = O.load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = O.load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return _text_items(rules.basket_itemsets(lines.join(part, "l_partkey"), ["l_orderkey"], "p_type", 0.1), "items")


def _wide_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    """Brands, months and return flags of one order: some forty items."""
    lines = O.load(spark, sf, "lineitem").join(O.load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    items = F.array("p_brand", "l_returnflag", F.concat(F.lit("month "), F.month("l_shipdate").cast("string")))
    rows = lines.select("l_orderkey", F.explode(items).alias("item"))
    return rules.basket_itemsets(rows, ["l_orderkey"], "item", 0.04)


@query
def itemsets_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(_wide_itemsets(spark, sf), "items")


@query
def rules_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(rules.rules(_wide_itemsets(spark, sf), 0.5), "antecedents", "consequents")


@query
def rules_none(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of part types at a support that no set has: no rows, and the same columns."""
    lines = O.load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = O.load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return _text_items(rules.rules(rules.basket_itemsets(lines.join(part, "l_partkey"), ["l_orderkey"], "p_type", 0.99)), "antecedents", "consequents")


@query
def itemsets_growth(spark: SparkSession, sf: str) -> DataFrame:
    """The event itemsets again, through FP-growth on arrays."""
    visits = O.load(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.collect_set("event_type").alias("items"))
    return _text_items(rules.array_itemsets(visits, 0.1), "items")


def _flag_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return rules.itemsets(O.order_features(spark, sf), O.RULE_ITEMS, 0.1)


@query
def itemsets_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(_flag_itemsets(spark, sf), "items")


@query
def rules_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _text_items(rules.rules(materialize(_flag_itemsets(spark, sf), "itemsets")), "antecedents", "consequents")


@query
def rules_top10(spark: SparkSession, sf: str) -> DataFrame:
    found = rules.rules(materialize(_flag_itemsets(spark, sf), "itemsets"))
    return _text_items(rules.top_rules(found), "antecedents", "consequents")


# --- bands and scores -----------------------------------------------------------------


def _event_probability() -> Column:
    """Event value as a share of 500, at most 1."""
    return F.least(F.col("value") / 500.0, F.lit(1.0))


@query
def risk_bands_right(spark: SparkSession, sf: str) -> DataFrame:
    score = C.percent(_event_probability())
    return O.load(spark, sf, "events").select("event_id", score.alias("predicted_risk_score")).withColumn(
        "risk_band", C.band_right_closed("predicted_risk_score", S.SCORE_EDGES, S.SCORE_BANDS))


@query
def risk_bands_left(spark: SparkSession, sf: str) -> DataFrame:
    p = _event_probability()
    return O.load(spark, sf, "events").select(
        "event_id", scoring.risk_band(p).alias("risk_band"), scoring.verdict(p).alias("verdict"))


@query
def band_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rate of errors per score band, empty bands kept."""
    scored = O.load(spark, sf, "events").select(
        C.percent(_event_probability()).alias("s"), (F.col("event_type") == "error").cast("int").alias("outcome")
    ).withColumn("risk_band", C.band_right_closed("s", S.SCORE_EDGES, S.SCORE_BANDS))
    return rounded(metrics.band_summary(scored, "risk_band", "outcome", S.SCORE_BANDS))


@query
def rounding_modes(spark: SparkSession, sf: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    return O.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", C.round_half_even(half, 0).alias("half_even"),
        C.round_half_away(half, 0).alias("half_away"))


@query
def validate_inputs(spark: SparkSession, sf: str) -> DataFrame:
    checked = scoring.validate_inputs(
        O.load(spark, sf, "lineitem"),
        {"l_quantity": (5, 45), "l_linenumber": (1, 6), "l_extendedprice": (1000, 90000)}, ["l_linenumber"], ["l_returnflag"])
    return checked.select("l_orderkey", "l_linenumber", F.array_join("rejected_reason", "; ").alias("rejected"),
                          (F.size("rejected_reason") == 0).alias("accepted"))


@query
def yes_no_tokens(spark: SparkSession, sf: str) -> DataFrame:
    token = C.recode("event_type", {"click": " Yes ", "view": "NO", "signup": "1", "purchase": "n", "error": "maybe"})
    return O.load(spark, sf, "events").select(
        "event_id", C.parse_yes_no(token).alias("flag"), C.menu_offset(F.col("event_id") % 3).alias("menu_code"))


@query
def drift_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = O.load(spark, sf, "events").select("event_id", "value")
    scaled = features.apply_zscore(rows, features.fit_zscore(rows, ["value"]))
    return rounded(scoring.drift_flags(scaled, ["value"], 6, ["event_id"]))


@query
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Trained layout from other columns: one absent, one dropped, one neutralised."""
    rows = O.load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    aligned = features.align_to(rows, ["o_totalprice", "o_orderkey", "unseen"])
    return features.fixed_zero(aligned, ["o_totalprice"])


def _order_artefacts(spark: SparkSession, sf: str) -> scoring.Artefacts:
    """Fitted transforms of the orders with fixed weights."""
    table = O.load(spark, sf, "orders")
    categories = features.fit_one_hot(table, ["o_orderpriority", "o_orderstatus"])
    dummies = [f"{c}_{v}" for c, values in categories.items() for v in values[1:]]
    return scoring.Artefacts(
        features=["o_totalprice", *dummies], scaler=features.fit_zscore(table, ["o_totalprice"]),
        categories=categories, weights=[0.9, 0.5, -0.25, 0.125, -0.75, 0.3, -0.6], intercept=-0.2)


def _score_columns(scored: DataFrame) -> DataFrame:
    return scored.select("o_orderkey", r("probability").alias("probability"), "risk_score", "risk_band", "verdict")


@query
def score_fixed(spark: SparkSession, sf: str) -> DataFrame:
    art = _order_artefacts(spark, sf)
    return _score_columns(scoring.score(O.load(spark, sf, "orders"), art, ["o_orderkey"]))


@query
def score_reloaded(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores with artefacts that were saved and loaded again."""
    path = scratch_path(spark, "artefacts")
    _order_artefacts(spark, sf).save(spark, path)
    art = scoring.Artefacts.load(spark, path)
    return _score_columns(scoring.score(O.load(spark, sf, "orders"), art, ["o_orderkey"]))


@query
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores, computed as a stream over the data folder."""
    art, schema = _order_artefacts(spark, sf), O.load(spark, sf, "orders").schema
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    records = read_records(spark, sf, schema, pathGlobFilter="orders.parquet")
    start_scoring(records, art, ["o_orderkey"], out, state).awaitTermination()
    return _score_columns(spark.read.parquet(out))


@query
def top_contrib(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.score(O.load(spark, sf, "orders"), _order_artefacts(spark, sf), ["o_orderkey"])
    names = lambda c: F.array_join(F.transform(c, lambda s: s["feature"]), ",").alias(c)
    return scored.select("o_orderkey", names("top_up"), names("top_down"),
                         r(F.get("top_up", 0)["contribution"]).alias("largest"),
                         r(F.get("top_down", 0)["contribution"]).alias("smallest"))


@query
def advice_lines(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.score(O.load(spark, sf, "orders"), _order_artefacts(spark, sf), ["o_orderkey"])
    return scored.select("o_orderkey", F.size("advice").alias("n_lines"), F.array_join("advice", " ").alias("advice"))


@query
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Every order scored by a random forest trained on four fifths of them."""
    table, names = O.tree_features(spark, sf)
    train, _ = split(table, ["order_id"], stratify="target")
    model = forest.fit_forest(materialize(train, "train"), names, "target", "order_id", **FOREST)
    art = scoring.Artefacts(features=names, scaler={}, weights=model.importances().tolist(), model=model)
    scored = scoring.score(table, art, ["order_id", "target"])
    return scored.select("order_id", "target", "probability", "risk_score", "risk_band")


# --- outliers and summaries -----------------------------------------------------------


@query
def outliers_iforest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their anomaly score; the 5 % most anomalous are no inliers."""
    table = materialize(O.clean_features(spark, sf).select("order_id", *O.NUMERIC), "measures", spread=True)
    return outliers.mark_outliers(table, O.NUMERIC, "order_id").select("order_id", r("anomaly").alias("anomaly"), "is_inlier")


@query
def iforest_grown(spark: SparkSession, sf: str) -> DataFrame:
    """Anomaly score of every order by a grown forest of twelve trees of depth two."""
    orders = O.load(spark, sf, "orders").join(O.load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "o_totalprice", F.coalesce("c_acctbal", F.lit(0.0)).alias("c_acctbal"), F.col("o_custkey").cast("double").alias("o_custkey"))
    table = materialize(orders, "measures", spread=True)
    fit = outliers.fit_iforest(table, ["o_totalprice", "c_acctbal", "o_custkey"], "o_orderkey", max_depth=2, **SMALL_IFOREST)
    return outliers.score_iforest(table, fit, "score").select("o_orderkey", r("score").alias("score"))


@query
def outlier_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The 95 % quantile of event values and the rows it keeps and removes."""
    rows = O.load(spark, sf, "events").select("value")
    limit = outliers.outlier_threshold(rows, "value")
    inside = F.col("value") <= F.lit(limit)
    return rows.agg(r(F.lit(limit)).alias("threshold"), F.count_if(inside).alias("kept"), F.count_if(~inside).alias("removed"))


@query
def preview_head(spark: SparkSession, sf: str) -> DataFrame:
    """First ten orders by key."""
    return O.load(spark, sf, "orders").orderBy("o_orderkey").limit(10).select("o_orderkey", "o_custkey", "o_totalprice")


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One row: size and class balance of the orders, best rule by f1."""
    shape = O.order_features(spark, sf).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("target") == 0).alias("kept_orders"),
        F.count_if(F.col("target") == 1).alias("returned_orders"))
    best = rounded(metrics.best_model(_rule_metrics(spark, sf), ["f1"]))
    both = shape.unionByName(best, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# --- fitted models whose results SQL can compute as well -------------------------------


def _flag_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of all orders with their 0/1 flags, missing ones 0; the target is to have four lines."""
    many = (F.coalesce("n_lines", F.lit(0.0)) >= 4).cast("int").alias("target")
    rows = O.order_features(spark, sf).select("order_id", many, *[F.coalesce(c, F.lit(0)).alias(c) for c in O.FLAGS])
    return split(materialize(rows, "flags"), ["order_id"], stratify="target")


def _stump(spark: SparkSession, sf: str, names: list[str]) -> tuple[object, DataFrame, DataFrame]:
    """Decision tree of depth one on flags: (model, its metrics, scored test rows)."""
    train, test = _flag_rows(spark, sf)
    vectors = _dealt(models.assemble(train, names, "target", ["order_id"]))
    held = models.assemble(test, names, "target", ["order_id"])
    model, quality = models.evaluate("Stump", models.decision_tree(1), vectors, held)
    return model, quality, models.probability_of_one(model.transform(held))


@query
def classify_stump(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_stump(spark, sf, O.FLAGS)[1])


@query
def stump_importance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(models.importance_table(spark, _stump(spark, sf, O.FLAGS)[0], O.FLAGS, 3))


@query
def stump_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Risk score, band and outcome of every held-out order."""
    scored = _stump(spark, sf, O.FLAGS)[2].withColumn("predicted_risk_score", C.percent("probability_1"))
    band = C.band_right_closed("predicted_risk_score", S.SCORE_EDGES, S.SCORE_BANDS)
    return scored.select("order_id", "predicted_risk_score", band.alias("risk_band"), F.col("label").cast("int").alias("actual_target"))


@query
def compare_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """Three stumps on one split, each with one flag, and the best of them."""
    found = [_stump(spark, sf, [c])[1].withColumn("model", F.lit(c)) for c in ("open_lines", "bulk", "urgent")]
    return rounded(metrics.best_model(models.compare(found), ["accuracy"]))


def _slopes(spark: SparkSession, sf: str) -> DataFrame:
    table = O.clean_features(spark, sf)
    slopes = table.agg(*[F.regr_slope("target", c).alias(c) for c in O.NUMERIC]).first()  # one row
    return models.weights_table(spark, [slopes[c] for c in O.NUMERIC], O.NUMERIC, "slope")


@query
def top_slopes_positive(spark: SparkSession, sf: str) -> DataFrame:
    return models.top_weights(_slopes(spark, sf), "slope", 2).select("feature")


@query
def top_slopes_negative(spark: SparkSession, sf: str) -> DataFrame:
    return models.top_weights(_slopes(spark, sf), "slope", 2, largest=False).select("feature")


LLOYD_STEPS = 4


@query
def kmeans_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    """Centres after four passes from the class means, ranked by the share of even labels."""
    rows = _labelled_points(spark, sf).withColumn("even", (F.col("label") % 2 == 0).cast("int"))
    centers, _, _ = cluster.lloyd(rows.select("x"), _class_means(rows), LLOYD_STEPS)
    placed = materialize(cluster.assign(rows, F.col("x"), centers), "placed")
    ranked = cluster.rank_labels(cluster.cluster_rates(placed, "cluster", "even"), "cluster", S.RISK_LABELS)
    names = [str(i + 1) for i in range(centers.shape[1])]
    return rounded(cluster.centroid_table(rows, cluster.KMeansFit(len(centers), centers, 0.0, LLOYD_STEPS), names, ranked))


@query
def elbow_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    """Within-cluster squares after four passes from the first k class means, k = 2 to 5."""
    rows = _labelled_points(spark, sf)
    means = _class_means(rows)
    fits = {}
    for k in range(2, 6):
        centers, _, cost = cluster.lloyd(rows.select("x"), means[:k], LLOYD_STEPS)
        fits[k] = cluster.KMeansFit(k, centers, float(cost.sum()), LLOYD_STEPS)
    return rounded(cluster.elbow_table(spark, fits))


#: Two isolation trees: (tree, node, feature, cut, left, right, path), leaves with feature -1.
FIXED_FOREST = [
    (0, 0, 0, 100000.0, 1, 2, 0.0), (0, 1, 1, 0.0, 3, 4, 0.0), (0, 2, -1, 0.0, 2, 2, 1.5), (0, 3, -1, 0.0, 3, 3, 2.0), (0, 4, -1, 0.0, 4, 4, 4.25),
    (1, 0, 1, 5000.0, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 3.5), (1, 2, 0, 250000.0, 3, 4, 0.0), (1, 3, -1, 0.0, 3, 3, 2.75), (1, 4, -1, 0.0, 4, 4, 2.0),
]


@query
def iforest_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that a fixed forest keeps, with their scores; the limit is the 90 % quantile."""
    nodes = pd.DataFrame(FIXED_FOREST, columns=["tree", "node", "feature", "split", "left", "right", "path"])
    forest = outliers.IsolationForest(["totalprice", "acctbal"], nodes, 2, 256)
    table = O.load(spark, sf, "orders").join(O.load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("totalprice"), F.col("c_acctbal").alias("acctbal"))
    scored = materialize(outliers.score_iforest(table, forest), "anomaly")
    marked = scored.withColumn("is_inlier", F.col("anomaly") <= F.lit(outliers.outlier_threshold(scored, "anomaly", 0.1)))
    shown = marked.withColumn("score", r("anomaly"))
    return outliers.drop_outliers(shown).select("order_id", "score")


@query
def pca_reduced(spark: SparkSession, sf: str) -> DataFrame:
    """Two components of four standardised measures: C v - (share x trace) v, the length of v, and the trace."""
    lines = O.load(spark, sf, "lineitem")
    scaled = materialize(features.apply_zscore(lines, features.fit_zscore(lines, MEASURES)).select(*MEASURES), "scaled")
    loadings, _, shares = pca.fit_pca(scaled, MEASURES, 2)
    cells = {(c["row"], c["col"]): c["value"] for c in models.covariance_matrix(scaled, MEASURES).collect()}  # 4 x 4 numbers
    cov = np.array([[cells.get((a, b), cells.get((b, a))) for b in MEASURES] for a in MEASURES])
    trace = float(np.trace(cov))
    rows = [(f"pc{i + 1}", float(np.abs(cov @ v - share * trace * v).max()), float(v @ v), trace, float(cov[0, 1]))
            for i, (v, share) in enumerate(zip(loadings, shares))]
    return rounded(spark.createDataFrame(rows, "component string, residual double, length double, trace double, corr double"), 5)


@query
def csv_bom(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as comma text with a byte-order mark and read back by column name."""
    text = O.load(spark, sf, "customer").select(F.col("c_name").alias("\ufeffc_name"), "c_acctbal", "c_custkey")
    path = files.write_table(text, scratch_path(spark, "customer-csv"), "csv")
    return files.read_delimited(spark, path, {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double"})


@query
def star_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension of flags, stored as whole numbers with 0 where an order has no lines."""
    tables = build_star(
        O.order_features(spark, sf), ["order_id"], {"dim_flags": ("flags_id", ["open_lines", "bulk", "high_tax"])}, "flag_fact",
        ["target"], O.RISK_FLAGS, defaults=["open_lines", "bulk", "high_tax"])
    return tables["dim_flags"]


@query
def run_quality(spark: SparkSession, sf: str) -> DataFrame:
    """One row: orders, best stump, and the error of the price regression."""
    shape = O.load(spark, sf, "orders").agg(F.count(F.lit(1)).alias("row_count"))
    parts = [shape, compare_stumps(spark, sf), regress_simple(spark, sf).select("rmse", "r2")]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
