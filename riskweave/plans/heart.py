"""The clinical run: three sources to one patient table, warehouse, models and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions.columns import band_right_closed, convert, percent, ratio_per_square, recode
from riskweave.operators import clean, cluster, features, integrate, metrics, models, outliers, pca, rules, warehouse
from riskweave.operators.forest import fit_forest, fit_tree
from riskweave.operators.logistic import fit_logistic
from riskweave.operators.scoring import Artefacts
from riskweave.operators.split import mark_test, split
from riskweave.session import materialize
from riskweave.sources.files import load_scaler, read_delimited, read_table, save_scaler, source_counts, write_table

FACT = "heart_disease_fact"
DIMS = {
    "dim_patient": ("patient_id", S.DIM_PATIENT),
    "dim_clinical": ("clinical_id", S.DIM_CLINICAL),
    "dim_lifestyle": ("lifestyle_id", S.DIM_LIFESTYLE),
}
SPLIT_SEED = 42
KEYS = {FACT: "fact_id", **{t: k for t, (k, _) in DIMS.items()}}

# Roll-up queries: dimension, grouping column and result columns.
ROLLUPS = {
    "risk_by_gender": ("dim_patient", "gender", ["avg_risk_score", "patient_count", "disease_count"]),
    "disease_by_smoking": ("dim_lifestyle", "smoke", ["disease_rate", "patient_count"]),
    "disease_by_medication": ("dim_clinical", "BPMeds", ["disease_rate", "patient_count"]),
}


def read_sources(spark: SparkSession, uci: str, framingham: str, cardio: str) -> dict[str, DataFrame]:
    return {
        "uci": read_delimited(spark, uci, S.UCI_COLUMNS),
        "framingham": read_delimited(spark, framingham, S.FRAMINGHAM_COLUMNS),
        "cardio": read_delimited(spark, cardio, S.CARDIO_COLUMNS, sep=";"),
    }


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def mappings() -> dict[str, dict[str, Column | str]]:
    """Source column or expression behind each canonical column; the rest is NULL."""
    return {
        "cardio": {
            "age": convert("age", S.DAYS_PER_YEAR), "gender": recode("gender", S.CARDIO_GENDER),
            "BMI": ratio_per_square("weight", "height"), "sysBP": "ap_hi", "diaBP": "ap_lo",
            "cholesterol": recode("cholesterol", S.CARDIO_CHOLESTEROL), "glucose": recode("gluc", S.CARDIO_GLUCOSE),
            "alcohol": "alco", "target": "cardio", **_same("smoke", "active"),
        },
        "framingham": {
            "gender": "male", "cholesterol": "totChol", "smoke": "currentSmoker", "stroke": "prevalentStroke",
            "hypertension": "prevalentHyp", "target": "TenYearCHD",
            **_same("age", "BMI", "sysBP", "diaBP", "glucose", "BPMeds", "diabetes", "heartRate"),
        },
        "uci": {
            "gender": "sex", "sysBP": "trestbps", "cholesterol": "chol", "glucose": recode("fbs", S.UCI_GLUCOSE),
            **_same("age", "cp", "restecg", "thalach", "exang", "oldpeak", "slope", "ca", "thal", "target"),
        },
    }


def integrate_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All sources in the canonical layout, copies kept."""
    maps = mappings()
    order = [n for n in ("cardio", "framingham", "uci") if n in sources]
    return integrate.union_all(
        *[integrate.harmonise(sources[n], maps[n], S.CANONICAL_COLUMNS) for n in order]
    )


@dataclass
class Prepared:
    """Cleaned, encoded and scaled patients with what was fitted on the way."""

    patients: DataFrame  # with row_key, the identity of the deduplicated raw row
    unscaled: DataFrame  # the same rows before standardisation
    columns: list[str]  # feature columns in order, without the target
    categories: dict[str, list]
    scaler: dict[str, tuple[float, float]]
    imputed_with: dict[str, object]
    removed_copies: DataFrame
    removed_outliers: DataFrame


def prepare(
    combined: DataFrame, contamination: float = 0.05, trees: int = 100, fit_on: str = "all"
) -> Prepared:
    """Deduplicate, impute, drop outliers, encode and standardise.

    By default fill values, outlier model and scale come from all rows, before any
    split. ``fit_on="train"`` takes them from the training rows of the stratified
    split that :func:`classify` would make of the deduplicated rows.
    """
    combined = materialize(combined, "combined")
    names = list(S.CANONICAL_COLUMNS)
    distinct = integrate.dedup(combined)
    keyed = materialize(distinct.withColumn("row_key", integrate.row_key(distinct, names)), "distinct")
    if fit_on == "train":
        keyed = materialize(mark_test(keyed, ["row_key"], stratify="target", seed=SPLIT_SEED), "marked")
        source = lambda df: df.where(~F.col("is_test"))
    else:
        source = lambda df: df
    mode_cols = [*S.BINARY, *S.NOMINAL]
    fill = clean.fit_impute(source(keyed), S.CONTINUOUS, mode_cols)
    filled = materialize(features.cast_int(clean.apply_impute(keyed, fill), mode_cols), "filled", spread=True)
    forest = outliers.fit_iforest(source(filled), S.CONTINUOUS, "row_key", trees)
    scored = materialize(outliers.score_iforest(filled, forest), "anomaly")
    limit = outliers.outlier_threshold(source(scored), contamination=contamination)
    marked = scored.withColumn("is_inlier", F.col("anomaly") <= F.lit(limit))
    inliers = outliers.drop_outliers(marked)
    categories = features.fit_one_hot(inliers, S.NOMINAL)
    encoded = features.apply_one_hot(inliers, categories)
    scaler = features.fit_zscore(source(encoded), S.CONTINUOUS)
    scaled = materialize(features.apply_zscore(encoded, scaler), "patients")
    columns = [c for c in scaled.columns if c not in ("row_key", "target", "is_test")]
    return Prepared(
        scaled, encoded, columns, categories, scaler, fill,
        integrate.dedup_stats(combined, keyed), integrate.dedup_stats(marked, marked.where("is_inlier")),
    )


def build_warehouse(prepared: Prepared, scaled: bool = True) -> dict[str, DataFrame]:
    """Fact and dimension tables over the prepared patients, registered as views.

    ``scaled=False`` stores measures in their units instead of standardised ones.
    """
    tables = warehouse.build_star(
        prepared.patients if scaled else prepared.unscaled, ["row_key"], DIMS, FACT, ["target"], S.RISK_FLAGS,
        defaults=["gender", "hypertension", "diabetes", "stroke", "BPMeds", "smoke", "alcohol", "active"],
    )
    warehouse.register_views(tables)
    return tables


def olap(tables: Mapping[str, DataFrame], digits: int | None = None) -> dict[str, DataFrame]:
    """The three roll-ups over the warehouse; ``digits`` rounds their averages as SQL does.

    Other questions go to ``spark.sql``, which sees the tables as views.
    """
    measures = {
        "avg_risk_score": F.avg("risk_score"), "patient_count": F.count("*"),
        "disease_count": F.sum("target"), "disease_rate": F.avg("target"),
    }
    return {
        name: warehouse.rollup_query(tables[FACT], tables[dim], KEYS[dim], by, {m: measures[m] for m in wanted}, digits)
        for name, (dim, by, wanted) in ROLLUPS.items()
    }


def classify(prepared: Prepared, forest_depth: int = 30, trees: int = 100) -> dict[str, object]:
    """Three classifiers on one stratified split, with their metrics and test scores."""
    if "is_test" in prepared.patients.columns:
        train, test = prepared.patients.where("not is_test"), prepared.patients.where("is_test")
    else:
        train, test = split(prepared.patients, ["row_key"], stratify="target", seed=SPLIT_SEED)
    train, test = materialize(train, "train", spread=True), materialize(test, "test")
    columns = prepared.columns
    fitted = {
        "Logistic Regression": fit_logistic(train, columns, "target"),
        "Decision Tree": fit_tree(train, columns, "target", "row_key"),
        "Random Forest": fit_forest(train, columns, "target", "row_key", trees, forest_depth),
    }
    scored = {n: m.transform(test).withColumn("prediction", F.col("prediction").cast("int")) for n, m in fitted.items()}
    weights = models.weights_table(train.sparkSession, fitted["Random Forest"].importances(), columns, "importance")
    return {
        "models": fitted,
        "train_classes": metrics.value_counts(train.select(F.col("target").cast("double").alias("label")), "label"),
        "comparison": models.compare([metrics.binary_metrics(t, "target", "prediction", n) for n, t in scored.items()]),
        "reports": {n: metrics.class_report(t, "target", "prediction", S.CLASS_NAMES) for n, t in scored.items()},
        "importances": models.top_weights(weights, "importance", 10),
        "risk_bands": risk_table(scored["Random Forest"]),
    }


def risk_table(scored: DataFrame) -> DataFrame:
    """(predicted_risk_score, risk_band, actual_target) of scored test rows."""
    return scored.withColumn("predicted_risk_score", percent("probability_1")).select(
        "predicted_risk_score",
        band_right_closed("predicted_risk_score", S.SCORE_EDGES, S.SCORE_BANDS).alias("risk_band"),
        F.col("target").cast("int").alias("actual_target"),
    )


def regress(prepared: Prepared, x: str = "sysBP", y: str = "cholesterol") -> dict[str, DataFrame]:
    """Simple and multiple regression of cholesterol on one 80/20 split."""
    rows = prepared.patients.dropna(subset=[y])
    train, test = split(rows, ["row_key"], seed=SPLIT_SEED)
    simple = models.predict_simple(test, models.simple_regression(train, x, y), x)
    columns = [c for c in prepared.columns if c != y]
    fitted, multiple = models.multiple_regression(
        models.assemble(train, columns, y), models.assemble(test, columns, y))
    weights = models.weights_table(rows.sparkSession, fitted.coefficients.toArray(), columns, "coefficient")
    return {
        "metrics": metrics.regression_metrics(simple, y, "prediction", "simple").unionByName(multiple),
        "top_positive": models.top_weights(weights, "coefficient"),
        "top_negative": models.top_weights(weights, "coefficient", largest=False),
    }


def segment(prepared: Prepared, restarts: int = 10) -> dict[str, DataFrame]:
    """Elbow table, labelled clusters, centroids and principal components."""
    points = cluster.as_points(prepared.patients, S.CONTINUOUS)
    fits = cluster.fit_many(points, range(2, 9), restarts)
    assigned = cluster.assign(prepared.patients, S.CONTINUOUS, fits[3].centers)
    labelled = cluster.label_clusters(assigned, "cluster", "target", S.RISK_LABELS)
    ranked = cluster.rank_labels(
        cluster.cluster_rates(assigned, "cluster", "target"), "cluster", S.RISK_LABELS)
    coords, variance = pca.pca_2d(labelled, S.CONTINUOUS)
    return {
        "elbow": cluster.elbow_table(points.sparkSession, fits), "patients": labelled,
        "profile": cluster.label_profile(labelled, "target", S.RISK_LABELS),
        "centroids": cluster.centroid_table(labelled, fits[3], S.CONTINUOUS, ranked),
        "components": coords.select("risk_label", "pc1", "pc2"), "explained": variance,
    }


def associate(prepared: Prepared) -> dict[str, DataFrame]:
    """Frequent itemsets and rules among the clinical flags."""
    frequent = materialize(rules.itemsets(prepared.patients, S.RULE_ITEMS, 0.1), "itemsets")
    found = materialize(rules.rules(frequent, 0.6), "rules")
    return {"itemsets": frequent, "rules": found, "top_rules": rules.top_rules(found)}


def run_summary(prepared: Prepared, comparison: DataFrame, regression: DataFrame) -> DataFrame:
    """One row: shape, class balance, best classifier, regression quality."""
    shape = prepared.patients.agg(
        F.count("*").alias("row_count"), F.lit(len(prepared.columns) + 1).alias("column_count"),
        F.count_if(F.col("target") == 0).alias("no_disease"), F.count_if(F.col("target") == 1).alias("disease"),
    )
    best = metrics.best_model(comparison)
    multi = regression.where("model = 'multiple'").select("rmse", "r2")
    all_ = shape.unionByName(best, allowMissingColumns=True).unionByName(multi, allowMissingColumns=True)  # one row each
    return all_.agg(*[F.max(c).alias(c) for c in all_.columns])


def run(spark: SparkSession, uci: str, framingham: str, cardio: str, out: str, forest_depth: int = 30,
        trees: int = 100, restarts: int = 10) -> dict[str, object]:
    """The whole run. Saves the feature table, the scaler and the warehouse below ``out``."""
    sources = read_sources(spark, uci, framingham, cardio)
    prepared = prepare(integrate_sources(sources))
    write_table(prepared.patients, f"{out}/features")
    write_table(prepared.patients.drop("row_key"), f"{out}/features_csv", "csv")
    save_scaler(spark, prepared.scaler, f"{out}/scaler")
    tables = build_warehouse(prepared)
    warehouse.save_star(tables, f"{out}/warehouse")
    tables = warehouse.load_star(spark, f"{out}/warehouse", list(tables))
    classified = classify(prepared, forest_depth, trees)
    regression = regress(prepared)
    return {
        "prepared": prepared,
        "source_counts": source_counts(sources),
        "table_counts": source_counts(tables),
        "preview": prepared.patients.orderBy("row_key").limit(3),
        "null_cells": clean.total_nulls(prepared.patients),
        "describe": clean.describe_exact(prepared.patients, S.CONTINUOUS),
        "olap": olap(tables),
        "classification": classified,
        "regression": regression,
        "clusters": segment(prepared, restarts),
        "rules": associate(prepared),
        "band_summary": metrics.band_summary(classified["risk_bands"], "risk_band", "actual_target", S.SCORE_BANDS),
        "summary": run_summary(prepared, classified["comparison"], regression["metrics"]),
    }


def fit_artefacts(
    spark: SparkSession, features_path: str, scaler_path: str, categories: Mapping[str, list] | None = None,
    trees: int = 100, max_depth: int = 30, least_deviation: float = 1e-6,
    collapsed: Sequence[str] = tuple(S.COLLAPSED),
) -> tuple[Artefacts, DataFrame]:
    """Train the scorer on the saved feature table and scaler: (artefacts, holdout metrics).

    The ``collapsed`` columns, and those whose fitted deviation is at most ``least_deviation``,
    are neutralised, as scaling them would only enlarge noise. Without ``categories`` they are read off the dummy column names, each with a
    dropped smallest category.
    """
    table = read_table(spark, features_path)
    scaler = load_scaler(spark, scaler_path)
    columns = [c for c in table.columns if c not in ("row_key", "target", "is_test")]
    if categories is None:
        kept = {o: sorted(int(c[len(o) + 1:]) for c in columns if c.startswith(f"{o}_")) for o in S.NOMINAL}
        categories = {o: [None, *v] for o, v in kept.items()}
    train, test = split(table, ["row_key"], stratify="target", seed=SPLIT_SEED)
    model = fit_forest(materialize(train, "train"), columns, "target", "row_key", trees, max_depth)
    quality = metrics.binary_metrics(model.transform(test), "target", "prediction", "Random Forest")
    art = Artefacts(
        features=columns, scaler={c: scaler[c] for c in S.CONTINUOUS if c in columns}, categories=dict(categories),
        collapsed=[c for c in scaler if c in {*collapsed, *features.collapsed_columns(scaler, least_deviation)}], weights=model.importances().tolist(), model=model,
    )
    return art, quality
