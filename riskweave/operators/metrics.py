"""Quality measures of classifiers and regressions, each from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def compare_predictions(df: DataFrame, label: str, preds: Sequence[str]) -> DataFrame:
    """Rows (model, accuracy, precision, recall, f1) of class 1, one per prediction column.

    All columns are counted in one pass; a zero denominator gives 0.
    """
    y = F.col(label) == 1
    counts = []
    for i, p in enumerate(preds):
        yes = F.col(p) == 1
        counts.append(F.struct(
            F.lit(p).alias("model"), F.count_if(y & yes).alias("tp"), F.count_if(yes).alias("predicted"),
            F.count_if(y).alias("actual"), F.count_if(F.col(label) == F.col(p)).alias("hit"), F.count("*").alias("n"),
        ).alias(f"m{i}"))
    rows = df.agg(*counts).select(F.inline(F.array(*[f"m{i}" for i in range(len(preds))])))
    return rows.select(
        "model", _ratio(F.col("hit"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"),
    )


def binary_metrics(df: DataFrame, label: str, pred: str, name: str | None = None) -> DataFrame:
    """accuracy, precision, recall and f1 of one prediction column, with ``name`` as model."""
    out = compare_predictions(df, label, [pred])
    return out.withColumn("model", F.lit(name)) if name else out.drop("model")


def class_report(df: DataFrame, label: str, pred: str, names: Mapping | None = None) -> DataFrame:
    """Rows (class, precision, recall, f1, support) per class, then accuracy and averages.

    The table is reduced to one row per (label, prediction) pair first.
    """
    pairs = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(
        F.inline(F.array(
            F.struct(F.col("y").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                     F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("p").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                     F.lit(0).cast("bigint").alias("hit")),
        ))
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    per = per.select(
        "class", _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"), "support", "hit",
    )
    if names:
        shown = F.coalesce(*[F.when(F.col("class") == str(k), F.lit(v)) for k, v in names.items()], F.col("class"))
        per = per.withColumn("class", shown)
    measures = ["precision", "recall", "f1"]
    weight = F.col("support").cast("double")
    per = materialize(per, "classes")  # one row per class, read for the summary rows and for itself
    whole = per.agg(
        F.sum("support").alias("support"), _ratio(F.sum("hit"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * weight), F.sum(weight)).alias(f"weighted_{m}") for m in measures],
    )

    def line(title: str, cols: Sequence[str]) -> Column:
        return F.struct(F.lit(title).alias("class"), *[F.col(c).alias(m) for c, m in zip(cols, measures)], F.col("support"))

    tail = F.array(
        line("accuracy", ["accuracy"] * 3), line("macro avg", [f"macro_{m}" for m in measures]),
        line("weighted avg", [f"weighted_{m}" for m in measures]),
    )
    return per.select("class", *measures, "support").unionByName(whole.select(F.inline(tail)))


def regression_metrics(df: DataFrame, label: str, pred: str, name: str | None = None) -> DataFrame:
    """mse, rmse and r2; r2 compares with the mean of the rows measured."""
    err = F.col(label) - F.col(pred)
    sums = df.agg(F.avg(err * err).alias("mse"), F.var_pop(label).alias("var"))
    return sums.select(
        *([F.lit(name).alias("model")] if name else []),
        "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("var"))).alias("r2"),
    )


def best_model(metrics: DataFrame, by: Sequence[str] = ("f1", "accuracy")) -> DataFrame:
    """One row: for each measure the best value and the model that reached it."""
    cols = []
    for m in by:
        order = F.struct(-F.col(m), "model")
        cols += [F.min_by("model", order).alias(f"best_{m}_model"), F.max(m).alias(f"best_{m}")]
    return metrics.agg(*cols)


def value_counts(df: DataFrame, col: str, values: Sequence | None = None) -> DataFrame:
    """Rows (value, row_count). Given ``values`` are all kept, with 0 where absent."""
    if values is None:
        return df.groupBy(col).agg(F.count("*").alias("row_count"))
    row = df.agg(*[F.count_if(F.col(col) == F.lit(v)).alias(f"c{i}") for i, v in enumerate(values)])
    pairs = [F.struct(F.lit(v).alias(col), F.col(f"c{i}").alias("row_count")) for i, v in enumerate(values)]
    return row.select(F.inline(F.array(*pairs)))


def band_summary(df: DataFrame, band: str, outcome: str, bands: Sequence[str]) -> DataFrame:
    """Rows (ord, band, row_count, outcome_rate) in the given order, empty bands with NULL rate."""
    row = df.agg(
        *[F.struct(F.count_if(F.col(band) == b).alias("row_count"),
                   F.avg(F.when(F.col(band) == b, F.col(outcome))).alias("outcome_rate")).alias(f"b{i}")
          for i, b in enumerate(bands)]
    )
    parts = [F.struct(F.lit(i).alias("ord"), F.lit(b).alias(band), F.col(f"b{i}.row_count").alias("row_count"),
                      F.col(f"b{i}.outcome_rate").alias("outcome_rate")) for i, b in enumerate(bands)]
    return row.select(F.inline(F.array(*parts)))
