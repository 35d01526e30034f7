"""Score new records with fitted transforms: validate, encode, scale, predict, explain.

Everything here is a projection without shuffles or state, so the same functions
serve batch tables and streams.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions.columns import abs_above, band_left_closed, parse_yes_no, percent
from riskweave.operators.features import align_to, apply_one_hot, apply_zscore, fixed_zero
from riskweave.operators.forest import Forest
from riskweave.sources.files import load_scaler, save_scaler


@dataclass
class Artefacts:
    """What scoring needs from training. ``model`` is a fitted classifier; without
    one ``weights`` and ``intercept`` form a logistic score."""

    features: list[str]
    scaler: dict[str, tuple[float, float]]
    categories: dict[str, list] = field(default_factory=dict)
    collapsed: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0
    model: Model | Forest | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        save_scaler(spark, self.scaler, f"{path}/scaler")
        meta = {"features": self.features, "categories": self.categories, "collapsed": self.collapsed,
                "weights": [float(w) for w in self.weights], "intercept": self.intercept,
                "has_model": self.model is not None, "is_forest": isinstance(self.model, Forest)}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/meta")
        if isinstance(self.model, Forest):
            self.model.save(spark, f"{path}/model")
        elif self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str, model_class: type = RandomForestClassificationModel) -> Artefacts:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        has_model, is_forest = meta.pop("has_model"), meta.pop("is_forest", False)
        model = None
        if has_model:
            model = Forest.load(spark, f"{path}/model") if is_forest else model_class.load(f"{path}/model")
        return Artefacts(scaler=load_scaler(spark, f"{path}/scaler"), model=model, **meta)


def validate_inputs(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]] = S.INPUT_RANGES,
    whole: Sequence[str] = tuple(S.INPUT_WHOLE),
    yes_no: Sequence[str] = tuple(S.INPUT_YES_NO),
) -> DataFrame:
    """Add ``rejected_reason``, one text per broken rule; an empty array means accepted."""

    def reason(broken: Column, text: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(True)), F.lit(text))

    checks = []
    for c, (lo, hi) in ranges.items():
        number = F.col(c).try_cast("double")
        fits = number.between(lo, hi)
        if c in whole:
            fits &= number == F.floor(number)
        checks.append(reason(~fits, f"{c}: no {'whole ' if c in whole else ''}number in {lo}-{hi}"))
    checks += [reason(parse_yes_no(F.col(c).cast("string")).isNull(), f"{c}: not yes or no") for c in yes_no]
    return df.withColumn("rejected_reason", F.array_compact(F.array(*checks)))


def parse_answers(df: DataFrame, yes_no: Sequence[str]) -> DataFrame:
    """Turn yes/no text columns into 1/0."""
    return df.withColumns({c: parse_yes_no(F.col(c).cast("string")) for c in yes_no if c in df.columns})


def build_features(df: DataFrame, art: Artefacts, keep: Sequence[str] = ()) -> DataFrame:
    """Raw records to the trained layout; ``keep`` columns pass through as ``__id_`` columns.

    Categories and scale come from training, so one record is encoded exactly
    like a whole table. Collapsed columns are set to their training mean.
    """
    ids = [f"__id_{c}" for c in keep]
    tagged = df.withColumns({i: F.col(c) for i, c in zip(ids, keep)})
    wide = align_to(apply_one_hot(tagged, art.categories), [*ids, *art.features])
    scaled = apply_zscore(wide, {c: s for c, s in art.scaler.items() if c in art.features})
    return fixed_zero(scaled, art.collapsed)


def drift_flags(df: DataFrame, cols: Sequence[str], limit: float = 6, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (keep, feature, z) for every scaled value whose magnitude exceeds ``limit``."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("z")) for c in cols])
    return df.select(*keep, F.inline(F.filter(cells, lambda s: abs_above(s["z"], limit))))


def contributions(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], top: int = 5, bottom: int = 3
) -> DataFrame:
    """Add ``top_up`` and ``top_down``: the largest and smallest weight x value, with feature names.

    Missing values contribute nothing and are not listed. Ties keep the column
    order. Sorting stays inside the row.
    """
    values = [F.col(c).cast("double") * F.lit(float(w)) for c, w in zip(features, weights, strict=True)]

    def ranked(sign: float, n: int) -> Column:
        cells = F.array(*[
            F.struct((v * F.lit(sign)).alias("by"), F.lit(i).alias("i"), F.lit(c).alias("feature"), v.alias("contribution"))
            for i, (c, v) in enumerate(zip(features, values))
        ])
        known = F.filter(cells, lambda s: s["contribution"].isNotNull())
        return F.transform(
            F.slice(F.array_sort(known), 1, n),
            lambda s: F.struct(s["feature"].alias("feature"), s["contribution"].alias("contribution")),
        )

    return df.withColumns({"top_up": ranked(-1.0, top), "top_down": ranked(1.0, bottom)})


def risk_band(prob: Column | str) -> Column:
    return band_left_closed(prob, S.PROBABILITY_CUTS, S.PROBABILITY_BANDS)


def verdict(prob: Column | str) -> Column:
    return band_left_closed(prob, S.PROBABILITY_CUTS, S.VERDICTS)


def advice(prob: Column | str) -> Column:
    """Advice lines; records from the medium band on get two more."""
    prob = F.col(prob) if isinstance(prob, str) else prob
    general = F.array(*[F.lit(t) for t in S.ADVICE_GENERAL])
    at_risk = F.array(*[F.lit(t) for t in S.ADVICE_AT_RISK])
    return F.when(prob >= F.lit(S.PROBABILITY_CUTS[0]), F.concat(at_risk, general)).otherwise(general)


def logistic_probability(features: Sequence[str], weights: Sequence[float], intercept: float) -> Column:
    """Logistic function of a weighted sum of columns."""
    total = F.lit(float(intercept))
    for c, w in zip(features, weights, strict=True):
        total = total + F.col(c) * F.lit(float(w))
    return 1.0 / (1.0 + F.exp(-total))


def score(df: DataFrame, art: Artefacts, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, probability, risk_score, risk_band, verdict, top_up, top_down, advice) per record."""
    features = build_features(df, art, keep)
    if art.model is None:
        scored = features.withColumn("probability_1", logistic_probability(art.features, art.weights, art.intercept))
    elif isinstance(art.model, Forest):
        scored = art.model.transform(features)
    else:
        vectors = VectorAssembler(inputCols=art.features, outputCol="features").transform(features)
        scored = art.model.transform(vectors).withColumn("probability_1", vector_to_array("probability")[1])
    explained = contributions(scored, art.features, art.weights)
    p = F.col("probability_1")
    return explained.select(
        *[F.col(f"__id_{c}").alias(c) for c in keep],
        p.alias("probability"), percent(p).alias("risk_score"), risk_band(p).alias("risk_band"),
        verdict(p).alias("verdict"), "top_up", "top_down", advice(p).alias("advice"),
    )
