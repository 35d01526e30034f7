import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.operators import features, scoring
from riskweave.streaming.score import read_records, start_scoring

GOOD = {"age": "50", "gender": "1", "BMI": "27.5", "sysBP": "130", "diaBP": "80", "heartRate": "70", "cholesterol": "210",
        "glucose": "90", "smoke": "y", "alcohol": "no", "active": " YES ", "hypertension": "0", "diabetes": "n", "stroke": "N",
        "BPMeds": "1", "cp": "2", "thalach": "150", "exang": "no", "oldpeak": "0.0", "slope": "1", "restecg": "0", "ca": "0",
        "thal": "2"}


def records(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in GOOD))


def test_validation_rules(spark):
    df = records(spark, {}, {"age": "17.9"}, {"age": "100"}, {"thal": "0"}, {"ca": "1.5"}, {"BMI": "abc"}, {"smoke": "maybe"}, {"cp": None})
    got = [r["rejected_reason"] for r in scoring.validate_inputs(df).collect()]
    assert got == [[], ["age: no number in 18-100"], [], ["thal: no whole number in 1-3"], ["ca: no whole number in 0-3"],
                   ["BMI: no number in 10-70"], ["smoke: not yes or no"], ["cp: no whole number in 0-3"]]
    assert set(S.INPUT_RANGES) | set(S.INPUT_YES_NO) == set(GOOD)


def art():
    return scoring.Artefacts(
        features=["x", "n", "cp_1", "cp_2"], scaler={"x": (10.0, 2.0), "n": (5.0, 1.0)}, categories={"cp": [0, 1, 2]},
        collapsed=["n"], weights=[1.0, 9.0, 0.5, -2.0], intercept=0.1)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, 12.0, 7.0, 1), (2, 10.0, 5.0, 2), (3, 4.0, 0.0, 0)], "id int, x double, n double, cp int")


def test_single_record_is_encoded_like_a_table(rows):
    whole = {r["id"]: r for r in scoring.score(rows, art(), ["id"]).collect()}
    for i in (1, 2, 3):
        assert scoring.score(rows.where(F.col("id") == i), art(), ["id"]).first() == whole[i]
    expect = 1 / (1 + np.exp(-(0.1 + 1.0 + 0.5)))
    assert whole[1]["probability"] == pytest.approx(expect)
    assert whole[1]["risk_band"] == "HIGH RISK" and len(whole[1]["advice"]) == 6
    assert whole[3]["risk_band"] == "LOW RISK" and len(whole[3]["advice"]) == 4


def test_contributions_order_and_ties(rows):
    row = scoring.score(rows, art(), ["id"]).where("id = 1").first()
    assert [(c["feature"], c["contribution"]) for c in row["top_up"]] == [("x", 1.0), ("cp_1", 0.5), ("n", 0.0), ("cp_2", 0.0)]
    assert [c["feature"] for c in row["top_down"]] == ["n", "cp_2", "cp_1"]


def test_scoring_has_no_shuffle(rows):
    plan = scoring.score(rows, art(), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_drift_rows(spark):
    df = spark.createDataFrame([(1, 6.0, -6.1), (2, 7.0, None)], "id int, a double, b double")
    got = sorted(tuple(r) for r in scoring.drift_flags(df, ["a", "b"], 6, ["id"]).collect())
    assert got == [(1, "b", -6.1), (2, "a", 7.0)]


def test_save_load_and_stream_equal_batch(spark, rows, tmp_path):
    art().save(spark, str(tmp_path / "art"))
    loaded = scoring.Artefacts.load(spark, str(tmp_path / "art"))
    assert loaded == art()
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    for batch in range(2):  # the second run finds nothing new
        stream = read_records(spark, str(tmp_path / "in"), rows.schema)
        assert stream.isStreaming
        start_scoring(stream, loaded, ["id"], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
        assert got == scoring.score(rows, art(), ["id"]).orderBy("id").collect()


def test_yes_no_answers_become_flags(spark):
    parsed = scoring.parse_answers(records(spark, {}), S.INPUT_YES_NO).first()
    assert [parsed[c] for c in ("smoke", "alcohol", "active", "BPMeds")] == [1, 0, 1, 1]


def test_constant_column_scores_as_zero(spark):
    df = spark.createDataFrame([(3.0,), (None,)], "v double")
    assert [r[0] for r in features.apply_zscore(df, {"v": (3.0, 1e-12)}).collect()] == [0.0, None]
