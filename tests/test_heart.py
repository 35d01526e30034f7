"""The clinical run on small synthetic files with the three sources' layouts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.operators import scoring
from riskweave.plans import heart


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    rng, root = np.random.default_rng(4), tmp_path_factory.mktemp("sources")

    def write(name, header, rows, sep, bom=""):
        body = "\r\n".join([sep.join(header), *[sep.join(map(str, r)) for r in rows]]) + "\r\n"
        (root / name).write_bytes((bom + body).encode())
        return str(root / name)

    n = 150
    sick = rng.random(n) < 0.5
    uci = [[int(rng.integers(30, 75)), rng.integers(0, 2), rng.integers(0, 4), rng.integers(95, 190), rng.integers(150, 400),
            rng.integers(0, 2), rng.integers(0, 3), int(rng.integers(90, 200) - 20 * s), rng.integers(0, 2),
            round(float(rng.random() * 4), 1), rng.integers(0, 3), rng.integers(0, 5), rng.integers(0, 4), int(s)] for s in sick]
    uci.append(uci[0])
    fram = [["x", rng.integers(35, 70), rng.integers(0, 2), round(float(rng.normal(26, 4)), 2) if i % 9 else "NA",
             rng.integers(100, 180), rng.integers(60, 110), rng.integers(150, 300), "NA" if i % 7 == 0 else rng.integers(60, 140),
             rng.integers(0, 2), "NA" if i % 11 == 0 else rng.integers(0, 2), rng.integers(0, 2), rng.integers(0, 2),
             rng.integers(0, 2), rng.integers(50, 100), rng.integers(0, 2)] for i in range(300)]
    cardio = [[i, rng.integers(14600, 23700), rng.integers(1, 3), rng.integers(150, 195), rng.integers(50, 110),
               rng.integers(100, 180), rng.integers(60, 110), rng.integers(1, 4), rng.integers(1, 4), rng.integers(0, 2),
               rng.integers(0, 2), rng.integers(0, 2), rng.integers(0, 2)] for i in range(400)]
    return (
        write("uci.csv", list(S.UCI_COLUMNS), uci, ",", "﻿"),
        write("framingham.csv", ["education", "age", "male", "BMI", "sysBP", "diaBP", "totChol", "glucose", "currentSmoker", "BPMeds",
                                 "prevalentStroke", "prevalentHyp", "diabetes", "heartRate", "TenYearCHD"], fram, ","),
        write("cardio.csv", ["id", *S.CARDIO_COLUMNS], cardio, ";"),
        str(root / "out"),
    )


@pytest.fixture(scope="module")
def run(spark, paths):
    return heart.run(spark, *paths, forest_depth=4, trees=10, restarts=2)


def test_counts_and_cleaning(run):
    assert {r["source"]: r["row_count"] for r in run["source_counts"].collect()} == {"uci": 151, "framingham": 300, "cardio": 400}
    copies = run["prepared"].removed_copies.first()
    assert copies["rows_before"] == 851 and copies["rows_removed"] >= 1
    outliers = run["prepared"].removed_outliers.first()
    assert outliers["rows_removed"] / outliers["rows_before"] == pytest.approx(0.05, abs=0.01)
    assert run["null_cells"].first()[0] == 0


def test_feature_layout(run):
    columns = run["prepared"].columns
    assert [c for c in columns if c in S.CONTINUOUS + S.BINARY] == [c for c in S.CANONICAL_COLUMNS if c in S.CONTINUOUS + S.BINARY]
    assert {"cp_1", "cp_2", "cp_3", "restecg_1", "restecg_2", "slope_1", "slope_2", "thal_1", "thal_2", "thal_3"} <= set(columns)
    stats = {r["feature"]: r for r in run["describe"].collect()}
    assert all(abs(stats[c]["mean"]) < 1e-9 for c in S.CONTINUOUS)


def test_warehouse_and_olap(run):
    n = run["prepared"].patients.count()
    assert {r["row_count"] for r in run["table_counts"].collect()} == {n}
    by_gender = run["olap"]["risk_by_gender"].collect()
    assert sum(r["patient_count"] for r in by_gender) == n
    assert sum(r["disease_count"] for r in by_gender) == run["prepared"].patients.where("target = 1").count()
    assert run["olap"]["disease_by_smoking"].columns == ["smoke", "disease_rate", "patient_count"]
    assert run["olap"]["disease_by_medication"].columns == ["BPMeds", "disease_rate", "patient_count"]


def test_models(run):
    table = run["classification"]["comparison"].collect()
    assert [r["model"] for r in table] == ["Logistic Regression", "Decision Tree", "Random Forest"]
    assert run["classification"]["importances"].count() == 10
    assert {r["model"] for r in run["regression"]["metrics"].collect()} == {"simple", "multiple"}
    assert run["regression"]["top_positive"].count() == 5 == run["regression"]["top_negative"].count()
    bands = run["band_summary"].collect()
    assert [r["risk_band"] for r in bands] == S.SCORE_BANDS
    assert set(run["classification"]["reports"]) == {r["model"] for r in table}
    report = [r["class"] for r in run["classification"]["reports"]["Decision Tree"].collect()]
    assert report == ["Disease", "No Disease", "accuracy", "macro avg", "weighted avg"]
    assert run["preview"].count() == 3


def test_clusters_rules_and_summary(run):
    wcss = [r["wcss"] for r in run["clusters"]["elbow"].orderBy("k").collect()]
    assert len(wcss) == 7 and wcss[0] > wcss[-1]
    assert run["clusters"]["centroids"].count() == 27
    assert run["clusters"]["components"].columns == ["risk_label", "pc1", "pc2"]
    assert run["rules"]["rules"].where("confidence < 0.6").count() == 0
    assert run["rules"]["top_rules"].count() <= 10
    row = run["summary"].first()
    assert row["row_count"] == row["no_disease"] + row["disease"] and row["best_f1_model"]


def test_predictor_uses_saved_artefacts(spark, run, paths, tmp_path):
    out = paths[3]
    art, quality = heart.fit_artefacts(spark, f"{out}/features", f"{out}/scaler", trees=10, max_depth=4)
    assert 0.0 < quality.first()["accuracy"] <= 1.0
    art.save(spark, str(tmp_path))
    loaded = scoring.Artefacts.load(spark, str(tmp_path))
    raw = spark.createDataFrame(
        [(1, 50.0, 1, 27.0, 130.0, 80.0, 210.0, 90.0, 0, 0, 1, 0, 0, 1, 0, 70.0, 2, 0, 150.0, 0, 1.0, 1, 0, 2),
         (2, 50.0, 1, 27.0, 130.0, 80.0, 210.0, 90.0, 0, 0, 1, 0, 0, 1, 0, 70.0, 0, 0, 150.0, 0, 1.0, 1, 0, 3)],
        "id int, " + ", ".join(f"{c} {k}" for c, k in S.CANONICAL_COLUMNS.items() if c != "target"))
    features = scoring.build_features(raw, loaded, ["id"]).collect()
    assert [r["cp_2"] for r in features] == [1, 0] and [r["thal_3"] for r in features] == [0, 1]
    assert {r["heartRate"] for r in features} == {0.0}
    scored = scoring.score(raw, loaded, ["id"]).collect()
    assert all(0.0 <= r["probability"] <= 1.0 and len(r["top_up"]) == 5 and len(r["top_down"]) == 3 for r in scored)


def test_mapping_of_each_source(spark, paths):
    sources = heart.read_sources(spark, *paths[:3])
    one = {n: heart.integrate_sources({n: df}) for n, df in sources.items()}
    assert all(df.columns == list(S.CANONICAL_COLUMNS) for df in one.values())
    cardio = one["cardio"].agg(F.min("age"), F.max("age"), F.max("gender"), F.min("cholesterol"), F.max("glucose"), F.count("cp")).first()
    assert 40 <= cardio[0] and cardio[1] <= 65 and tuple(cardio)[2:] == (1, 180.0, 140.0, 0)
    assert {r[0] for r in one["uci"].select("glucose").distinct().collect()} == {90.0, 130.0}
    assert one["framingham"].where("alcohol is not null or thal is not null").count() == 0


def test_fit_on_train_and_unscaled_warehouse(spark, paths):
    combined = heart.integrate_sources(heart.read_sources(spark, *paths[:3]))
    prepared = heart.prepare(combined, trees=10, fit_on="train")
    train = prepared.patients.where("not is_test")
    row = train.agg(F.avg("age"), F.stddev_pop("age")).first()
    assert tuple(row) == pytest.approx((0.0, 1.0), abs=1e-9)
    assert abs(prepared.patients.agg(F.avg("age")).first()[0]) > 1e-9
    assert "is_test" not in prepared.columns
    tables = heart.build_warehouse(prepared, scaled=False)
    assert tables["dim_patient"].agg(F.min("age")).first()[0] >= 30
    rounded = heart.olap(tables, 4)["disease_by_smoking"].collect()
    assert all(r["disease_rate"] == round(r["disease_rate"], 4) for r in rounded)
    sql = spark.sql("SELECT smoke, COUNT(*) AS n FROM heart_disease_fact JOIN dim_lifestyle USING (lifestyle_id) GROUP BY smoke")
    assert {tuple(r) for r in sql.collect()} == {(r["smoke"], r["patient_count"]) for r in rounded}
