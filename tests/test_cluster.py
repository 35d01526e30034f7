import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.operators import cluster


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(11)
    centers = np.array([[0.0, 0.0], [8.0, 0.0], [0.0, 8.0]])
    return np.vstack([c + rng.normal(size=(60, 2)) for c in centers])


@pytest.fixture(scope="module")
def frame(spark, blobs):
    rows = [(float(a), float(b), int(i // 60 == 2 or (i // 60 == 1 and i % 2))) for i, (a, b) in enumerate(blobs)]
    return spark.createDataFrame(rows, "a double, b double, target int").repartition(3)


def test_finds_planted_clusters_and_exact_cost(frame, blobs):
    fit = cluster.fit_kmeans(cluster.as_points(frame, ["a", "b"]), 3, restarts=4)
    means = np.array([blobs[i * 60:(i + 1) * 60].mean(axis=0) for i in range(3)])
    assert ((means[:, None] - fit.centers[None]) ** 2).sum(axis=2).min(axis=1) == pytest.approx(np.zeros(3), abs=0.05)
    d = ((blobs[:, None, :] - fit.centers[None]) ** 2).sum(axis=2)
    assert fit.wcss == pytest.approx(d.min(axis=1).sum())
    assigned = cluster.assign(frame, ["a", "b"], fit.centers)
    assert assigned.agg(F.sum("sq_dist")).first()[0] == pytest.approx(fit.wcss)
    array_form = cluster.assign(frame.select(F.array("a", "b").alias("x")), F.col("x"), fit.centers)
    assert array_form.agg(F.sum("sq_dist")).first()[0] == pytest.approx(fit.wcss)


def test_elbow_falls_and_ignores_partitioning(frame):
    points = cluster.as_points(frame, ["a", "b"])
    one = [r["wcss"] for r in cluster.elbow(points, range(2, 6), 4).orderBy("k").collect()]
    many = [r["wcss"] for r in cluster.elbow(points.repartition(8), range(2, 6), 4).orderBy("k").collect()]
    assert one == sorted(one, reverse=True) and one == pytest.approx(many)


def test_few_distinct_points(spark):
    points = spark.createDataFrame([([1.0],)] * 50 + [([2.0],)] * 5, "x array<double>")
    assert cluster.fit_kmeans(points, 2, 2).wcss == pytest.approx(0.0)
    assert cluster.fit_kmeans(points, 4, 2).wcss == pytest.approx(0.0)


def test_labels_follow_outcome_rate(frame):
    fit = cluster.fit_kmeans(cluster.as_points(frame, ["a", "b"]), 3, restarts=4)
    labelled = cluster.label_clusters(cluster.assign(frame, ["a", "b"], fit.centers), "cluster", "target", S.RISK_LABELS)
    profile = cluster.label_profile(labelled, "target", S.RISK_LABELS).orderBy("ord").collect()
    assert [r["risk_label"] for r in profile] == S.RISK_LABELS
    rates = [r["outcome_rate"] for r in profile]
    assert rates == sorted(rates) and sum(r["row_count"] for r in profile) == 180
    ranked = cluster.rank_labels(cluster.cluster_rates(labelled, "cluster", "target"), "cluster", S.RISK_LABELS)
    table = cluster.centroid_table(frame, fit, ["a", "b"], ranked)
    assert table.count() == 6 and {r["risk_label"] for r in table.collect()} == set(S.RISK_LABELS)


def test_missing_label_keeps_its_row(spark):
    df = spark.createDataFrame([("Low Risk", 1), ("Low Risk", 0)], "risk_label string, target int")
    rows = cluster.label_profile(df, "target", S.RISK_LABELS).orderBy("ord").collect()
    assert [r["row_count"] for r in rows] == [2, 0, 0] and rows[1]["outcome_rate"] is None


def test_a_pass_sums_every_model_as_one_by_one(spark, monkeypatch):
    """Weights, distances and sums of models of several sizes, with ties; a point's distances are laid out once, a row per centroid."""
    rng = np.random.default_rng(5)
    x, w = rng.integers(-3, 4, (200, 2)).astype(float), rng.integers(1, 5, 200)
    points = spark.createDataFrame([(r.tolist(), int(n)) for r, n in zip(x, w)], "x array<double>, w long").repartition(3)
    models = [np.array([[0.0, 0.0]]), np.array([[1.0, 0.0], [-1.0, 0.0], [1.0, 0.0]]), np.array([[0.0, 2.0], [9.0, 9.0], [0.0, -2.0], [3.0, 3.0]])]
    monkeypatch.setattr(cluster, "_distances", None)
    counts, cost, sums = cluster._pass(points, models, np.zeros(2))
    at = 0
    for c in models:
        d = ((x[:, None] - c) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        for j in range(len(c)):
            own = near == j
            assert counts[at + j] == w[own].sum() and cost[at + j] == pytest.approx((w * d[:, j])[own].sum())
            assert sums[at + j] == pytest.approx((w[:, None] * x)[own].sum(axis=0))
        at += len(c)
