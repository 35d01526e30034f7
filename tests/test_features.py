import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import features


def test_one_hot_drops_smallest_and_ignores_unseen(spark):
    train = spark.createDataFrame([(2, 1.0), (0, 2.0), (1, 3.0), (None, 4.0)], "cp int, v double")
    cats = features.fit_one_hot(train, ["cp"])
    assert cats == {"cp": [0, 1, 2]}
    new = spark.createDataFrame([(1, 5.0), (9, 6.0), (None, 7.0)], "cp int, v double")
    out = features.apply_one_hot(new, cats)
    assert out.columns == ["v", "cp_1", "cp_2"]
    assert [tuple(r) for r in out.orderBy("v").collect()] == [(5.0, 1, 0), (6.0, 0, 0), (7.0, 0, 0)]


def test_too_many_categories_is_an_error(spark):
    with pytest.raises(ValueError):
        features.fit_one_hot(spark.range(20), ["id"], max_categories=10)


def test_align_and_fixed_zero(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "a int, b double, c int")
    out = features.fixed_zero(features.align_to(df, ["b", "z", "a"]), ["b", "absent"])
    assert out.columns == ["b", "z", "a"] and tuple(out.first()) == (0.0, 0, 1)


def test_anova_matches_formula_and_selects(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 300)
    cols = {"strong": y * 2.0 + rng.normal(size=300), "none": rng.normal(size=300), "weak": y * 0.2 + rng.normal(size=300)}
    df = spark.createDataFrame(
        [(int(y[i]), *[float(v[i]) for v in cols.values()]) for i in range(300)], "y int, strong double, none double, weak double")
    got = {r["feature"]: r["f_score"] for r in features.anova_f(df, list(cols), "y").collect()}
    for name, x in cols.items():
        groups = [x[y == k] for k in range(3)]
        between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 297
        assert got[name] == pytest.approx(between / within)
    assert features.select_k_best(df, ["none", "weak", "strong"], "y", 1) == ["strong"]


def test_sparse_code_of_many_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("b",)], "v string")
    got = sorted((str(r["v"]), r["v_index"], r["v_size"]) for r in features.sparse_one_hot(df, "v").collect())
    assert got == [("None", None, 2), ("a", None, 2), ("b", 0, 2), ("b", 0, 2), ("c", 1, 2)]
    assert features.sparse_one_hot(df.limit(0), "v").count() == 0
    with pytest.raises(ValueError):
        features.fit_one_hot(spark.range(2000).select(F.col("id").cast("string").alias("v")), ["v"])
