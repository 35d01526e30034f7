import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import clean, integrate
from riskweave.operators.features import apply_zscore, fit_zscore
from riskweave.operators.quantiles import exact_quantiles

ROWS = [  # age, gender, BMI, cholesterol, smoke, cp, target
    (50.0, 1, 25.0, 220.0, 0, None, 1),
    (50.0, 1, 25.0, 220.0, 0, None, 1),
    (40.0, 0, None, 180.0, 1, None, 0),
    (60.0, 1, None, 260.0, None, 2, 1),
    (60.0, 0, None, 200.0, None, 0, 0),
]
LAYOUT = "age double, gender int, BMI double, cholesterol double, smoke int, cp int, target int"


@pytest.fixture(scope="module")
def distinct(spark):
    return integrate.dedup(spark.createDataFrame(ROWS, LAYOUT))


def test_dedup_counts_null_as_equal(spark, distinct):
    row = integrate.dedup_stats(spark.createDataFrame(ROWS, LAYOUT), distinct).first()
    assert tuple(row) == (5, 4, 1)


def test_impute_mean_and_smallest_mode(distinct):
    fill = clean.fit_impute(distinct, ["age", "BMI", "cholesterol"], ["gender", "smoke", "cp"])
    assert fill == {"age": 52.5, "BMI": 25.0, "cholesterol": 215.0, "gender": 0, "smoke": 0, "cp": 0}
    filled = clean.apply_impute(distinct, fill)
    assert clean.total_nulls(distinct).first()[0] == 3 + 2 + 2
    assert clean.total_nulls(filled).first()[0] == 0
    stats = fit_zscore(filled, ["age", "BMI"])
    assert stats["age"][1] == pytest.approx(np.sqrt(68.75))
    assert {r["BMI"] for r in apply_zscore(filled, stats).collect()} == {0.0}


def test_mode_of_empty_column_and_of_text(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "t string, n int")
    assert clean.column_modes(df, ["t", "n"]) == {"t": "a", "n": None}
    same = clean.apply_impute(df, clean.column_modes(df, ["t", "n"]))
    assert sorted(r["t"] for r in same.collect()) == ["a", "a", "b"]


def test_harmonise_types_order_and_nulls(spark):
    df = spark.createDataFrame([(3, "x")], "a int, b string")
    out = integrate.harmonise(df, {"v": F.col("a") * 2}, {"w": "int", "v": "double"})
    assert out.dtypes == [("w", "int"), ("v", "double")]
    assert tuple(out.first()) == (None, 6.0)
    with pytest.raises(ValueError):
        integrate.harmonise(df, {"nope": "a"}, {"w": "int"})


def test_row_key_tells_nulls_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    assert df.select(integrate.row_key(df, ["a", "b"])).distinct().count() == 3


def _column(kind, rng, n):
    if kind == "smooth":
        return rng.normal(size=n)
    if kind == "hot":  # a third of all rows share one value
        return np.where(rng.random(n) < 0.34, 7.0, rng.exponential(size=n) * 10)
    if kind == "two":
        return np.where(rng.random(n) < 0.5, 1.0, 2.0)
    return np.floor(rng.random(n) * 5)


@pytest.mark.parametrize("kind", ["smooth", "hot", "two", "few"])
@pytest.mark.parametrize("direct_rows", [50, 10**6])
def test_exact_quantiles_match_numpy(spark, kind, direct_rows):
    x = _column(kind, np.random.default_rng(5), 4001)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 7, "x double").repartition(5)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df, ["x"], probs, direct_rows=direct_rows, max_accuracy=100)["x"]
    assert got == pytest.approx(list(np.quantile(x, probs)), abs=1e-12)


def test_quantiles_of_empty_and_single(spark):
    df = spark.createDataFrame([(3.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5, 0.9]) == {"a": [3.0, 3.0], "b": [None, None]}


def test_describe(spark):
    x = [1.0, 2.0, 4.0, 8.0, None]
    row = clean.describe_exact(spark.createDataFrame([(v,) for v in x], "x double"), ["x"]).first()
    y = np.array(x[:4])
    assert list(row)[1:] == pytest.approx(
        [4, y.mean(), y.std(ddof=1), 1.0, *np.quantile(y, [0.25, 0.5, 0.75]), 8.0])


def test_wide_dedup_moves_only_rows_whose_fingerprint_repeats(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, 1, "a"), (2, 3, None), (2, 3, None), (2, 3, None), (4, 4, "b"), (5, None, None)]
    df = spark.createDataFrame(rows, "x int, y int, z string").repartition(3)
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, integrate.dedup_wide(df).collect()), key=str) == sorted(set(rows), key=str)
    signed = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "v double")
    assert integrate.dedup_wide(signed).count() == signed.distinct().count() == 3
    assert integrate.dedup_wide(df.limit(0)).count() == 0
    once = df.distinct().withColumn("__n", F.lit(1))
    plan = integrate.dedup_wide(once)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("LeftAnti")  # the distinct side is only under the semi join
    assert sorted(map(key, integrate.dedup_wide(once).drop("__n").collect())) == sorted(map(str, set(rows)))


def test_rows_that_share_a_group_of_fingerprints_are_all_kept(spark, monkeypatch):
    monkeypatch.setattr(integrate, "FINGERPRINT_GROUPS", 2)
    df = spark.range(200).withColumn("v", F.col("id") % 7)
    assert integrate.dedup_wide(df.unionAll(df.where("id < 3"))).count() == 200


def test_modes_of_many_values_are_exact(spark):
    n = 3000
    rows = [(i % 700, f"s{i % 900:04d}", i, None) for i in range(n)] + [(11, "s0005", 7, None)] * 3
    df = spark.createDataFrame(rows, "a int, b string, c int, d int").repartition(4)
    for tracked, listed in ((clean.TRACKED, clean.LISTED), (1024, 16), (64, 8)):
        got = clean.column_modes(df, ["a", "b", "c", "d"], tracked, listed)
        assert got == {"a": 11, "b": "s0005", "c": 7, "d": None}, (tracked, listed)
    flat = spark.range(5000).withColumn("v", F.col("id") + 3)
    assert clean.column_modes(flat, ["v"], 64, 8) == {"v": 3}  # all values tie: the smallest
    assert clean.column_modes(flat.limit(0), ["v"]) == {"v": None} and clean.column_modes(flat, []) == {}
