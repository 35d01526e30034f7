from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions import columns as C
from riskweave.operators.scoring import advice, risk_band, verdict


def values(spark, items, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_recode_unknown_and_null(spark):
    assert values(spark, [1, 2, 9, None], "int", C.recode("x", S.CARDIO_GENDER)) == [0, 1, None, None]


def test_conversion_and_ratio(spark):
    assert values(spark, [18250, None], "int", C.convert("x", 365)) == [50.0, None]
    assert values(spark, [200.0, 0.0, None], "double", C.ratio_per_square(F.lit(100.0), "x")) == [25.0, None, None]


def test_right_closed_bands(spark):
    got = values(spark, [0.0, 0.1, 33.0, 33.1, 66.0, 66.1, 100.0, 100.1, None], "double",
                 C.band_right_closed("x", S.SCORE_EDGES, S.SCORE_BANDS))
    low, mid, high = S.SCORE_BANDS
    assert got == [None, low, low, mid, mid, high, high, None, None]


def test_left_closed_bands(spark):
    xs = [0.0, 0.3299, 0.33, 0.6599, 0.66, 1.0, None]
    low, mid, high = S.PROBABILITY_BANDS
    assert values(spark, xs, "double", risk_band("x")) == [low, low, mid, mid, high, high, None]
    assert values(spark, [0.1, 0.5, 0.9], "double", verdict("x")) == S.VERDICTS
    assert values(spark, [0.1, 0.33], "double", F.size(advice("x"))) == [4, 6]


def test_rounding(spark):
    assert values(spark, [0.5, 1.5, 2.5, -0.5], "double", C.round_half_even("x", 0)) == [0.0, 2.0, 2.0, 0.0]
    assert values(spark, [0.5, 1.5, 2.5], "double", C.round_half_away(F.col("x"), 0)) == [1.0, 2.0, 3.0]
    assert values(spark, [0.0715, 0.12345], "double", C.percent("x")) == [7.2, 12.3]


def test_yes_no_and_menu(spark):
    got = values(spark, [" Yes ", "Y", "1", "no", "N", "0", "maybe", "", None], "string", C.parse_yes_no("x"))
    assert got == [1, 1, 1, 0, 0, 0, None, None, None]
    assert values(spark, [0, 2], "int", C.menu_offset("x")) == [1, 3]


def test_flag_share_and_truth(spark):
    df = spark.createDataFrame([(1, None, 0), (1, 1, 1), (None, None, None)], "a int, b int, c int")
    assert [round(r[0], 6) for r in df.select(C.flag_share(["a", "b", "c"])).collect()] == [0.333333, 1.0, 0.0]
    assert values(spark, [0, 2, None], "int", C.as_flag("x")) == [False, True, None]
