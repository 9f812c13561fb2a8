from datetime import date

from pyspark.sql import functions as F

from demandlab.functions import scalar as S


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_div0_zero_and_null(spark):
    out = _one(spark, S.div0("a", "b"), "a double, b double", [(1.0, 0.0), (None, 0.0), (1.0, None), (6.0, 3.0)])
    assert out == [0.0, None, None, 2.0]


def test_ln_pos_is_null_for_non_positive(spark):
    out = _one(spark, S.ln_pos("a"), "a double", [(0.0,), (-1.0,), (None,), (1.0,)])
    assert out == [None, None, None, 0.0]


def test_finite_or_null(spark):
    out = _one(spark, S.finite_or_null("a"), "a double", [(float("nan"),), (float("inf"),), (float("-inf"),), (2.0,)])
    assert out == [None, None, None, 2.0]


def test_flags_and_units(spark):
    assert _one(spark, S.yes_no_flag("a"), "a string", [("yes",), ("no",), ("maybe",), (None,)]) == [1, 0, None, None]
    assert _one(spark, S.presence_flag("a"), "a string", [("x",), (None,)]) == [1, 0]
    out = _one(spark, S.volume_ml("v", "u"), "v double, u string", [(1.5, "liter"), (330.0, "ml"), (2.0, "kg")])
    assert out == [1500.0, 330.0, None]


def test_clamp_positive(spark):
    assert _one(spark, S.clamp_positive("a"), "a double", [(-2.0,), (None,), (3.0,)]) == [0.0, 0.0, 3.0]


def test_week_number_second_week(spark):
    out = _one(spark, S.week_number("d", date(2020, 12, 28)), "d date", [(date(2021, 1, 4),), (date(2020, 12, 28),)])
    assert out == [2.0, 1.0]


def test_holiday_and_drop_weeks(spark):
    hs = [date(2021, 1, 4)]
    assert _one(spark, S.holiday_flag("d", hs), "d date", [(date(2021, 1, 4),), (date(2021, 1, 11),), (None,)]) == [1, 0, 0]
    keep = _one(spark, S.not_in_weeks("d", hs), "d date", [(date(2021, 1, 4),), (None,), (date(2021, 1, 11),)])
    assert keep == [False, True, True]


def test_regime_line(spark):
    shift, ppln = S.regime_line("k", "p", 20210620, ["PPL1", "PPL2"])
    rows = spark.createDataFrame([(20210101, "PPL1"), (20210701, "PPL1"), (20210701, "PPL9")], "k int, p string") \
        .select(shift.alias("s"), ppln.alias("n")).collect()
    assert [(r.s, r.n) for r in rows] == [("pre", "PPL1"), ("post", "postPPL1"), ("post", None)]


def test_round_half_even(spark):
    assert _one(spark, S.round_half_even("a"), "a double", [(2.5,), (3.5,)]) == [2.0, 4.0]


def test_decode_dummies(spark):
    e = S.decode_dummies({"c_b": "b", "c_c": "c"}, "a")
    assert _one(spark, e, "c_b int, c_c int", [(0, 0), (1, 0), (0, 1)]) == ["a", "b", "c"]


def test_keys(spark):
    df = spark.createDataFrame([(date(2021, 6, 23),)], "d date")
    r = df.select(S.key_of_date("d").alias("k"), S.week_key("d").alias("w"),
                  S.year_calendar_week("d").alias("y"), S.date_of_key(F.lit(20210621)).alias("b")).first()
    assert (r.k, r.w, r.y, r.b) == (20210623, 20210621, 202125, date(2021, 6, 21))
