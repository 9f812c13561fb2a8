from datetime import date

import pytest
from pyspark.sql import functions as F

from demandlab.operators import features as FE

# fixed values: holiday week starts listed for the 2020-2022 study period
STUDY_HOLIDAY_WEEKS = (
    "2020-12-28", "2021-01-04", "2021-03-29", "2021-05-03", "2021-07-26", "2021-08-02",
    "2021-08-09", "2021-08-16", "2021-12-27", "2022-01-03", "2022-04-11", "2022-05-02",
    "2022-07-25", "2022-08-01", "2022-08-08", "2022-08-15", "2022-12-26",
)


@pytest.fixture(scope="module")
def series(spark):
    rows = [(a, p, w, float(a * 100 + w)) for a in (1, 2) for p in ("A", "B") for w in range(6)]
    return spark.createDataFrame(rows, "a long, p string, w int, v double")


def test_lag_k_equals_lag1_applied_k_times(series):
    two = FE.add_lags(series, ["v"], 2, ["a", "p"], "w")
    one = FE.add_lags(series, ["v"], 1, ["a", "p"], "w")
    one = FE.add_lags(one.drop("v").withColumnRenamed("v_t_1", "v"), ["v"], 1, ["a", "p"], "w")
    a = {(r.a, r.p, r.w): r.v_t_2 for r in two.collect()}
    b = {(r.a, r.p, r.w): r.v_t_1 for r in one.collect()}
    assert a == b
    assert FE.add_lags(series, ["v"], 2, ["a", "p"], "w", dropna=True).count() == 2 * 2 * 4


def test_dummies_drop_first_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "c string")
    enc = FE.FrozenDummies.fit(df, ["c"])
    assert enc.defaults == {"c": "a"} and enc.columns == ["c_b", "c_c"]
    out = enc.transform(df).collect()
    assert [(r.c, r.c_b, r.c_c) for r in out] == [("b", 1, 0), ("a", 0, 0), ("c", 0, 1), (None, 0, 0)]
    # dummies plus the left-out level sum to one on every non-NULL row
    for r in out:
        if r.c is not None:
            assert r.c_b + r.c_c + (1 if r.c == enc.defaults["c"] else 0) == 1
    later = enc.transform(spark.createDataFrame([("z",)], "c string")).first()
    assert (later.c_b, later.c_c) == (0, 0)
    dec = enc.transform(df).select(enc.decode("c").alias("x")).collect()
    assert [r.x for r in dec] == ["b", "a", "c", "a"]


def test_align_powers_impute(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 4.0)], "x double, y double")
    assert FE.align(df, ["y", "x", "z"]).columns == ["y", "x", "z"]
    p = FE.add_powers(df, {"x": 3}).orderBy("x").collect()
    assert (p[1].x_pow2, p[1].x_pow3) == (4.0, 8.0)
    assert [r.y for r in FE.impute(df, ["y"], "max").orderBy("x").collect()] == [4.0, 4.0]
    assert [r.y for r in FE.impute(df, ["y"], "mean").orderBy("x").collect()] == [4.0, 4.0]
    assert [r.y_m for r in FE.impute(df, ["y"], "max", suffix="_m").orderBy("x").collect()] == [4.0, 4.0]


def test_logs_const_rename(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    out = FE.add_const(FE.add_logs(df, ["x"])).collect()
    assert [r.l_x for r in out] == [None, 0.0] and all(r.const == 1.0 for r in out)
    assert FE.rename(df, prefix="l_").columns == ["l_x"]


def test_holiday_weeks_rule_reproduces_study_list():
    hw = [d for d in FE.holiday_weeks([2020, 2021, 2022]) if date(2020, 12, 28) <= d <= date(2022, 12, 26)]
    assert [d.isoformat() for d in hw] == list(STUDY_HOLIDAY_WEEKS)
    assert all(d.weekday() == 0 for d in FE.holiday_weeks(range(1995, 2002)))


def test_regime_dummies(spark):
    df = spark.createDataFrame([(date(2021, 1, 4), "P1"), (date(2021, 7, 5), "P1"), (date(2021, 7, 5), "P2")],
                               "w date, p string")
    out = FE.regime_dummies(df, "w", date(2021, 6, 20), "p", ["P1", "P2"]).collect()
    assert [(r.pre_P1, r.post_P1, r.pre_P2, r.post_P2) for r in out] == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 0, 1)]


def test_filters_and_casts(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("b", 0.3, 2), (None, 0.2, 3)], "c string, u double, k int")
    assert FE.below(df, "u", 0.25).count() == 2
    assert sorted(str(r.c) for r in FE.exclude(df, "c", "a").collect()) == ["None", "b"]
    assert FE.rename(df, {"u": "unav"}).columns == ["c", "unav", "k"]
    assert dict(FE.to_string(df, ["k"]).dtypes)["k"] == "string"
    assert FE.fill_zero(df.withColumn("u", F.lit(None).cast("double")), ["u"]).first().u == 0.0
    assert FE.week_number_from_log(spark.createDataFrame([(0.6931471805599453,)], "l double"), "l").first().week_nr == 2.0
