"""Tree learners, grid search, importance and diagnostics on a small simulated frame."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators import diagnostics as DG
from demandlab.operators import dml, trees


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    n = 600
    x1, x2, z = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    d = z + 0.5 * x1 + 0.2 * rng.normal(size=n)
    y = -1.0 * d + np.sin(x1) + 0.2 * rng.normal(size=n)
    x3 = np.where(rng.random(n) < 0.2, np.nan, x2)
    rows = [(int(i), int(i % 5), float(y[i]), float(d[i]), float(z[i]), float(x1[i]), float(x2[i]),
             None if np.isnan(x3[i]) else float(x3[i])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, fold int, y double, d double, z double, x1 double, x2 double, x3 double")


def test_missing_indicators(small):
    df, feats = trees.with_missing_indicators(small, ["x3"])
    assert feats == ["x3", "x3_missing"]
    assert df.where("x3 is null").count() == 0 and df.where("x3_missing = 1").count() > 0


def test_dml_with_forest_and_mixed(small):
    df, feats = trees.with_missing_indicators(small, ["x3"])
    rf = trees.rf(trees=10, max_depth=4)
    r = dml.dml_plr(df, "y", "d", ["x1", "x2"] + feats, rf, rf, fold="fold").table.first()
    assert abs(r.theta + 1.0) < 0.3 and r.n == 600 and r.learner.startswith("plr[")
    from demandlab.operators.linear import LinearLearner
    m = dml.dml_pliv(df, "y", "d", "z", ["x1", "x2"], trees.gbt(rounds=5, depth=3), LinearLearner(),
                     LinearLearner(), fold="fold").table.first()
    assert abs(m.theta + 1.0) < 0.3


def test_grid_search_and_importance(spark, small):
    best, table = trees.grid_search(small, trees.gbt(rounds=3, depth=2), ["x1", "x2"], "y",
                                    {"stepSize": [0.1, 0.3]}, fold="fold")
    assert table.count() == 2
    # the tuned choice is never worse than the default step (0.1) on the same folds
    rows = {r.params: r.mse for r in table.collect()}
    default = [v for k, v in rows.items() if "stepSize=0.1" in k and "stepSize=0.1" == k.split(",")[0]][0]
    assert min(rows.values()) <= default
    imp = trees.importance(spark, best, ["x1", "x2"], "gbt", "y").collect()
    assert abs(sum(r.share for r in imp) - 1.0) < 1e-9


def test_diagnostics(small):
    res = dml.dml_pliv(small, "y", "d", "z", ["x1", "x2"], fold="fold")
    st = DG.instrument_strength(res.residuals, "_w", "_v", "z", "d").first()
    assert st.corr_resid > 0.5
    fe = DG.first_stage_errors(res.residuals, {"l": ("y", "_lhat"), "r": ("d", "_rhat")}).collect()
    assert {r.slot for r in fe} == {"l", "r"} and all(r.mse >= 0 for r in fe)
    p = DG.predict_demand(res.residuals, res.table.first().theta, "d", "_lhat", "_rhat")
    assert p.where(F.col("yhat").isNull()).count() == 0
    h = DG.residual_histogram(res.residuals, "_w", "_v", bins=5)
    assert h.agg(F.sum("count")).first()[0] == 600 and h.count() <= 25
    assert DG.residual_table(p, "y", "yhat", "linear", ["k"]).columns == ["k", "y", "yhat", "resid", "learner"]


def test_estimate_plan_helpers(small):
    from demandlab.plans import estimate_plan as EP
    res = EP.elasticity(small, ["x1", "x2"], y="y", d="d", z="z", fold="fold")
    yhat = EP.predicted_demand(res, d="d")
    assert yhat.where("yhat is null").count() == 0
    plr = EP.elasticity(small, ["x1", "x2"], y="y", d="d", z=None, fold="fold")
    assert plr.table.first().learner.startswith("plr[")
    nm = {r.model: r.coef for r in EP.naive_models(small, ["x1", "x2"], y="y", d="d", z="z").collect()}
    assert set(nm) == {"ols", "2sls"} and abs(nm["2sls"] + 1.0) < 0.3


def test_a_refit_that_breaks_off_is_tried_again_alone(small, monkeypatch):
    """Each fit writes its own folder; a failed one is repeated, the others are not; rows without training rows stay."""
    from pyspark.ml.regression import RandomForestRegressor

    df = small.withColumns({"g": F.when(F.col("k") % 2 == 0, "a").when(F.col("k") < 30, "lonely"),
                            "fold": F.when((F.col("k") % 2 == 1) & (F.col("k") < 30), 0).otherwise(F.col("fold"))})
    fits, real = [], RandomForestRegressor.fit

    def flaky(self, data, params=None):
        fits.append(1)
        if len(fits) == 2:
            raise RuntimeError("executor lost")
        return real(self, data, params)
    monkeypatch.setattr(RandomForestRegressor, "fit", flaky)
    rf = trees.rf(trees=3, max_depth=3)
    out = dml._ml_out_of_fold(df, ["x1", "x2"], {"_p": ("y", rf)}, "fold", ["g"], parallelism=1)
    assert out.columns == [*df.columns, "_p"] and out.count() == df.count()
    assert len(fits) == 5 + 5 + 1                                   # two groups of five folds, one fit twice; "lonely" has one fold only
    none = {r.g: r["n"] for r in out.where("_p is null").groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert none == {"lonely": 15}
    assert out.select("k").distinct().count() == 600


def test_tuned_against_default_and_shares(spark, small):
    got = {r.model: r for r in trees.tuned_against_default(small.where("k < 450"), small.where("k >= 450"), trees.gbt(rounds=2, depth=2), ["x1", "x2"], "y",
                                                           {"stepSize": [0.2, 0.9]}, fold="fold").collect()}
    assert set(got) == {"default", "tuned"} and got["tuned"].test_mse > 0 and got["default"].cv_mse is None and "stepSize" in got["tuned"].params
    coefs = spark.createDataFrame([("a", "const", 9.0), ("a", "x", -3.0), ("a", "z", 1.0), ("b", "x", 0.0), ("b", "z", None)], "g string, term string, coef double")
    shares = {(r.g, r.feature): (r.value, r.share) for r in trees.coefficient_shares(coefs, "g").collect()}
    assert shares == {("a", "x"): (3.0, 0.75), ("a", "z"): (1.0, 0.25), ("b", "x"): (0.0, None), ("b", "z"): (None, None)}
