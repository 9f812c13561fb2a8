"""Registered estimation, statistics and feature queries with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.config import PrepConfig
from demandlab.functions.scalar import finite_or_null
from demandlab.operators import diagnostics as DG
from demandlab.operators import dml, features as FE, lasso, linear, sampling, stats
from demandlab.operators.panel import daily_features, weekly
from demandlab.plans.oracle_fixtures import regression_cte
from demandlab.plans.sql_linear import normal_p
from demandlab.sources.fixtures import regression_panel
from demandlab.sources.io import Tables

BY = "p_type"
X = ["x"]
PREP = PrepConfig()


def _reg(spark: SparkSession, d: str) -> DataFrame:
    return regression_panel(Tables(spark, d))


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    from demandlab.plans.registry import rounded
    return rounded(df, digits)


def q_regression_panel(spark, d):
    return _round(_reg(spark, d))


def _estimates(table: DataFrame) -> DataFrame:
    """All columns of an estimate, p to three digits (the oracle's erfc is an approximation)."""
    return _round(table.withColumn("p", F.round("p", 3)))


def q_ols(spark, d):
    r = linear.ols(_reg(spark, d), "y", ["const", "d"], by=BY, cov="unadjusted")
    return _estimates(r)


def q_ols_multi(spark, d):
    """OLS with two regressors and a constant, per category (M1, k = 3)."""
    r = linear.ols(_reg(spark, d), "y", ["const", "d", "x"], by=BY, cov="unadjusted")
    return _estimates(r)


def q_iv2sls_multi(spark, d):
    """2SLS with an exogenous covariate besides the constant (M2, k = 3), price term."""
    r = linear.iv2sls(_reg(spark, d), "y", ["const", "x"], ["d"], ["z"], by=BY, cov="unadjusted")
    return _estimates(r.where(F.col("term") == "d"))


def q_iv2sls(spark, d):
    r = linear.iv2sls(_reg(spark, d), "y", ["const"], ["d"], ["z"], by=BY, cov="robust")
    return _estimates(r)


def q_dml_plr(spark, d):
    return _estimates(dml.dml_plr(_reg(spark, d), "y", "d", X, fold="fold", by=BY).table)


X2 = ["x", "n_lines"]


def q_dml_plr_multi(spark, d):
    """DML-PLR with two covariates per category (linear learners, 5 folds)."""
    res = dml.dml_plr(_reg(spark, d), "y", "d", X2, fold="fold", by=BY)
    return _round(res.table.drop("p", "status"))


HOLDOUT_FROM = "2001-01-01"


def q_holdout_errors(spark, d):
    """Out-of-time check (R3): first stages y, d, z ~ [1, x] fitted on the weeks
    before the holdout, scored on the holdout weeks; errors per target."""
    reg = _reg(spark, d)
    train = reg.where(F.col("week") < F.lit(HOLDOUT_FROM).cast("date"))
    test = sampling.holdout(reg, "week", F.lit(HOLDOUT_FROM).cast("date"), F.lit("9999-12-31").cast("date"))
    lin = linear.LinearLearner()
    slots = {f"_{t}hat": (t, lin) for t in ("y", "d", "z")}
    scored = linear.apply_linear(test, linear.coefficients(train, X, slots), X, list(slots))
    return _round(DG.first_stage_errors(scored, {t: (t, f"_{t}hat") for t in ("y", "d", "z")}).withColumnRenamed("slot", "target"))


def q_dml_pliv(spark, d):
    return _estimates(dml.dml_pliv(_reg(spark, d), "y", "d", "z", X, fold="fold", by=BY).table)


def _pliv_resid(spark, d):
    return dml.dml_pliv(_reg(spark, d), "y", "d", "z", X, fold="fold", by=BY)


def _ok(res: DataFrame) -> DataFrame:
    return res.where(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.col("_w").isNotNull())


def q_first_stage_errors(spark, d):
    res = _pliv_resid(spark, d).residuals
    return _round(DG.first_stage_errors(res, {"l": ("y", "_lhat"), "m": ("z", "_mhat"), "r": ("d", "_rhat")}, by=BY))


def q_instrument_strength(spark, d):
    return _round(DG.instrument_strength(_ok(_pliv_resid(spark, d).residuals), "_w", "_v", "z", "d", by=BY))


def q_predict_demand(spark, d):
    r = _pliv_resid(spark, d)
    sc = DG.predict_demand(_ok(r.residuals), r.table.select(BY, "theta"), "d", "_lhat", "_rhat", by=BY)
    e = stats.errors(sc, "y", "yhat", by=BY)
    return _round(e.join(stats.pair_corr(sc, "yhat", "d", by=BY).withColumnRenamed("corr", "corr_yhat_d"), BY))


def q_predict_demand_missing_theta(spark, d):
    """Rows of a category without an estimate stay, with a NULL prediction."""
    r = _pliv_resid(spark, d)
    theta = r.table.select(BY, "theta").where(F.col(BY) != EXCLUDED)
    sc = DG.predict_demand(_ok(r.residuals), theta, "d", "_lhat", "_rhat", by=BY)
    return _round(sc.groupBy(BY).agg(F.count(F.lit(1)).alias("n_rows"), F.count("yhat").alias("n_predicted"), F.avg("yhat").alias("mean_yhat")))


def q_predict_demand_holdout(spark, d):
    """Per-category elasticity on the 80 % training split, demand predicted on the
    20 % test split with first stages fitted on the whole training split (M16):
    yhat = l(X) + theta_c (d - r(X)); RMSE and corr(yhat, d) per category."""
    train, test = sampling.train_test(_reg(spark, d))
    th = dml.dml_pliv(train, "y", "d", "z", X, fold="fold", by=BY).table.select(BY, "theta")
    lin = linear.LinearLearner()
    slots = {"_lhat": ("y", lin), "_rhat": ("d", lin), "_mhat": ("z", lin)}
    sc = linear.apply_linear(test, linear.coefficients(train, X, slots, BY), X, list(slots), BY)
    sc = DG.predict_demand(sc, th, "d", "_lhat", "_rhat", by=BY)
    e = stats.errors(sc, "y", "yhat", by=BY)
    c = stats.pair_corr(sc, "yhat", "d", by=BY).withColumnRenamed("corr", "corr_yhat_d")
    return _round(e.join(c, BY).join(th, BY))


def _planted(spark, d) -> DataFrame:
    """The panel with NaN in d and +inf in y on rows told by arithmetic on their values."""
    k = F.pmod(F.col("n_lines").cast("long") * 7 + F.col("fold"), F.lit(11))
    return _reg(spark, d).withColumns({"d": F.when(k == 3, F.lit(float("nan"))).otherwise(F.col("d")),
                                       "y": F.when(k == 4, F.lit(float("inf"))).otherwise(F.col("y"))})


def q_ols_non_finite(spark, d):
    """OLS leaves rows with NaN or infinite values out."""
    return _round(linear.ols(_planted(spark, d), "y", ["const", "d"], by=BY).drop("p", "status"))


def q_non_finite_planted(spark, d):
    return stats.non_finite(_planted(spark, d), ["y", "d", "z", "x"])


DEGENERATE, EMPTY = "PROMO", "SMALL"


def q_dml_pliv_degenerate_category(spark, d):
    """One category with a constant covariate (left out there) and one without any
    complete row (a row with NULLs and the reason) among ordinary ones (M11)."""
    df = _reg(spark, d).withColumns({"x": F.when(F.col(BY) == DEGENERATE, 0.0).otherwise(F.col("x")),
                                     "y": F.when(F.col(BY) != EMPTY, F.col("y"))})
    return _round(dml.dml_pliv(df, "y", "d", "z", X, fold="fold", by=BY).table.select(BY, "theta", "se", "n", (F.col("status") == "ok").cast("int").alias("estimated")))


LASSO_FOLDS = 10


def _inner_folds(df: DataFrame) -> DataFrame:
    return lasso.with_inner(df, bucket=F.pmod(F.col("n_lines").cast("long") * 3 + F.datediff("week", F.lit("1990-01-01").cast("date")) / 7, F.lit(LASSO_FOLDS)))


def q_lasso_cv_single(spark, d):
    """Lasso with ten inner folds and 100 penalties, one covariate, per category."""
    got = lasso.lasso_cv(_inner_folds(_reg(spark, d)), X, ["y", "d"], by=BY)
    return _round(got.drop("n_iter"))


def q_dml_plr_lasso_single(spark, d):
    """PLR with cross-validated Lasso first stages, one covariate (M3, M8)."""
    res = dml.dml_plr(_inner_folds(_reg(spark, d)), "y", "d", X, lasso.LassoCV(), lasso.LassoCV(), by=BY, inner=lasso.INNER)
    return _round(res.table.drop("p", "status"))


N_SIGNS = 40


def q_bootstrap_signs(spark, d):
    """Multiplier bootstrap with sign multipliers from an arithmetic key hash."""
    res = _pliv_resid(spark, d)
    h = F.datediff("week", F.lit("1990-01-01").cast("date")) * 37 + F.col("n_lines").cast("long") * 101 + F.length("p_brand") * 7 + F.ascii(F.col("ppl")) * 13
    return _round(dml.bootstrap(res, key=[], n_boot=N_SIGNS, by=BY, key_hash=h))


def q_unique_values(spark, d):
    return stats.unique_values(_reg(spark, d), "ppl")


def q_column_stats(spark, d):
    return _round(stats.column_stats(_reg(spark, d), ["y", "d", "z", "x"]))


TYPES_LEVELS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def q_regression_features(spark, d):
    """Feature operators on the regression panel: demand lags 1-2 per
    (brand, type, line) series with incomplete rows dropped (W2, W3), week number
    (F16), holiday flag (P7), category dummies from a fitted encoder (E1), squared
    log price (E5)."""
    from datetime import date as _date
    reg = _reg(spark, d)
    df = FE.add_lags(reg, ["y"], 2, ["p_brand", "p_type", "ppl"], "week", dropna=True)
    df = FE.add_week_number(df, "week", _date(1995, 1, 2))
    df = FE.add_holiday(df, "week", FE.holiday_weeks(range(1995, 2002)))
    enc = FE.FrozenDummies.fit(df, ["p_type"])
    df = FE.add_powers(enc.transform(df), {"d": 2})
    return _round(df.select("p_brand", "p_type", "week", "ppl", "y", "y_t_1", "y_t_2", "week_nr", "holiday",
                            "d_pow2", *enc.columns))


def q_predict_demand_uncentered(spark, d):
    """yhat = theta * d + l(X) (M15), errors per category."""
    r = _pliv_resid(spark, d)
    ok = r.residuals.where(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.col("_w").isNotNull())
    sc = DG.predict_demand(ok, r.table.select(BY, "theta"), "d", "_lhat", None, by=BY)
    return _round(stats.errors(sc, "y", "yhat", by=BY))


def q_residual_table(spark, d):
    """Rows behind the residual plots (M18): key, y, yhat, resid, learner."""
    r = _pliv_resid(spark, d)
    ok = r.residuals.where(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.col("_w").isNotNull())
    sc = DG.predict_demand(ok, r.table.select(BY, "theta"), "d", "_lhat", "_rhat", by=BY)
    return _round(DG.residual_table(sc, "y", "yhat", "pliv[linear,linear,linear]",
                                    ["p_brand", "p_type", "week", "ppl"]))


def q_residual_histogram_linear(spark, d):
    """2-D histogram (20 x 20 bins) of the instrument and price residuals of the
    linear PLIV (M18): a size-bounded extract for the residual scatter plots."""
    res = _pliv_resid(spark, d).residuals
    ok = res.where(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.col("_w").isNotNull())
    return DG.residual_histogram(ok, "_w", "_v", bins=20)


def q_value_counts(spark, d):
    return stats.value_counts(_reg(spark, d), BY)


def q_describe_by(spark, d):
    return _round(stats.describe_by(_reg(spark, d), ["y", "d", "z", "x"], by=BY))


def q_corr_matrix(spark, d):
    return _round(stats.corr_matrix(_reg(spark, d), ["y", "d", "z", "x"]))


def q_non_finite(spark, d):
    return stats.non_finite(_reg(spark, d), ["y", "d", "z", "x"])


def q_split(spark, d):
    return _reg(spark, d).select("p_brand", "p_type", "week", "ppl", "fold", "is_test")


DESIGN_COLS = ["key_article", "key_week", "ppl", "week_start_date", "article_cat_2",
               "l_product_order_amt", "l_avg_sell_price", "l_avg_purchase_price", "l_avg_high_temp",
               "l_total_order_amt", "l_nr_articles_in_cat", "l_nr_articles_in_cat_2",
               "l_product_order_amt_t_1", "l_product_order_amt_t_2", "l_avg_sell_price_t_1",
               "l_avg_sell_price_t_2", "l_week_nr", "avg_unavailability_perc",
               "l_avg_unavailability_perc", "promo_dummy", "art_content_volume", "art_is_multipack",
               "week_nr", "holiday", "const"]


def design_matrix(spark, d, cfg=PREP):
    from demandlab.plans.panel_plan import warehouse
    from demandlab.plans.registry import CFG
    w = weekly(daily_features(warehouse(spark, d), CFG, packed=True), CFG)
    years = range(CFG.start.year, CFG.end.year + 1)
    mat, enc = FE.prepare(w, cfg, holidays=FE.holiday_weeks(years))
    return mat, enc


def q_design_matrix(spark, d):
    mat, enc = design_matrix(spark, d)
    return _round(mat.select(*DESIGN_COLS, *FE.design_columns(PREP), *enc.columns))


# ------------------------------------------------------------------ oracles

def _w(body: str) -> str:
    return f"WITH {regression_cte()}\n{body}"


def _r(select_sql: str, cols: list[str]) -> str:
    from demandlab.plans.registry import sql_rounded
    return sql_rounded(select_sql, cols)


OLS_SQL = _w(_r("""
, s AS (SELECT p_type, count(*) AS n, sum(d) AS sd, sum(y) AS sy, sum(d*d) AS sdd, sum(d*y) AS sdy, sum(y*y) AS syy
        FROM reg WHERE y IS NOT NULL AND d IS NOT NULL GROUP BY p_type),
c AS (SELECT *, sdd - sd*sd/n AS sxx, sdy - sd*sy/n AS sxy, syy - sy*sy/n AS syc FROM s),
f AS (SELECT *, sxy/sxx AS b1, (sy - sxy/sxx*sd)/n AS b0, (syc - sxy*sxy/sxx)/n AS sig2 FROM c)
SELECT p_type, 'const' AS term, b0 AS coef, sqrt(sig2*sdd/(n*sxx)) AS se, b0/sqrt(sig2*sdd/(n*sxx)) AS t, n FROM f
UNION ALL
SELECT p_type, 'd' AS term, b1 AS coef, sqrt(sig2/sxx) AS se, b1/sqrt(sig2/sxx) AS t, n FROM f""".lstrip()
    .replace(", s AS", "SELECT * FROM (WITH s AS", 1) + ") q0", ["coef", "se", "t"]))

OLS_MULTI_SQL = _w(_r("""SELECT * FROM (WITH
r0 AS (SELECT * FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL),
s AS (SELECT p_type, count(*) AS n, avg(d) AS md, avg(x) AS mx, avg(y) AS my,
             sum(d*d) - count(*)*avg(d)*avg(d) AS kdd, sum(x*x) - count(*)*avg(x)*avg(x) AS kxx,
             sum(d*x) - count(*)*avg(d)*avg(x) AS kdx, sum(d*y) - count(*)*avg(d)*avg(y) AS kdy,
             sum(x*y) - count(*)*avg(x)*avg(y) AS kxy, sum(y*y) - count(*)*avg(y)*avg(y) AS kyy
      FROM r0 GROUP BY p_type),
f AS (SELECT *, kdd*kxx - kdx*kdx AS det FROM s),
b AS (SELECT *, (kdy*kxx - kxy*kdx)/det AS bd, (kxy*kdd - kdy*kdx)/det AS bx FROM f),
e AS (SELECT *, my - bd*md - bx*mx AS b0, (kyy - bd*kdy - bx*kxy)/n AS sig2 FROM b)
SELECT p_type, 'const' AS term, b0 AS coef,
       sqrt(sig2*(1.0/n + (md*md*kxx - 2*md*mx*kdx + mx*mx*kdd)/det)) AS se,
       b0/sqrt(sig2*(1.0/n + (md*md*kxx - 2*md*mx*kdx + mx*mx*kdd)/det)) AS t, n FROM e
UNION ALL SELECT p_type, 'd', bd, sqrt(sig2*kxx/det), bd/sqrt(sig2*kxx/det), n FROM e
UNION ALL SELECT p_type, 'x', bx, sqrt(sig2*kdd/det), bx/sqrt(sig2*kdd/det), n FROM e) q0""",
                     ["coef", "se", "t"]))

IV_MULTI_SQL = _w(_r("""SELECT * FROM (WITH
r0 AS (SELECT * FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND z IS NOT NULL AND x IS NOT NULL),
s AS (SELECT p_type, count(*) AS n,
             covar_pop(x, x) * count(*) AS kxx, covar_pop(x, y) * count(*) AS kxy,
             covar_pop(x, d) * count(*) AS kxd, covar_pop(x, z) * count(*) AS kxz,
             covar_pop(z, y) * count(*) AS kzy, covar_pop(z, d) * count(*) AS kzd,
             covar_pop(z, z) * count(*) AS kzz, covar_pop(y, y) * count(*) AS kyy,
             covar_pop(d, d) * count(*) AS kdd, covar_pop(d, y) * count(*) AS kdy
      FROM r0 GROUP BY p_type),
b AS (SELECT *, (kzy - kxz*kxy/kxx) / (kzd - kxz*kxd/kxx) AS bd,
             kzz - kxz*kxz/kxx AS zz, kzd - kxz*kxd/kxx AS zd FROM s),
c AS (SELECT *, (kxy - bd*kxd)/kxx AS bx FROM b),
e AS (SELECT *, (kyy + bd*bd*kdd + bx*bx*kxx - 2*bd*kdy - 2*bx*kxy + 2*bd*bx*kxd)/n AS sig2 FROM c)
SELECT p_type, 'd' AS term, bd AS coef, sqrt(sig2*zz/(zd*zd)) AS se, bd/sqrt(sig2*zz/(zd*zd)) AS t, n FROM e) q0""",
                     ["coef", "se", "t"]))

IV_SQL = _w(_r("""SELECT * FROM (WITH
r0 AS (SELECT * FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND z IS NOT NULL),
s AS (SELECT p_type, count(*) AS n, sum(d) AS sd, sum(y) AS sy, sum(z) AS sz, sum(z*z) AS szz,
             sum(z*d) AS szd, sum(z*y) AS szy FROM r0 GROUP BY p_type),
c AS (SELECT *, szz - sz*sz/n AS czz, szd - sz*sd/n AS czd, szy - sz*sy/n AS czy FROM s),
f AS (SELECT *, czy/czd AS b1, (sy - czy/czd*sd)/n AS b0 FROM c),
m AS (SELECT r0.p_type, sum(power(y - b0 - b1*d, 2)) AS m00,
             sum(power(y - b0 - b1*d, 2) * (sd/n + czd/czz*(z - sz/n))) AS m01,
             sum(power(y - b0 - b1*d, 2) * power(sd/n + czd/czz*(z - sz/n), 2)) AS m11
      FROM r0 JOIN f ON r0.p_type = f.p_type GROUP BY r0.p_type),
v AS (SELECT f.*, m.m00, m.m01, m.m11, n*czd*czd/czz AS det, n*power(sd/n, 2) + czd*czd/czz AS sdh2
      FROM f JOIN m ON f.p_type = m.p_type),
vv AS (SELECT *, (sdh2*sdh2*m00 - 2*sdh2*sd*m01 + sd*sd*m11)/(det*det) AS v00,
              (sd*sd*m00 - 2*sd*n*m01 + n*n*m11)/(det*det) AS v11 FROM v)
SELECT p_type, 'const' AS term, b0 AS coef, sqrt(v00) AS se, b0/sqrt(v00) AS t, n FROM vv
UNION ALL
SELECT p_type, 'd' AS term, b1 AS coef, sqrt(v11) AS se, b1/sqrt(v11) AS t, n FROM vv) q0""",
               ["coef", "se", "t"]))


def _dml_chain(iv: bool, src: str = "reg", g: str = "p_type") -> str:
    tz = "AND z IS NOT NULL" if iv else ""
    zs = ", sum(z) AS sz, sum(x*z) AS sxz" if iv else ""
    ztot = ", sum(sz) OVER w - sz AS Tz, sum(sxz) OVER w - sxz AS Txz" if iv else ""
    zfit = (", (N*Txz - Tx*Tz)/(N*Txx - Tx*Tx) AS bz, (Tz - (N*Txz - Tx*Tz)/(N*Txx - Tx*Tx)*Tx)/N AS az"
            if iv else "")
    what = "z - (az + bz*x)" if iv else "d - (ad + bd*x)"
    mhat = "az + bz*x" if iv else "NULL"
    return f"""
r0 AS (SELECT * FROM {src} WHERE y IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL {tz}),
sf AS (SELECT {g}, fold, count(*) AS nf, sum(x) AS sx, sum(x*x) AS sxx, sum(y) AS sy, sum(x*y) AS sxy,
              sum(d) AS sd, sum(x*d) AS sxd {zs}
       FROM r0 GROUP BY {g}, fold),
lo AS (SELECT {g}, fold, sum(nf) OVER w - nf AS N, sum(sx) OVER w - sx AS Tx, sum(sxx) OVER w - sxx AS Txx,
              sum(sy) OVER w - sy AS Ty, sum(sxy) OVER w - sxy AS Txy, sum(sd) OVER w - sd AS Td,
              sum(sxd) OVER w - sxd AS Txd {ztot}
       FROM sf WINDOW w AS (PARTITION BY {g})),
cf AS (SELECT {g}, fold,
              (N*Txy - Tx*Ty)/(N*Txx - Tx*Tx) AS by_, (Ty - (N*Txy - Tx*Ty)/(N*Txx - Tx*Tx)*Tx)/N AS ay,
              (N*Txd - Tx*Td)/(N*Txx - Tx*Tx) AS bd, (Td - (N*Txd - Tx*Td)/(N*Txx - Tx*Tx)*Tx)/N AS ad {zfit}
       FROM lo),
res AS (SELECT r0.*, ay + by_*x AS lhat, ad + bd*x AS rhat, {mhat} AS mhat,
               y - (ay + by_*x) AS u, d - (ad + bd*x) AS v, {what} AS w
        FROM r0 JOIN cf ON r0.{g} = cf.{g} AND r0.fold = cf.fold),
agg AS (SELECT {g}, count(*) AS n, sum(u*w) AS suw, sum(v*w) AS svw, sum(u*u*w*w) AS suuww,
               sum(u*v*w*w) AS suvww, sum(v*v*w*w) AS svvww FROM res GROUP BY {g}),
th AS (SELECT *, suw/svw AS theta,
              sqrt(((suuww - 2*(suw/svw)*suvww + (suw/svw)*(suw/svw)*svvww)/n) / (n*(svw/n)*(svw/n))) AS se
       FROM agg)"""


def _dml_sql(iv: bool) -> str:
    name = "pliv[linear,linear,linear]" if iv else "plr[linear,linear]"
    body = f"""SELECT * FROM (WITH {_dml_chain(iv)}
SELECT p_type, '{name}' AS learner, theta, se, theta/se AS t, theta - {dml.Z975}*se AS ci_lo,
       theta + {dml.Z975}*se AS ci_hi, n, round({normal_p("(theta/se)")}, 3) AS p, CASE WHEN theta IS NOT NULL THEN 'ok' END AS status FROM th) q0"""
    return _w(_r(body, ["theta", "se", "t", "ci_lo", "ci_hi"]))


def _dml2_sql() -> str:
    """PLR with covariates (x, n_lines): leave-fold-out 2 x 2 solves in SQL."""
    def fit(t):
        c11, c22, c12 = "(T11 - T1*T1/N)", "(T22 - T2*T2/N)", "(T12 - T1*T2/N)"
        c1t, c2t = f"(T1{t} - T1*T{t}/N)", f"(T2{t} - T2*T{t}/N)"
        det = f"({c11}*{c22} - {c12}*{c12})"
        b1 = f"(({c1t}*{c22} - {c2t}*{c12})/{det})"
        b2 = f"(({c2t}*{c11} - {c1t}*{c12})/{det})"
        b0 = f"((T{t} - {b1}*T1 - {b2}*T2)/N)"
        return b0, b1, b2
    y0, y1, y2 = fit("y")
    d0, d1, d2 = fit("d")
    names = ["nf", "s1", "s2", "s11", "s22", "s12", "sy", "s1y", "s2y", "sd", "s1d", "s2d"]
    tot = ["N", "T1", "T2", "T11", "T22", "T12", "Ty", "T1y", "T2y", "Td", "T1d", "T2d"]
    body = f"""SELECT * FROM (WITH
r0 AS (SELECT *, n_lines AS w2 FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL AND n_lines IS NOT NULL),
sf AS (SELECT p_type, fold, count(*) AS nf, sum(x) AS s1, sum(w2) AS s2, sum(x*x) AS s11, sum(w2*w2) AS s22,
              sum(x*w2) AS s12, sum(y) AS sy, sum(x*y) AS s1y, sum(w2*y) AS s2y, sum(d) AS sd,
              sum(x*d) AS s1d, sum(w2*d) AS s2d FROM r0 GROUP BY p_type, fold),
lo AS (SELECT p_type, fold, {", ".join(f"sum({a}) OVER w - {a} AS {b}" for a, b in zip(names, tot))}
       FROM sf WINDOW w AS (PARTITION BY p_type)),
cf AS (SELECT p_type, fold, {y0} AS ay, {y1} AS by1, {y2} AS by2, {d0} AS ad, {d1} AS bd1, {d2} AS bd2 FROM lo),
res AS (SELECT r0.p_type, y - (ay + by1*x + by2*w2) AS u, d - (ad + bd1*x + bd2*w2) AS v
        FROM r0 JOIN cf ON r0.p_type = cf.p_type AND r0.fold = cf.fold),
agg AS (SELECT p_type, count(*) AS n, sum(u*v) AS suv, sum(v*v) AS svv, sum(u*u*v*v) AS suuvv,
               sum(u*v*v*v) AS suvvv, sum(v*v*v*v) AS svvvv FROM res GROUP BY p_type),
th AS (SELECT *, suv/svv AS theta,
              sqrt(((suuvv - 2*(suv/svv)*suvvv + (suv/svv)*(suv/svv)*svvvv)/n) / (n*(svv/n)*(svv/n))) AS se FROM agg)
SELECT p_type, 'plr[linear,linear]' AS learner, theta, se, theta/se AS t, theta - {dml.Z975}*se AS ci_lo,
       theta + {dml.Z975}*se AS ci_hi, n FROM th) q0"""
    return _w(_r(body, ["theta", "se", "t", "ci_lo", "ci_hi"]))


def _holdout_sql() -> str:
    parts = []
    for t in ("y", "d", "z"):
        parts.append(f"""SELECT '{t}' AS target, count(CASE WHEN {t} IS NOT NULL AND x IS NOT NULL THEN 1 END) AS n,
       avg(CASE WHEN {t} IS NOT NULL AND x IS NOT NULL THEN power({t} - (a_{t} + b_{t}*x), 2) END) AS mse,
       sqrt(avg(CASE WHEN {t} IS NOT NULL AND x IS NOT NULL THEN power({t} - (a_{t} + b_{t}*x), 2) END)) AS rmse,
       sqrt(avg(CASE WHEN {t} IS NOT NULL AND x IS NOT NULL THEN power({t} - (a_{t} + b_{t}*x), 2) END))
         / avg(CASE WHEN {t} IS NOT NULL AND x IS NOT NULL THEN {t} END) AS rel_rmse
FROM reg, fitted WHERE week >= DATE '{HOLDOUT_FROM}'""")
    fitted = ", ".join(f"regr_slope({t}, x) AS b_{t}, regr_intercept({t}, x) AS a_{t}" for t in ("y", "d", "z"))
    body = f"""SELECT * FROM (WITH fitted AS (SELECT {fitted} FROM reg
  WHERE week < DATE '{HOLDOUT_FROM}' AND x IS NOT NULL AND y IS NOT NULL AND d IS NOT NULL AND z IS NOT NULL)
{" UNION ALL ".join(parts)}) q0"""
    return _w(_r(body, ["mse", "rmse", "rel_rmse"]))


def _features_sql() -> str:
    hol = ", ".join(f"DATE '{h}'" for h in FE.holiday_weeks(range(1995, 2002)))
    dums = ", ".join(f"CAST(coalesce(p_type = '{v}', false) AS INTEGER) AS {FE.dummy_name('p_type', v)}"
                     for v in sorted(TYPES_LEVELS)[1:])
    body = f"""SELECT * FROM (WITH f AS (
  SELECT *, lag(y, 1) OVER s AS y_t_1, lag(y, 2) OVER s AS y_t_2 FROM reg
  WINDOW s AS (PARTITION BY p_brand, p_type, ppl ORDER BY week))
SELECT p_brand, p_type, week, ppl, y, y_t_1, y_t_2,
       date_diff('day', DATE '1995-01-02', week) / 7.0 + 1.0 AS week_nr,
       CAST(coalesce(week IN ({hol}), false) AS INTEGER) AS holiday,
       power(d, 2) AS d_pow2, {dums}
FROM f WHERE y_t_1 IS NOT NULL AND y_t_2 IS NOT NULL) q0"""
    return _w(_r(body, ["y", "y_t_1", "y_t_2", "week_nr", "d_pow2"]))


UNCENTERED_SQL = _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)},
p AS (SELECT res.*, lhat + th.theta * d AS yhat FROM res JOIN th ON res.p_type = th.p_type)
SELECT p_type, count(*) AS n, avg(power(y - yhat, 2)) AS mse, sqrt(avg(power(y - yhat, 2))) AS rmse,
       sqrt(avg(power(y - yhat, 2))) / avg(y) AS rel_rmse FROM p GROUP BY p_type) q0""",
                        ["mse", "rmse", "rel_rmse"]))

RESIDUAL_SQL = _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)},
p AS (SELECT res.*, lhat + th.theta * (d - rhat) AS yhat FROM res JOIN th ON res.p_type = th.p_type)
SELECT p_brand, p_type, week, ppl, y, yhat, y - yhat AS resid, 'pliv[linear,linear,linear]' AS learner
FROM p) q0""", ["y", "yhat", "resid"]))


def _bucket(c: str, lo: str, hi: str, n: int = 20) -> str:
    return (f"CASE WHEN {c} < {lo} THEN 0 WHEN {c} >= {hi} THEN {n + 1} "
            f"ELSE CAST(floor({n} * ({c} - {lo}) / ({hi} - {lo})) AS BIGINT) + 1 END")


HISTOGRAM_SQL = _w(f"""SELECT * FROM (WITH {_dml_chain(True)},
lim AS (SELECT min(w) AS lo_w, max(w) + 1e-12 AS hi_w, min(v) AS lo_v, max(v) + 1e-12 AS hi_v FROM res)
SELECT {_bucket("w", "lo_w", "hi_w")} AS bin_x, {_bucket("v", "lo_v", "hi_v")} AS bin_y, count(*) AS count
FROM res, lim GROUP BY 1, 2) q0""")


EXCLUDED = "PROMO"


def _dml_excluding_sql() -> str:
    body = f"""SELECT * FROM (WITH reg2 AS (SELECT *, 'all' AS grp FROM reg WHERE p_type <> '{EXCLUDED}'),
{_dml_chain(True, "reg2", "grp")}
SELECT 'pliv[linear,linear,linear]' AS learner, theta, se, theta/se AS t, theta - {dml.Z975}*se AS ci_lo,
       theta + {dml.Z975}*se AS ci_hi, n FROM th) q0"""
    return _w(_r(body, ["theta", "se", "t", "ci_lo", "ci_hi"]))


def q_dml_pliv_excluding(spark, d):
    """PLIV on all categories but one (P10), one pooled estimate."""
    df = FE.exclude(_reg(spark, d), BY, EXCLUDED)
    return _round(dml.dml_pliv(df, "y", "d", "z", X, fold="fold").table.drop("p", "status"))


def q_profile(spark, d):
    """Row and column count of the regression panel."""
    from demandlab.sources.io import profile
    got = profile(_reg(spark, d))
    return spark.createDataFrame([(got["rows"], len(got["columns"]))], "n_rows long, n_cols int")


PANEL_KEY = ["p_brand", "p_type", "week", "ppl"]


def q_profile_head(spark, d):
    """First rows of the panel in key order."""
    from demandlab.sources.io import profile
    df = _reg(spark, d).select(*PANEL_KEY, "n_lines")
    return spark.createDataFrame(profile(df, 5, PANEL_KEY)["head"], df.schema)


def q_weekly_csv(spark, d):
    """Weekly panel through the CSV sink and source (S5, S6): written with a header and
    compressed under the shared checkpoint folder, read back with an explicit schema."""
    import os
    import uuid
    from demandlab.plans.panel_plan import warehouse
    from demandlab.plans.registry import CFG, rounded
    from demandlab.session import ensure_checkpoint_dir
    from demandlab.sources.io import read_panel_csv, write_panel
    w = rounded(weekly(daily_features(warehouse(spark, d), CFG, packed=True), CFG, ordered=True))
    path = os.path.join(ensure_checkpoint_dir(spark), "csv", uuid.uuid4().hex)
    write_panel(w, path, fmt="csv", compression="gzip", file_rows=1_000_000)
    return read_panel_csv(spark, path, w.schema)


FIRST_STAGE_SQL = _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)}
SELECT p_type, count(*) AS n, avg(power(y - lhat, 2)) AS mse, sqrt(avg(power(y - lhat, 2))) AS rmse,
       sqrt(avg(power(y - lhat, 2))) / avg(y) AS rel_rmse, 'l' AS slot FROM res GROUP BY p_type
UNION ALL
SELECT p_type, count(*), avg(power(z - mhat, 2)), sqrt(avg(power(z - mhat, 2))),
       sqrt(avg(power(z - mhat, 2))) / avg(z), 'm' FROM res GROUP BY p_type
UNION ALL
SELECT p_type, count(*), avg(power(d - rhat, 2)), sqrt(avg(power(d - rhat, 2))),
       sqrt(avg(power(d - rhat, 2))) / avg(d), 'r' FROM res GROUP BY p_type) q0""",
                         ["mse", "rmse", "rel_rmse"]))

STRENGTH_SQL = _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)}
SELECT p_type, corr(w, v) AS corr_resid, corr(z, d) AS corr_raw FROM res GROUP BY p_type) q0""",
                      ["corr_resid", "corr_raw"]))

PREDICT_SQL = _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)},
p AS (SELECT res.*, lhat + th.theta * (d - rhat) AS yhat FROM res JOIN th ON res.p_type = th.p_type)
SELECT p_type, count(*) AS n, avg(power(y - yhat, 2)) AS mse, sqrt(avg(power(y - yhat, 2))) AS rmse,
       sqrt(avg(power(y - yhat, 2))) / avg(y) AS rel_rmse, corr(yhat, d) AS corr_yhat_d
FROM p GROUP BY p_type) q0""", ["mse", "rmse", "rel_rmse", "corr_yhat_d"]))

_COLS = ["y", "d", "z", "x"]

DESCRIBE_SQL = _w(_r("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"""SELECT p_type, '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM reg GROUP BY p_type""" for c in _COLS) + ") q0",
    ["mean", "std", "min", "p25", "p50", "p75", "max"]))

CORR_SQL = _w(_r("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM reg" for a in _COLS for b in _COLS) + ") q0",
    ["corr"]))

NONFINITE_SQL = _w("SELECT " + ", ".join(
    f"CAST(count_if(isnan({c}) OR isinf({c})) AS BIGINT) AS {c}" for c in _COLS) + " FROM reg")


def _design_body() -> tuple[str, list[str]]:
    """The design matrix as a query over the panel's CTEs, and its double columns."""
    from demandlab.plans.registry import CFG, WEEKLY_SQL
    holidays = ", ".join(f"DATE '{h}'" for h in FE.holiday_weeks(range(CFG.start.year, CFG.end.year + 1)))
    lines = sorted(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])
    tiers = sorted(["Good", "Better", "Best"])
    brands = sorted(f"Brand#{i}" for i in range(1, 26))
    dummies = []
    for col, lv in (("ppl", lines), ("article_tier", tiers), ("article_cat_2", brands)):
        for v in lv[1:]:
            dummies.append(f"CAST(coalesce(CAST({col} AS VARCHAR) = '{v}', false) AS INTEGER) AS "
                           f"{FE.dummy_name(col, v)}")
    logs = ", ".join(f"CASE WHEN {c} > 0 THEN ln({c}) END AS l_{c}" for c in PREP.log_cols)
    post = f"CAST(coalesce(week_start_date > DATE '{PREP.shift_date}', false) AS INTEGER)"
    extra = []
    for ln in PREP.regime_lines:
        is_l = f"CAST(coalesce(ppl = '{ln}', false) AS INTEGER)"
        extra += [f"{is_l} - {post} * {is_l} AS {FE.regime_name('pre', ln)}",
                  f"{post} * {is_l} AS {FE.regime_name('post', ln)}"]
    extra += [f"power({c}, {k}) AS {FE.power_name(c, k)}" for c, dg in PREP.powers for k in range(2, dg + 1)]
    extra += [f"coalesce({c}, {h}({c}) OVER ()) AS {c}_m" for c, h in PREP.impute]
    body = f"""SELECT * FROM (WITH wk AS ({WEEKLY_SQL}),
f0 AS (SELECT * REPLACE (coalesce(product_order_amt, 0) AS product_order_amt,
                         coalesce(avg_unavailability_perc, 0) AS avg_unavailability_perc) FROM wk),
f1 AS (SELECT *,
         lag(product_order_amt, 1) OVER s AS product_order_amt_t_1,
         lag(product_order_amt, 2) OVER s AS product_order_amt_t_2,
         lag(avg_sell_price, 1) OVER s AS avg_sell_price_t_1,
         lag(avg_sell_price, 2) OVER s AS avg_sell_price_t_2
       FROM f0 WINDOW s AS (PARTITION BY key_article, ppl ORDER BY key_week)),
f2 AS (SELECT * FROM f1 WHERE product_order_amt_t_2 IS NOT NULL AND product_order_amt > 0),
f3 AS (SELECT *, date_diff('day', DATE '{PREP.week_origin}', week_start_date) / 7.0 + 1.0 AS week_nr
       FROM f2),
f4 AS (SELECT * REPLACE (avg_unavailability_perc * 100.0 AS avg_unavailability_perc) FROM f3),
f5 AS (SELECT *, {logs},
         CAST(coalesce(week_start_date IN ({holidays}), false) AS INTEGER) AS holiday, CAST(1.0 AS DOUBLE) AS const,
         {", ".join(dummies)}
       FROM f4),
f6 AS (SELECT *, {", ".join(extra)} FROM f5)
SELECT {", ".join(DESIGN_COLS)}, {", ".join(FE.design_columns(PREP))},
       {", ".join(d.split(" AS ")[-1] for d in dummies)} FROM f6) q0"""
    dbl = [c for c in DESIGN_COLS if c.startswith("l_")] + ["avg_unavailability_perc", "art_content_volume",
                                                            "week_nr", "const"] + \
        [c for c in FE.design_columns(PREP) if not c.startswith(("pre_", "post_"))]
    return body, dbl


def _design_sql() -> str:
    from demandlab.plans.registry import with_panel
    return with_panel(_r(*_design_body()))


_PLANT = "((CAST(n_lines AS BIGINT) * 7 + fold) % 11)"


def _degenerate_sql() -> str:
    """A constant covariate leaves the mean as first stage; a category without rows has NULLs."""
    src = f"""reg3 AS (SELECT * REPLACE (CASE WHEN p_type = '{DEGENERATE}' THEN 0.0 ELSE x END AS x, CASE WHEN p_type <> '{EMPTY}' THEN y END AS y) FROM reg)"""
    chain = _dml_chain(True, "reg3")
    for t in ("y", "d", "z"):
        slope = f"(N*Tx{t} - Tx*T{t})/(N*Txx - Tx*Tx)"
        chain = chain.replace(slope, f"coalesce((N*Tx{t} - Tx*T{t})/nullif(N*Txx - Tx*Tx, 0), 0)")
    body = f"""SELECT * FROM (WITH {src}, {chain}
SELECT c.p_type, theta, se, coalesce(n, 0) AS n, CAST(theta IS NOT NULL AS INTEGER) AS estimated
FROM (SELECT DISTINCT p_type FROM reg) c LEFT JOIN th ON th.p_type = c.p_type) q0"""
    return _w(_r(body, ["theta", "se"]))


_INNER = f"CAST((CAST(n_lines AS BIGINT) * 3 + date_diff('day', DATE '1990-01-01', week) // 7) % {LASSO_FOLDS} AS INTEGER)"


def _lasso_ctes(grp: str, src: str, targets: tuple[str, ...]) -> str:
    """Cross-validated one-covariate Lasso of each target on x, by group ``grp``: the fit is
    soft-thresholding, so the whole search over 100 penalties and ten folds is plain SQL."""
    stacked = " UNION ALL ".join(f"SELECT {grp}, k, '{t}' AS target, x, {t} AS v FROM {src}" for t in targets)
    st = "sign(cxv) * greatest(abs(cxv) - a, 0) / cxx"
    return f"""
st AS ({stacked}),
pf AS (SELECT {grp}, target, k, count(*) AS n, sum(x) AS sx, sum(v) AS sv, sum(x*x) AS sxx, sum(x*v) AS sxv, sum(v*v) AS svv FROM st GROUP BY ALL),
tot AS (SELECT {grp}, target, sum(n) AS n, sum(sx)/sum(n) AS mx, sum(sv)/sum(n) AS mv, sum(sxx)/sum(n) - (sum(sx)/sum(n))*(sum(sx)/sum(n)) AS cxx,
               sum(sxv)/sum(n) - (sum(sx)/sum(n))*(sum(sv)/sum(n)) AS cxv FROM pf GROUP BY ALL),
grid AS (SELECT {grp}, target, i, power(10, log10(abs(cxv)) + i * (log10(abs(cxv) * 1e-3) - log10(abs(cxv))) / 99) AS a
         FROM tot, (SELECT unnest(range(0, 100)) AS i)),
trs AS (SELECT pf.*, sum(n) OVER g - n AS tn, sum(sx) OVER g - sx AS tx, sum(sv) OVER g - sv AS tv, sum(sxx) OVER g - sxx AS txx, sum(sxv) OVER g - sxv AS txv
        FROM pf WINDOW g AS (PARTITION BY {grp}, target)),
tr AS (SELECT *, tx/tn AS mx, tv/tn AS mv, txx/tn - (tx/tn)*(tx/tn) AS cxx, txv/tn - (tx/tn)*(tv/tn) AS cxv FROM trs),
cvb AS (SELECT tr.*, i, a, {st} AS b FROM tr JOIN grid USING ({grp}, target)),
cv AS (SELECT {grp}, target, i, a, sum(svv - 2*(mv - b*mx)*sv - 2*b*sxv + n*(mv - b*mx)*(mv - b*mx) + 2*b*(mv - b*mx)*sx + b*b*sxx) AS sse FROM cvb GROUP BY ALL),
best AS (SELECT {grp}, target, arg_min(a, {{'s': sse, 'i': i}}) AS a FROM cv GROUP BY ALL),
fitted AS (SELECT {grp}, target, a AS alpha, {st} AS b, mv - {st} * mx AS b0 FROM tot JOIN best USING ({grp}, target))"""


def _lasso_sql() -> str:
    body = f"""SELECT * FROM (WITH src AS (SELECT *, {_INNER} AS k FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL),
{_lasso_ctes("p_type", "src", ("y", "d"))}
SELECT p_type, target, 'intercept' AS term, b0 AS coef, alpha FROM fitted
UNION ALL SELECT p_type, target, 'x', b, alpha FROM fitted) q0"""
    return _w(_r(body, ["coef", "alpha"]))


def _dml_lasso_sql() -> str:
    body = f"""SELECT * FROM (WITH r0 AS (SELECT *, {_INNER} AS k FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND x IS NOT NULL),
src AS (SELECT r0.* REPLACE (f.fold AS fold), r0.p_type || '|' || f.fold AS g FROM r0 JOIN (SELECT DISTINCT fold FROM r0) f ON f.fold <> r0.fold),
{_lasso_ctes("g", "src", ("y", "d"))},
res AS (SELECT r0.p_type, r0.y - (l.b0 + l.b * r0.x) AS u, r0.d - (m.b0 + m.b * r0.x) AS v
        FROM r0 JOIN fitted l ON l.g = r0.p_type || '|' || r0.fold AND l.target = 'y'
                JOIN fitted m ON m.g = r0.p_type || '|' || r0.fold AND m.target = 'd'),
t0 AS (SELECT p_type, count(*) AS n, sum(u*v)/sum(v*v) AS theta, avg(v*v) AS j FROM res GROUP BY p_type),
th AS (SELECT p_type, t0.n, theta, sqrt(avg(power((u - theta*v)*v, 2)) / (t0.n*j*j)) AS se FROM res JOIN t0 USING (p_type) GROUP BY ALL, j)
SELECT p_type, 'plr[lasso,lasso]' AS learner, theta, se, theta/se AS t, theta - {dml.Z975}*se AS ci_lo, theta + {dml.Z975}*se AS ci_hi, n FROM th) q0"""
    return _w(_r(body.replace("GROUP BY ALL, j", "GROUP BY p_type, t0.n, theta, j"), ["theta", "se", "t", "ci_lo", "ci_hi"]))


def _signs_sql() -> str:
    h = "(date_diff('day', DATE '1990-01-01', week) * 37 + CAST(n_lines AS BIGINT) * 101 + length(p_brand) * 7 + ascii(ppl) * 13)"
    body = f"""SELECT * FROM (WITH {_dml_chain(True)},
dr AS (SELECT res.p_type, b, sum(((({h} * (2*b + 1)) // 64) % 2 * 2 - 1) * (u - theta*v)*w / se) / sum(v*w) AS t
       FROM res JOIN th ON res.p_type = th.p_type, (SELECT unnest(range(0, {N_SIGNS})) AS b) GROUP BY res.p_type, b),
q AS (SELECT p_type, count(*) AS n_boot, quantile_cont(abs(t), 0.95) AS q95 FROM dr GROUP BY p_type)
SELECT q.p_type, 'pliv[linear,linear,linear]' AS learner, n_boot, q95, theta - q95*se AS ci_lo_boot, theta + q95*se AS ci_hi_boot
FROM q JOIN th ON q.p_type = th.p_type) q0"""
    return _w(_r(body, ["q95", "ci_lo_boot", "ci_hi_boot"]))


def q_panel_csv_dirty(spark, d):
    """A CSV with inf, -inf, NaN and empty entries, read with inferred types."""
    from demandlab.session import scratch_table
    from demandlab.sources.io import read_panel_csv, write_panel
    k = F.pmod(F.col("n_lines").cast("long") * 7 + F.col("fold"), F.lit(11))
    text = F.when(k == 1, "inf").when(k == 2, "-inf").when(k == 3, "NaN").when(k == 4, "").otherwise(F.col("n_lines").cast("string"))
    path = scratch_table(spark, "dirty")
    write_panel(_reg(spark, d).select(*PANEL_KEY, text.alias("lines"), "fold"), path, fmt="csv")
    return read_panel_csv(spark, path).withColumn("fold", F.col("fold").cast("int"))


LEVELS = ("B C", "B&C", "b-c", "other")


def q_dummies_colliding_levels(spark, d):
    """Levels whose plain names would agree get distinct dummies (E1), decoded again."""
    k = F.pmod(F.col("n_lines").cast("long") + F.col("fold"), F.lit(4))
    df = _reg(spark, d).select(*PANEL_KEY, F.element_at(F.array(*map(F.lit, LEVELS)), (k + 1).cast("int")).alias("c"))
    enc = FE.FrozenDummies.fit(df, ["c"])
    out = enc.transform(df)
    return out.withColumn("label", enc.decode("c"))


DROPPED = "1996-01-01"


def q_feature_filters(spark, d):
    """Week and threshold filters, renaming, text cast, finite values, week number from its log
    (P8, P11, P13, P15, F12, F15)."""
    from datetime import date as _date
    df = FE.drop_weeks(_planted(spark, d), "week", [_date.fromisoformat(DROPPED)])
    df = FE.below(df, "x", 0.06)
    df = FE.add_week_number(df, "week", _date(1990, 1, 1)).withColumn("l_week", F.ln("week_nr"))
    df = FE.week_number_from_log(df.drop("week_nr"), "l_week")
    df = df.withColumns({"y": finite_or_null(F.col("y")), "d": finite_or_null(F.col("d"))})
    df = FE.to_string(FE.rename(df, {"n_lines": "lines"}), ["fold"])
    return _round(df.select(*PANEL_KEY, "y", "d", "x", "lines", "fold", "week_nr"))


_DUMMY_SQL = f"""SELECT *, CAST(c = 'B&C' AS INTEGER) AS c_B_C, CAST(c = 'b-c' AS INTEGER) AS c_b_c_x, CAST(c = 'other' AS INTEGER) AS c_other, c AS label
FROM (SELECT p_brand, p_type, week, ppl, (['{"', '".join(LEVELS)}'])[(CAST(n_lines AS BIGINT) + fold) % 4 + 1] AS c FROM reg)"""


QUERIES = {
    "panel_csv_dirty": q_panel_csv_dirty,
    "dummies_colliding_levels": q_dummies_colliding_levels,
    "feature_filters": q_feature_filters,
    "regression_panel": q_regression_panel,
    "ols": q_ols,
    "iv2sls": q_iv2sls,
    "ols_multi": q_ols_multi,
    "iv2sls_multi": q_iv2sls_multi,
    "dml_plr_multi": q_dml_plr_multi,
    "holdout_errors": q_holdout_errors,
    "unique_values": q_unique_values,
    "predict_demand_uncentered": q_predict_demand_uncentered,
    "residual_table": q_residual_table,
    "residual_histogram_linear": q_residual_histogram_linear,
    "column_stats": q_column_stats,
    "regression_features": q_regression_features,
    "dml_plr": q_dml_plr,
    "dml_pliv": q_dml_pliv,
    "first_stage_errors": q_first_stage_errors,
    "instrument_strength": q_instrument_strength,
    "predict_demand": q_predict_demand,
    "value_counts": q_value_counts,
    "describe_by": q_describe_by,
    "corr_matrix": q_corr_matrix,
    "non_finite": q_non_finite,
    "split": q_split,
    "design_matrix": q_design_matrix,
    "dml_pliv_excluding": q_dml_pliv_excluding,
    "predict_demand_holdout": q_predict_demand_holdout,
    "profile": q_profile,
    "weekly_csv": q_weekly_csv,
    "ols_non_finite": q_ols_non_finite,
    "non_finite_planted": q_non_finite_planted,
    "dml_pliv_degenerate_category": q_dml_pliv_degenerate_category,
    "predict_demand_missing_theta": q_predict_demand_missing_theta,
    "lasso_cv_single": q_lasso_cv_single,
    "dml_plr_lasso_single": q_dml_plr_lasso_single,
    "bootstrap_signs": q_bootstrap_signs,
    "profile_head": q_profile_head,
}


def _tested(sql: str) -> str:
    """An estimate's rows with p-value and status."""
    return f"SELECT *, round({normal_p('t')}, 3) AS p, 'ok' AS status FROM ({sql}) q_t"


def oracle_sql() -> dict[str, str]:
    return {
        "regression_panel": _w(_r("SELECT * FROM reg", ["y", "d", "z", "x", "const", "n_lines"])),
        "ols": _tested(OLS_SQL),
        "iv2sls": _tested(IV_SQL),
        "ols_multi": _tested(OLS_MULTI_SQL),
        "iv2sls_multi": _tested(IV_MULTI_SQL),
        "dml_plr_multi": _dml2_sql(),
        "holdout_errors": _holdout_sql(),
        "unique_values": _w("SELECT DISTINCT ppl FROM reg"),
        "predict_demand_uncentered": UNCENTERED_SQL,
        "residual_table": RESIDUAL_SQL,
        "residual_histogram_linear": HISTOGRAM_SQL,
        "column_stats": _w(_r("SELECT " + ", ".join(
            f"max({c}) AS max_{c}, min({c}) AS min_{c}, avg({c}) AS mean_{c}" for c in _COLS) + " FROM reg",
            [f"{k}_{c}" for c in _COLS for k in ("max", "min", "mean")])),
        "regression_features": _features_sql(),
        "dml_plr": _dml_sql(False),
        "dml_pliv": _dml_sql(True),
        "first_stage_errors": FIRST_STAGE_SQL,
        "instrument_strength": STRENGTH_SQL,
        "predict_demand": PREDICT_SQL,
        "value_counts": _w("SELECT p_type, count(*) AS count FROM reg GROUP BY p_type"),
        "describe_by": DESCRIBE_SQL,
        "corr_matrix": CORR_SQL,
        "non_finite": NONFINITE_SQL,
        "split": _w("SELECT p_brand, p_type, week, ppl, fold, is_test FROM reg"),
        "design_matrix": _design_sql(),
        "dml_pliv_excluding": _dml_excluding_sql(),
        "predict_demand_holdout": _predict_holdout_sql(),
        "profile": _w("SELECT count(*) AS n_rows, 12 AS n_cols FROM reg"),
        "weekly_csv": _weekly_sql(),
        "panel_csv_dirty": _w(f"SELECT p_brand, p_type, week, ppl, CASE WHEN {_PLANT} NOT IN (1, 2, 3, 4) THEN CAST(n_lines AS DOUBLE) END AS lines, fold FROM reg"),
        "dummies_colliding_levels": _w(_DUMMY_SQL.replace("c_B_C", "c_B_C_da1c10").replace("c_b_c_x", "c_b_c_a21f57")),
        "feature_filters": _w(_r(f"""SELECT p_brand, p_type, week, ppl, CASE WHEN {_PLANT} <> 4 THEN y END AS y, CASE WHEN {_PLANT} <> 3 THEN d END AS d, x,
       n_lines AS lines, CAST(fold AS VARCHAR) AS fold, round_even(date_diff('day', DATE '1990-01-01', week) / 7.0 + 1, 0) AS week_nr
FROM reg WHERE week <> DATE '{DROPPED}' AND x < 0.06""", ["y", "d", "x", "week_nr"])),
        "ols_non_finite": OLS_SQL.replace("FROM reg WHERE y IS NOT NULL AND d IS NOT NULL",
                                          f"FROM reg WHERE y IS NOT NULL AND d IS NOT NULL AND {_PLANT} NOT IN (3, 4)"),
        "non_finite_planted": _w(f"SELECT CAST(count(CASE WHEN {_PLANT} = 4 THEN 1 END) AS BIGINT) AS y, "
                                 f"CAST(count(CASE WHEN {_PLANT} = 3 THEN 1 END) AS BIGINT) AS d, CAST(0 AS BIGINT) AS z, CAST(0 AS BIGINT) AS x FROM reg"),
        "dml_pliv_degenerate_category": _degenerate_sql(),
        "predict_demand_missing_theta": _w(_r(f"""SELECT * FROM (WITH {_dml_chain(True)},
p AS (SELECT res.*, CASE WHEN res.p_type <> '{EXCLUDED}' THEN lhat + th.theta * (d - rhat) END AS yhat FROM res JOIN th ON res.p_type = th.p_type)
SELECT p_type, count(*) AS n_rows, count(yhat) AS n_predicted, avg(yhat) AS mean_yhat FROM p GROUP BY p_type) q0""", ["mean_yhat"])),
        "lasso_cv_single": _lasso_sql(),
        "dml_plr_lasso_single": _dml_lasso_sql(),
        "bootstrap_signs": _signs_sql(),
        "profile_head": _w("SELECT p_brand, p_type, week, ppl, n_lines FROM reg ORDER BY 1, 2, 3, 4 LIMIT 5"),
    }


def _predict_holdout_sql() -> str:
    body = f"""SELECT * FROM (WITH reg_tr AS (SELECT * FROM reg WHERE is_test = 0),
{_dml_chain(True, "reg_tr", "p_type")},
ftr AS (SELECT p_type, count(*) AS m, sum(x) AS qx, sum(x*x) AS qxx, sum(y) AS qy, sum(x*y) AS qxy,
               sum(d) AS qd, sum(x*d) AS qxd
        FROM reg_tr WHERE y IS NOT NULL AND d IS NOT NULL AND z IS NOT NULL AND x IS NOT NULL GROUP BY p_type),
cof AS (SELECT p_type, (m*qxy - qx*qy)/(m*qxx - qx*qx) AS ly1, (qy - (m*qxy - qx*qy)/(m*qxx - qx*qx)*qx)/m AS ly0,
               (m*qxd - qx*qd)/(m*qxx - qx*qx) AS rd1, (qd - (m*qxd - qx*qd)/(m*qxx - qx*qx)*qx)/m AS rd0 FROM ftr),
tst AS (SELECT reg.p_type, reg.y, reg.d, ly0 + ly1*x + th.theta * (d - (rd0 + rd1*x)) AS yhat, th.theta
        FROM reg JOIN cof ON reg.p_type = cof.p_type JOIN th ON reg.p_type = th.p_type WHERE reg.is_test = 1)
SELECT p_type, count(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN 1 END) AS n,
       avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN power(y - yhat, 2) END) AS mse,
       sqrt(avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN power(y - yhat, 2) END)) AS rmse,
       sqrt(avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN power(y - yhat, 2) END))
         / avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN y END) AS rel_rmse,
       corr(yhat, d) AS corr_yhat_d, max(theta) AS theta
FROM tst GROUP BY p_type) q0"""
    return _w(_r(body, ["mse", "rmse", "rel_rmse", "corr_yhat_d", "theta"]))


def _weekly_sql() -> str:
    from demandlab.plans.registry import _panel_sql
    return _panel_sql()["weekly"]
