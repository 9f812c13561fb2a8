"""End-to-end runs on the design matrix with DuckDB oracles: naive OLS and 2SLS with
every covariate, linear DML with two, an out-of-time holdout scored in a later session
from stored tables, and a table one period of which is replaced."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.config import PrepConfig
from demandlab.operators import diagnostics as DG
from demandlab.operators import features as FE
from demandlab.operators import linear, store, trees
from demandlab.operators.panel import daily_features, weekly
from demandlab.plans import sql_linear as S
from demandlab.plans.design_plan import build_design, design_covariates
from demandlab.plans.estimate_plan import D, Y, Z, elasticity, naive_models
from demandlab.plans.panel_plan import warehouse
from demandlab.plans.registry import CFG, with_panel
from demandlab.plans.registry_models import _design_body, _reg, _round, _w, oracle_sql
from demandlab.session import scratch_table
from demandlab.sources.versions import read_periods, replace_periods

PREP = PrepConfig()
XS2 = ["promo_dummy", "l_week_nr"]


def _tested(df: DataFrame, *first: str) -> DataFrame:
    """Estimates to six digits, t and p to four."""
    six = [F.round(c, 6).alias(c) for c in df.columns if c in ("coef", "theta", "se", "ci_lo", "ci_hi")]
    return df.select(*first, *six, F.round("t", 4).alias("t"), F.round("p", 4).alias("p"), "n", "status")


def q_naive_models_design(spark, d):
    """Naive OLS (unadjusted) and 2SLS (robust) of log demand on the design
    covariates and log price, the instrument being log purchase price (M1, M2, M2a)."""
    mat, enc = build_design(warehouse(spark, d), CFG)
    return _tested(naive_models(mat, design_covariates(enc)), "model", "term")


def q_elasticity_design_linear(spark, d):
    """DML-PLIV on the design matrix with linear first stages and two covariates."""
    mat, _ = build_design(warehouse(spark, d), CFG)
    fold = F.pmod(F.col("key_article") * 7 + F.datediff("week_start_date", F.lit("1995-01-02").cast("date")) / 7 * 3 + F.length("ppl"), F.lit(5)).cast("int")
    return _tested(elasticity(mat.withColumn("fold", fold), XS2).table, "learner")


def q_holdout_design(spark, d):
    """Out-of-time holdout on the design matrix (R3, E7): encoder, fills and linear
    first stages are fitted on the training weeks and stored; the holdout weeks are
    prepared and scored with what is read back. Errors per target."""
    w = weekly(daily_features(warehouse(spark, d), CFG, packed=True), CFG)
    cut = F.lit(CFG.holdout_start)
    hol = FE.holiday_weeks(range(CFG.start.year, CFG.end.year + 1))
    train, enc = FE.prepare(w.where(F.col("week_start_date") < cut), PREP, holidays=hol)
    slots = {f"_{t}": (t, linear.LinearLearner()) for t in (Y, D)}
    path = scratch_table(spark, "study")
    store.save_encoder(spark, enc, path)
    store.save_coefficients(linear.coefficients(train, design_covariates(enc, PREP), slots), path)

    later = store.load_encoder(spark, path)
    xs = design_covariates(later, PREP)
    # the later set starts n_lags weeks early so its first weeks have lag history
    history = F.lit(CFG.holdout_start - timedelta(weeks=PREP.n_lags))
    hold, _ = FE.prepare(w.where(F.col("week_start_date") >= history), PREP, encoder=later, holidays=hol)
    hold = FE.align(hold.where(F.col("week_start_date") >= cut), train.columns)
    scored = linear.apply_linear(hold, store.load_coefficients(spark, path, list(slots)), xs, list(slots))
    return _round(DG.first_stage_errors(scored, {t: (t, o) for o, (t, _) in slots.items()}).withColumnRenamed("slot", "target"))


RERUN = 1996


def q_replace_period(spark, d):
    """A table by year of which one year is run again (S3): the run reads the year it replaces."""
    panel = _reg(spark, d).select("p_brand", "p_type", "week", "ppl", "y").withColumn("year", F.year("week"))
    schema, path = ", ".join(f"{c} {t}" for c, t in panel.dtypes), scratch_table(spark, "by_year")
    replace_periods(panel, path, "year")
    old = read_periods(spark, path, schema, [RERUN])
    replace_periods(old.where(F.col("ppl") != CFG.default_line).withColumn("y", F.col("y") + 1), path, "year", [RERUN])
    return _round(read_periods(spark, path, schema))


def q_importance_linear(spark, d):
    """Shares of the absolute coefficients of a linear model per category."""
    fit = linear.ols(_reg(spark, d), "y", ["const", "d", "x"], by="p_type")
    shares = trees.coefficient_shares(fit, "p_type")
    return shares.select("p_type", "feature", F.round("value", 6).alias("value"), F.round("share", 4).alias("share"))


def q_left_out_levels(spark, d):
    """The level of each encoded column that has no dummy (L4)."""
    enc = FE.FrozenDummies.fit(_reg(spark, d), ["p_brand", "p_type", "ppl"])
    return spark.createDataFrame(list(enc.defaults.items()), "name string, level string")


QUERIES = {"importance_linear": q_importance_linear, "left_out_levels": q_left_out_levels, "naive_models_design": q_naive_models_design, "elasticity_design_linear": q_elasticity_design_linear,
           "holdout_design": q_holdout_design, "replace_period": q_replace_period}


# ------------------------------------------------------------------ oracles

def _xs() -> list[str]:
    levels = {"ppl": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], "article_tier": ["Best", "Better", "Good"],
              "article_cat_2": sorted(f"Brand#{i}" for i in range(1, 26))}
    return design_covariates(FE.FrozenDummies({c: tuple(levels[c]) for c in PREP.dummy_cols}), PREP)


def _q(cols) -> list[str]:
    return [f'"{c}"' if not c.replace("_", "").isalnum() else c for c in cols]


def _list(cols) -> str:
    return f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in cols)}]"


def _complete(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _naive_sql() -> str:
    x = ["const", *_q(_xs()), D]
    z, k = [*x[:-1], Z], len(x)
    body = f"""SELECT * FROM (WITH mat AS MATERIALIZED ({_design_body()[0]}),
o AS MATERIALIZED (SELECT * FROM mat WHERE {_complete([*x, Y])}),
v AS MATERIALIZED (SELECT * FROM o WHERE {Z} IS NOT NULL),
{S.system("a", "o", x, [*x, Y], unit=k - 1)}, {S.solved("a", k)},
{S.system("b", "v", z, [*x, Y])}, {S.solved("b", k)},
{S.system("c", "v", x, z, unit=k - 1)}, {S.solved("c", k)},
e1 AS (SELECT sum(power({Y} - list_dot_product({_list(x)}, s.b), 2)) AS sse, count(*) AS n FROM o, {S.vector("a", k)} s),
r1 AS (SELECT 'ols' AS model, (SELECT v FROM a WHERE i = {k - 1} AND j = {k}) AS coef, sqrt(sse / n * (SELECT v FROM a WHERE i = {k - 1} AND j = {k + 1})) AS se, n FROM e1),
r2 AS (SELECT '2sls' AS model, (SELECT v FROM b WHERE i = {k - 1} AND j = {k}) AS coef,
              sqrt(sum(power(({Y} - list_dot_product({_list(x)}, s.b)) * list_dot_product({_list(z)}, w.b), 2))) AS se, count(*) AS n
       FROM v, {S.vector("b", k)} s, {S.vector("c", k)} w),
r AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2)
SELECT model, '{D}' AS term, round(coef, 6) AS coef, round(se, 6) AS se, round(coef / se, 4) AS t, round({S.normal_p("(coef / se)")}, 4) AS p, n, 'ok' AS status FROM r) q0"""
    return with_panel(body)


def _elasticity_sql() -> str:
    x = ["const", *XS2]
    fold = "CAST((key_article * 7 + date_diff('day', DATE '1995-01-02', week_start_date) // 7 * 3 + length(ppl)) % 5 AS INTEGER)"
    k = len(x)
    res = ", ".join(f"{t} - list_dot_product({_list(x)}, s{i}.b) AS {n}" for i, (t, n) in enumerate(((Y, "u"), (D, "v"), (Z, "w"))))
    joins = " ".join(f"JOIN {S.vector('a', k + i)} s{i} ON s{i}.k = o.fold" for i in range(3))
    body = f"""SELECT * FROM (WITH mat AS MATERIALIZED ({_design_body()[0]}),
o AS MATERIALIZED (SELECT *, {fold} AS fold FROM mat WHERE {_complete([*x, Y, D, Z])}),
tr AS MATERIALIZED (SELECT o.*, f.left_out FROM o JOIN (SELECT DISTINCT fold AS left_out FROM o) f ON o.fold <> f.left_out),
{S.system("a", "tr", x, [*x, Y, D, Z], key="left_out")}, {S.solved("a", k)},
res AS MATERIALIZED (SELECT {res} FROM o {joins}),
th AS (SELECT sum(u * w) / sum(v * w) AS theta, avg(v * w) AS j, count(*) AS n FROM res),
sd AS (SELECT theta, n, sqrt(avg(power((u - theta * v) * w, 2)) / (n * j * j)) AS se FROM res, th GROUP BY theta, j, n)
SELECT 'pliv[linear,linear,linear]' AS learner, round(theta, 6) AS theta, round(se, 6) AS se, round(theta - 1.959963984540054 * se, 6) AS ci_lo,
       round(theta + 1.959963984540054 * se, 6) AS ci_hi, round(theta / se, 4) AS t, round({S.normal_p("(theta / se)")}, 4) AS p, n, 'ok' AS status FROM sd) q0"""
    return with_panel(body)


def _holdout_sql() -> str:
    x = ["const", *_q(_xs())]
    k, cut = len(x), f"DATE '{CFG.holdout_start}'"
    part = "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS target, count(e) AS n, avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, sqrt(avg(e * e)) / avg({t}) AS rel_rmse
FROM (SELECT {t}, {t} - list_dot_product({_list(x)}, s.b) AS e FROM mat, {S.vector("a", k + i)} s WHERE week_start_date >= {cut} AND {_complete([*x, t])})"""
        for i, t in enumerate((Y, D)))
    body = f"""SELECT * FROM (WITH mat AS MATERIALIZED ({_design_body()[0]}),
o AS MATERIALIZED (SELECT * FROM mat WHERE week_start_date < {cut} AND {_complete([*x, Y, D])}),
{S.system("a", "o", x, [*x, Y, D])}, {S.solved("a", k)}
SELECT target, n, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(rel_rmse, 6) AS rel_rmse FROM ({part})) q0"""
    return with_panel(body)


REPLACE_SQL = _w(f"""SELECT p_brand, p_type, week, ppl, round(CASE WHEN year(week) = {RERUN} THEN y + 1 ELSE y END, 6) AS y, CAST(year(week) AS INTEGER) AS year
FROM reg WHERE year(week) <> {RERUN} OR ppl <> '{CFG.default_line}'""")

SHARES_SQL = f"""SELECT p_type, term AS feature, round(abs(coef), 6) AS value, round(abs(coef) / sum(abs(coef)) OVER (PARTITION BY p_type), 4) AS share
FROM ({oracle_sql()["ols_multi"]}) WHERE term <> 'const'"""

LEVELS_SQL = _w("\nUNION ALL\n".join(f"SELECT '{c}' AS name, min({c}) AS level FROM reg" for c in ("p_brand", "p_type", "ppl")))

ORACLE_SQL = {"importance_linear": SHARES_SQL, "left_out_levels": LEVELS_SQL, "naive_models_design": _naive_sql(), "elasticity_design_linear": _elasticity_sql(), "holdout_design": _holdout_sql(), "replace_period": REPLACE_SQL}
