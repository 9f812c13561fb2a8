"""Estimators against numpy and known truths on simulated rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators import dml, gram as G, lasso, linear, stats


def _sim(spark, n=4000, theta=-1.5, seed=1, groups=("g1", "g2")):
    rng = np.random.default_rng(seed)
    x1, x2, z = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    e = rng.normal(size=n)
    d = 0.8 * z + 0.5 * x1 + 0.3 * e + 0.2 * rng.normal(size=n)
    y = theta * d + 1.0 * x1 - 0.5 * x2 + 0.5 * e + 0.1 * rng.normal(size=n)   # d endogenous through e
    g = np.array(groups)[np.arange(n) % len(groups)]
    rows = [(int(i), str(g[i]), int(i % 5), float(y[i]), float(d[i]), float(z[i]), float(x1[i]), float(x2[i]), 1.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "k long, g string, fold int, y double, d double, z double, x1 double, "
                                       "x2 double, const double").repartition(7), (y, d, z, x1, x2)


@pytest.fixture(scope="module")
def sim(spark):
    return _sim(spark)


def _collect(table):
    rows = table.collect()
    out = {}
    for r in rows:
        k = len(r["mean"])
        c = G.Cell(r["n"], np.array(r["mean"]), np.array(r["m"]).reshape(k, k))
        key = tuple(r[g] for g in table.columns if g.startswith("_g")), r["_fold"], r["_inner"]
        out[key] = out[key] + c if key in out else c
    return out


def test_cells_merge_to_the_whole(sim):
    df, (y, _, _, x1, _) = sim
    parts = _collect(G.cells(df, ["x1", "y"], fold="fold"))
    total = G.merged(list(parts.values()))
    assert len(parts) == 5 and total.n == 4000
    X = np.column_stack([x1, y])
    assert np.allclose(total.mean, X.mean(0)) and np.allclose(total.m, np.cov(X.T, bias=True) * 4000)


def test_non_finite_rows_are_left_out_under_any_partitioning(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    y = 2 * x + 0.1 * rng.normal(size=300)
    bad = [(float("nan"), 1.0), (1.0, float("inf")), (None, 2.0), (3.0, float("-inf"))]
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y, strict=True)] + [(a, b, 1.0) for a, b in bad], "x double, y double, const double")
    want = np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0]
    for parts in (1, 4, 16):
        r = {t.term: t for t in linear.ols(df.repartition(parts), "y", ["const", "x"], cov="robust").collect()}
        assert r["x"].coef == pytest.approx(want[1], rel=1e-9) and r["x"].n == 300 and r["x"].status == "ok"


def test_offset_columns_keep_their_digits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=2000)
    y = 0.5 * x + rng.normal(size=2000)
    X = np.column_stack([np.ones(2000), x])
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    se = np.sqrt(((y - X @ b) ** 2).mean() * np.linalg.inv(X.T @ X)[1, 1])
    df = spark.createDataFrame([(float(v) * 10 + 1e6, float(w), 1.0) for v, w in zip(x, y, strict=True)], "x double, y double, const double")
    r = {t.term: t for t in linear.ols(df.repartition(5), "y", ["const", "x"]).collect()}
    assert r["x"].coef * 10 == pytest.approx(b[1], rel=1e-8) and r["x"].se * 10 == pytest.approx(se, rel=1e-8)


def test_a_bad_group_does_not_stop_the_others(spark):
    rows = [("a", float(i), 2.0 * i + (i % 3), 5.0, 1.0) for i in range(20)] + [("b", 1.0, float(i), float(i % 4), 1.0) for i in range(20)] + [("c", 1.0, 2.0, 3.0, 1.0)] + [(None, float(i), 3.0 * i, float(i * i), 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, x double, y double, w double, const double")
    for cov in ("unadjusted", "robust"):
        r = {(t.g, t.term): t for t in linear.ols(df, "y", ["const", "x", "w"], by="g", cov=cov).collect()}
        assert r["a", "x"].coef == pytest.approx(2.0, abs=0.05) and r["a", "w"].coef is None and "left out" in r["a", "w"].status
        assert r["a", "x"].status == "without w" and r["b", "x"].coef is None and r["b", "w"].coef is not None
        assert r["c", "x"].coef is None and r["c", "const"].status != "ok"
        assert r[None, "x"].coef == pytest.approx(3.0, abs=1e-6)


def test_many_groups_and_their_type(spark):
    n = 30_000
    df = spark.range(n * 4).select((F.col("id") % n).cast("int").alias("g"), F.floor(F.col("id") / n).cast("double").alias("x"), F.lit(1.0).alias("const"))
    df = df.withColumn("y", F.col("x") * F.col("g") + 1)
    out = linear.ols(df, "y", ["const", "x"], by="g").where("term = 'x'")
    assert dict(out.dtypes)["g"] == "int"
    assert out.where(F.abs(F.col("coef") - F.col("g")) < 1e-6).count() == n


def test_ols_matches_numpy(sim):
    df, (y, d, z, x1, x2) = sim
    r = {row.term: row for row in linear.ols(df, "y", ["const", "d", "x1"]).collect()}
    X = np.column_stack([np.ones(len(y)), d, x1])
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    e = y - X @ b
    V = (e @ e / len(y)) * np.linalg.inv(X.T @ X)
    assert r["d"].coef == pytest.approx(b[1], rel=1e-9)
    assert r["d"].se == pytest.approx(np.sqrt(V[1, 1]), rel=1e-7)
    Vr = np.linalg.inv(X.T @ X) @ (X.T * e ** 2) @ X @ np.linalg.inv(X.T @ X)
    rr = {row.term: row for row in linear.ols(df, "y", ["const", "d", "x1"], cov="robust").collect()}
    assert rr["x1"].se == pytest.approx(np.sqrt(Vr[2, 2]), rel=1e-7)


def test_iv_with_z_equal_d_is_ols(sim):
    df, _ = sim
    a = {r.term: r.coef for r in linear.iv2sls(df.withColumn("zz", F.col("d")), "y", ["const", "x1"], ["d"], ["zz"],
                                               cov="unadjusted").collect()}
    b = {r.term: r.coef for r in linear.ols(df, "y", ["const", "x1", "d"]).collect()}
    assert a["d"] == pytest.approx(b["d"], rel=1e-8)


def test_iv_recovers_theta_and_grouping(sim):
    df, _ = sim
    out = linear.iv2sls(df, "y", ["const", "x1", "x2"], ["d"], ["z"], by="g").where("term = 'd'").collect()
    assert len(out) == 2
    for r in out:
        assert abs(r.coef + 1.5) < 4 * r.se


def test_rank_deficiency_is_told(sim):
    df, _ = sim
    r = {t.term: t for t in linear.ols(df.withColumn("c2", F.col("const") * 2), "y", ["const", "c2", "d"]).collect()}
    assert r["c2"].coef is None and "left out" in r["c2"].status and r["d"].coef is not None
    r = linear.ols(df.withColumn("d2", F.col("d") * 2), "y", ["const", "d", "d2"]).collect()
    assert all(t.coef is None and "rank-deficient" in t.status and "d2" in t.status for t in r)


def test_dml_pliv_recovers_theta(sim):
    df, _ = sim
    r = dml.dml_pliv(df, "y", "d", "z", ["x1", "x2"], fold="fold").table.first()
    assert abs(r.theta + 1.5) < 4 * r.se and r.ci_lo < r.theta < r.ci_hi
    assert 0 <= r.p <= 1


def test_pliv_with_z_equal_d_is_plr(sim):
    df, _ = sim
    a = dml.dml_plr(df, "y", "d", ["x1", "x2"], fold="fold").table.first()
    b = dml.dml_pliv(df.withColumn("zz", F.col("d")), "y", "d", "zz", ["x1", "x2"], fold="fold").table.first()
    assert a.theta == pytest.approx(b.theta, rel=1e-9) and a.se == pytest.approx(b.se, rel=1e-7)


def test_dml_linear_equals_refit(sim):
    """Gram subtraction = refitting each fold's model on the other folds."""
    df, (y, d, z, x1, x2) = sim
    pdf = df.toPandas()
    u = np.empty(len(pdf)); v = np.empty(len(pdf))
    for f in range(5):
        tr, te = pdf[pdf.fold != f], pdf[pdf.fold == f]
        Xtr = np.column_stack([np.ones(len(tr)), tr.x1, tr.x2]); Xte = np.column_stack([np.ones(len(te)), te.x1, te.x2])
        u[te.index] = te.y - Xte @ np.linalg.lstsq(Xtr, tr.y, rcond=None)[0]
        v[te.index] = te.d - Xte @ np.linalg.lstsq(Xtr, tr.d, rcond=None)[0]
    theta = (u @ v) / (v @ v)
    r = dml.dml_plr(df, "y", "d", ["x1", "x2"], fold="fold").table.first()
    assert r.theta == pytest.approx(theta, rel=1e-9)


def test_bootstrap_deterministic(sim):
    df, _ = sim
    res = dml.dml_pliv(df, "y", "d", "z", ["x1", "x2"], fold="fold", by="g")
    a = {r.g: r.q95 for r in dml.bootstrap(res, ["k"], n_boot=200, seed=5, by="g").collect()}
    b = {r.g: r.q95 for r in dml.bootstrap(
        dml.dml_pliv(df.repartition(3), "y", "d", "z", ["x1", "x2"], fold="fold", by="g"),
        ["k"], n_boot=200, seed=5, by="g").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9) and 1.4 < a[k] < 2.6


def test_lasso_kkt_and_ols_limit(sim):
    df, (y, d, z, x1, x2) = sim
    parts = [c for _, c in sorted(_collect(G.cells(df, ["x1", "x2", "d", "y"], fold="fold")).items())]
    ix, iy = [0, 1, 2], 3
    T = G.merged(parts)
    alpha = 0.05
    coef, _ = lasso.lasso_fit(T, ix, iy, alpha)
    X = np.column_stack([x1, x2, d]); Xc = X - X.mean(0); yc = y - y.mean()
    grad = Xc.T @ (yc - Xc @ coef[1:]) / len(y)
    for j, b in enumerate(coef[1:]):
        if b != 0:
            assert grad[j] == pytest.approx(alpha * np.sign(b), abs=1e-6)
        else:
            assert abs(grad[j]) <= alpha + 1e-6
    c0, _ = lasso.lasso_fit(T, ix, iy, 1e-12)
    ols = np.linalg.lstsq(np.column_stack([np.ones(len(y)), X]), y, rcond=None)[0]
    assert np.allclose(c0, ols, atol=1e-6)
    got = lasso.LassoCV().fit(parts, ix, iy)
    assert got.alpha > 0 and len(got.coef) == 4
    # an empty inner fold changes nothing; a single fold gives no estimate
    none = G.Cell(0.0, np.zeros(4), np.zeros((4, 4)))
    assert np.allclose(lasso.LassoCV().fit([*parts, none], ix, iy).coef, got.coef)
    assert lasso.LassoCV().fit([parts[0], none], ix, iy) is None
    assert abs(got.coef[3] + 1.2) < 0.4


def test_stats_against_pandas(sim):
    df, _ = sim
    pdf = df.toPandas()
    cm = {(r.a, r.b): r.corr for r in stats.corr_matrix(df, ["y", "d", "x1"]).collect()}
    assert cm[("y", "d")] == pytest.approx(pdf.y.corr(pdf.d), rel=1e-9) and cm[("d", "y")] == cm[("y", "d")]
    e = stats.errors(df, "y", "d").first()
    assert e.mse == pytest.approx(((pdf.y - pdf.d) ** 2).mean(), rel=1e-9)
    dsc = {r.column: r for r in stats.describe_by(df, ["y"], by="g").where("g = 'g1'").collect()}
    s = pdf[pdf.g == "g1"].y.describe()
    assert dsc["y"].p25 == pytest.approx(s["25%"], rel=1e-9) and dsc["y"].std == pytest.approx(s["std"], rel=1e-9)


def test_results_invariant_under_repartition(sim):
    df, _ = sim
    a = dml.dml_pliv(df, "y", "d", "z", ["x1", "x2"], fold="fold", by="g").table.orderBy("g").collect()
    b = dml.dml_pliv(df.repartition(2), "y", "d", "z", ["x1", "x2"], fold="fold", by="g").table.orderBy("g").collect()
    assert [r.theta for r in a] == pytest.approx([r.theta for r in b], rel=1e-10)
