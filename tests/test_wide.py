"""Wide designs: plans stay small, results equal numpy, all within a time limit."""
import time

import numpy as np
import pandas as pd
import pytest

from demandlab.operators import dml, gram, lasso, linear, models

K, N = 200, 3000


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(N, K)) * np.linspace(0.2, 4, K)
    z = rng.normal(size=N) + X[:, 0]
    d = 0.7 * z + X[:, 1] * 0.3 + rng.normal(size=N)
    y = -1.5 * d + X[:, :5] @ [1.0, -1, 0.5, 0.2, 0] + rng.normal(size=N) * (1 + np.abs(X[:, 3]))
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(K)]).assign(y=y, d=d, z=z, const=1.0, fold=np.arange(N) % 5, g=np.where(np.arange(N) % 3, "a", "b"))
    pdf.loc[7, "x3"], pdf.loc[11, "y"], pdf.loc[13, "z"] = np.nan, np.inf, np.nan
    return spark.createDataFrame(pdf).repartition(6), pdf, [f"x{i}" for i in range(K)]


def _iv(pdf, xs):
    ok = pdf[np.isfinite(pdf[[*xs, "y", "d", "z"]]).all(axis=1)]
    X, Z = ok[["const", *xs, "d"]].to_numpy(float), ok[["const", *xs, "z"]].to_numpy(float)
    P = Z @ np.linalg.solve(Z.T @ Z, Z.T @ X)
    bread = np.linalg.inv(X.T @ P)
    b = bread @ (P.T @ ok.y.to_numpy(float))
    e = ok.y.to_numpy(float) - X @ b
    V = bread @ ((P * (e**2)[:, None]).T @ P) @ bread.T
    return b[-1], np.sqrt(V[-1, -1]), len(ok)


@pytest.mark.parametrize("by", [None, "g"])
def test_robust_iv_with_200_covariates(wide, by):
    df, pdf, xs = wide
    t0 = time.time()
    got = linear.iv2sls(df, "y", ["const", *xs], ["d"], ["z"], by=by, cov="robust").where("term = 'd'").collect()
    assert time.time() - t0 < 60
    for r in got:
        b, se, n = _iv(pdf if by is None else pdf[pdf.g == r.g], xs)
        assert r.coef == pytest.approx(b, rel=1e-7) and r.se == pytest.approx(se, rel=1e-6) and r.n == n
    assert len(got) == (1 if by is None else 2)


def test_dml_with_200_covariates(wide):
    df, pdf, xs = wide
    t0 = time.time()
    r = dml.dml_pliv(df, "y", "d", "z", xs, fold="fold").table.first()
    assert time.time() - t0 < 60
    ok = np.isfinite(pdf[[*xs, "y", "d", "z"]]).all(axis=1).to_numpy()
    res = {}
    X = np.column_stack([np.ones(N), pdf[xs].to_numpy(float)])
    for c in "ydz":
        t = pdf[c].to_numpy(float)
        u = np.full(N, np.nan)
        for f in range(5):
            tr, te = ok & (pdf.fold != f).to_numpy(), (pdf.fold == f).to_numpy()
            u[te] = t[te] - X[te] @ np.linalg.lstsq(X[tr], t[tr], rcond=None)[0]
        res[c] = u
    full = np.isfinite(res["y"]) & np.isfinite(res["d"]) & np.isfinite(res["z"])
    theta = (res["y"] * res["z"])[full].sum() / (res["d"] * res["z"])[full].sum()
    assert r.theta == pytest.approx(theta, rel=1e-7) and r.n == full.sum()


def test_models_travel_or_are_joined_with_the_same_result(wide, monkeypatch):
    df, _, xs = wide
    slots = {"_a": ("y", linear.LinearLearner()), "_b": ("d", linear.LinearLearner())}
    coefs = linear.coefficients(df, xs[:20], slots, by="g", fold="fold")

    def run():
        out = linear.apply_linear(df.where("g = 'a'").withColumn("g", df.g), coefs, xs[:20], ["_a", "_b"], "g", "fold")
        return sorted((r.x0, r._a is None, r._a or 0.0, r._b or 0.0) for r in out.select("x0", "_a", "_b").collect())
    closed = run()
    monkeypatch.setattr(models.with_models, "__defaults__", (0,))
    joined = run()
    assert np.allclose(np.array(closed, float), np.array(joined, float))
    assert any(c[1] for c in closed)   # the row with a missing covariate has no prediction


def _dummies(n=6000, groups=6, levels=25, seed=3):
    rng = np.random.default_rng(seed)
    codes = [rng.integers(0, levels, n) for _ in range(groups)]
    X = np.column_stack([(c[:, None] == np.arange(levels)).astype(float) for c in codes])
    y = X[:, 3] * 2 - X[:, 30] + 0.5 * X[:, -3] + rng.normal(size=n) * 0.5
    return X, y


def _kkt(S, s, alpha, b):
    q = s - S @ b
    on = b != 0
    return max(np.abs(q[on] - alpha * np.sign(b[on])).max(initial=0.0), (np.abs(q[~on]) - alpha).max(initial=0.0))


def test_lasso_path_on_150_collinear_dummies():
    X, y = _dummies()
    cell = gram.Cell.of(np.column_stack([X, y]))
    ix, iy = list(range(150)), 150
    t0 = time.time()
    grid = lasso.alpha_grid(cell, ix, iy)
    B, its = lasso.lasso_path(cell, ix, iy, grid)
    assert time.time() - t0 < 20
    S, s = cell.m[:150, :150] / cell.n, cell.m[:150, 150] / cell.n
    for a, b in zip(grid, B, strict=True):
        assert _kkt(S, s, a, b[1:]) < 1e-6 * grid[0]


def test_lasso_search_is_the_same_spread_over_tasks_or_not(spark):
    X, y = _dummies(n=2000, groups=3, levels=12)
    d = X[:, 5] + np.random.default_rng(1).normal(size=len(X))
    xs = [f"x{i}" for i in range(X.shape[1])]
    pdf = pd.DataFrame(X, columns=xs).assign(y=y, d=d, fold=np.arange(len(X)) % 3, cv=np.arange(len(X)) // 3 % 4)
    df = spark.createDataFrame(pdf)
    slots = {"_l": ("y", lasso.LassoCV(n_alphas=20)), "_m": ("d", lasso.LassoCV(n_alphas=20)), "_p": ("y", linear.LinearLearner())}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")   # three units, eight partitions: one path to a task
        got = {r._fold: r for r in linear.coefficients(df, xs, slots, fold="fold", inner="cv").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert set(got) == {0, 1, 2}
    for f in range(3):
        for o, t in (("_l", "y"), ("_m", "d")):
            rest = pdf[pdf.fold != f]
            cells = [gram.Cell.of(rest[rest.cv == i][[*xs, t]].to_numpy(float)) for i in range(4)]
            want = lasso.LassoCV(n_alphas=20).fit(cells, list(range(len(xs))), len(xs)).coef
            assert np.allclose(got[f][o], want, atol=1e-6)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")   # three units, two partitions: nothing is spread
        again = {r._fold: r for r in linear.coefficients(df, xs, slots, fold="fold", inner="cv").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for f in range(3):
        assert np.allclose(got[f]._l, again[f]._l, atol=1e-9) and np.allclose(got[f]._m, again[f]._m, atol=1e-9)


def test_wide_dml_lasso_finishes(spark):
    X, y = _dummies()
    rng = np.random.default_rng(5)
    z = rng.normal(size=len(X)) + X[:, 2]
    d = z + X[:, 40] + rng.normal(size=len(X))
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(150)]).assign(y=y - 1.2 * d, d=d, z=z, fold=np.arange(len(X)) % 5)
    t0 = time.time()
    r = dml.dml_pliv(spark.createDataFrame(pdf), "y", "d", "z", [f"x{i}" for i in range(150)], *[lasso.LassoCV()] * 3, fold="fold").table.first()
    assert abs(r.theta + 1.2) < 4 * r.se and time.time() - t0 < 240
