"""OLS, two-stage least squares and plain linear learners on cross-product cells
(M1, M2, M2a, M6, M11).

No intercept is added silently: pass a constant column in ``x`` / ``exog``
(``features.add_const``) to get one (decision D8). Grouped fits (``by``) are
one more cell key, not a loop over filtered frames. Groups are solved on the
executors: a column that is constant inside a group (beyond the intercept) is
left out there and named in ``status``; a group that cannot be solved gives rows
with NULL estimates and the reason. Robust (White, no small-sample correction)
covariances take a second pass weighted by e^2.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from demandlab.operators.gram import (BUCKETS, HELD_BYTES, Cell, _by, _none, arrays, batch_groups, cell_schema, cells, key_columns, key_types, matrix,
                                      merged, numbers, solve, solve_groups, with_types)
from demandlab.operators.models import with_models
from demandlab.session import scratch_table, ship_package

TERMS = "term string, coef double, se double, t double, p double, n long, status string"


def _pvalue(t: float) -> float:
    return math.erfc(abs(t) / math.sqrt(2.0))


# ------------------------------------------------------------------ OLS and 2SLS

class Fit:
    """One group's solution in the basis [intercept, centred columns] (or raw columns without intercept)."""

    def __init__(self, cell: Cell, x: Sequence[str], z: Sequence[str], y: str, cols: Sequence[str]):
        at = {c: i for i, c in enumerate(cols)}
        constant = cell.constant()
        self.x, self.n = list(x), cell.n
        flat = [c for c in x if constant[at[c]]]
        self.one = next((c for c in flat if cell.mean[at[c]] != 0), None)
        self.left_out = [c for c in flat if c != self.one]
        self.xs = [c for c in x if not constant[at[c]]]
        self.zs = [c for c in z if not constant[at[c]]]
        self.level = cell.mean[at[self.one]] if self.one else 1.0
        ix, iz, iy = [at[c] for c in self.xs], [at[c] for c in self.zs], at[y]
        G = cell.m if self.one else cell.raw()
        self.mean_x, self.mean_z = (cell.mean[ix], cell.mean[iz]) if self.one else (np.zeros(len(ix)), np.zeros(len(iz)))
        if cell.n <= len(ix) + bool(self.one):
            raise np.linalg.LinAlgError("not more rows than terms")
        ZX = G[np.ix_(iz, ix)]
        self.proj = solve(G[np.ix_(iz, iz)], ZX, self.zs)
        self.bread = solve(ZX.T @ self.proj, np.eye(len(ix)), self.xs) if ix else np.zeros((0, 0))
        self.beta = self.bread @ (self.proj.T @ G[iz, iy])
        XX, Xy = G[np.ix_(ix, ix)], G[ix, iy]
        self.ee = max(0.0, float(G[iy, iy] - 2 * self.beta @ Xy + self.beta @ XX @ self.beta))
        self.b0 = (cell.mean[iy] - self.mean_x @ self.beta) / self.level

    def coefficients(self) -> list[float]:
        """By term of ``x``, 0 where left out."""
        got = dict(zip(self.xs, self.beta.tolist(), strict=True)) | ({self.one: float(self.b0)} if self.one else {})
        return [got.get(c, 0.0) for c in self.x]

    def unadjusted(self) -> tuple[float, np.ndarray]:
        """Variance of the intercept in the centred basis, covariance of the others."""
        s2 = self.ee / self.n
        return s2 / self.n, s2 * self.bread, np.zeros(len(self.xs))

    def robust(self, S: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """From sums of e^2 [1, z][1, z]' with z centred."""
        P = np.zeros((len(self.xs) + 1, len(self.zs) + 1))
        P[0, 0] = 1.0
        P[1:, 1:] = self.proj.T
        M = P @ S @ P.T
        return M[0, 0] / self.n**2, self.bread @ M[1:, 1:] @ self.bread, self.bread @ M[1:, 0] / self.n

    def rows(self, var: tuple[float, np.ndarray, np.ndarray]) -> Iterator[tuple]:
        v0, V, c = var
        by_term = {x: (float(self.beta[i]), float(V[i, i])) for i, x in enumerate(self.xs)}
        if self.one:
            by_term[self.one] = float(self.b0), float((v0 - 2 * self.mean_x @ c + self.mean_x @ V @ self.mean_x) / self.level**2)
        for x in self.x:
            if x in self.left_out:
                yield x, None, None, None, None, int(self.n), "constant in the group: left out"
                continue
            b, v = by_term[x]
            se = math.sqrt(v) if v >= 0 else None
            t = b / se if se else None
            yield x, b, se, t, _pvalue(t) if t is not None else None, int(self.n), "ok" if not self.left_out else "without " + ", ".join(self.left_out)


def _failed(x: Sequence[str], n: float, why: str) -> Iterator[tuple]:
    for c in x:
        yield c, None, None, None, None, int(n), why


def _estimate(df: DataFrame, y: str, x: Sequence[str], z: Sequence[str], by, cov: str) -> DataFrame:
    keys = _by(by)
    cols = list(dict.fromkeys([*x, *z, y]))
    types = key_types(df, keys)
    table = cells(df, cols, keys or None)

    def unadjusted(_, own):
        cell = merged(list(own.values()))
        try:
            fit = Fit(cell, x, z, y, cols)
            yield from fit.rows(fit.unadjusted())
        except np.linalg.LinAlgError as e:
            yield from _failed(x, cell.n, str(e))

    if cov != "robust":
        return with_types(solve_groups(table, unadjusted, TERMS), keys, types)

    def fitted(_, own):
        cell = merged(list(own.values()))
        try:
            fit = Fit(cell, x, z, y, cols)
            full = dict(zip(fit.zs, fit.mean_z.tolist(), strict=True))
            yield pickle.dumps(fit), fit.coefficients(), [full.get(c, 0.0) for c in z], int(cell.n), None
        except np.linalg.LinAlgError as e:
            yield None, None, None, int(cell.n), str(e)

    path = scratch_table(df.sparkSession, "fits")
    solve_groups(table, fitted, "fit binary, coef array<double>, mean array<double>, n long, why string").write.parquet(path)
    fits = df.sparkSession.read.parquet(path)
    meat = _weighted(df, keys, fits, x, z, y)
    gcols = key_columns(keys)
    joined = fits.alias("f").join(meat.alias("s"), _same([f"f.{g}" for g in gcols], [f"s.{g}" for g in gcols]), "left") \
        .select(*[f"f.{g}" for g in gcols], "fit", "f.n", "why", "s.s")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(z) + 1
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                g = [_none(r[c]) for c in gcols]
                if r["fit"] is None:
                    out += [(*g, *row) for row in _failed(x, r["n"], r["why"])]
                    continue
                fit = pickle.loads(r["fit"])
                use = [0, *(1 + list(z).index(c) for c in fit.zs)]
                S = np.asarray(r["s"], float).reshape(k, k)[np.ix_(use, use)]
                out += [(*g, *row) for row in fit.rows(fit.robust(S))]
            yield pd.DataFrame(out, columns=[*gcols, *(t.split()[0] for t in TERMS.split(", "))])

    done = joined.mapInPandas(finish, ", ".join([f"{g} string" for g in gcols] + [TERMS]))
    return with_types(done, keys, types)


def _same(left: Sequence[str], right: Sequence[str]):
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _weighted(df: DataFrame, keys: list[str], fits: DataFrame, x: Sequence[str], z: Sequence[str], y: str) -> DataFrame:
    """_g..., s: per group the sum of e^2 [1, z - mean][1, z - mean]' (one pass, summed in the tasks first, then in buckets)."""
    gcols = key_columns(keys)
    kx, kz = len(x), len(z)
    rows = df.select(*[F.col(k).cast("string").alias(g) for k, g in zip(keys, gcols, strict=True)], numbers([*x, *z, y]).alias("_x"))
    data, per_row = with_models(rows, fits, lambda names: _same(gcols, names), gcols, {"coef": kx, "mean": kz})
    schema = ", ".join([f"{g} string" for g in gcols] + ["s array<double>"])

    def total(acc: dict) -> pa.RecordBatch:
        cols = [pa.array([g[i] for g in acc], pa.string()) for i in range(len(gcols))] + [arrays([S.ravel() for S in acc.values()])]
        return pa.RecordBatch.from_arrays(cols, names=[*gcols, "s"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict = {}
        for batch in batches:
            X, B = matrix(batch.column("_x"), kx + kz + 1), per_row(batch, "coef")
            ok = np.isfinite(X).all(axis=1) & np.isfinite(B).all(axis=1)
            e = X[:, -1] - (X[:, :kx] * B).sum(axis=1)
            Z = np.column_stack([np.ones(len(X)), X[:, kx:-1] - per_row(batch, "mean")])
            for g, idx in batch_groups(batch, gcols, ok):
                acc[g] = acc.get(g, 0.0) + (Z[idx] * (e[idx] ** 2)[:, None]).T @ Z[idx]
            if len(acc) * 8 * (kz + 1) ** 2 > HELD_BYTES:
                yield total(acc)
                acc = {}
        if acc:
            yield total(acc)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, S = None, None
        for batch in batches:
            groups = batch.select(gcols).to_pylist() if gcols else [{}] * batch.num_rows
            for i, r in enumerate(groups):
                g, part = tuple(r[c] for c in gcols), batch.column("s")[i].values.to_numpy()
                if g == last:
                    S = S + part
                    continue
                if last is not None:
                    yield total({last: S})
                last, S = g, part
        if last is not None:
            yield total({last: S})

    part = data.mapInArrow(partial, schema).withColumn("_b", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    some = part.repartition(*gcols, "_b").sortWithinPartitions(*gcols, "_b").drop("_b").mapInArrow(merge, schema)
    return (some.repartition(*gcols).sortWithinPartitions(*gcols) if gcols else some.repartition(1)).mapInArrow(merge, schema)


def ols(df: DataFrame, y: str, x: Sequence[str], by=None, cov: str = "unadjusted") -> DataFrame:
    """y on x (no automatic intercept): by..., term, coef, se, t, p, n, status."""
    return _estimate(df, y, list(x), list(x), by, cov)


def iv2sls(df: DataFrame, y: str, exog: Sequence[str], endog: Sequence[str], instr: Sequence[str],
           by=None, cov: str = "robust") -> DataFrame:
    """Two-stage least squares: X = [exog, endog], Z = [exog, instr].

    beta = (X'PX)^-1 X'Py with P = Z (Z'Z)^-1 Z'; unadjusted V = (e'e/n)(X'PX)^-1,
    robust V = (X'PX)^-1 (sum e^2 xhat xhat') (X'PX)^-1, xhat = P x. With no
    endogenous column this is OLS.
    """
    return _estimate(df, y, [*exog, *endog], [*exog, *instr], by, cov)


# ------------------------------------------------------------------ learners

class LinearLearner:
    """Least squares with intercept (M6); columns constant in the sample get 0."""
    name = "linear"

    def coefficients(self, train: Cell, ix: Sequence[int], iy: int) -> list[float] | None:
        """[b_0, b...] of y on [1, x]; None where the sample can't be solved."""
        use = [i for i in ix if not train.constant()[i]]
        if train.n <= len(use) + 1:
            return None
        try:
            b = solve(train.m[np.ix_(use, use)], train.m[use, iy])
        except np.linalg.LinAlgError:
            return None
        beta = dict(zip(use, b.tolist(), strict=True))
        return [float(train.mean[iy] - sum(train.mean[i] * v for i, v in beta.items())), *(beta.get(i, 0.0) for i in ix)]


def coefficients(df: DataFrame, features: Sequence[str], targets: dict, by=None, fold: str | None = None,
                 inner: str | None = None) -> DataFrame:
    """Coefficient arrays [b_0, b...] per group and, with ``fold``, per left-out fold.

    ``targets`` maps an output name to (target column, learner). The model of
    fold f is fitted on the merged cells of all other folds (no refits); a
    learner with an inner cross-validation sees the cells of the inner folds, and
    its paths are spread over tasks (``lasso.cross_validated``).
    Columns: _g..., _fold, one array per output (NULL where not estimable).
    """
    from demandlab.operators.lasso import cross_validated

    names = list(dict.fromkeys([*features, *(t for t, _ in targets.values())]))
    ix = [names.index(f) for f in features]
    gcols = key_columns(_by(by))
    path = scratch_table(df.sparkSession, "cells")
    cells(df, names, by, fold, inner).write.parquet(path)
    table = df.sparkSession.read.schema(cell_schema(gcols)).parquet(path)
    plain = {o: (names.index(t), lr) for o, (t, lr) in targets.items() if not hasattr(lr, "paths")}
    searched = {o: (names.index(t), lr) for o, (t, lr) in targets.items() if hasattr(lr, "paths")}

    def fn(_, own):
        folds = sorted({f for f, _ in own})
        for f in folds if fold else [None]:
            train = merged([c for (g, _), c in own.items() if g != f])
            yield (-1 if f is None else f, *(None if train is None else learner.coefficients(train, ix, iy) for iy, learner in plain.values()))

    out = solve_groups(table, fn, ", ".join(["_fold int", *(f"{o} array<double>" for o in plain)]))
    if searched:
        found = cross_validated(table, ix, list(searched.values()), fold is not None)
        wide = found.groupBy(*gcols, "_fold").agg(*[F.max_by(F.when(F.col("slot") == i, F.col("coef")), F.when(F.col("slot") == i, F.lit(1))).alias(o) for i, o in enumerate(searched)])
        wide = wide.select(*[F.col(c).alias(f"_r{c}") for c in [*gcols, "_fold"]], *searched)
        out = out.join(wide, _same([*gcols, "_fold"], [f"_r{c}" for c in [*gcols, "_fold"]]), "left")
    return out.select(*gcols, "_fold", *targets)


def apply_linear(df: DataFrame, coefs: DataFrame, features: Sequence[str], outs: Sequence[str], by=None,
                 fold: str | None = None) -> DataFrame:
    """Add each output's prediction b_0 + sum b_i x_i from the row's (group, fold) arrays; NULL without one."""
    ship_package(df.sparkSession)
    keys, k = _by(by), len(features)
    rows = df.withColumns({f"_k{i}": F.col(c).cast("string") for i, c in enumerate(keys)} | {"_x": numbers(features), "_kf": F.col(fold).cast("int") if fold else F.lit(-1)})
    keyed, per_row = with_models(rows, coefs, lambda names: _same([*(f"_k{i}" for i in range(len(keys))), "_kf"], names),
                                 [*key_columns(keys), "_fold"], {o: k + 1 for o in outs})
    own = list(df.columns)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            X, made = matrix(batch.column("_x"), k), []
            for o in outs:
                B = per_row(batch, o)
                value = B[:, 0] + (X * B[:, 1:]).sum(axis=1)
                made.append(pa.array(value, mask=~np.isfinite(value)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *made], names=[*own, *outs])

    schema = StructType([*[StructField(f.name, f.dataType, True) for f in df.schema.fields], *[StructField(o, DoubleType()) for o in outs]])
    return keyed.mapInArrow(predict, schema)
