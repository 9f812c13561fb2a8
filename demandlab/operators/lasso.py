"""Lasso with a cross-validated penalty, solved on cross-product cells.

Objective (the common one): (1 / 2n) ||y - b0 - X b||^2 + alpha ||b||_1, with
an unpenalised intercept. Coordinate descent runs on the centred k x k moments
over an active set and ends by the duality gap; the paths of a search are spread
over tasks (``cross_validated``). The penalty comes from the learner's own inner folds (ten by default, a key bucket gathered in the same
pass), 100 penalties from the largest useful one down to its thousandth.
Empty inner folds are skipped, folds count by their rows; with fewer than two
non-empty ones there is no estimate. Constant columns get coefficient 0 (D9).
Learners hold parameters only: a fit returns a value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.operators.gram import Cell, _by, _rows, cell_schema, cells, key_columns, key_types, merge_cells, merged, read_cells, with_types
from demandlab.operators.sampling import key_bucket
from demandlab.session import scratch_table, ship_package

INNER = "_cv"
INNER_FOLDS = 10


GAP = 1e-11   # duality gap at which a fit ends, as a share of the target's variance
SWEEPS = 5


def _gap(Sxx: np.ndarray, Sxy: np.ndarray, syy: float, alpha: float, b: np.ndarray, q: np.ndarray) -> float:
    """Duality gap of b; q = Sxy - Sxx b."""
    at = np.flatnonzero(b)
    rr = max(0.0, syy - b[at] @ (Sxy[at] + q[at]))
    top = float(np.max(np.abs(q))) if len(q) else 0.0
    s = 1.0 if top <= alpha else alpha / top
    dual = s * (syy - b[at] @ Sxy[at]) - 0.5 * s * s * rr
    return 0.5 * rr + alpha * float(np.abs(b).sum()) - dual


def _settled(Sxx: np.ndarray, Sxy: np.ndarray, alpha: float, b: np.ndarray) -> Iterator[np.ndarray]:
    """Solutions for the signs of b: of the linear system, and where it is singular the one nearest to b."""
    at = np.flatnonzero(b)
    sign, A = np.sign(b[at]), Sxx[np.ix_(at, at)]
    off = Sxy[at] - alpha * sign - A @ b[at]
    for step in (lambda: np.linalg.solve(A, off), lambda: np.linalg.lstsq(A, off, rcond=1e-10)[0]):
        try:
            new = b[at] + step()
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(new).all() and (np.sign(new) == sign).all():
            out = np.zeros(len(b))
            out[at] = new
            yield out


def _cd(Sxx: np.ndarray, Sxy: np.ndarray, alpha: float, beta0: np.ndarray | None = None, syy: float | None = None, max_iter: int = 2_000):
    """Coordinate descent over an active set until the duality gap closes.

    A round sweeps the columns that are in use or break the optimality condition,
    then tries to settle the fit exactly for the signs found. Returns (b, rounds).
    """
    k = len(Sxy)
    b = np.zeros(k) if beta0 is None else beta0.copy()
    diag = np.diag(Sxx)
    usable = diag > 1e-14 * max(1.0, float(np.max(diag)) if k else 1.0)
    b[~usable] = 0.0
    syy = float(Sxy @ np.linalg.lstsq(Sxx, Sxy, rcond=None)[0]) if syy is None else syy
    Sxy = np.where(usable, Sxy, 0.0)
    q = np.where(usable, Sxy - Sxx @ b, 0.0)
    it = 0
    for it in range(1, max_iter + 1):
        work = np.flatnonzero(usable & ((b != 0) | (np.abs(q) > alpha))).tolist()
        for _ in range(SWEEPS):
            moved = False
            for j in work:
                old = b[j]
                rho = q[j] + diag[j] * old
                new = (rho - alpha if rho > alpha else rho + alpha if rho < -alpha else 0.0) / diag[j]
                if new != old:
                    q -= Sxx[j] * (new - old)
                    b[j], moved = new, True
            if not moved:
                break
        q = np.where(usable, Sxy - Sxx @ b, 0.0)
        gap = _gap(Sxx, Sxy, syy, alpha, b, q)
        for settled in _settled(Sxx, Sxy, alpha, b):
            q2 = np.where(usable, Sxy - Sxx @ settled, 0.0)
            if (g2 := _gap(Sxx, Sxy, syy, alpha, settled, q2)) <= gap:
                b, q, gap = settled, q2, g2
                break
        if gap <= GAP * max(syy, 1e-300):
            break
    return b, it


def _moments(cell: Cell, ix: Sequence[int], iy: int):
    return cell.m[np.ix_(ix, ix)] / cell.n, cell.m[ix, iy] / cell.n


def _syy(cell: Cell, iy: int) -> float:
    return float(cell.m[iy, iy]) / cell.n


def lasso_fit(cell: Cell, ix: Sequence[int], iy: int, alpha: float) -> tuple[np.ndarray, int]:
    """[b_0, b...] and the number of rounds for one penalty."""
    B, it = lasso_path(cell, ix, iy, [alpha])
    return B[0], it[0]


def lasso_path(cell: Cell, ix: Sequence[int], iy: int, grid: Sequence[float]) -> tuple[np.ndarray, list[int]]:
    """[b_0, b...] and rounds for each penalty, from the largest on.

    While no column enters or leaves, the solution is linear in the penalty: the
    signs found settle all following penalties for which the optimality
    conditions hold, and descent is needed only where they change.
    """
    Sxx, Sxy = _moments(cell, ix, iy)
    grid, syy = np.asarray(grid, float), _syy(cell, iy)
    B, its = np.zeros((len(grid), len(ix))), []
    b = np.zeros(len(ix))
    while len(its) < len(grid):
        i = len(its)
        found = _same_signs(Sxx, Sxy, grid[i:], b)
        if len(found):
            B[i:i + len(found)] = found
            its += [1] * len(found)
        else:
            B[i], it = _cd(Sxx, Sxy, grid[i], b, syy)
            its.append(it)
        b = B[len(its) - 1]
    return np.column_stack([cell.mean[iy] - B @ cell.mean[list(ix)], B]), its


def _same_signs(Sxx: np.ndarray, Sxy: np.ndarray, grid: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions, one row each, for the leading penalties of ``grid`` at which the columns and signs of b remain those of the optimum."""
    at = np.flatnonzero(b)
    sign = np.sign(b[at])
    try:
        u, w = np.linalg.solve(Sxx[np.ix_(at, at)], np.stack([Sxy[at], sign], axis=1)).T
    except np.linalg.LinAlgError:
        return np.empty((0, len(b)))
    own = u - grid[:, None] * w
    q = Sxy - own @ Sxx[at]
    ok = np.isfinite(own).all(axis=1) & (np.sign(own) == sign).all(axis=1)
    ok &= (np.abs(q[:, at] - grid[:, None] * sign) <= 1e-9 * grid[:, None]).all(axis=1)
    q[:, at] = 0.0
    ok &= (np.abs(q) <= grid[:, None] * (1 + 1e-12)).all(axis=1)
    n = len(ok) if ok.all() else int(np.argmin(ok))
    out = np.zeros((n, len(b)))
    out[:, at] = own[:n]
    return out


def heldout_sse(cell: Cell, ix: Sequence[int], iy: int, coefs: np.ndarray) -> np.ndarray:
    """Squared errors of fits (rows [b_0, b...]) on the rows of a cell."""
    coefs = np.atleast_2d(coefs)
    B = coefs[:, 1:]
    off = cell.mean[iy] - coefs[:, 0] - B @ cell.mean[list(ix)]
    return cell.m[iy, iy] - 2 * B @ cell.m[ix, iy] + ((B @ cell.m[np.ix_(ix, ix)]) * B).sum(axis=1) + cell.n * off * off


def alpha_grid(cell: Cell, ix: Sequence[int], iy: int, n_alphas: int = 100, eps: float = 1e-3) -> np.ndarray:
    _, Sxy = _moments(cell, ix, iy)
    top = float(np.max(np.abs(Sxy))) if len(Sxy) else 0.0
    top = top if top > 0 else 1.0
    return np.logspace(np.log10(top), np.log10(top * eps), n_alphas)


@dataclass(frozen=True)
class LassoFit:
    coef: np.ndarray
    alpha: float
    n_iter: int


@dataclass(frozen=True)
class LassoCV:
    """Lasso learner; ``inner`` names the inner-fold column when it isn't the default bucket."""
    n_alphas: int = 100
    eps: float = 1e-3
    name: str = "lasso"

    def paths(self, folds: Sequence[Cell], ix: Sequence[int], iy: int, out: int | None) -> tuple[np.ndarray, np.ndarray | None, list[int]] | None:
        """One piece of the search: the squared errors on fold ``out`` of the path fitted without it, or (None) the path on all folds."""
        if len(folds) < 2:
            return None
        grid = alpha_grid(merged(folds), ix, iy, self.n_alphas, self.eps)
        if out is None:
            B, its = lasso_path(merged(folds), ix, iy, grid)
            return grid, B, its
        train = merged([*folds[:out], *folds[out + 1:]])
        return heldout_sse(folds[out], ix, iy, lasso_path(train, ix, iy, grid)[0]), None, []

    def fit(self, folds: Sequence[Cell], ix: Sequence[int], iy: int) -> LassoFit | None:
        """Penalty by cross-validation over the folds, then a fit on all of them; None with fewer than two."""
        ix = list(ix)
        folds = [c for c in folds if c.n > 0]
        if len(folds) < 2:
            return None
        sse = sum(self.paths(folds, ix, iy, k)[0] for k in range(len(folds)))
        grid, B, its = self.paths(folds, ix, iy, None)
        best = int(np.argmin(sse))
        return LassoFit(B[best], float(grid[best]), its[best])


def cross_validated(table: DataFrame, ix: Sequence[int], slots: Sequence[tuple[int, LassoCV]], fold: bool) -> DataFrame:
    """_g..., _fold (left out; -1 without), slot, coef, alpha, n_iter from a written table of cells.

    The cells of the other folds are merged by inner fold first. A unit of work
    is one (group, left-out fold) or, while these fill less than half the
    partitions, one path: (group, left-out fold, inner fold held out or none),
    for all slots. The errors of the paths are added up where the whole path is.
    """
    spark = table.sparkSession
    ship_package(spark)
    gcols = [c for c in table.columns if c.startswith("_g")]
    ix = list(ix)
    if fold:
        folds = [r[0] for r in table.select("_fold").distinct().collect()]   # a handful by construction
        left = F.explode(F.array(*[F.lit(f) for f in folds]) if folds else F.array().cast("array<int>"))
        path = scratch_table(spark, "other_folds")
        merge_cells(table.select("*", left.alias("_left")).where("_left <> _fold").drop("_fold").withColumnRenamed("_left", "_fold").select(*table.columns)).write.parquet(path)
        others = spark.read.schema(table.schema).parquet(path)
    else:
        others = table.withColumn("_fold", F.lit(-1))
    others = others.where("n > 0")
    inner = [r[0] for r in others.select("_inner").distinct().orderBy("_inner").collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = others.select(*gcols, "_fold").distinct().limit(parts + 1).count()
    jobs = [-1, *inner] if 2 * units <= parts else [-2]   # -1: the path on all rows; -2: everything
    keys = [*gcols, "_fold", "_job"]
    schema = ", ".join([f"{g} string" for g in gcols] + ["_fold int, slot int, error array<double>, alpha array<double>, path array<double>, n_iter array<int>"])
    names = [x.split()[0] for x in schema.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(key, own):
            *g, f, job = key
            cells = [own[i] for i in sorted(own)]
            at = {i: n for n, i in enumerate(sorted(own))}
            if job >= 0 and job not in at:
                return
            for slot, (iy, learner) in enumerate(slots):
                if job == -2:
                    got = learner.fit(cells, ix, iy)
                    found = ([0.0], [got.alpha], got.coef.tolist(), [got.n_iter]) if got else (None,) * 4
                    yield (*g, f, slot, *found)
                elif (got := learner.paths(cells, ix, iy, None if job == -1 else at[job])) is None:
                    if job == -1:
                        yield (*g, f, slot, None, None, None, None)
                elif job == -1:
                    yield (*g, f, slot, [0.0] * len(got[0]), got[0].tolist(), got[1].ravel().tolist(), got[2])
                else:
                    yield (*g, f, slot, got[0].tolist(), None, None, None)

        last, own = None, {}
        for (g, f, i), cell, batch, row in read_cells(batches, gcols):
            key = (*g, f, batch.column("_job")[row].as_py())
            if key != last and last is not None:
                yield _rows(list(work(last, own)), names, schema)
                own = {}
            last, own[i] = key, cell
        if last is not None:
            yield _rows(list(work(last, own)), names, schema)

    dealt = others.select("*", F.explode(F.array(*[F.lit(j) for j in jobs])).alias("_job")).repartition(max(parts, min(units * len(jobs), 4 * parts)), *keys)
    path = scratch_table(spark, "paths")
    dealt.sortWithinPartitions(*keys).mapInArrow(search, schema).write.parquet(path)
    found = spark.read.parquet(path)
    n = F.size(F.max("alpha"))
    errors = F.aggregate(F.collect_list("error"), F.array_repeat(F.lit(0.0), n), lambda s, e: F.zip_with(s, e, lambda a, b: a + b))   # one short array for each inner fold
    picked = found.groupBy(*gcols, "_fold", "slot").agg(errors.alias("error"), F.max("alpha").alias("alpha"), F.max("path").alias("path"), F.max("n_iter").alias("n_iter"))
    best = F.array_position("error", F.array_min("error"))
    return picked.withColumn("_at", best).select(*gcols, "_fold", "slot", F.expr(f"slice(path, cast((_at - 1) * {len(ix) + 1} + 1 as int), {len(ix) + 1})").alias("coef"),
                                                 F.expr("alpha[cast(_at - 1 as int)]").alias("alpha"), F.expr("n_iter[cast(_at - 1 as int)]").alias("n_iter"))


def with_inner(df: DataFrame, keys: Sequence[str] = (), bucket: Column | None = None, k: int = INNER_FOLDS, salt: int = 11) -> DataFrame:
    """Tag rows with an inner fold: a bucket of the row key, or the given expression."""
    return df.withColumn(INNER, (bucket if bucket is not None else key_bucket(keys, salt, k)).cast("int"))


def lasso_cv(df: DataFrame, features: Sequence[str], targets: Sequence[str], by=None, inner: str = INNER,
             learner: LassoCV = LassoCV()) -> DataFrame:
    """by..., target, term, coef, alpha, n_iter: one cross-validated fit per group and target."""
    keys = _by(by)
    names, gcols = [*features, *targets], key_columns(keys)
    path = scratch_table(df.sparkSession, "cells")
    cells(df, names, keys or None, inner=inner).write.parquet(path)
    table = df.sparkSession.read.schema(cell_schema(gcols)).parquet(path)
    found = cross_validated(table, range(len(features)), [(names.index(t), learner) for t in targets], False)
    terms = F.array(*[F.lit(t) for t in ["intercept", *features]])
    target = F.element_at(F.array(*[F.lit(t) for t in targets]), F.col("slot") + 1)
    coef = F.coalesce("coef", F.array_repeat(F.lit(None).cast("double"), len(features) + 1))
    long = found.select(*gcols, target.alias("target"), F.explode(F.arrays_zip(terms.alias("term"), coef.alias("coef"))).alias("_t"), "alpha", "n_iter")
    return with_types(long.select(*gcols, "target", "_t.term", "_t.coef", "alpha", "n_iter"), keys, key_types(df, keys))
