"""Cross-product cells: the building block of every linear estimator (M0).

A cell holds the row count, the means and the centred cross products of some
columns; two cells merge exactly (no cancellation between large sums). Each
Spark task reduces its rows to one cell per (group, fold, inner fold); cells are
merged in two steps (first in a bounded number of buckets, so a hot group never
sends one row per task to one place) and solved on the executors, group by
group. Nothing reaches the driver, so neither rows nor groups are limited; a task
holds cells of a bounded size and passes them on beyond that. The columns travel
as one array, so the plan doesn't grow with the width of the design.

Rows with a NULL, NaN or infinite value in any used column are left out
(complete cases).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

BUCKETS = 256
HELD_BYTES = 64 << 20  # of the cells a task holds before it passes them on
CELL = "_fold int, _inner int, n double, mean array<double>, m array<double>"


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


@dataclass(frozen=True)
class Cell:
    """n rows, their means and centred cross products."""
    n: float
    mean: np.ndarray
    m: np.ndarray

    @staticmethod
    def of(X: np.ndarray) -> Cell:
        mean = X.mean(axis=0)
        Xc = X - mean
        return Cell(float(len(X)), mean, Xc.T @ Xc)

    def __add__(self, other: Cell) -> Cell:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        d = other.mean - self.mean
        return Cell(n, self.mean + d * (other.n / n), self.m + other.m + np.outer(d, d) * (self.n * other.n / n))

    def constant(self) -> np.ndarray:
        """Which columns do not vary."""
        return np.diag(self.m) <= self.n * (1e-9 * np.abs(self.mean)) ** 2

    def raw(self) -> np.ndarray:
        """Uncentred cross products."""
        return self.m + self.n * np.outer(self.mean, self.mean)


def merged(cells: Sequence[Cell]) -> Cell | None:
    out = None
    for c in cells:
        out = c if out is None else out + c
    return out


def _none(v):
    return None if v is None or v != v else v


def key_columns(keys: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(keys))]


def key_types(df: DataFrame, keys: Sequence[str]) -> list[DataType]:
    return [df.schema[k].dataType for k in keys]


def with_types(out: DataFrame, keys: Sequence[str], types: Sequence[DataType]) -> DataFrame:
    """Group columns under their own names and types again."""
    rest = [c for c in out.columns if not c.startswith("_g")]
    return out.select(*[F.col(f"_g{i}").cast(t).alias(k) for i, (k, t) in enumerate(zip(keys, types, strict=True))], *rest)


def matrix(col: pa.Array, k: int) -> np.ndarray:
    """Rows of an array column of ``k`` doubles; NULL entries are NaN."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(col), k)


def numbers(cols: Sequence[str]) -> Column:
    """Columns as one array of doubles: one entry in the plan, however wide the design."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def arrays(rows: Sequence[np.ndarray]) -> pa.Array:
    """An array column from one vector for each row."""
    offs = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(rows) if rows else np.empty(0), pa.float64()))


def batch_groups(batch: pa.RecordBatch, cols: Sequence[str], ok: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
    """(values of ``cols``, positions) of the rows in ``ok``."""
    if not cols:
        yield (), np.flatnonzero(ok)
        return
    keys = batch.select(list(cols)).to_pandas()
    at = np.flatnonzero(ok)
    for key, idx in keys.iloc[at].groupby(list(cols), sort=False, dropna=False).indices.items():
        yield tuple(_none(v) for v in (key if isinstance(key, tuple) else (key,))), at[idx]


def _batch(gcols: list[str], rows: Sequence[tuple]) -> pa.RecordBatch:
    """Rows ((group, fold, inner fold), cell)."""
    keys = [k for k, _ in rows]
    cols = [pa.array([k[0][i] for k in keys], pa.string()) for i in range(len(gcols))]
    cols += [pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2)]
    cols += [pa.array([c.n for _, c in rows], pa.float64()), arrays([c.mean for _, c in rows]), arrays([c.m.ravel() for _, c in rows])]
    return pa.RecordBatch.from_arrays(cols, names=[*gcols, "_fold", "_inner", "n", "mean", "m"])


def read_cells(batches: Iterator[pa.RecordBatch], gcols: list[str]) -> Iterator[tuple[tuple, Cell, pa.RecordBatch, int]]:
    """((group, fold, inner fold), cell, batch, row), one by one."""
    for batch in batches:
        keys = batch.select([*gcols, "_fold", "_inner", "n"]).to_pylist()
        means, ms = batch.column("mean"), batch.column("m")
        for i, r in enumerate(keys):
            mean = means[i].values.to_numpy()
            yield (tuple(r[g] for g in gcols), r["_fold"], r["_inner"]), Cell(r["n"], mean, ms[i].values.to_numpy().reshape(len(mean), -1)), batch, i


def cell_schema(gcols: Sequence[str]) -> str:
    return ", ".join([f"{g} string" for g in gcols] + [CELL])


def merge_cells(table: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """One cell per (group, fold, inner fold): rows are dealt and sorted by these (and ``more``) and merged as they pass."""
    gcols = [c for c in table.columns if c.startswith("_g")]
    keys = [*gcols, "_fold", "_inner", *more]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for key, cell, _, _ in read_cells(batches, gcols):
            if key == last:
                total = total + cell
                continue
            if last is not None:
                yield _batch(gcols, [(last, total)])
            last, total = key, cell
        if last is not None:
            yield _batch(gcols, [(last, total)])

    return table.repartition(*keys).sortWithinPartitions(*keys).drop(*more).mapInArrow(merge, cell_schema(gcols))


def cells(df: DataFrame, cols: Sequence[str], by=None, fold: str | None = None, inner: str | None = None) -> DataFrame:
    """One cell per (group, fold, inner fold) of the columns ``cols``; group columns as strings _g0, _g1, ..."""
    from demandlab.session import ship_package
    ship_package(df.sparkSession)
    keys = _by(by)
    gcols, k = key_columns(keys), len(cols)
    data = df.select(*[F.col(c).cast("string").alias(g) for c, g in zip(keys, gcols, strict=True)],
                     (F.col(fold).cast("int") if fold else F.lit(0)).alias("_fold"),
                     (F.col(inner).cast("int") if inner else F.lit(0)).alias("_inner"), numbers(cols).alias("_x")).where("_fold is not null and _inner is not null")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict = {}
        for batch in batches:
            X = matrix(batch.column("_x"), k)
            for key, idx in batch_groups(batch, [*gcols, "_fold", "_inner"], np.isfinite(X).all(axis=1)):
                key = key[:-2], int(key[-2]), int(key[-1])
                cell = Cell.of(X[idx])
                acc[key] = acc[key] + cell if key in acc else cell
            if len(acc) * 8 * k * (k + 1) > HELD_BYTES:
                yield _batch(gcols, list(acc.items()))
                acc = {}
        if acc:
            yield _batch(gcols, list(acc.items()))

    part = data.mapInArrow(partial, cell_schema(gcols)).withColumn("_b", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    return merge_cells(part, ["_b"])


def solve_groups(table: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Solve group by group on the executors, one group in memory at a time.

    ``fn(group, {(fold, inner): Cell})`` yields result tuples without the group;
    the result has the columns _g0, ... and those of ``schema``.
    """
    gcols = [c for c in table.columns if c.startswith("_g")]
    names = [*gcols, *(x.split()[0] for x in schema.split(", "))]
    whole = ", ".join([f"{g} string" for g in gcols] + [schema])

    def solve_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, rows = None, {}, []
        for (g, f, i), c, _, _ in read_cells(batches, gcols):
            if g != last and last is not None:
                rows += [(*last, *r) for r in fn(last, own)]
                own = {}
                if len(rows) >= 1000:
                    yield _rows(rows, names, whole)
                    rows = []
            last, own[f, i] = g, own[f, i] + c if (f, i) in own else c
        if last is not None:
            rows += [(*last, *r) for r in fn(last, own)]
        if rows:
            yield _rows(rows, names, whole)

    # a stated number of partitions: few rows, but each may take long to solve
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = table.repartition(n, *gcols).sortWithinPartitions(*gcols) if gcols else table.repartition(1)
    return table.mapInArrow(solve_all, whole)


ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
         "array<int>": pa.list_(pa.int32())}


def _rows(rows: Sequence[tuple], names: Sequence[str], schema: str) -> pa.RecordBatch:
    kinds = [x.split(" ", 1)[1] for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), ARROW[t]) for c, t in zip(cols, kinds, strict=True)], names=list(names))


def solve(A: np.ndarray, b: np.ndarray, names: Sequence[str] | None = None, rcond: float = 1e-12) -> np.ndarray:
    """Solve A x = b on the scaled system; raise on a (near) singular one, naming the columns."""
    A = np.asarray(A, dtype=float)
    if A.size == 0:
        return np.zeros(np.shape(b))
    scale = np.sqrt(np.clip(np.diag(A), 1e-300, None))
    As = A / np.outer(scale, scale)
    s = np.linalg.svd(As, compute_uv=False)
    if s.size and (s[-1] <= rcond * s[0]):
        raise np.linalg.LinAlgError(f"rank-deficient design: {', '.join(names) if names else ''}")
    x = np.linalg.solve(As, (b.T / scale).T if b.ndim > 1 else b / scale)
    return (x.T / scale).T if x.ndim > 1 else x / scale
