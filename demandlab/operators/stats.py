"""Descriptive statistics and error measures as aggregates.

All are single aggregate passes (partial aggregation on the map side), grouped
by an optional key; outputs are long tables, never driver-side loops over rows.
Exact quantiles rank a range-sorted table, so groups may be any number and size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.operators.gram import BUCKETS, HELD_BYTES, arrays, batch_groups, key_columns, key_types, matrix, numbers, with_types
from demandlab.session import scratch_table, ship_package


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def unique_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (A10)."""
    return df.select(col).distinct()


def describe_by(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, linear), max per group
    and column (A11). Long output: (by..., column, statistic...).

    Moments come from one aggregate pass; the quartiles from ``exact_quantiles``
    (ranks in a range-sorted table), so no group is ever gathered in one task.
    """
    keys = _by(by)
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")) \
        .select(*keys, F.col("s.column").alias("column"), F.col("s.v").alias("v"))
    v = F.col("v")
    moments = stacked.groupBy(*keys, "column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    qk = keys + ["column"]
    qt = exact_quantiles(stacked, "v", [0.25, 0.5, 0.75], by=qk)
    wide = qt.groupBy(*qk).agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                 for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    m = moments.select(*[F.col(k).cast("string").alias(k) for k in qk], "count", "mean", "std", "min", "max")
    named = wide.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(qk)], "p25", "p50", "p75")
    out = m.join(named, _same(qk, [f"_w{i}" for i in range(len(qk))]), "left")
    return out.select(*qk, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def non_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count of NaN / +-inf entries per column (A12). One row, one column per input."""
    return df.agg(*[F.count_if(F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).alias(c) for c in cols])


class PairCell:
    """Of every pair (i, j), over the rows where both are present: n, mean of i, squares of i and products, both centred."""

    def __init__(self, n: np.ndarray, a: np.ndarray, v: np.ndarray, c: np.ndarray):
        self.n, self.a, self.v, self.c = n, a, v, c

    @staticmethod
    def of(X: np.ndarray) -> "PairCell":
        M = np.isfinite(X)
        shift = np.where(M, X, 0.0).sum(axis=0) / np.maximum(M.sum(axis=0), 1)
        D, M = np.where(M, X - shift, 0.0), M.astype(float)
        n, s = M.T @ M, D.T @ M
        per = np.divide(1.0, n, out=np.zeros_like(n), where=n > 0)
        return PairCell(n, s * per + shift[:, None], (D * D).T @ M - s * s * per, D.T @ D - s * s.T * per)

    def __add__(self, other: "PairCell") -> "PairCell":
        n = self.n + other.n
        per = np.divide(1.0, n, out=np.zeros_like(n), where=n > 0)
        d = np.where((self.n > 0) & (other.n > 0), other.a - self.a, 0.0)
        w = self.n * other.n * per
        mean = np.where(self.n > 0, self.a, other.a) + d * other.n * per
        return PairCell(n, mean, self.v + other.v + d * d * w, self.c + other.c + d * d.T * w)

    def corr(self) -> np.ndarray:
        """NaN where a pair has no rows or a column doesn't vary in them."""
        flat = self.v <= self.n * (1e-12 * np.abs(self.a)) ** 2
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.c / np.sqrt(self.v * self.v.T)
        return np.where(flat | flat.T, np.nan, np.clip(r, -1.0, 1.0))

    def parts(self) -> list[np.ndarray]:
        return [x.ravel() for x in (self.n, self.a, self.v, self.c)]


def corr_matrix(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """Pairwise-complete Pearson correlation for every column pair.

    Each pair uses the rows where both are present (NULL, NaN and infinite entries are
    missing). A task turns its rows into masked matrix products for all pairs at
    once; these cells merge exactly, in buckets first, and the result of a group is
    written out by the task that merges its last cells. Long output (by..., a, b,
    corr); the diagonal is 1 where defined.
    """
    ship_package(df.sparkSession)
    keys, k = _by(by), len(cols)
    gcols = key_columns(keys)
    schema = ", ".join([f"{g} string" for g in gcols] + ["n array<double>, a array<double>, v array<double>, c array<double>"])

    def packed(acc: dict) -> pa.RecordBatch:
        columns = [pa.array([g[i] for g in acc], pa.string()) for i in range(len(gcols))]
        columns += [arrays([c.parts()[i] for c in acc.values()]) for i in range(4)]
        return pa.RecordBatch.from_arrays(columns, names=[*gcols, "n", "a", "v", "c"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict = {}
        for batch in batches:
            X = matrix(batch.column("_x"), k)
            for g, idx in batch_groups(batch, gcols, np.ones(len(X), bool)):
                cell = PairCell.of(X[idx])
                acc[g] = acc[g] + cell if g in acc else cell
            if len(acc) * 32 * k * k > HELD_BYTES:
                yield packed(acc)
                acc = {}
        if acc:
            yield packed(acc)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, PairCell]]:
        last, total = None, None
        for batch in batches:
            groups = batch.select(gcols).to_pylist() if gcols else [{}] * batch.num_rows
            for i, r in enumerate(groups):
                g = tuple(r[c] for c in gcols)
                cell = PairCell(*(batch.column(c)[i].values.to_numpy().reshape(k, k) for c in ("n", "a", "v", "c")))
                if g == last:
                    total = total + cell
                    continue
                if last is not None:
                    yield last, total
                last, total = g, cell
        if last is not None:
            yield last, total

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, cell in runs(batches):
            yield packed({g: cell})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, cell in runs(batches):
            r = cell.corr().ravel()
            columns = [pa.array([v] * (k * k), pa.string()) for v in g] + [pa.array(np.repeat(list(cols), k).tolist()), pa.array(list(cols) * k), pa.array(r, mask=np.isnan(r))]
            yield pa.RecordBatch.from_arrays(columns, names=[*gcols, "a", "b", "corr"])

    data = df.select(*[F.col(c).cast("string").alias(g) for c, g in zip(keys, gcols, strict=True)], numbers(cols).alias("_x"))
    part = data.mapInArrow(partial, schema).withColumn("_b", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    some = part.repartition(*gcols, "_b").sortWithinPartitions(*gcols, "_b").drop("_b").mapInArrow(merge, schema)
    whole = some.repartition(*gcols).sortWithinPartitions(*gcols) if gcols else some.repartition(1)
    out = whole.mapInArrow(finish, ", ".join([f"{g} string" for g in gcols] + ["a string, b string, corr double"]))
    return with_types(out, keys, key_types(df, keys))


def pair_corr(df: DataFrame, a: str, b: str, by=None) -> DataFrame:
    """Pearson correlation of two columns (A14); NULL rows are skipped pairwise."""
    return df.groupBy(*_by(by)).agg(F.corr(a, b).alias("corr"))


def errors(df: DataFrame, y: str | Column, yhat: str | Column, by=None) -> DataFrame:
    """MSE, RMSE and relative RMSE (RMSE / mean y) per group."""
    y = F.col(y) if isinstance(y, str) else y
    yhat = F.col(yhat) if isinstance(yhat, str) else yhat
    ok = y.isNotNull() & yhat.isNotNull()
    e2 = F.when(ok, (y - yhat) * (y - yhat))
    out = df.groupBy(*_by(by)).agg(F.count(e2).alias("n"), F.avg(e2).alias("mse"),
                                   F.avg(F.when(ok, y)).alias("mean_y"))
    return out.select(*_by(by), "n", "mse", F.sqrt("mse").alias("rmse"),
                      F.try_divide(F.sqrt("mse"), F.col("mean_y")).alias("rel_rmse"))


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """max / min / mean per column, the inputs of imputation."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in cols
                    for n, f in (("max", F.max), ("min", F.min), ("mean", F.avg))])


# ---------------------------------------------------------------- exact quantiles

def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for x, y in zip(left, right, strict=True):
        out = out & F.col(x).eqNullSafe(F.col(y))
    return out


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], by=None) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas / SQL ``quantile_cont``
    rule, h = (n - 1) q) per group, for any number of groups of any size.

    Distinct values with their counts are dealt by ranges of (group, value) and
    sorted; each task adds up counts within its groups as the rows pass. A
    group's rows before a range are the sum over the ranges before it (at most
    one row for each range), so the range and the position of every wanted rank
    are known, and one join fetches the values. Nothing passes through the driver
    and no group is gathered. NULL and NaN values don't count. Output: (by..., q, value),
    group columns as strings.
    """
    ship_package(df.sparkSession)
    keys, spark = _by(by), df.sparkSession
    gcols = key_columns(keys)
    base = df.select(*[F.col(k).cast("string").alias(g) for k, g in zip(keys, gcols, strict=True)], F.col(col).cast("double").alias("v"))
    base = base.where(F.col("v").isNotNull() & ~F.isnan("v"))
    values = base.groupBy(*gcols, "v").agg(F.count(F.lit(1)).alias("c"))
    dealt = values.repartitionByRange(*gcols, "v").sortWithinPartitions(*gcols, "v").select(*gcols, "v", "c", F.spark_partition_id().alias("part"))

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, had = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c, new = batch.column("c").to_numpy(), np.zeros(n, bool)
            for g in gcols:
                code = batch.column(g).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            first = tuple(batch.column(g)[0].as_py() for g in gcols)
            if first != last:
                had = 0
            total = np.cumsum(c)
            starts = np.flatnonzero(new)
            before = np.zeros(n, np.int64)
            if len(starts):
                before[starts[0]:] = np.repeat(total[starts - 1], np.diff(np.append(starts, n)))
                cum = total - before
                cum[:starts[0]] += had
            else:
                cum = total + had
            last, had = tuple(batch.column(g)[n - 1].as_py() for g in gcols), int(cum[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in (*gcols, "part", "v", "c")), pa.array(cum)], names=[*gcols, "part", "v", "c", "cum"])

    path = scratch_table(spark, "ranks")
    schema = ", ".join([f"{g} string" for g in gcols] + ["part int, v double, c long, cum long"])
    dealt.mapInArrow(running, schema).write.parquet(path)
    ranked = spark.read.schema(schema).parquet(path)
    # one row for each (group, range): rows of the group before it, and in all
    ranges = ranked.groupBy(*gcols, "part").agg(F.max("cum").alias("m"))
    own = Window.partitionBy(*(gcols or [F.lit(0)]))
    ranges = ranges.withColumns({"before": F.sum("m").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m"), "n": F.sum("m").over(own)})
    h = (F.col("n") - 1) * F.col("q")
    wanted = ranges.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))) \
        .withColumns({"frac": h - F.floor(h), "side": F.explode(F.array(F.lit(0), F.lit(1)))}) \
        .withColumn("rank", F.least(F.floor(h) + F.when(F.col("frac") > 0, F.col("side")).otherwise(0), F.col("n") - 1) - F.col("before")) \
        .where((F.col("rank") >= 0) & (F.col("rank") < F.col("m")))
    wanted = wanted.select(*[F.col(c).alias(f"_{c}") for c in (*gcols, "part")], "q", "side", "frac", "rank")
    hit = ranked.join(wanted, _same([*gcols, "part"], [f"_{c}" for c in (*gcols, "part")]) & (F.col("cum") > F.col("rank")) & (F.col("cum") - F.col("c") <= F.col("rank")))
    two = hit.groupBy(*gcols, "q").agg(F.max("frac").alias("frac"), *[F.max(F.when(F.col("side") == i, F.col("v"))).alias(n) for i, n in enumerate(("lo", "hi"))])
    value = F.when((F.col("frac") == 0) | (F.col("lo") == F.col("hi")), F.col("lo")).otherwise(F.col("lo") + F.col("frac") * (F.col("hi") - F.col("lo")))
    return two.select(*[F.col(g).alias(k) for g, k in zip(gcols, keys, strict=True)], "q", value.alias("value"))
