"""Double machine learning: partially linear regression (PLR) and partially
linear IV (PLIV) with cross-fitting (M8, M9, M9a, M10, M11).

    u = y - l(X),  v = d - r(X),  w = z - m(X)          (PLR: w := v)
    theta = sum u w / sum v w
    psi_i = (u_i - theta v_i) w_i,  J = mean(v w),  se = sqrt(mean(psi^2) / (n J^2))

Plan: the used columns are written once and read by every later pass. (1)
Out-of-fold nuisance predictions: learners on cross-product cells (linear,
Lasso) get all slots, folds and groups from ONE pass (the model of fold f is
fitted on the merged cells of the other folds, no refits); Spark ML learners
are refitted per fold (and group). (2) Two aggregates over the residuals: theta
per group, then its score variance. A group without an estimate keeps its row,
with NULLs and the reason.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from demandlab.functions.scalar import finite_or_null
from demandlab.operators.gram import _by, _none
from demandlab.operators.lasso import INNER, LassoCV, with_inner
from demandlab.operators.linear import LinearLearner, _same, apply_linear, coefficients
from demandlab.session import scratch_table

Z975 = 1.959963984540054


def _is_gram_learner(lr) -> bool:
    return hasattr(lr, "coefficients") or hasattr(lr, "paths")


def _learner_name(lr) -> str:
    return getattr(lr, "name", None) or type(lr).__name__


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the shared folder."""
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def out_of_fold(df: DataFrame, x: Sequence[str], targets: dict, fold: str = "fold", by=None,
                inner: str | None = None) -> DataFrame:
    """Add one out-of-fold prediction column per slot: ``targets`` maps an output
    column name to (target column, learner). ``inner`` names the inner-fold column
    of the Lasso; without one it is a key bucket of the row's own values."""
    keys = _by(by)
    cell_slots = {o: (t, lr) for o, (t, lr) in targets.items() if _is_gram_learner(lr)}
    ml_slots = {o: (t, lr) for o, (t, lr) in targets.items() if not _is_gram_learner(lr)}
    out = df
    if cell_slots:
        src = df
        if inner is None and any(isinstance(lr, LassoCV) for _, lr in cell_slots.values()):
            src, inner = with_inner(df, list(dict.fromkeys([*keys, fold, *x, *(t for t, _ in cell_slots.values())]))), INNER
        coefs = coefficients(src, x, cell_slots, keys or None, fold, inner)
        out = apply_linear(out, coefs, x, list(cell_slots), keys or None, fold)
    return _ml_out_of_fold(out, x, ml_slots, fold, keys) if ml_slots else out


ML_PARALLELISM = 4   # concurrent Spark ML fits (each fit is itself distributed)
ML_ATTEMPTS = 3      # of one fit; its output replaces that of an attempt that broke off
MAX_REFITS = 10_000  # documented bound: Spark ML has no grouped fit, each (group, fold) is a job of its own


def _ml_out_of_fold(df: DataFrame, x, slots: dict, fold, keys, parallelism: int = ML_PARALLELISM) -> DataFrame:
    """Refit Spark ML regressors per fold (and group) and predict the held-out fold.

    The input is assembled and written once, by group and fold, so a refit reads
    its own folders only. Fits are submitted from a bounded thread pool; each
    writes its predictions into a folder of its own and is tried again by itself
    when it fails, so nothing that is done is lost. The result is one scan of
    these folders, however many fits there are. Rows whose fold has no training
    rows of their group (or no fold) get NULL predictions.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.feature import VectorAssembler

    spark = df.sparkSession
    found = df.select(*keys).distinct().limit(MAX_REFITS + 1).collect() if keys else [()]
    if len(found) > MAX_REFITS:
        raise ValueError(f"more than {MAX_REFITS} groups to refit")
    if keys:
        named = StructType([*[StructField(f"_n{i}", df.schema[k].dataType) for i, k in enumerate(keys)], StructField("_group", IntegerType())])
        index = spark.createDataFrame([(*r, i) for i, r in enumerate(found)], named)
        df2 = df.join(F.broadcast(index), _same(keys, [f"_n{i}" for i in range(len(keys))])).drop(*[f"_n{i}" for i in range(len(keys))])
    else:
        df2 = df.withColumn("_group", F.lit(0))
    table = VectorAssembler(inputCols=list(x), outputCol="_features", handleInvalid="keep").transform(df2.withColumn("_part", F.col(fold).cast("int")))
    path, out = scratch_table(spark, "folds"), scratch_table(spark, "predictions")
    table.write.partitionBy("_group", "_part").parquet(path)
    base = spark.read.schema(table.schema).parquet(path)
    counts = base.groupBy("_group", "_part").agg(*[F.count(t).alias(o) for o, (t, _) in slots.items()]).collect()
    if len(counts) > MAX_REFITS:
        raise ValueError(f"more than {MAX_REFITS} (group, fold) refits")

    def fit_one(job):
        n, row = job
        own = base.where(F.col("_group") == row["_group"])
        part = own.where(F.col("_part").eqNullSafe(F.lit(row["_part"])))
        for o, (t, estimator) in slots.items():
            rest = sum(r[o] for r in counts if r["_group"] == row["_group"] and r["_part"] is not None and r["_part"] != row["_part"])
            if row["_part"] is None or not rest:
                part = part.withColumn(o, F.lit(None).cast("double"))
                continue
            train = own.where((F.col("_part") != row["_part"]) & F.col(t).isNotNull())
            part = estimator.copy().setFeaturesCol("_features").setLabelCol(t).setPredictionCol(o).fit(train).transform(part)
        part.select(*df.columns, *slots).write.mode("overwrite").parquet(f"{out}/_fit={n}")

    def with_attempts(job):
        for left in reversed(range(ML_ATTEMPTS)):
            try:
                return fit_one(job)
            except Exception:
                if not left:
                    raise

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(with_attempts, enumerate(sorted(counts, key=str))))
    schema = StructType([*[StructField(f.name, f.dataType) for f in df.schema.fields], *[StructField(o, DoubleType()) for o in slots]])
    if not counts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out}/_fit={n}" for n in range(len(counts))])


@dataclass
class DMLResult:
    table: DataFrame          # by..., learner, theta, se, t, p, ci_lo, ci_hi, n
    residuals: DataFrame      # input rows + _u, _v, _w


def _summary(res: DataFrame, keys: list[str], learner: str) -> DataFrame:
    from demandlab.session import ship_package
    ship_package(res.sparkSession)
    u, v, w = F.col("_u"), F.col("_v"), F.col("_w")
    ok = u.isNotNull() & v.isNotNull() & w.isNotNull()
    first = res.groupBy(*keys).agg(
        F.count_if(ok).alias("n"), F.sum(F.when(ok, u * w)).alias("suw"), F.sum(F.when(ok, v * w)).alias("svw")) \
        .select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], "n", F.try_divide("suw", "svw").alias("theta"),
                F.try_divide(F.col("svw"), F.col("n").cast("double")).alias("J"))
    scored = res.where(ok).join(first, _same(keys, [f"_t{i}" for i in range(len(keys))]), "right")
    psi = (u - F.col("theta") * v) * w
    agg = scored.groupBy(*[f"_t{i}" for i in range(len(keys))], "n", "theta", "J").agg(F.avg(psi * psi).alias("psi2"))
    theta = F.col("theta")
    se = F.sqrt(F.try_divide(F.col("psi2"), F.col("n") * F.col("J") * F.col("J")))
    out = agg.select(*[F.col(f"_t{i}").alias(k) for i, k in enumerate(keys)], theta, se.alias("se"), "n")
    t = F.try_divide(theta, F.col("se"))
    return out.select(*keys, F.lit(learner).alias("learner"), theta, "se",
                      t.alias("t"), _normal_p(t).alias("p"),
                      (theta - F.lit(Z975) * F.col("se")).alias("ci_lo"), (theta + F.lit(Z975) * F.col("se")).alias("ci_hi"),
                      F.col("n").cast("long").alias("n"),
                      F.when(theta.isNotNull(), "ok").when(F.col("n") == 0, "no complete rows or a singular first stage")
                       .otherwise("the residual instrument does not move the price").alias("status"))


def _normal_p(t):
    """Two-sided normal p-value erfc(|t|/sqrt 2) via a vectorised pandas UDF (tiny table)."""
    @F.pandas_udf("double")
    def erfc_p(s: pd.Series) -> pd.Series:
        return s.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)) if v is not None and np.isfinite(v) else None)
    return erfc_p(t)


def dml_plr(df: DataFrame, y: str, d: str, x: Sequence[str], ml_l=None, ml_m=None,
            fold: str = "fold", by=None, inner: str | None = None) -> DMLResult:
    """PLR, partialling-out score. l: y ~ X, m: d ~ X (M8)."""
    ml_l = ml_l or LinearLearner()
    ml_m = ml_m or LinearLearner()
    keys = _by(by)
    res = out_of_fold(_written(df, "dml"), x, {"_lhat": (y, ml_l), "_mhat": (d, ml_m)}, fold, keys or None, inner)
    res = res.withColumns({"_u": finite_or_null(F.col(y) - F.col("_lhat")), "_v": finite_or_null(F.col(d) - F.col("_mhat"))})
    res = _written(res.withColumn("_w", F.col("_v")), "residuals")
    name = f"plr[{_learner_name(ml_l)},{_learner_name(ml_m)}]"
    return DMLResult(_summary(res, keys, name), res)


def dml_pliv(df: DataFrame, y: str, d: str, z: str, x: Sequence[str], ml_l=None, ml_m=None,
             ml_r=None, fold: str = "fold", by=None, inner: str | None = None) -> DMLResult:
    """PLIV, partialling-out score. l: y ~ X, m: z ~ X, r: d ~ X."""
    ml_l, ml_m, ml_r = ml_l or LinearLearner(), ml_m or LinearLearner(), ml_r or LinearLearner()
    keys = _by(by)
    res = out_of_fold(_written(df, "dml"), x, {"_lhat": (y, ml_l), "_mhat": (z, ml_m), "_rhat": (d, ml_r)},
                      fold, keys or None, inner)
    res = res.withColumns({"_u": finite_or_null(F.col(y) - F.col("_lhat")), "_v": finite_or_null(F.col(d) - F.col("_rhat")),
                           "_w": finite_or_null(F.col(z) - F.col("_mhat"))})
    res = _written(res, "residuals")
    name = f"pliv[{_learner_name(ml_l)},{_learner_name(ml_m)},{_learner_name(ml_r)}]"
    return DMLResult(_summary(res, keys, name), res)


GROUPS_HELD = 2_000  # groups whose partial sums a task holds before it passes them on


def bootstrap(result: DMLResult, key: Sequence[str], n_boot: int = 500, seed: int = 1, by=None,
              key_hash=None) -> DataFrame:
    """Multiplier bootstrap of the score.

    t*_b = sum_i xi_ib psi_i / (n J se). xi_ib ~ N(0, 1) is a function of (row key,
    b, seed) only, so results do not depend on partitioning or retries. With
    ``key_hash`` (a non-negative long expression of the row) the multipliers are
    signs, xi_ib = +1 if (key_hash (2b + 1) div 64) is odd else -1, which other
    engines can reproduce. Each task sums its rows into n_boot partial sums per
    group; one ``groupBy`` adds them. Output: by..., learner, n_boot, q95
    (|t*| quantile), ci_lo_boot, ci_hi_boot; a group without an estimate has NULLs.
    """
    from demandlab.session import ship_package
    ship_package(result.table.sparkSession)
    keys = _by(by)
    summ = result.table.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], "learner", "theta", "se", "n")
    tcols = [f"_t{i}" for i in range(len(keys))]
    res = result.residuals.where(F.col("_u").isNotNull() & F.col("_v").isNotNull() & F.col("_w").isNotNull())
    j = res.join(summ.drop("learner"), _same(keys, tcols))
    # n J = sum v w cancels in t*: psi / (sum v w) is scaled once per group below
    scaled = j.select(*[F.col(k).cast("string").alias(f"_g{i}") for i, k in enumerate(keys)],
                      (key_hash.cast("long") if key_hash is not None else F.xxhash64(*[F.col(k) for k in key], F.lit(seed))).alias("_h"),
                      (((F.col("_u") - F.col("theta") * F.col("_v")) * F.col("_w")) / F.col("se")).alias("_psi"),
                      (F.col("_v") * F.col("_w")).alias("_vw"))
    gcols = [f"_g{i}" for i in range(len(keys))]
    schema = ", ".join([f"{g} string" for g in gcols] + ["b int", "s double"])
    B, signs = int(n_boot), key_hash is not None

    def frame(acc):
        rows = [(*k, b, float(v)) for k, vec in acc.items() for b, v in enumerate(vec, start=-1)]
        return pd.DataFrame(rows, columns=[*gcols, "b", "s"])

    def partial(batches):
        acc = {}
        bidx = np.arange(B, dtype=np.uint64)
        for pdf in batches:
            for lo in range(0, len(pdf), 4096):
                part = pdf.iloc[lo:lo + 4096]
                h = part["_h"].to_numpy().astype(np.int64)
                if signs:
                    xi = (h[:, None] * (2 * np.arange(B)[None, :] + 1) // 64 % 2 * 2 - 1).astype(float)
                else:
                    xi = _normals(h.view(np.uint64)[:, None], bidx[None, :], np.uint64(seed))
                psi, vw = part["_psi"].to_numpy(dtype=float), part["_vw"].to_numpy(dtype=float)
                groups = part.groupby(gcols, sort=False, dropna=False).indices.items() if gcols else [((), np.arange(len(part)))]
                for g, idx in groups:
                    g = tuple(_none(v) for v in (g if isinstance(g, tuple) else (g,)))
                    acc[g] = acc.get(g, 0) + np.concatenate([[vw[idx].sum()], psi[idx] @ xi[idx]])
                if len(acc) > GROUPS_HELD:
                    yield frame(acc)
                    acc = {}
        yield frame(acc)

    sums = scaled.mapInPandas(partial, schema).groupBy(*gcols, "b").agg(F.sum("s").alias("s"))
    scale = sums.where("b = -1").select(*[F.col(g).alias(f"_s{i}") for i, g in enumerate(gcols)], F.col("s").alias("svw"))
    draws = sums.where("b >= 0").join(scale, _same(gcols, [f"_s{i}" for i in range(len(gcols))]))
    q = draws.groupBy(*gcols).agg(F.count(F.lit(1)).alias("n_boot"), F.percentile(F.abs(F.col("s") / F.col("svw")), 0.95).alias("q95"))
    named = summ.select("*", *[F.col(t).cast("string").alias(f"_k{i}") for i, t in enumerate(tcols)])
    out = named.join(q, _same([f"_k{i}" for i in range(len(keys))], gcols), "left")
    return out.select(*[F.col(t).alias(k) for t, k in zip(tcols, keys, strict=True)], "learner", "n_boot", "q95",
                      (F.col("theta") - F.col("q95") * F.col("se")).alias("ci_lo_boot"),
                      (F.col("theta") + F.col("q95") * F.col("se")).alias("ci_hi_boot"))


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (vectorised, wrapping uint64 arithmetic)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _normals(h: np.ndarray, b: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Standard normals keyed by (row hash, draw index, seed): Box-Muller on two hashes."""
    with np.errstate(over="ignore"):
        base = _mix(h ^ _mix(b * np.uint64(0x9E3779B97F4A7C15) + seed))
        u1 = ((_mix(base + np.uint64(1)) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        u2 = ((_mix(base + np.uint64(2)) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2)
