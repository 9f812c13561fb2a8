"""Tree learners (Spark ML, distributed), missing-value handling, grid search
and feature importances (M4, M5, M5a, M7, M17).

Spark's boosted trees are not the histogram booster of the study (no L1/L2
leaf penalties, no NaN routing): estimates agree in spirit, not bitwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def rf(trees: int = 500, frac: float = 0.65, max_depth: int = 30, seed: int = 42) -> RandomForestRegressor:
    """Random forest; ``frac`` of the features considered per split (M4)."""
    return RandomForestRegressor(numTrees=trees, featureSubsetStrategy=str(frac), maxDepth=max_depth,
                                 seed=seed)


def gbt(rounds: int = 500, lr: float = 0.2, depth: int = 6, colsample: float = 1.0,
        min_info_gain: float = 0.0, seed: int = 42) -> GBTRegressor:
    """Gradient-boosted trees (M5); ``min_info_gain`` plays the split-loss threshold."""
    return GBTRegressor(maxIter=rounds, stepSize=lr, maxDepth=depth,
                        featureSubsetStrategy="all" if colsample >= 1.0 else str(colsample),
                        minInfoGain=min_info_gain, seed=seed)


def with_missing_indicators(df: DataFrame, cols: Sequence[str], fill: float = 0.0,
                            suffix: str = "_missing") -> tuple[DataFrame, list[str]]:
    """NULL-tolerant features for learners that reject missing values (M5a):
    each column is filled and gets a 0/1 indicator. Returns (frame, feature names)."""
    out = df.withColumns({c + suffix: F.col(c).isNull().cast("double") for c in cols})
    out = out.fillna(fill, subset=list(cols))
    return out, list(cols) + [c + suffix for c in cols]


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; rows with missing values stay (see ``with_missing_indicators``)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def grid_search(df: DataFrame, estimator, features: Sequence[str], label: str, grid: dict,
                fold: str = "fold", k: int = 5, parallelism: int = 2):
    """K-fold grid search on a fold column, MSE criterion (M7). Returns
    (best model, table of (params, mean MSE))."""
    data = assemble(df.where(F.col(label).isNotNull()), features)
    est = estimator.copy().setFeaturesCol("features").setLabelCol(label)
    pg = ParamGridBuilder()
    for name, values in grid.items():
        pg = pg.addGrid(est.getParam(name), list(values))
    maps = pg.build()
    ev = RegressionEvaluator(labelCol=label, metricName="mse")
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, foldCol=fold, numFolds=k,
                        parallelism=parallelism)
    model = cv.fit(data)
    rows = [(",".join(f"{p.name}={v}" for p, v in m.items()), float(s)) for m, s in zip(maps, model.avgMetrics)]
    table = df.sparkSession.createDataFrame(rows, "params string, mse double")
    return model.bestModel, table


def tuned_against_default(train: DataFrame, test: DataFrame, estimator, features: Sequence[str], label: str, grid: dict,
                          fold: str = "fold", k: int = 5) -> DataFrame:
    """(model, params, cv_mse, test_mse) of the estimator as given and of the grid's best point,
    both fitted on all of ``train`` and scored on ``test`` (M7)."""
    best, points = grid_search(train, estimator, features, label, grid, fold, k)
    rows = points.orderBy("mse", "params").limit(1).collect()   # one point
    fit = assemble(train.where(F.col(label).isNotNull()), features)
    default = estimator.copy().setFeaturesCol("features").setLabelCol(label).fit(fit)
    score = RegressionEvaluator(labelCol=label, metricName="mse")
    held = assemble(test.where(F.col(label).isNotNull()), features)
    out = [("default", None, None, score.evaluate(default.transform(held))),
           ("tuned", rows[0].params, rows[0].mse, score.evaluate(best.transform(held)))]
    return train.sparkSession.createDataFrame(out, "model string, params string, cv_mse double, test_mse double")


def coefficient_shares(coefs: DataFrame, by=(), term: str = "term", coef: str = "coef", leave_out: Sequence[str] = ("const", "intercept")) -> DataFrame:
    """by..., feature, value = |coefficient|, share of their sum, from any table of coefficients
    (``linear.ols``, ``lasso.lasso_cv``) without collecting it (M17, F13)."""
    keys = [by] if isinstance(by, str) else list(by)
    own = coefs.where(~F.col(term).isin(*leave_out)).select(*keys, F.col(term).alias("feature"), F.abs(coef).alias("value"))
    total = F.sum("value").over(Window.partitionBy(*(keys or [F.lit(0)])))
    return own.withColumn("share", F.try_divide("value", total))


def importance(spark: SparkSession, model, features: Sequence[str], learner: str, target: str) -> DataFrame:
    """Feature importance: tree importances or |coefficients|, raw and normalised
    to sum 1 (M17, F13). Output (target, learner, feature, value, share)."""
    if hasattr(model, "featureImportances"):
        vals = list(model.featureImportances.toArray())
    elif hasattr(model, "coefficients"):
        vals = [abs(float(v)) for v in model.coefficients]
    else:
        vals = [abs(float(v)) for v in model]
    total = sum(vals)
    rows = [(target, learner, f, float(v), float(v / total) if total > 0 else None) for f, v in zip(features, vals)]
    return spark.createDataFrame(rows, "target string, learner string, feature string, value double, share double")
