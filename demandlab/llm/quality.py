"""Quality classifier by Bradley-Terry pairwise ranking.

A text becomes a short vector of shares and rates (case, signs, repeated words,
kinds of lines) over its whole length. From labelled rows, preference pairs
(label 1 preferred to label 0) are formed and a logistic loss on feature
differences is fitted with Spark ML; the weights give every text a score.
The decision threshold is a quantile of the scores of all usable labelled rows,
at their share of label 0, and the logistic curve is moved so that it passes 0.7 there.

The fit uses at most ``max_labels`` labelled rows (smallest hashes of the id):
the only bounded sample here. Features, scores and the threshold cover every row.

Defined cases: NULL and empty texts have the zero vector; rows with a NULL id
are scored and never used for learning; an id labelled twice counts once, with
its smallest label; repeated rows are scored alike; without labels of both
kinds every score is 0.5; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.llm.textcols import SPACE, id_and_text, row_of, runs, small_batches, text_slices, words
from demandlab.session import scratch_table, ship_package

SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGITS = np.zeros(256, bool)
DIGITS[48:58] = True
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
SIGN = np.zeros(256, bool)
SIGN[SIGNS] = True
SIGN[[ord(c) for c in ".,;:'\"-()?"]] = False
FIT_PAIRS = 4
CUT = 0.7


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of features per text of the slice."""
    n = len(offs) - 1
    size = np.diff(offs)
    hist = np.bincount(np.repeat(np.arange(n), size) * 256 + buf, minlength=n * 256).reshape(n, 256)
    letters = hist[:, LETTERS].sum(1)
    parts = [np.log1p(100 * _share(hist[:, c], size)) for c in SIGNS]
    upper, sign = _share(hist[:, UPPER].sum(1), letters), _share(hist[:, SIGN].sum(1), size)
    parts += [upper, sign, _share(hist[:, DIGITS].sum(1), size), _share(hist[:, SPACE].sum(1), size), _share(hist[:, 128:].sum(1), size)]

    h, woffs = words(buf, offs)
    count = np.diff(woffs)
    starts, _ = runs(~SPACE[buf], offs)
    row = row_of(woffs, np.arange(len(h)))
    line_start, line_end = runs(buf != 10, offs)
    line_row = row_of(offs, line_start)
    line = np.searchsorted(line_start, starts, "right") - 1
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    parts += [_share(np.bincount(row, again, minlength=n), count), _share(size - hist[:, SPACE].sum(1), count) / 10, np.log1p(count) / 10]

    def kept(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[line_end] - total[line_start]

    width = line_end - line_start
    in_line = np.maximum(np.bincount(line, minlength=len(width)), 1) if len(h) else np.ones(len(width))
    kinds = [kept(UPPER[buf]) / np.maximum(kept(LETTERS[buf]), 1), kept(SIGN[buf]) / np.maximum(width, 1),
             (np.bincount(line, again, minlength=len(width)) if len(h) else np.zeros(len(width))) / in_line]
    for kind, most in zip(kinds, (0.5, 0.05, 0.5), strict=True):
        worst = np.zeros(n)
        long = width >= 20
        np.maximum.at(worst, line_row[long], kind[long])
        parts += [worst, _share(np.bincount(line_row, width * (kind > most), minlength=n), size)]
    return np.stack(parts, 1).astype(np.float32)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches):
        x = features(buf, offs)
        at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
        yield pa.record_batch([rows.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["doc_id", "x"])


def _score(weights: np.ndarray, cut: float):
    shift = np.log(CUT / (1 - CUT))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, len(weights)).astype(np.float64)
            z = np.clip(x @ weights - cut + shift, -500, 500)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "held_out", "score"])
    return kernel


def preference_pairs(sample: DataFrame, per_row: int = FIT_PAIRS) -> DataFrame:
    """Feature differences (preferred minus other, half of them reversed) from a bounded sample."""
    order = Window.partitionBy("quality").orderBy("pick", "doc_id")
    ranked = sample.withColumn("i", F.row_number().over(order) - 1)
    good, bad = ranked.where("quality = 1"), ranked.where("quality = 0")
    n_good, n_bad = good.count(), bad.count()
    if not n_good or not n_bad:
        return None
    most = max(n_good, n_bad)
    draws = sample.sparkSession.range(most * per_row).select(
        (F.col("id") % n_good).alias("g"), ((F.col("id") * 7919 + F.floor(F.col("id") / most)) % n_bad).alias("b"), "id")
    pairs = draws.join(good.select(F.col("i").alias("g"), F.col("x").alias("xg")), "g") \
        .join(bad.select(F.col("i").alias("b"), F.col("x").alias("xb")), "b")
    sign = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    diff = F.zip_with("xg", "xb", lambda a, b: (a - b) * sign)
    return pairs.select(array_to_vector(diff.cast("array<double>")).alias("features"), (sign > 0).cast("double").alias("label"))


def fit(sample: DataFrame) -> np.ndarray | None:
    """Weights, from rows (doc_id, pick, x, quality)."""
    pairs = preference_pairs(sample)
    if pairs is None:
        return None
    return LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60).fit(pairs).coefficients.toArray()


def value_at(rows: DataFrame, rank: int) -> float:
    """The value of column s at a rank (from 0) in ascending order, by counts in ever smaller ranges."""
    low, high = rows.agg(F.min("s"), F.max("s")).first()
    before = 0
    while low < high:
        part = F.least(F.floor((F.col("s") - low) / (high - low) * 1000), F.lit(999))
        for r in rows.where(F.col("s").between(low, high)).groupBy(part.alias("k")).agg(F.count("s").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).orderBy("k").collect():
            if before + r["n"] > rank:
                low, high = r["a"], r["b"]
                break
            before += r["n"]
    return low


def quantile_cut(usable: DataFrame, weights: np.ndarray) -> float:
    """Midway between the two scores at the share of label 0, over all labelled rows (x, quality)."""
    path = scratch_table(usable.sparkSession, "labelled_scores")
    usable.select("quality", F.aggregate(
        F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v).alias("s")).write.parquet(path)
    scored = usable.sparkSession.read.parquet(path)
    worse = scored.where("quality = 0").count()
    return (value_at(scored, worse - 1) + value_at(scored, worse)) / 2


def _rated(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str, text_col: str, label_col: str, max_labels: int) -> tuple[DataFrame, tuple | None]:
    """The written features of every row and the model fitted on them."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    path = scratch_table(spark, "quality")
    id_and_text(docs, id_col, text_col).mapInArrow(_extract, "doc_id long, x array<float>") \
        .withColumn("held_out", F.coalesce(held_out, F.lit(False))).write.parquet(path)
    rows = spark.read.parquet(path)
    marks = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("quality")) \
        .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    usable = rows.where(~F.col("held_out")).join(marks, "doc_id").withColumn("pick", F.xxhash64("doc_id"))
    taught = scratch_table(spark, "labelled")
    usable.orderBy("pick", "doc_id").limit(max_labels).write.parquet(taught)
    weights = fit(spark.read.parquet(taught))
    return rows, None if weights is None else (weights, quantile_cut(usable, weights))


def _good(weights: np.ndarray, cut: float, text_col: str):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, text_col):
            yield rows.filter(pa.array(features(buf, offs).astype(np.float64) @ weights >= cut))
    return kernel


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", max_labels: int = 20_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the cut; all of them if nothing can be learnt."""
    _, model = _rated(docs, labels, held_out, id_col, text_col, label_col, max_labels)
    return docs if model is None else docs.mapInArrow(_good(*model, text_col), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; rows that are held out never teach."""
    rows, got = _rated(docs, labels, held_out, id_col, text_col, label_col, max_labels)
    if got is None:
        out = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        out = rows.mapInArrow(_score(*got), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
