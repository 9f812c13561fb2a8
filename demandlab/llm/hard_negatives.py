"""Hard-negative mining by segment summary filtering.

A vector is quantised to integers (floor of ``scale`` times each component, as
double) and cut into 1, 4, 16, ... equal segments. Each segment's mean m and
deviation d (root of the summed squared distances to m) are stored. Over a
segment of length L the inner product of two vectors lies within
L m m' - d d' and L m m' + d d', so the sums over the segments bound the score;
finer segments give closer bounds. A pair is settled on the coarsest level
whose bounds rule it out; only what is left after the finest level is multiplied
out. Results are exact: bounds carry a margin for rounding, scores are integers.

Vectors and summaries are written once. Anchors come in waves of at most
``wave_bytes`` (the number of waves grows with the input, what a worker or the driver
holds doesn't): each wave is sent to all tasks, which keep the k best rows of
every anchor in their share of the vectors, and a window limited before its
shuffle merges the tasks' winners. First the k best rows of the anchor's own label
(positives), then for each positive the k best rows of other labels with
``low`` * positive score <= score <= positive score (``low`` as a fraction of integers).

Ties go to the smaller id, NULL ids last. Defined cases: rows with a NULL label, a
NULL vector or a NULL or non-finite component take no part; nor do vectors whose
quantised length reaches 2^28 (their scores could not be told exactly in a long);
shorter vectors count as padded with zeros, so empty ones score 0; repeated rows
are rows of their own, NULL ids are no anchors, repeated ids are several; a
negative positive-score admits no negative. Empty tables give no rows. Only
the three columns named are read; other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.llm.textcols import buffers
from demandlab.session import scratch_table, ship_package

TABLE = "rid long, vec_id long, label long, q binary, summary binary"
FOUND = "rid long, slot long, found_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
EXACT, MOST = 2.0**52, 2.0**56   # squared lengths: exact in doubles, exact in longs (100 times a score too)
ROWS, ANCHORS = 2048, 256        # of a tile
DENSE = 0.05                     # below this share of open pairs, pairs are refined one by one


def levels(dim: int) -> list[int]:
    """Numbers of segments, coarsest first; each divides ``dim`` and leaves two components at least."""
    out = [s for s in (4**i for i in range(16)) if dim % s == 0 and dim // s >= 2]
    return out or [1]


class Vectors:
    """Quantised rows of one length with the summaries of their segments."""

    def __init__(self, q: np.ndarray, sums: list[tuple[np.ndarray, np.ndarray]]):
        self.q, self.sums = q, sums
        self.large = float((q * q).sum(axis=1).max(initial=0.0))

    @staticmethod
    def stored(q: np.ndarray, summary: np.ndarray) -> Vectors:
        """From the table's rows: integers and, level by level, means and deviations."""
        sums, at = [], 0
        for s in levels(q.shape[1]):
            sums.append((summary[:, at:at + s], summary[:, at + s:at + 2 * s]))
            at += 2 * s
        return Vectors(q.astype(float), sums)

    def take(self, at: np.ndarray) -> Vectors:
        return Vectors(self.q[at], [(m[at], d[at]) for m, d in self.sums])


def summaries(q: np.ndarray) -> np.ndarray:
    """Means (times the root of the segment's length, so that their product is L m m') and deviations, level by level."""
    out = []
    for s in levels(q.shape[1]):
        part = q.reshape(len(q), s, q.shape[1] // s)
        mean = part.mean(axis=2)
        out += [mean * np.sqrt(part.shape[2]), np.sqrt(((part - mean[:, :, None]) ** 2).sum(axis=2))]
    return np.concatenate(out, axis=1)


def exact(a: Vectors, b: Vectors) -> np.ndarray:
    if max(a.large, b.large) < EXACT:
        return a.q @ b.q.T
    return (a.q.astype(np.int64) @ b.q.T.astype(np.int64)).astype(float)


def open_pairs(a: Vectors, b: Vectors, low: np.ndarray, high: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Pairs of ``may`` whose score can lie within [low, high] of its anchor, by the summaries."""
    edge = 1e-12 * np.sqrt(a.large * b.large) + 1e-6   # far above the rounding of sums of that size
    for (ma, da), (mb, db) in zip(a.sums, b.sums, strict=True):
        share = may.mean() if may.size else 0.0
        if not share:
            return may
        if share > DENSE:
            mid, off = ma @ mb.T, da @ db.T + edge
            may &= (mid + off >= low[:, None]) & (mid - off <= high[:, None])
        else:
            i, j = np.nonzero(may)
            mid, off = (ma[i] * mb[j]).sum(axis=1), (da[i] * db[j]).sum(axis=1) + edge
            may[i, j] = (mid + off >= low[i]) & (mid - off <= high[i])
    return may


def pair_scores(a: Vectors, b: Vectors, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and exact score of the open pairs."""
    i, j = np.nonzero(may)
    if len(i) and may.mean() > DENSE:
        return i, j, exact(a, b)[i, j]
    kind = float if max(a.large, b.large) < EXACT else np.int64
    return i, j, (a.q[i].astype(kind) * b.q[j].astype(kind)).sum(axis=1).astype(float)


class Best:
    """The k best entries (score, then id, NULL ids last) of every list, kept in flat arrays."""

    def __init__(self, lists: int, k: int):
        self.k, self.floor = k, np.full(lists, -np.inf)
        self.of, self.score, self.ident, self.none = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, of: np.ndarray, score: np.ndarray, ident: np.ndarray, none: np.ndarray) -> None:
        keep = score >= self.floor[of]
        of, score, ident, none = (np.concatenate([old, new[keep]]) for old, new in
                                  ((self.of, of), (self.score, score), (self.ident, ident), (self.none, none)))
        order = np.lexsort((ident, none, -score, of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        top = order[rank < self.k]
        last = (rank == self.k - 1)[rank < self.k]
        self.of, self.score, self.ident, self.none = of[rank < self.k], score[top], ident[top], none[top]
        self.floor[self.of[last]] = self.score[last]


def _tiles(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """rid, id, whether it is NULL, label and vectors of some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            n = part.num_rows
            q, s = (buffers(part.column(c))[0] for c in ("q", "summary"))
            yield (part.column("rid").to_numpy(), part.column("vec_id").fill_null(0).to_numpy(), part.column("vec_id").is_null().to_numpy(zero_copy_only=False),
                   part.column("label").to_numpy(), Vectors.stored(q.view(np.int32).reshape(n, dim), s.view(np.float64).reshape(n, -1)))


def quantised(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """The rows that take part, with their summaries; all are as long as the longest vector (or a few components more)."""
    spark = vectors.sparkSession
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         vectors[vec_col].cast("array<double>").alias("v")).where("label is not null and v is not null")
    own = own.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    dim = own.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(dim, 1) if dim < 8 else -(-dim // 4) * 4

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            q = np.zeros((len(v), dim))
            sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(v):
                at = np.repeat(np.arange(len(v)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                with np.errstate(over="ignore"):
                    q[at] = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False))
            with np.errstate(over="ignore", invalid="ignore"):
                fits = (q * q).sum(axis=1) < MOST
            q, keep = q[fits], pa.array(fits)
            stored = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (q.astype(np.int32), summaries(q))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).filter(keep) for c in ("rid", "vec_id", "label")), *stored], names=["rid", "vec_id", "label", "q", "summary"])

    path = scratch_table(spark, "vectors")
    own.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(kernel, TABLE).write.parquet(path)
    return spark.read.parquet(path)


def _wave(rows: list) -> tuple[np.ndarray, np.ndarray, Vectors]:
    q, s = (np.stack([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("q", np.int32), ("summary", np.float64)))
    return np.array([r.rid for r in rows], np.int64), np.array([r.label for r in rows], np.int64), Vectors.stored(q, s)


def _blocks(n: int) -> Iterator[np.ndarray]:
    for lo in range(0, n, ANCHORS):
        yield np.arange(lo, min(lo + ANCHORS, n))


def _positives(wave: tuple, k: int, dim: int):
    rid, label, a = wave

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(rid), k)
        for row, ident, none, own, b in _tiles(batches, dim):
            for some in _blocks(len(rid)):
                part = a.take(some)
                may = (label[some, None] == own[None, :]) & (rid[some, None] != row[None, :])
                may = open_pairs(part, b, best.floor[some], np.full(len(some), np.inf), may)
                i, j, score = pair_scores(part, b, may)
                best.add(some[i], score, ident[j], none[j])
        yield _found(rid[best.of], np.zeros(len(best.of), np.int64), best)
    return kernel


def _negatives(wave: tuple, scores: np.ndarray, k: int, dim: int, low: tuple[int, int]):
    """``scores``: of each anchor's positives, NaN where it has fewer."""
    rid, label, a = wave
    p = scores.shape[1]
    used = scores >= 0   # a negative score admits nothing
    top = np.where(used, scores, -np.inf)
    # whole numbers: the least score that low[0] * positive <= low[1] * score allows
    least = np.where(used, -(-low[0] * np.where(used, scores, 0).astype(np.int64) // low[1]), np.inf)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(rid) * p, k)
        for _, ident, none, own, b in _tiles(batches, dim):
            for some in _blocks(len(rid)):
                part = a.take(some)
                bar = np.maximum(least[some], best.floor.reshape(-1, p)[some])
                may = open_pairs(part, b, bar.min(axis=1), top[some].max(axis=1), label[some, None] != own[None, :])
                i, j, score = pair_scores(part, b, may)
                for s in range(p):
                    ok = (score >= bar[i, s]) & (score <= top[some[i], s])
                    best.add(some[i[ok]] * p + s, score[ok], ident[j[ok]], none[j[ok]])
        yield _found(rid[best.of // p], best.of % p, best)
    return kernel


def _found(rid: np.ndarray, slot: np.ndarray, best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(slot), pa.array(best.ident, pa.int64(), mask=best.none), pa.array(best.score.astype(np.int64))],
                                      names=["rid", "slot", "found_id", "score"])


def _merged(parts: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks, ranked from 1; the window's limit applies before the shuffle, too."""
    w = Window.partitionBy("rid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("found_id"))
    return parts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0,
                   k_positives: int = 5, k_negatives: int = 5, low: tuple[int, int] = (80, 100), wave_bytes: int = 8 << 20) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on ``vec_id`` alone, ``label`` an expression of the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    table = quantised(vectors, id_col, vec_col, label, scale)
    row = table.select(F.octet_length("q").alias("b")).first()
    if row is None:
        return spark.createDataFrame([], RESULT)
    dim = row.b // 4
    anchors = table.where(anchor)
    per_anchor = 8 * dim * (2 + sum(2 * s for s in levels(dim)) / dim) + 8 * k_positives * (1 + k_negatives)
    waves = max(1, int(-(-anchors.count() * per_anchor // wave_bytes)))
    path, out, wrote = scratch_table(spark, "anchors"), scratch_table(spark, "negatives"), False
    anchors.withColumn("wave", F.pmod(F.xxhash64("rid"), F.lit(waves)).cast("int")).write.partitionBy("wave").parquet(path)
    dealt = spark.read.schema(f"{TABLE}, wave int").parquet(path)
    for w in range(waves):
        rows = dealt.where(F.col("wave") == w).collect()   # bounded by wave_bytes
        if not rows:
            continue
        wave, ids = _wave(rows), {r.rid: r.vec_id for r in rows}
        at = {r.rid: i for i, r in enumerate(rows)}
        scores, names = np.full((len(rows), k_positives), np.nan), []
        for r in _merged(table.mapInArrow(_positives(wave, k_positives, dim), FOUND), k_positives).collect():   # k for each anchor
            scores[at[r.rid], r.rank - 1] = r.score
            names.append((r.rid, r.rank - 1, ids[r.rid], r.found_id, r.score))
        known = F.broadcast(spark.createDataFrame(names, "rid long, slot long, anchor_id long, positive_id long, positive_score long"))
        found = _merged(table.mapInArrow(_negatives(wave, scores, k_negatives, dim, low), FOUND), k_negatives).join(known, ["rid", "slot"])
        found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                     "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
        wrote = True
    return spark.read.schema(RESULT).parquet(out) if wrote else spark.createDataFrame([], RESULT)
