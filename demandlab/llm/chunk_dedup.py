"""Substring dedup by content-defined chunking with a gear rolling hash.

The rolling hash of the last 32 bytes places the cuts, so a cut depends on
nearby bytes only and an insertion moves chunks without changing them. After a
cut the next ``MIN`` bytes hold none, and a chunk never exceeds ``MAX`` bytes.
Chunks are deduplicated by a 128-bit digest over the whole corpus: the first
occurrence (smallest id, then text hash, then position) stays. The others go
where they lie in a run of repeated chunks (first occurrences count in it) of at
least ``min_run`` bytes, so that short common phrases stay in place; a text made
of repeated chunks only is one run, however short.

Digests are summed before they are shuffled. Those with at least
1 / ``HOT_DIGESTS`` of all chunks, at most ``HOT_DIGESTS``, are broadcast and
their chunks marked where they are; only the others are dealt by digest.

Defined cases: NULL and empty texts have no chunks; rows that agree in id and
text are one row that occurs several times: one stays, as far as others don't
hold its chunks first, and the rest are removed in whole; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.textcols import id_and_text, list_array, small_batches, text_slices
from demandlab.session import scratch_table, ship_package

MIN, MAX, CUT_BITS = 32, 512, 5
GEAR = np.random.default_rng(17).integers(0, 2**32, 256, dtype=np.uint32)
HOT_DIGESTS, HOT_CHUNKS = 100_000, 10_000
COPIES = 100_000  # equal rows listed at once
KEY = ["none", "d", "row"]
RESULT = "none boolean, d long, row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def gear_cuts(buf: np.ndarray, start: int, end: int, hits: np.ndarray) -> list[int]:
    """Chunk ends of one row from the positions after which the hash allows a cut."""
    out, last = [], start
    for at in hits.tolist():
        while at - last > MAX:
            last += MAX
            out.append(last)
        if at - last >= MIN:
            out.append(at)
            last = at
    while end - last > MAX:
        last += MAX
        out.append(last)
    if last < end:
        out.append(end)
    return out


def allowed(buf: np.ndarray) -> np.ndarray:
    """Positions after which a cut may be: the top bits of the 32-byte gear hash are zero."""
    h = GEAR[buf]
    for width in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint32(width)
        h = h + shifted
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1


def chunks(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends of a slice and the number of chunks of each row."""
    hits = allowed(buf)
    # the hash must not look into the row before
    row = np.searchsorted(offs, hits, "left") - 1
    hits = hits[hits - offs[row] >= MIN]
    bounds = np.searchsorted(hits, offs, "right")
    ends, count = [], np.zeros(len(offs) - 1, np.int64)
    for i in range(len(offs) - 1):
        own = gear_cuts(buf, int(offs[i]), int(offs[i + 1]), hits[bounds[i]:bounds[i + 1]])
        ends += own
        count[i] = len(own)
    return np.array(ends, np.int64), count


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches):
        ends, count = chunks(buf, offs)
        first = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        raw = buf.tobytes()
        digest = pa.array([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), ends.tolist(), strict=True)], pa.binary())
        yield pa.record_batch([*(rows.column(c) for c in KEY), list_array(digest, count), list_array(pa.array((ends - first).astype(np.int32)), count)],
                              [*KEY, "digests", "sizes"])


def removed_spans(marks: np.ndarray, sizes: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bytes to remove from a text: ``marks`` are 2 * chunk number, one more for first occurrences."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    marks = np.sort(marks)
    chunk, first = marks >> 1, (marks & 1).astype(bool)
    new = np.concatenate([[True], np.diff(chunk) > 1])
    run = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    length = at[chunk[np.append(begin[1:], len(chunk)) - 1] + 1] - at[chunk[begin]]
    go = chunk[~first & ((length >= min_run)[run] | (len(chunk) == len(sizes)))]
    if len(go) == 0:
        return go, go
    gap = np.diff(go) > 1
    return at[go[np.concatenate([[True], gap])]], at[go[np.concatenate([gap, [True]])] + 1]


def _spans(min_run: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, stops = [], []
            for marks, sizes in zip(b.column("marks"), b.column("sizes"), strict=True):
                x, y = removed_spans(marks.values.to_numpy(), sizes.values.to_numpy(), min_run)
                starts.append(x.astype(np.int32))
                stops.append(y.astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.record_batch([*(b.column(c) for c in KEY), b.column("rid"), pa.array(starts, kind), pa.array(stops, kind)], [*KEY, "rid", "starts", "stops"])
    return kernel


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches):
        starts, stops = rows.column("starts"), rows.column("stops")
        spans = pc.fill_null(pc.list_value_length(starts), 0).to_numpy().astype(np.int64)
        base = np.repeat(offs[:-1], spans)
        step = np.zeros(len(buf) + 1, np.int8)
        step[base + starts.flatten().to_numpy()] += 1
        step[base + stops.flatten().to_numpy()] -= 1
        keep = np.cumsum(step[:-1], dtype=np.int8) == 0
        at = np.concatenate([[0], np.cumsum(keep)])[offs]
        raw = buf[keep].tobytes()
        kept = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.record_batch([*(rows.column(c) for c in KEY), pa.array(np.diff(offs)), pa.array(np.diff(offs) - np.diff(at)), pa.array(spans), pa.array(kept, pa.string())],
                              [*KEY, "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _repeats(cut: DataFrame) -> DataFrame:
    """rid and mark of every chunk whose digest occurs more than once: 2 * its number, one more at the first occurrence."""
    spark = cut.sparkSession
    one = cut.select("rid", *KEY, F.posexplode("digests").alias("i", "digest"))
    path = scratch_table(spark, "repeated")
    one.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "i", "rid")).alias("lead")).where("n > 1") \
        .select("digest", "n", F.col("lead.rid").alias("lead_rid"), F.col("lead.i").alias("lead_i")).write.parquet(path)
    again = spark.read.parquet(path)
    chunks_in_all = cut.agg(F.sum(F.size("digests"))).first()[0] or 0
    hot = max(HOT_CHUNKS, -(-chunks_in_all // HOT_DIGESTS))
    most = F.broadcast(again.where(F.col("n") >= hot).drop("n"))   # at most HOT_DIGESTS rows
    one = one.select("rid", "i", "digest")
    others = one.join(most.select("digest"), "digest", "left_anti").join(again.where(F.col("n") < hot).drop("n"), "digest")
    first = (F.col("rid") == F.col("lead_rid")) & (F.col("i") == F.col("lead_i"))
    return one.join(most, "digest").unionByName(others).select("rid", (F.col("i") * 2 + first.cast("int")).alias("mark"))


def _listed(rows: DataFrame) -> DataFrame:
    """The rows again from their numbers ``m``: the first one as it is, the others removed in whole."""
    block, k = F.col("block") * COPIES, F.col("k")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / COPIES))))
    rows = rows.withColumn("k", F.explode(F.sequence(block, F.least(F.col("m"), block + COPIES) - 1)))

    def of(kept: str, gone: Column) -> Column:
        return F.when(k == 0, F.col(kept)).otherwise(gone).alias(kept)
    return rows.select(F.when(~F.col("none"), F.col("d")).alias("doc_id"), "n_bytes", of("n_removed", F.col("n_bytes")),
                       of("n_spans", (F.col("n_bytes") > 0).cast("long")), of("kept_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def chunk_dedup(docs: DataFrame, min_run: int = 96, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    docs = id_and_text(docs, id_col, text_col).select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("d"),
                                                      F.xxhash64("text").alias("row"), "text")
    path = scratch_table(spark, "chunks")
    docs.mapInArrow(_cut, "none boolean, d long, row long, digests array<binary>, sizes array<int>") \
        .withColumn("rid", F.monotonically_increasing_id()).write.parquet(path)
    cut = spark.read.parquet(path)
    marked = _repeats(cut).groupBy("rid").agg(F.collect_list("mark").alias("marks"))
    placed = cut.select("rid", *KEY, "sizes").join(marked, "rid").mapInArrow(
        _spans(min_run), "none boolean, d long, row long, rid long, starts array<int>, stops array<int>")
    # of equal rows the first one tells what goes
    placed = placed.groupBy(*KEY).agg(F.min_by(F.struct("starts", "stops"), "rid").alias("spans")).select(*KEY, "spans.starts", "spans.stops")
    got = docs.join(placed, KEY, "left").mapInArrow(_remove, RESULT)
    return _listed(got.groupBy(*got.columns).agg(F.count(F.lit(1)).alias("m")))
