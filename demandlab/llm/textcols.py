"""Vectorised kernels over Arrow text columns, used inside Spark tasks.

A text column arrives as one UTF-8 buffer plus row offsets. The helpers here
cut it into slices of bounded size and find words, span hashes and shingles
for a whole slice at once with numpy, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_MULT = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SYMBOL = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_SYMBOL_LOWER = _SYMBOL[LOWER]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch: texts may be long, tasks have little memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns can't clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def row_key(ident: Column | None = None, text: Column | None = None) -> Column:
    """128-bit key of a row by its id and text: equal rows share it, whatever their order."""
    ident, text = (F.col("doc_id"), F.col("text")) if text is None else (ident, text)
    return F.unhex(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("-")), F.lit(":"), text)))


def small(df: DataFrame, most: int, weight: str = "1") -> DataFrame:
    """Marked for broadcast if its checked size (the sum of ``weight``) allows it."""
    return F.broadcast(df) if (df.agg(F.sum(F.expr(weight))).first()[0] or 0) <= most else df


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; NULL counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) pieces of at most ``most`` bytes, or one longer row alone."""
    for batch in batches:
        buf, offs = buffers(batch.column(column))
        i, n = 0, len(offs) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
            yield batch.slice(i, j - i), buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (spreads every input bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pw, inv = np.full(size, _MULT[base], U64), np.full(size, pow(_MULT[base], -1, 2**64), U64)
        pw[0] = inv[0] = 1
        got = np.cumprod(pw, dtype=U64), np.cumprod(inv, dtype=U64)
        if size <= 8 * SLICE_BYTES:
            _powers[base] = got
    return got


class SpanHash:
    """64-bit hashes of any byte spans of one buffer (polynomial prefix sums, then mixed)."""

    def __init__(self, buf: np.ndarray, lower: bool = False, base: int = 0):
        pw, self.inv = _power(len(buf) + 1, base)
        self.prefix = np.zeros(len(buf) + 1, U64)
        np.cumsum((_SYMBOL_LOWER if lower else _SYMBOL)[buf] * pw[:len(buf)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.prefix[ends] - self.prefix[starts]) * self.inv[starts]
        return mix(h ^ ((ends - starts).astype(U64) * U64(0xA24BAED4963EE407)))


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs; a run never crosses a row."""
    n = len(mask)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, mask[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, mask[1:]
    before[offs[:-1][offs[:-1] < n]] = False
    after[(offs[1:] - 1)[offs[1:] > 0]] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def row_of(offs: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offs, pos, "right") - 1


def words(buf: np.ndarray, offs: np.ndarray, kind: np.ndarray = NOT_SPACE,
          base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased word hashes of a slice and, per row, the offsets into them."""
    starts, ends = runs(kind[LOWER[buf]], offs)
    h = SpanHash(buf, lower=True, base=base)(starts, ends)
    return h, np.searchsorted(starts, offs)


def shingles(h: np.ndarray, woffs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and the validity mask (a shingle stays in its row).

    Entry i covers words i .. i+k-1; entries that leave their row are invalid.
    """
    n = len(h)
    if n < k:
        return np.empty(0, U64), np.empty(0, bool)
    acc = np.zeros(n - k + 1, U64)
    for j in range(k):
        acc = acc * U64(0x9FB21C651E98DF25) + h[j:n - k + 1 + j]
    row = row_of(woffs, np.arange(n))
    return mix(acc), row[:n - k + 1] == row[k - 1:]


def as_long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def in_sorted(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in a sorted unique table, -1 where absent."""
    if len(table) == 0:
        return np.full(len(x), -1, np.int64)
    i = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[i] == x, i, -1)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), values)
