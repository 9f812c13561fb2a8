"""Training-order materialisation: token-ID shards in a permuted global order.

Each text becomes token ids of a byte-level BPE plus an end id, cut into
sequences of at most ``length`` tokens. Sequences are numbered densely: rows of a
partition follow those of the partitions before it, as one counting pass over
the same scan tells (a second pass over the texts costs less than a table of all
ids beside the shuffle and the shards). A keyed Feistel network over the next
even number of bits, walked until the value is below the number of sequences,
maps each number to its global slot, so any position of any epoch can be
computed without a stored permutation.

Slots are dealt by ranges, some shards of ``records`` slots to a task, sorted,
padded and written by Spark's own committed writer as fixed-stride binary
records: record k of a shard starts at byte k * stride, so a reader seeks to any
slot and resumes there. A record is doc_id (8 bytes), piece number (4), number
of tokens (2), flags (2; 1: no doc_id), the ids (2 bytes each, little-endian)
and one line feed.

Defined cases: NULL and empty texts have one sequence holding the end id only; a
NULL doc_id is stored as 0 with its flag; repeated rows get sequences each; empty
tables give no shards; other columns are ignored. ``length`` is below 65,536.
``docs`` must be a scan that gives the same partitions twice; if the counts of the
two passes differ, the job fails.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.codepoints import BLANK, LETTER, OTHER, code_points, inside_stretches, tables
from demandlab.llm.textcols import U64, id_and_text, mix, text_slices
from demandlab.llm.token_counts import KeyCache, span_hashes, strings_of
from demandlab.session import scratch_table, ship_package

#: Fixed values of the byte-level vocabulary.
VOCABULARY, END_ID = 50_256, 50_256
ROUNDS = 6
HEADER = 16
POOL = 1 << 24
MOST_TASKS = 20_000  # of the writing stage; beyond that a task writes several shards


# -- the permutation

def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of 0 .. n-1 chosen by ``key``; values outside are walked on."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = U64((1 << half) - 1)
    keys = mix(np.arange(ROUNDS, dtype=U64) + U64(key % 2**64) * U64(2654435761))
    out = index.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> U64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[todo] = (left << U64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


# -- tokens

def gpt_pieces(cp: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the byte-level BPE's pre-tokens.

    A stretch between blanks with an unassigned code point is one piece (with the space before it).
    """
    n = len(cp)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = tables().kind[cp]
    first = np.zeros(n + 1, bool)
    first[0] = first[n] = True
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first |= edge
    first[1:n] |= cls[1:] != cls[:-1]
    # the last blank before a sign: a space joins what follows, another blank stands alone
    last = np.flatnonzero((cls[:-1] == BLANK) & (cls[1:] != BLANK) & ~edge[1:n])
    first[last] = True
    joins = last[cp[last] == 0x20]
    first[joins + 1] = False
    # an apostrophe at the start of a piece, alone before letters
    q = np.flatnonzero((cp[:-1] == 0x27) & first[:n - 1] & first[1:n] & ~edge[1:n])
    q = q[(cls[q + 1] == LETTER) & (cls[q] == OTHER)]
    if len(q):
        far = np.append(cp, np.zeros(3, cp.dtype))
        c1, c2 = far[q + 1], far[q + 2]
        one = np.isin(c1, [ord(x) for x in "stmd"])
        two = ~first[np.minimum(q + 2, n)] & (((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l"))))
        for hit, k in ((one, 2), (two & ~one, 3)):
            first[q[hit] + 1] = False
            first[np.minimum(q[hit] + k, n)] = True
    wild = tables().unassigned[cp]
    if wild.any():
        first[:n] &= ~inside_stretches(cls != BLANK, wild, offs)
    at = np.flatnonzero(first)
    return at[:-1], at[1:]


class Ids:
    """Token ids of pieces and texts, with a bounded cache per worker."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._clear()

    def _clear(self) -> None:
        self.cache, self.pool, self.used = KeyCache(), np.empty(1 << 16, np.uint16), 0

    def _keep(self, ids: np.ndarray) -> int:
        """Append to the pool, which doubles when it is full; returns the place."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool[:at], np.empty(max(len(self.pool), len(ids)), np.uint16)])
        self.pool[at:self.used] = ids
        return at

    def _values(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of each piece, and the pieces' ends by row."""
        cp, coffs = code_points(buf, offs)
        s, e = gpt_pieces(cp, coffs)
        h = span_hashes(cp, s, e)
        value = self.cache.quick(h)
        miss = np.flatnonzero(value < 0)
        if len(miss):
            key, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            got = self.cache.get(key)
            new = np.flatnonzero(got < 0)
            if len(new) and self.used and (self.cache.full(len(new)) or self.used > POOL):
                self._clear()
                return self._values(buf, offs)
            if len(new):
                at = miss[one[new]]
                ids = [self.enc.encode_ordinary(x) for x in strings_of(cp, s[at], e[at])]
                sizes = np.array([len(x) for x in ids], np.int64)
                first = self._keep(np.array([i for x in ids for i in x], np.uint16))
                got[new] = (first + np.cumsum(sizes) - sizes) << 24 | sizes
                self.cache.put(key[new], got[new])
            self.cache.show(key, got)
            value[miss] = got[back]
        return value, np.searchsorted(s, coffs)

    def sizes(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Number of ids of each row, the end id included."""
        value, ends = self._values(buf, offs)
        total = np.concatenate([[0], np.cumsum(value & 0xFFFFFF)])
        return total[ends[1:]] - total[ends[:-1]] + 1

    def rows(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each closed by the end id, and the row offsets."""
        value, ends = self._values(buf, offs)
        place, sizes = value >> 24, value & 0xFFFFFF
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(place - total[:-1], sizes) + np.arange(total[-1])]
        stops = total[ends[1:]] + np.arange(len(ends) - 1)
        out = np.empty(len(ids) + len(stops), np.uint16)
        text = np.ones(len(out), bool)
        text[stops] = False
        out[text], out[stops] = ids, END_ID
        return out, np.concatenate([[0], stops + 1])


_ids: dict[str, Ids] = {}


def _encoder(path: str, pattern: str) -> Ids:
    if path not in _ids:
        _ids[path] = Ids(path, pattern)
    return _ids[path]


# -- sequences, slots and shards

RECORD = np.dtype([("doc", "<i8"), ("piece", "<i4"), ("n", "<u2"), ("flags", "<u2")])


def _count(path: str, pattern: str, length: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, n = _encoder(path, pattern), 0
        for _, buf, offs in text_slices(batches):
            n += int((-(-enc.sizes(buf, offs) // length)).sum())
        if n:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])
    return kernel


def _emit(path: str, pattern: str, length: int, first: dict[int, tuple[int, int]], total: int, key: int):
    """Slot, and header and ids as one unpadded binary value, of every sequence."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        number, last = first.get(TaskContext.get().partitionId(), (0, 0))
        for rows, buf, offs in text_slices(batches):
            ids, toffs = enc.rows(buf, offs)
            size = np.diff(toffs)
            count = -(-size // length)
            doc = np.repeat(np.arange(len(size)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            used = np.minimum(size[doc] - piece * length, length)
            ident = rows.column("doc_id")
            head = np.zeros(len(doc), RECORD)
            head["doc"], head["piece"], head["n"] = ident.fill_null(0).to_numpy()[doc], piece, used
            head["flags"] = ident.is_null().to_numpy(zero_copy_only=False)[doc]
            # headers between the runs of ids, all in units of two bytes
            stop = np.cumsum(used + HEADER // 2)
            out = np.empty(int(stop[-1]) if len(stop) else 0, "<u2")
            text = np.ones(len(out), bool)
            text[((stop - used - HEADER // 2)[:, None] + np.arange(HEADER // 2)).ravel()] = False
            out[text], out[~text] = ids, head.view("<u2")
            at = np.concatenate([[0], 2 * stop]).astype(np.int32)
            slot = feistel(np.arange(number, number + len(doc)), total, key)
            number += len(doc)
            yield pa.record_batch([pa.array(slot), pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(out.tobytes())])],
                                  ["slot", "record"])
        if number != last:
            raise RuntimeError("the two passes saw different rows: docs must be a repeatable scan")
    return kernel


def write_shards(docs: DataFrame, out: str, path: str, pattern: str, length: int = 512, records: int = 16_384, key: int = 11,
                 id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write the shards under ``out`` (shard=K/part-...) and return the number of sequences."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = id_and_text(docs, id_col, text_col)
    counts = sorted((r.part, r.n) for r in docs.select("text").mapInArrow(_count(path, pattern, length), "part int, n long").collect())   # one for each partition
    first, total = {}, 0
    for part, n in counts:
        first[part] = (total, total + n)
        total += n
    if not total:
        return 0
    slots = docs.mapInArrow(_emit(path, pattern, length, first, total, key), "slot long, record binary")
    shards = -(-total // records)
    each = -(-shards // MOST_TASKS)
    padded = F.rpad("record", HEADER + 2 * length, F.lit(END_ID.to_bytes(2, "little")))
    dealt = slots.repartitionById(-(-shards // each), F.floor(F.col("slot") / (records * each)).cast("int"))
    dealt.withColumn("shard", F.floor(F.col("slot") / records)).sortWithinPartitions("shard", "slot").select("shard", padded.cast("string").alias("value")) \
        .write.partitionBy("shard").text(out)
    return total


def _parse(length: int, records: int):
    stride = HEADER + 2 * length + 1

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                raw = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                head = raw[:, :HEADER].copy().view(RECORD).ravel()
                k = np.arange(len(raw))
                sha = [hashlib.sha256(r[HEADER:HEADER + 2 * n]).hexdigest() for r, n in zip(raw, head["n"].tolist(), strict=True)]
                doc = pa.array(head["doc"], mask=head["flags"] == 1)
                yield pa.record_batch([pa.array(shard * records + k), pa.array(np.full(len(k), shard)), pa.array(k * stride), doc, pa.array(head["piece"]), pa.array(head["n"].astype(np.int32)), pa.array(sha, pa.string())],
                                      ["slot", "shard", "byte_offset", "doc_id", "piece", "n_tokens", "ids_sha256"])
    return kernel


def read_shards(spark: SparkSession, out: str, length: int = 512, records: int = 16_384) -> DataFrame:
    """slot, shard, byte_offset, doc_id, piece, n_tokens, ids_sha256 of every record, read from the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema(
        "path string, modificationTime timestamp, length long, content binary, shard long").load(out)
    return files.select("shard", "content").mapInArrow(
        _parse(length, records), "slot long, shard long, byte_offset long, doc_id long, piece int, n_tokens int, ids_sha256 string")


def token_shards(docs: DataFrame, path: str, pattern: str, length: int = 512, records: int = 16_384, key: int = 11,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards into the shared folder and describe every record as read back from them."""
    out = scratch_table(docs.sparkSession, "shards")
    total = write_shards(docs, out, path, pattern, length, records, key, id_col, text_col)
    if total == 0:
        return docs.sparkSession.createDataFrame([], "slot long, shard long, byte_offset long, doc_id long, piece int, n_tokens int, ids_sha256 string")
    return read_shards(docs.sparkSession, out, length, records)
