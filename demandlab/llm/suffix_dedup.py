"""Substring dedup over a distributed suffix array (difference-cover algorithm).

Removed is each byte covered by a string of ``window`` bytes that starts
anywhere else too. A suffix array over every byte of a corpus would sort as
many rows as there are bytes, so the suffixes sorted here start at positions
chosen by content: a position whose 16-byte gram hash is the least among its
neighbours. They are a difference cover for equal strings: two equal windows hold
the same chosen positions at the same offsets. The bytes between two of them are
a phrase; the text becomes a string of phrase names (hashes).

1. Phrases that occur once can't lie in a repeat and become terminators.
2. ``suffix_ranks`` sorts the suffixes of the name strings with the
   difference-cover scheme modulo 3: name the triples at positions 1 and 2 mod 3
   by their sorted order, recurse on the strings of names, then merge the
   remaining suffixes by (symbol, rank of the next sampled suffix). The recursion ends
   where names cover more phrases than a window and a phrase can hold.
3. Adjacent suffixes are compared: the longest common prefix with a neighbour,
   in whole phrases, tells how far a suffix repeats. That settles every window
   that starts inside a long repeat (repeated) and every window whose inner
   phrases don't repeat in sequence (not repeated).
4. What is left, the windows at the edges of repeats, are suffixes between the
   sampled ones; they are merged with those of one representative of each settled
   class by the hash of their ``window`` bytes, equal neighbours being repeats.
   Hashes that a piece of text has several times are settled there and travel once.

Sorted are distinct keys with their counts, so a phrase that a third of all
rows share is one row of a sort. Which names occur twice, and which classes have
open windows, is told to the tasks by bitmaps of a fixed size (8 MB): a bit set by
another name costs work and changes nothing. Tables are broadcast below checked
sizes only, beyond them they are joined, with the texts that a bitmap of their
keys lets through.

Defined cases: NULL and empty texts have no bytes; equal rows repeat each other;
texts shorter than the window keep all bytes; NULL ids are returned; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.llm.textcols import U64, SpanHash, as_long, id_and_text, in_sorted, list_array, mix, row_of, runs, small, small_batches, text_slices
from demandlab.session import scratch_table, ship_package

GRAM, NEAR = 16, 24
#: Bytes before and after a position that decide whether it is chosen.
BEFORE, AFTER = NEAR, NEAR + GRAM
CELL_BITS = 26
#: Bytes a kernel works on at a time: its arrays stay in the processor's cache.
PIECE = 1 << 18
#: Window hashes that a piece has so many times (2 or more) are settled in it.
HOT_WINDOWS = 2
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# -- phrases

def _gram_hashes(spans: SpanHash) -> np.ndarray:
    """32 bits of a hash of the GRAM bytes from every position that has as many."""
    at = spans.prefix
    h = at[GRAM:] - at[:-GRAM]
    h *= spans.inv[:len(h)]
    h ^= h >> U64(32)
    h *= U64(0xBF58476D1CE4E5B9)
    return (h >> U64(32)).astype(np.uint32)


def chosen(buf: np.ndarray, offs: np.ndarray, spans: SpanHash | None = None) -> np.ndarray:
    """Positions whose gram hash is the least within NEAR positions on both sides, inside one row."""
    m = len(buf) - GRAM + 1
    if m < 2 * NEAR + 1:
        return np.empty(0, np.int64)
    g = _gram_hashes(spans or SpanHash(buf))
    low, width = g, 1
    while 2 * width <= NEAR:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:m - NEAR + 1], low[NEAR - width:NEAR - width + m - NEAR + 1])
    # q from NEAR on: less than all NEAR hashes before it, not more than the NEAR from it on
    q = np.flatnonzero((g[NEAR:m - NEAR] < low[:m - 2 * NEAR]) & (g[NEAR:m - NEAR] <= low[NEAR + 1:m - NEAR + 1])) + NEAR
    row = row_of(offs, q)
    return q[(q - NEAR >= offs[row]) & (q + AFTER <= offs[row + 1])]


def phrases(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and lengths of all phrases of a slice, and the number of them in each row."""
    spans = SpanHash(buf)
    starts = np.union1d(offs[:-1][np.diff(offs) > 0], chosen(buf, offs, spans))
    ends = np.append(starts[1:], len(buf)) if len(starts) else starts
    name = spans(starts, ends) >> U64(1)  # positive: the terminator 0 is the least symbol
    name[name == 0] = 1
    return name, (ends - starts).astype(np.int32), np.diff(np.searchsorted(starts, offs))


def _phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches, most=PIECE):
        name, size, count = phrases(buf, offs)
        yield pa.record_batch([rows.column("doc_id"), rows.column("tid"), list_array(as_long(name), count), list_array(pa.array(size), count)], ["doc_id", "tid", "names", "sizes"])


# -- suffix ranks by the difference-cover scheme

def _cumulate(keys: list[str], counts: list[str]):
    """Running sums of sorted rows within the task, and the task's number."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had, part = dict.fromkeys(counts, 0), TaskContext.get().partitionId()
        for b in batches:
            cols = [b.column(k) for k in keys]
            for c in counts:
                x = b.column(c).to_numpy()
                total = had[c] + np.cumsum(x)
                cols += [b.column(c), pa.array(total - x)]
                had[c] = int(total[-1]) if len(total) else had[c]
            yield pa.record_batch([*cols, pa.array(np.full(b.num_rows, part, np.int64))], [*keys, *(n for c in counts for n in (c, f"{c}_before")), "part"])
    return kernel


def counts_before(rows: DataFrame, keys: list[str], counts: list[str], order: str | None = None) -> DataFrame:
    """Distinct keys with, for each count, its sum over all strictly smaller keys (of the same ``order``)."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    schema = ", ".join([f"{k} long" for k in keys] + [f"{c} long, {c}_before long" for c in counts] + ["part long"])
    path = scratch_table(spark, "order")
    distinct.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInArrow(_cumulate(keys, counts), schema).write.parquet(path)
    got = spark.read.parquet(path)
    up = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = got.groupBy("part").agg(*[F.sum(c).alias(f"{c}_sum") for c in counts]) \
        .select("part", *[(F.sum(f"{c}_sum").over(up) - F.col(f"{c}_sum")).alias(f"{c}_base") for c in counts])
    out = got.join(F.broadcast(parts), "part").select(*keys, *[(F.col(f"{c}_before") + F.col(f"{c}_base")).alias(f"{c}_before") for c in counts])
    if order is None:
        return out
    first = out.groupBy(order).agg(*[F.min(f"{c}_before").alias(f"{c}_first") for c in counts])  # a row for each of three orders
    return out.join(F.broadcast(first), order).select(*keys, *[(F.col(f"{c}_before") - F.col(f"{c}_first")).alias(f"{c}_before") for c in counts])


def _padded(s: np.ndarray, more: int = 3) -> np.ndarray:
    return np.concatenate([s, np.zeros(more, s.dtype)])


def _strings(b: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    col = b.column(name)
    ends = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
    flat = col.flatten().to_numpy()
    for i in range(b.num_rows):
        yield i, flat[ends[i]:ends[i + 1]]


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The triples at positions 1 and 2 mod 3 that don't begin with a terminator."""
    for b in batches:
        own, at, abc = [], [], []
        for i, s in _strings(b, "s"):
            p = np.arange(len(s))
            p = p[(p % 3 > 0) & (s != 0)]
            t = _padded(s)
            own.append(np.full(len(p), i))
            at.append(p)
            abc.append(np.stack([t[p], t[p + 1], t[p + 2]], 1))
        if at:
            abc = np.concatenate(abc)
            own = pa.array(np.concatenate(own))
            yield pa.record_batch([b.column("id").take(own), b.column("code").take(own), pa.array(np.concatenate(at).astype(np.int32)), *(pa.array(np.ascontiguousarray(abc[:, k])) for k in range(3))],
                                  ["id", "code", "i", "a", "b", "c"])


def _lists(col: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Lengths of a list column's rows (NULL: 0) and its entries, one after the other."""
    return col.value_lengths().fill_null(0).to_numpy().astype(np.int64), col.flatten()


def _placed(row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows' arrays that hold ``value`` at place ``at`` and 0 elsewhere: their lengths (0 for rows without entries) and entries."""
    size = np.zeros(n, np.int64)
    np.maximum.at(size, row, at + 1)
    out = np.zeros(int(size.sum()), np.int64)
    out[(np.cumsum(size) - size)[row] + at] = value
    return size, out


def _next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of names at positions 1 mod 3 and at positions 2 mod 3."""
    for b in batches:
        count, named = _lists(b.column("named"))
        row, at, rank = np.repeat(np.arange(b.num_rows), count), named.field("i").to_numpy().astype(np.int64), named.field("rank").to_numpy()
        for k in (1, 2):
            here = at % 3 == k
            size, out = _placed(row[here], at[here] // 3, rank[here], b.num_rows)
            has = pa.array(np.flatnonzero(size))
            yield pa.record_batch([b.column("id").take(has), pa.array(b.column("code").take(has).to_numpy() * 3 + k), list_array(pa.array(out), size[size > 0])], ["id", "code", "s"])


def _merge_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two keys per suffix, each in one of three orders, by its position i mod 3.

    Order 1, (symbol, rank of the next), compares positions 0 and 1 mod 3; order 2,
    (symbol, symbol, rank after them), positions 0 and 2; order 3, the own rank,
    positions 1 and 2. ``a`` counts positions 0, ``b`` the others; ``want`` tells
    which of the smaller ones count for this suffix (1: a, 2: b, 3: both).
    """
    for batch in batches:
        count, flat = _lists(batch.column("s"))
        base = np.concatenate([[0], np.cumsum(count + 3)])   # each row followed by three terminators
        row = np.repeat(np.arange(len(count)), count)
        place = base[row] + np.arange(len(row)) - (np.cumsum(count) - count)[row]
        s, rank = np.zeros(base[-1], np.int64), np.zeros(base[-1], np.int64)
        s[place] = flat.to_numpy()
        n_parts, parts = _lists(batch.column("parts"))
        size, ranks = _lists(parts.field("rank"))
        of, k = np.repeat(np.arange(len(n_parts)), n_parts), parts.field("code").to_numpy() % 3
        step = np.arange(len(ranks)) - np.repeat(np.cumsum(size) - size, size)
        rank[np.repeat(base[of] + k, size) + 3 * step] = ranks.to_numpy()
        live = place[s[place] != 0]
        row = row[s[place] != 0]
        at = live - base[row]
        own, cols = [], []
        for k, order, want in ((0, 1, 3), (0, 2, 2), (1, 3, 2), (1, 1, 1), (2, 3, 2), (2, 2, 1)):
            here = at % 3 == k
            q = live[here]
            key = {1: (s[q], rank[q + 1], 0 * q), 2: (s[q], s[q + 1], rank[q + 2]), 3: (rank[q], 0 * q, 0 * q)}[order]
            own.append(row[here])
            cols.append((at[here], np.full(len(q), order), *key, np.full(len(q), want), np.full(len(q), int(k == 0)), np.full(len(q), int(k > 0))))
        own = pa.array(np.concatenate(own))
        yield pa.record_batch([batch.column("id").take(own), batch.column("code").take(own), *(pa.array(np.concatenate(c)) for c in zip(*cols, strict=True))],
                              ["id", "code", "i", "o", "k1", "k2", "k3", "want", "a", "b"])


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        count, pairs = _lists(b.column("pairs"))
        size, out = _placed(np.repeat(np.arange(b.num_rows), count), pairs.field("i").to_numpy().astype(np.int64), pairs.field("rank").to_numpy(), b.num_rows)
        yield pa.record_batch([b.column("id"), b.column("code"), list_array(pa.array(out), size)], ["id", "code", "rank"])


def _save(df: DataFrame, name: str) -> DataFrame:
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    """id, code, rank (array): ranks of all suffixes of the strings (id, code, s), compared over 3 ** depth symbols.

    Symbols are longs, 0 is a terminator that equals nothing; suffixes that
    begin with it have rank 0. Suffixes that agree over the depth may tie.
    """
    if depth == 0:
        return strings.select("id", "code", F.col("s").alias("rank"))
    triples = _save(strings.mapInArrow(_triples, "id long, code long, i int, a long, b long, c long"), "triples")
    order = counts_before(triples.withColumn("k", F.lit(1)), ["a", "b", "c"], ["k"])
    named = triples.join(order, ["a", "b", "c"]).groupBy("id", "code").agg(F.collect_list(F.struct("i", (F.col("k_before") + 1).alias("rank"))).alias("named"))
    below = suffix_ranks(_save(named.mapInArrow(_next_level, "id long, code long, s array<long>"), "level"), depth - 1)
    parts = below.groupBy("id", F.expr("code div 3").alias("code")).agg(F.collect_list(F.struct("code", "rank")).alias("parts"))
    keys = _save(strings.join(parts, ["id", "code"], "left").mapInArrow(
        _merge_keys, "id long, code long, i long, o long, k1 long, k2 long, k3 long, want long, a long, b long"), "merge")
    on = ["o", "k1", "k2", "k3"]
    before = counts_before(keys, on, ["a", "b"], "o")
    part = F.when(F.col("want") == 1, F.col("a_before")).when(F.col("want") == 2, F.col("b_before")).otherwise(F.col("a_before") + F.col("b_before"))
    ranks = keys.select("id", "code", "i", "want", *on).join(before, on).groupBy("id", "code", "i").agg((F.sum(part) + 1).alias("rank"))
    return ranks.groupBy("id", "code").agg(F.collect_list(F.struct("i", "rank")).alias("pairs")) \
        .mapInArrow(_filled, "id long, code long, rank array<long>")


# -- adjacent prefixes

def _suffix_rows(window: int):
    """Per ranked suffix: its next names as far as a window can reach, and their lengths."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, names = _lists(b.column("s"))
            s, size = names.to_numpy(), b.column("sizes").flatten().to_numpy().astype(np.int32)
            given, ranks = _lists(b.column("rank"))   # may end before its string does
            first = np.cumsum(count) - count
            rank = np.zeros(len(s), np.int64)
            rank[np.repeat(first, given) + np.arange(len(ranks)) - np.repeat(np.cumsum(given) - given, given)] = ranks.to_numpy()
            total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            ends = np.union1d(np.flatnonzero(s == 0), np.append(first, len(s)))
            p = np.flatnonzero(rank)
            stop = np.minimum(np.searchsorted(total, total[p + 1] + window - 1, "left"), ends[np.searchsorted(ends, p, "right")])
            row = np.searchsorted(first, p, "right") - 1
            n = stop - p
            take = np.repeat(p - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.record_batch([b.column("id").take(pa.array(row)), pa.array((p - first[row]).astype(np.int32)), pa.array(rank[p]),
                                   list_array(pa.array(s[take]), n), list_array(pa.array(size[take]), n)], ["id", "i", "rank", "names", "sizes"])
    return kernel


def _matrix(col: pa.ListArray, width: int) -> np.ndarray:
    count = col.value_lengths().to_numpy()
    out = np.zeros((len(col), width), np.int64)
    out[np.arange(width)[None, :] < count[:, None]] = col.flatten().to_numpy()
    return out


def common_bytes(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of the leading phrases in which the rows of two name matrices agree."""
    same = np.cumprod((x == y) & (x != 0), axis=1)
    return (same * size).sum(1)


def _adjacent(window: int):
    """Per suffix: bytes shared with a neighbour, and whether the one before shares all windows of its first phrase.

    The first and the last row of the task carry their names along.
    """
    def out(b, before, after, edge, part):
        first = b.column("sizes").to_pylist()
        need = np.array([x[0] for x in first]) + window - 1
        inner = pa.array(edge == 0)
        return pa.record_batch([b.column("id"), b.column("i"), pa.array(np.maximum(before, after)), pa.array(before >= need), pa.array(edge, pa.int32()), pa.array(np.full(len(edge), part, np.int64)),
                                pc.if_else(inner, pa.scalar(None, b.column("names").type), b.column("names")), pc.if_else(inner, pa.scalar(None, b.column("sizes").type), b.column("sizes"))],
                               ["id", "i", "reach", "skip", "edge", "part", "names", "sizes"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, carried, first = TaskContext.get().partitionId(), None, 0, 1
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.record_batch([pa.concat_arrays([held.column(k), b.column(k)]) for k in b.schema.names], b.schema.names)
            width = max(int(b.column("names").value_lengths().to_numpy().max()), 1)
            names, sizes = _matrix(b.column("names"), width), _matrix(b.column("sizes"), width)
            lcp = common_bytes(names[1:], names[:-1], sizes[1:])
            n = b.num_rows - 1
            if n:
                edge = np.zeros(n, np.int64)
                edge[0] = first
                yield out(b.slice(0, n), np.append(carried, lcp[:-1]), lcp, edge, part)
                first, carried = 0, lcp[-1]
            held = b.slice(n)
        if held is not None:
            yield out(held, np.array([carried]), np.array([0]), np.array([first + 2]), part)
    return kernel


def reaches(strings: DataFrame, window: int, depth: int) -> DataFrame:
    """id, i, reach, skip of the suffixes of strings (id, s, sizes).

    ``reach``: bytes of whole phrases shared with another suffix, as far as the
    windows of the first phrase go; ``skip``: all these windows also start at a
    suffix sorted before.
    """
    spark = strings.sparkSession
    ranked = suffix_ranks(strings.select("id", F.lit(0).cast("long").alias("code"), "s"), depth).select("id", "rank")
    rows = strings.join(ranked, "id").mapInArrow(_suffix_rows(window), "id long, i int, rank long, names array<long>, sizes array<int>")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = _save(rows.repartitionByRange(n, "rank", "id", "i").sortWithinPartitions("rank", "id", "i").mapInArrow(
        _adjacent(window), "id long, i int, reach long, skip boolean, edge int, part long, names array<long>, sizes array<int>"), "adjacent")
    # neighbours across tasks: two rows of each task at most come to the driver
    ends = sorted(got.where("edge > 0").collect(), key=lambda r: (r["part"], r["edge"]))
    fixed = [[r["id"], r["i"], r["reach"], r["skip"]] for r in ends]
    for k, (x, y) in enumerate(pairwise(ends)):
        if x["part"] != y["part"]:
            both = 0
            for a, b, size in zip(x["names"], y["names"], x["sizes"], strict=False):
                if a != b:
                    break
                both += size
            fixed[k][2], fixed[k + 1][2] = max(fixed[k][2], both), max(fixed[k + 1][2], both)
            fixed[k + 1][3] = fixed[k + 1][3] or both >= y["sizes"][0] + window - 1
    cols = ["id", "i", "reach", "skip"]
    return got.where("edge = 0").select(*cols).union(spark.createDataFrame(pa.table(
        [pa.array([x[k] for x in fixed], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.bool_()))], cols)))


# -- windows

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the batches with at most PIECE bytes of text in all, or one longer row alone."""
    for b in batches:
        count, sizes = _lists(b.column("sizes"))
        ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(), dtype=np.int64)])[np.cumsum(count)]
        i = done = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, done + PIECE, "right")))
            yield b.slice(i, j - i)
            i, done = j, int(ends[j - 1])


class Windows:
    """Window starts of the texts of a piece, one text after the other.

    ``offs``: where each text's starts begin; for each start: ``sure`` (repeated),
    ``open``, ``skip`` (left to an equal suffix sorted before), ``key`` (first
    inner phrase, counted over the piece, or -1). ``names`` are the piece's phrases.
    """

    def __init__(self, b: pa.RecordBatch, window: int):
        count, sizes = _lists(b.column("sizes"))
        self.names = b.column("names").flatten().to_numpy()
        sizes, first = sizes.to_numpy().astype(np.int64), np.cumsum(count) - count
        reach, skip = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
        n_found, found = _lists(b.column("found"))
        place = np.repeat(first, n_found) + found.field("i").to_numpy()
        reach[place], skip[place] = found.field("reach").to_numpy(), found.field("skip").to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(sizes)])
        end = at[np.cumsum(count)]
        begin = np.concatenate([[0], end])[:-1]
        n = np.maximum(end - begin - window + 1, 0)
        self.offs = np.concatenate([[0], np.cumsum(n)])
        p = np.repeat(begin - self.offs[:-1], n) + np.arange(self.offs[-1])
        phrase = np.repeat(np.arange(len(sizes)), sizes)   # of every byte
        own = phrase[p]
        # a text's reaches end inside it, so those of the texts before don't count
        self.sure = p + window <= np.maximum.accumulate(at[:-1] + reach)[own] if len(p) else np.zeros(0, bool)
        lo, hi = phrase[p + BEFORE - 1] + 1, phrase[p + window - AFTER]
        has = hi > lo
        self.key = np.where(has, lo, -1)
        lo = np.where(has, lo, 0)
        self.open = ~self.sure
        if len(p):
            self.open &= ~(has & (reach[lo] < at[np.where(has, hi, 0)] - at[lo]))
        self.skip = skip[own]


def _cell(name: np.ndarray) -> np.ndarray:
    return (mix(name.view(U64)) >> U64(64 - CELL_BITS)).astype(np.int64)


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.record_batch([pa.array(np.unique(_cell(b.column("name").to_numpy())))], ["cell"])


def bitmap(cells: DataFrame) -> np.ndarray:
    """2 ** CELL_BITS bits as longs, those of the given cells set: as large for any number of cells."""
    words = cells.groupBy(F.shiftright("cell", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(1 << CELL_BITS - 6, np.int64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out


def in_bitmap(bits: np.ndarray, name: np.ndarray) -> np.ndarray:
    cell = _cell(name)
    return (bits[cell >> 6] >> (cell & 63)) & 1 > 0


def _open_cells(window: int):
    """Cells of the inner phrases of open windows."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            w = Windows(b, window)
            wanted = np.zeros(len(w.names), bool)
            wanted[w.key[w.open & (w.key >= 0)]] = True
            yield pa.record_batch([pa.array(np.unique(_cell(w.names[wanted])))], ["cell"])
    return kernel


def _ranges(mask: np.ndarray, offs: np.ndarray) -> list[pa.ListArray]:
    """Starts and ends of the runs of each text, counted from its begin."""
    a, b = runs(mask, offs)
    count = np.diff(np.searchsorted(a, offs))
    base = np.repeat(offs[:-1], count)
    return [list_array(pa.array((x - base).astype(np.int32)), count) for x in (a, b)]


def _plan(window: int, cells):
    """Ranges of window starts of each text: repeated, to be hashed, and open."""
    names = ["tid", "lead", "whole", "sure_a", "sure_b", "hash_a", "hash_b", "open_a", "open_b"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = cells.value
        for b in _pieces(batches):
            w = Windows(b, window)
            whole = np.repeat(b.column("whole").to_numpy(zero_copy_only=False), np.diff(w.offs))
            need = w.key < 0
            need[~need] = in_bitmap(wanted, w.names)[w.key[~need]]
            open_ = w.open & ~whole
            emit = open_ | (w.sure & ~w.skip | w.open) & need
            out = pa.record_batch([b.column("tid"), b.column("lead"), b.column("whole"), *_ranges(w.sure | whole, w.offs), *_ranges(emit, w.offs), *_ranges(open_, w.offs)], names)
            size = [out.column(k).value_lengths().to_numpy() for k in ("sure_a", "hash_a")]
            yield out.filter(pa.array(size[0] + size[1] > 0))
    return kernel


def _within(a: pa.ListArray, b: pa.ListArray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slice positions inside the ranges of each row, and the row of each."""
    count = a.value_lengths().fill_null(0).to_numpy()
    row = np.repeat(np.arange(len(count)), count)
    a, b = a.flatten().to_numpy().astype(np.int64), b.flatten().to_numpy().astype(np.int64)
    size = b - a
    at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
    row = np.repeat(row, size)
    return at + offs[row], row


def _windows(window: int, hot: int):
    """Hashes of the windows to be compared, with how often they start (``c``), and the ``n`` open windows from ``p`` on of text ``t`` (-1: none).

    A hash that occurs ``hot`` times in the piece sends one row without windows; its open
    windows are known to be repeated and travel as runs under keys of their own.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, most=PIECE):
            at, row = _within(rows.column("hash_a"), rows.column("hash_b"), offs)
            open_ = np.zeros(len(buf), bool)
            open_[_within(rows.column("open_a"), rows.column("open_b"), offs)[0]] = True
            t, times = rows.column("t").to_numpy(), 1 + rows.column("whole").to_numpy(zero_copy_only=False).astype(np.int64)
            h, back = np.unique(SpanHash(buf)(at, at + window), return_inverse=True)
            many = np.bincount(back, times[row], len(h)) >= hot
            known = np.zeros(len(buf), bool)
            known[at[many[back]]] = True
            a, b = runs(known & open_, offs)
            of = row_of(offs, a)
            at, row, back = (x[~many[back]] for x in (at, row, back))
            p, none = at - offs[row], np.zeros(many.sum(), np.int64)
            key = np.concatenate([h[back], h[many], mix(mix(t[of].view(U64)) ^ (a - offs[of]).view(U64))])
            columns = (key.view(np.int64), np.concatenate([p, none, a - offs[of]]).astype(np.int32), np.concatenate([np.where(open_[at], t[row], -1), none - 1, t[of]]),
                       np.concatenate([p * 0 + 1, none, b - a]).astype(np.int32), np.concatenate([times[row], none + 2, a * 0 + 2]).astype(np.int32))
            yield pa.record_batch([pa.array(x) for x in columns], ["key", "p", "t", "n", "c"])
    return kernel


def _covers(window: int):
    """Removed bytes of each text, as the fewest ranges."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, a, b = [], [], []
            count, sure = _lists(batch.column("sure_a"))
            row.append(np.repeat(np.arange(batch.num_rows), count))
            a.append(sure.to_numpy())
            b.append(batch.column("sure_b").flatten().to_numpy())
            count, more = _lists(batch.column("more"))
            row.append(np.repeat(np.arange(batch.num_rows), count))
            a.append(more.field("p").to_numpy())
            b.append(more.field("p").to_numpy() + more.field("n").to_numpy())
            base = np.concatenate(row) << 33   # texts are shorter
            a, b = base + np.concatenate(a), base + np.concatenate(b) + window - 1
            order = np.argsort(a)
            a, b = a[order], np.maximum.accumulate(b[order])
            first = np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), bool), a[1:] > b[:-1]]))
            last = np.append(first[1:], len(a)) - 1 if len(a) else first
            row, count = a[first] >> 33, np.bincount(a[first] >> 33, minlength=batch.num_rows)
            yield pa.record_batch([batch.column("tid"), *(list_array(pa.array((x - (row << 33)).astype(np.int32)), count) for x in (a[first], b[last]))], ["tid", "a", "b"])
    return kernel


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches, most=PIECE):
        edge = np.zeros(len(buf) + 1, np.int64)
        for k, step in (("a", 1), ("b", -1)):
            count, at = _lists(rows.column(k))
            np.add.at(edge, at.to_numpy() + np.repeat(offs[:-1], count), step)
        gone = np.cumsum(edge[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        spans = np.searchsorted(runs(gone, offs)[0], offs)
        kept = [hashlib.sha256(buf[x:y][~gone[x:y]].tobytes()).hexdigest() for x, y in pairwise(offs)]
        yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(offs)), pa.array(total[offs[1:]] - total[offs[:-1]]), pa.array(np.diff(spans)), pa.array(kept, pa.string())],
                              ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


# -- the operator

def useful(again: np.ndarray, sizes: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """Which phrases lie, with only repeated ones, inside some window of their text (``count`` phrases each); no other can lie in a repeat."""
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    end = at[np.cumsum(count)]
    begin = np.concatenate([[0], end])[:-1]
    text = np.repeat(np.arange(len(count)), count)
    inner = at[:-1][at[:-1] > begin[text]]
    of = text[at[:-1] > begin[text]]
    # the inner phrases of a window change only where a boundary comes in or goes out
    p = np.concatenate([begin, end - window, *(inner + d for d in (-BEFORE, 1 - BEFORE, AFTER - window, AFTER - window - 1))])
    of = np.concatenate([np.arange(len(count)), np.arange(len(count)), of, of, of, of])
    p = p[(p >= begin[of]) & (p + window <= end[of])]
    lo = np.searchsorted(at, p + BEFORE - 1, "right")
    hi = np.searchsorted(at, p + window - AFTER, "right") - 1
    seen = np.concatenate([[0], np.cumsum(again)])
    good = (hi > lo) & (seen[np.maximum(hi, lo)] - seen[lo] == np.maximum(hi, lo) - lo)
    edge = np.zeros(len(sizes) + 1, np.int64)
    np.add.at(edge, lo[good], 1)
    np.add.at(edge, hi[good], -1)
    return np.cumsum(edge[:-1]) > 0


def _mark(names, window: int):
    """Strings with terminators for phrases that lie in no repeat; ``some`` tells whether others are left.

    A text without any, of short phrases only and not repeated itself drops out: it has an
    inner phrase in every window, so nothing is repeated or open.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = names.value
        for b in batches:
            count, flat = _lists(b.column("names"))
            flat, sizes = flat.to_numpy(), b.column("sizes").flatten().to_numpy()
            row = np.repeat(np.arange(len(count)), count)
            flat = np.where(useful(in_bitmap(bits, flat), sizes, count, window), flat, 0)
            some = np.bincount(row, flat != 0, len(count)) > 0
            wide = np.bincount(row, sizes > (window - BEFORE - AFTER) // 2, len(count)) > 0
            out = pa.record_batch([*b.columns, list_array(pa.array(flat), count), pa.array(some)], [*b.schema.names, "s", "some"])
            yield out.filter(pa.array(some | wide | b.column("whole").to_numpy(zero_copy_only=False)))
    return kernel


def _strings_of(one: DataFrame, window: int) -> DataFrame:
    """The texts that may hold repeated or open windows, with their strings (``s``).

    Repeated names set bits of a bitmap of fixed size; a phrase that occurs once
    and meets such a bit stays in its string, where it equals nothing.
    """
    again = one.select(F.explode("names").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("name")
    bits = one.sparkSession.sparkContext.broadcast(bitmap(again.mapInArrow(_cells_of, "cell long")))
    return one.mapInArrow(_mark(bits, window), "id long, tid binary, lead long, whole boolean, names array<long>, sizes array<int>, s array<long>, some boolean")


def _may_hold(table: DataFrame) -> Column:
    """Whether a row's ``tid`` may be one of the table, told by a bitmap of its keys."""
    bits = table.sparkSession.sparkContext.broadcast(bitmap(table.select(F.xxhash64("tid").alias("name")).mapInArrow(_cells_of, "cell long")))

    @F.pandas_udf("boolean")
    def held(name: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, name.to_numpy()))
    return held(F.xxhash64("tid"))


def _meeting(docs: DataFrame, table: DataFrame, most: int, weight: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The documents to be joined with the table, the table, and the documents that stay out of a join that shuffles texts."""
    if (table.agg(F.sum(F.expr(weight))).first()[0] or 0) <= most:
        return docs, F.broadcast(table), None
    held = _may_hold(table)
    return docs.where(held), table, docs.where(~held)


def suffix_dedup(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text",
                 broadcast_most: int = 1_000_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    depth = 1
    while 3**depth * (NEAR + 1) < window + 2 * (NEAR + 1):
        depth += 1
    docs = id_and_text(docs, id_col, text_col).withColumn("tid", F.unhex(F.md5("text")))
    path = scratch_table(spark, "phrases")
    docs.select("doc_id", "tid", "text").mapInArrow(_phrase_rows, "doc_id long, tid binary, names array<long>, sizes array<int>") \
        .withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
    table = spark.read.parquet(path)
    # equal texts are one text that occurs several times
    twice = _save(table.groupBy("tid").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("first")).where("c > 1").select("tid", "first"), "copies")
    one = table.join(small(twice, broadcast_most), "tid", "left").where("first is null or id = first") \
        .select("id", "tid", F.col("doc_id").alias("lead"), F.col("first").isNotNull().alias("whole"), "names", "sizes")

    kept = _save(_strings_of(one, window), "strings")
    found = reaches(kept.where("some").select("id", "s", "sizes"), window, depth).groupBy("id").agg(F.collect_list(F.struct("i", "reach", "skip")).alias("found"))
    known = _save(kept.drop("s", "some").join(found, "id", "left"), "reaches")
    # see _mark; strings may hold names met by other bits only
    known = known.where(F.col("whole") | F.col("found").isNotNull() | (F.array_max("sizes") > (window - BEFORE - AFTER) // 2))
    cells = known.where("not whole").select("names", "sizes", "found").mapInArrow(_open_cells(window), "cell long")
    wanted = spark.sparkContext.broadcast(bitmap(cells))
    plan = _save(known.mapInArrow(_plan(window, wanted), "tid binary, lead long, whole boolean, sure_a array<int>, sure_b array<int>, "
                                  "hash_a array<int>, hash_b array<int>, open_a array<int>, open_b array<int>")
                 .withColumn("t", F.monotonically_increasing_id()), "plan")

    ranges = plan.where("size(hash_a) > 0").select("tid", "lead", "whole", "t", "hash_a", "hash_b", "open_a", "open_b")
    held, ranges, _ = _meeting(docs, ranges, broadcast_most, "size(hash_a) + size(open_a)")
    hashes = held.join(ranges, "tid").where(F.col("doc_id").eqNullSafe(F.col("lead"))).select("text", "whole", "t", "hash_a", "hash_b", "open_a", "open_b") \
        .mapInArrow(_windows(window, HOT_WINDOWS), "key long, p int, t long, n int, c int")
    again = hashes.withColumn("times", F.sum("c").over(Window.partitionBy("key"))).where("times > 1 and t >= 0")
    more = again.groupBy("t").agg(F.collect_list(F.struct("p", "n")).alias("more"))
    cover = _save(plan.select("tid", "t", "sure_a", "sure_b").join(more, "t", "left").where("size(sure_a) > 0 or more is not null")
                  .mapInArrow(_covers(window), "tid binary, a array<int>, b array<int>"), "cover")
    held, cover, rest = _meeting(docs, cover, broadcast_most, "size(a)")
    out = held.join(cover, "tid", "left").select("doc_id", "text", "a", "b")
    if rest is not None:
        none = F.lit(None).cast("array<int>")
        out = out.union(rest.select("doc_id", "text", none.alias("a"), none.alias("b")))
    return out.mapInArrow(_result, RESULT)
