"""Benchmark decontamination by winnowing.

Every 10-word window of a text holds six 5-word grams; its smallest gram hash
is a fingerprint of the window. Two equal windows have the same smallest gram,
so every shared span of 10 words or more shares a fingerprint. Fingerprints of
training texts are joined with those of the benchmark, hits are extended to
the whole windows around them and the windows are compared. An item of fewer
than 10 words (but not none) is one window of its own length, found by the
n-grams of that length.

The join is a lookup in a broadcast table when the benchmark has at most
``broadcast_windows`` windows (a checked bound), else a shuffled join on the
fingerprints and then on the windows; both give the same rows.

Defined cases: NULL and empty texts have no words; an item without words never
matches; repeated items and rows count as themselves (an item_id that repeats
counts once); empty tables work; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.textcols import ALNUM, U64, as_long, id_and_text, in_sorted, list_array, row_key, row_of, shingles, small_batches, text_slices, words
from demandlab.session import ship_package

WINDOW, GRAM = 10, 5
GRAMS_IN_WINDOW = WINDOW - GRAM + 1
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def fingerprints(h: np.ndarray, woffs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word position: gram hash, whether the gram is a window's minimum, window hash, window valid."""
    n = len(h)
    gram, gram_ok = shingles(h, woffs, GRAM)
    window, window_ok = shingles(h, woffs, WINDOW)
    chosen = np.zeros(n, bool)
    if len(window):
        low = gram[:len(window)].copy()
        for j in range(1, GRAMS_IN_WINDOW):
            np.minimum(low, gram[j:j + len(window)], out=low)
        for j in range(GRAMS_IN_WINDOW):
            chosen[j:j + len(window)] |= (gram[j:j + len(window)] == low) & window_ok
    return gram, chosen, window, window_ok


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id (text), length, window hash and the window's fingerprints, of every item."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            h, woffs = words(buf, offs, ALNUM)
            gram, _, window, ok = fingerprints(h, woffs)
            lengths = np.diff(woffs)
            ids, at = rows.column(0), np.flatnonzero(ok)
            low = np.full(len(at), 2**64 - 1, U64)
            for j in range(GRAMS_IN_WINDOW):
                np.minimum(low, gram[at + j], out=low)
            if len(at):
                yield pa.record_batch([ids.take(pa.array(row_of(woffs, at))), pa.array(np.full(len(at), WINDOW, np.int32)), as_long(window[at]), as_long(low)], ["item", "n", "window", "fp"])
            for i in np.flatnonzero((lengths > 0) & (lengths < WINDOW)):
                one, _ = shingles(h[woffs[i]:woffs[i + 1]], np.array([0, lengths[i]]), int(lengths[i]))
                yield pa.record_batch([ids.slice(i, 1), pa.array([lengths[i]], pa.int32()), as_long(one), as_long(one)], ["item", "n", "window", "fp"])

    items = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("item"),
                             F.coalesce(benchmark[text_col].cast("string"), F.lit("")).alias("text"))
    return items.mapInArrow(kernel, "item string, n int, window long, fp long").distinct()


def _items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _found(h: np.ndarray, woffs: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and table row of every occurrence of a benchmark window."""
    gram, chosen, window, ok = fingerprints(h, woffs)
    at = np.flatnonzero(chosen)
    at = at[in_sorted(table["fp"], gram[at]) >= 0] if len(at) else at
    near = np.unique((at[:, None] - np.arange(GRAMS_IN_WINDOW)[None, :]).ravel()) if len(at) else at
    near = near[(near >= 0) & (near < len(window))]
    near = near[ok[near]]
    k = in_sorted(table["window", WINDOW], window[near]) if len(near) else near
    out = [(near[k >= 0], np.full((k >= 0).sum(), WINDOW), table["row", WINDOW][k[k >= 0]])] if len(near) else []
    for n in table["short"]:
        short, good = shingles(h, woffs, n)
        k = in_sorted(table["window", n], short) if len(short) else np.empty(0, np.int64)
        hit = np.flatnonzero((k >= 0) & good) if len(short) else k
        if len(hit):
            out.append((hit, np.full(len(hit), n), table["row", n][k[hit]]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _counts(woffs: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hit words of each row."""
    edge = np.zeros(woffs[-1] + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return hit[woffs[1:]] - hit[woffs[:-1]]


def _local(table: dict):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        none = _items_digest([])
        for rows, buf, offs in text_slices(batches):
            h, woffs = words(buf, offs, ALNUM)
            start, length, item_row = _found(h, woffs, t)
            m = rows.num_rows
            n_items, sha = np.zeros(m, np.int64), [none] * m
            row = row_of(woffs, start)
            order = np.argsort(row, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(row[order])) + 1) if len(order) else []:
                items = sorted({x for r in np.unique(item_row[part]) for x in t["items"][r]})
                n_items[row[part[0]]], sha[row[part[0]]] = len(items), _items_digest(items)
            n_hit = _counts(woffs, start, length)
            yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(woffs)), pa.array(n_hit), pa.array(n_items), pa.array(sha), pa.array(n_hit > 0)],
                                  ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return kernel


def _table(windows: DataFrame) -> dict:
    """The lookup table on the driver; its size was checked by the caller."""
    by: dict[tuple[int, int], list[str]] = {}
    fps = set()
    for r in windows.collect():
        by.setdefault((r["n"], r["window"]), []).append(r["item"])
        if r["n"] == WINDOW:
            fps.add(r["fp"])
    keys = sorted(by, key=lambda k: (k[0], k[1] % 2**64))
    out = {"items": [sorted(by[k]) for k in keys], "fp": np.sort(np.array(sorted(fps), np.int64).view(U64)), "short": sorted({k[0] for k in keys} - {WINDOW})}
    for n in {k[0] for k in keys} | {WINDOW}:
        at = [i for i, k in enumerate(keys) if k[0] == n]
        out["window", n] = np.array([keys[i][1] for i in at], np.int64).view(U64)
        out["row", n] = np.array(at, np.int64)
    return out


def _scan(lengths: list[int]):
    """Per row key: number of words and, for each fingerprint, the windows around it."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            h, woffs = words(buf, offs, ALNUM)
            gram, chosen, window, ok = fingerprints(h, woffs)
            at = np.flatnonzero(chosen)
            near = (at[:, None] - np.arange(GRAMS_IN_WINDOW)[None, :]).ravel()
            fp = np.repeat(gram[at], GRAMS_IN_WINDOW) if len(at) else np.empty(0, U64)
            good = (near >= 0) & (near < len(window))
            good[good] = ok[near[good]]
            parts = [(near[good], np.full(good.sum(), WINDOW), window[near[good]] if len(window) else fp[:0], fp[good])]
            for n in lengths:
                short, valid = shingles(h, woffs, n)
                s = np.flatnonzero(valid)
                parts.append((s, np.full(len(s), n), short[s], short[s]))
            start, length, win, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
            row = row_of(woffs, start)
            yield pa.record_batch([rows.column("key").take(pa.array(row)), pa.array((start - woffs[row]).astype(np.int64)), pa.array(length.astype(np.int32)), as_long(win.astype(U64)), as_long(fp.astype(U64))], ["key", "start", "n", "window", "fp"])
    return kernel


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offs in text_slices(batches):
        _, woffs = words(buf, offs, ALNUM)
        yield pa.record_batch([rows.column("doc_id"), rows.column("key"), pa.array(np.diff(woffs))], ["doc_id", "key", "n_words"])


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """key, start, n, item of every occurrence, by joins on fingerprints and then on windows."""
    scan = docs.mapInArrow(_scan(lengths), "key binary, start long, n int, window long, fp long")
    near = scan.join(windows.select("fp", "n").distinct(), ["fp", "n"], "left_semi").drop("fp").distinct()
    return near.join(windows.drop("fp").distinct(), ["window", "n"])


def _shuffled(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The same result by joins, for a benchmark too large to broadcast."""
    docs = docs.withColumn("key", row_key())
    hits = _hits(docs, windows, lengths)
    items = hits.select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hit_words = hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("w")).distinct() \
        .groupBy("key").agg(F.count("w").alias("n_hit"))
    base = docs.select("doc_id", "key", "text").mapInArrow(_word_counts, "doc_id long, key binary, n_words long")
    out = base.join(items.join(hit_words, "key"), "key", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"))


def _clean(table: dict, text_col: str):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches, text_col):
            h, woffs = words(buf, offs, ALNUM)
            start, length, _ = _found(h, woffs, table.value)
            yield rows.filter(pa.array(_counts(woffs, start, length) == 0))
    return kernel


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", broadcast_windows: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    windows = item_windows(benchmark, item_col, item_text)
    if windows.count() <= broadcast_windows:
        return docs.mapInArrow(_clean(spark.sparkContext.broadcast(_table(windows)), text_col), docs.schema)
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect() if r["n"] < WINDOW)
    text, ident = F.coalesce(docs[text_col].cast("string"), F.lit("")), docs[id_col].cast("long")
    hit = _hits(id_and_text(docs, id_col, text_col).withColumn("key", row_key()), windows, lengths).select(F.col("key").alias("__key")).distinct()
    return docs.withColumn("__key", row_key(ident, text)).join(hit, "__key", "left_anti").select(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", broadcast_windows: int = 1_000_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    docs = id_and_text(docs, id_col, text_col)
    windows = item_windows(benchmark, item_col, item_text)
    if windows.count() <= broadcast_windows:
        table = spark.sparkContext.broadcast(_table(windows))
        return docs.mapInArrow(_local(table), RESULT)
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect() if r["n"] < WINDOW)
    return _shuffled(docs, windows, lengths)
