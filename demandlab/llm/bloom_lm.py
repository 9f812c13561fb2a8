"""Language-model scoring with a log-frequency Bloom filter.

Training tokens give word counts, bigram counts and, per word, the number of
different followers. Each count c is quantised to a class 1 + floor(log_b c);
an n-gram of class q puts the events (n-gram, 1) .. (n-gram, q) into a Bloom
filter. A count is read back by probing (n-gram, 1), (n-gram, 2), ... until a
probe misses, so a count is never read too small. The filter is broadcast and
each token's probability comes from such probes, Witten-Bell smoothed:

    P(w)     = (c(w) + 1) / (N + V + 1)
    P(w | v) = (c(v w) + T(v) P(w)) / (c(v) + T(v))

The filter is a set of segments, an n-gram's segment follows from its hash, so
a segment is built in one task from the rows shuffled to it and nothing else.
Inside a segment a pair is told by 40 bits of its hash, as is its first word:
a collision is far rarer than the filter's own false positives.
Segments hold every n-gram and grow with the counts. Up to ``filter_bytes`` in
all they are broadcast. Beyond it the probes travel instead: each slice of text
sends its distinct n-grams once to the tasks that hold their segments and gets
a class for each one back, so scores are the same on both ways.

The base score needs exact counts: words of the ``exact_entries`` most
frequent ones are looked up in a broadcast table, all others are joined with
the written table of counts.

Defined cases: a NULL text is empty and has the end token only; a NULL id is
never held out; repeated rows count each; without training tokens N = V = 0;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.textcols import U64, as_long, buffers, id_and_text, in_sorted, list_array, mix, row_of, small_batches, text_slices, words
from demandlab.session import scratch_table, ship_package

END, START = U64(0x5BF03635A0C7D1E1), U64(0x3C6EF372FE94F82B)
PAIR, FOLLOW = U64(0x9FB21C651E98DF25), U64(0xC2B2AE3D27D4EB4F)
HASHES, BITS_PER_EVENT = 5, 8
#: Base of the count classes: fine for words and followers, coarser for pairs.
WORD_BASE, PAIR_BASE = 1.25, 1.6
TOKENS_PER_SEGMENT = 1_500_000
COMBINE = 1_500_000
#: Bits of a hash that a segment doesn't keep.
SHORT = U64(24)
#: Where probes travel: text of a slice, and segments that share a task.
PROBE_BYTES, SEGMENTS_PER_TASK = 4 << 20, 16


def classes(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(base) + 1e-9).astype(np.int64)


def class_value(q: np.ndarray, base: float) -> np.ndarray:
    """The count a class stands for: the middle of the whole counts in it, 0 for class 0."""
    low, high = np.ceil(base ** (q - 1) - 1e-9), np.maximum(np.ceil(base**q - 1e-9) - 1, 1)
    return np.where(q > 0, (low + np.maximum(high, low)) / 2, 0.0)


def _bits(key: np.ndarray, event: int, size: int) -> Iterator[np.ndarray]:
    h = mix(key + U64(event * 0x9E3779B97F4A7C15 % 2**64))
    step = mix(h) | U64(1)
    for _ in range(HASHES):
        yield (h % U64(size)).astype(np.int64)
        h = h + step


def build_segment(key: np.ndarray, q: np.ndarray, most_bytes: int | None = None) -> np.ndarray:
    """The packed bits of one segment; with ``most_bytes``, classes that don't fit are left out from below."""
    per_class = np.bincount(q, minlength=2) * np.arange(max(len(np.bincount(q)), 2))
    least = 1
    while most_bytes is not None and per_class[least:].sum() * BITS_PER_EVENT > most_bytes * 8 and least < len(per_class):
        least += 1
    key, q = key[q >= least], q[q >= least]
    size = max(64, -(-int(q.sum()) * BITS_PER_EVENT // 64) * 64)
    bits = np.zeros(size, bool)
    for event in range(1, int(q.max(initial=0)) + 1):
        for at in _bits(key[q >= event], event, size):
            bits[at] = True
    return np.packbits(bits)


class Filter:
    """Segments of packed bits; ``probe`` reads the class of each n-gram."""

    def __init__(self, segments: list[np.ndarray]):
        self.sizes = np.array([8 * len(s) for s in segments], np.int64)
        self.base = np.concatenate([[0], np.cumsum([len(s) for s in segments])])[:-1] * 8
        self.bits = np.concatenate(segments) if segments else np.empty(0, np.uint8)

    def _has(self, key: np.ndarray, seg: np.ndarray, event: int) -> np.ndarray:
        h = mix(key + U64(event * 0x9E3779B97F4A7C15 % 2**64))
        step = mix(h) | U64(1)
        alive = np.arange(len(key))
        size, base = self.sizes[seg].astype(U64), self.base[seg]
        for _ in range(HASHES):
            at = base[alive] + (h[alive] % size[alive]).astype(np.int64)
            alive = alive[(self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
            h = h + step
        out = np.zeros(len(key), bool)
        out[alive] = True
        return out

    def probe(self, key: np.ndarray, seg: np.ndarray) -> np.ndarray:
        q = np.zeros(len(key), np.int64)
        if not len(self.sizes):
            return q
        left, event = np.arange(len(key)), 1
        while len(left):
            left = left[self._has(key[left], seg[left], event)]
            q[left] = event
            event += 1
        return q


def segment(key: np.ndarray, n: int) -> np.ndarray:
    return (mix(key) % U64(n)).astype(np.int64)


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, each row closed by its end token, and the row offsets."""
    h, woffs = words(buf, offs)
    n = len(offs) - 1
    out = np.empty(len(h) + n, U64)
    ends = woffs[1:] + np.arange(n)
    out[ends] = END
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word] = h
    return out, woffs + np.arange(n + 1)


def before(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    prev = np.empty_like(h)
    prev[1:] = h[:-1]
    prev[offs[:-1]] = START
    return prev


def _pairs(prev: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(prev * PAIR + h)


def _combined(arrays: list[tuple]) -> list[np.ndarray]:
    """Sums of the last column by the first; the columns between follow the first."""
    cols = [np.concatenate(x) for x in zip(*arrays, strict=True)]
    key, first, back = np.unique(cols[0], return_index=True, return_inverse=True)
    return [key, *(c[first] for c in cols[1:-1]), np.bincount(back, cols[-1], len(key)).astype(np.int64)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for _, buf, offs in text_slices(batches):
        key, c = np.unique(tokens(buf, offs)[0], return_counts=True)
        held.append((key, c))
        n += len(key)
        if n > COMBINE:
            held = [tuple(_combined(held))]
            n = len(held[0][0])
            if n > COMBINE // 2:
                yield pa.record_batch([as_long(held[0][0]), pa.array(held[0][1])], ["h", "c"])
                held, n = [], 0
    if held:
        key, c = _combined(held)
        yield pa.record_batch([as_long(key), pa.array(c)], ["h", "c"])


def _pack(key: np.ndarray, prev: np.ndarray, c: np.ndarray) -> bytes:
    """Columns of 40-bit keys, 40-bit first words and 16-bit counts; larger counts take several entries."""
    parts = -(-c // 0xFFFF)
    key, prev = np.repeat(key, parts), np.repeat(prev, parts)
    left = np.repeat(c, parts) - 0xFFFF * (np.arange(len(key)) - np.repeat(np.cumsum(parts) - parts, parts))
    return b"".join([(key >> U64(8)).astype("<u4").tobytes(), key.astype(np.uint8).tobytes(), (prev >> U64(8)).astype("<u4").tobytes(), prev.astype(np.uint8).tobytes(),
                     np.minimum(left, 0xFFFF).astype("<u2").tobytes()])


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(blob) // 12
    at = lambda kind, start: np.frombuffer(blob, kind, n, start * n)
    return at("<u4", 0).astype(U64) << U64(8) | at("u1", 4), at("<u4", 5).astype(U64) << U64(8) | at("u1", 9), at("<u2", 10).astype(np.int64)


def _count_pairs(segments: int):
    def out(held):
        key, prev, c = _combined(held)
        seg = segment(key, segments)
        order = np.argsort(seg, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(seg[order])) + 1)
        return pa.record_batch([pa.array([int(seg[x[0]]) for x in parts], pa.int32()), pa.array([_pack(key[x] >> SHORT, prev[x] >> SHORT, c[x]) for x in parts], pa.binary())], ["seg", "pairs"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, buf, offs in text_slices(batches):
            h, toffs = tokens(buf, offs)
            if not len(h):
                continue
            prev = before(h, toffs)
            key, first, c = np.unique(_pairs(prev, h), return_index=True, return_counts=True)
            held.append((key, prev[first], c))
            n += len(key)
            if n > COMBINE:
                yield out(held)
                held, n = [], 0
        if held:
            yield out(held)
    return kernel


def _pair_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment: its bits, and for each first word the different followers seen here."""
    got: dict[int, list] = {}
    for b in batches:
        for seg, blob in zip(b.column("seg").to_pylist(), b.column("pairs").to_pylist(), strict=True):
            got.setdefault(seg, []).append(blob)
    for s in list(got):
        key, prev, c = _combined([_unpack(blob) for blob in got.pop(s)])
        bits = build_segment(key, classes(c, PAIR_BASE))
        word, follow = np.unique(prev, return_counts=True)
        yield pa.record_batch([pa.array([s], pa.int32()), pa.array([bits.tobytes()]), pa.array([None], pa.int64()), pa.array([None], pa.int64())], ["seg", "bits", "v", "t"])
        m = len(word)
        yield pa.record_batch([pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), as_long(word), pa.array(follow)], ["seg", "bits", "v", "t"])


def _by_segment(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """All rows of each segment of the task."""
    got: dict[int, list] = {}
    for b in batches:
        seg = b.column("seg").to_numpy()
        cols = [b.column(x).to_numpy() for x in names]
        order = np.argsort(seg, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(seg[order])) + 1) if len(order) else []:
            got.setdefault(int(seg[part[0]]), []).append(tuple(c[part] for c in cols))
    for s in list(got):
        yield s, [np.concatenate(x) for x in zip(*got.pop(s), strict=True)]


def _word_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for s, (h, c) in _by_segment(batches, ["h", "c"]):
        bits = build_segment(h.view(U64), classes(c, WORD_BASE))
        yield pa.record_batch([pa.array([s], pa.int32()), pa.array([bits.tobytes()])], ["seg", "bits"])


def _probes(h: np.ndarray, offs: np.ndarray) -> tuple:
    """Distinct words, their keys as first words, distinct pairs, and where each token finds its own."""
    prev = before(h, offs)
    word, back = np.unique(np.concatenate([h, prev]), return_inverse=True)
    pair, where = np.unique(_pairs(prev, h), return_inverse=True)
    return word, (word >> SHORT) * FOLLOW, pair >> SHORT, back[:len(h)], back[len(h):], where


def log_probability(h: np.ndarray, offs: np.ndarray, model: dict, read=None) -> np.ndarray:
    """log10 P of each token given the one before it, by probes of the filter or of the classes ``read``."""
    word, short, pair, here, there, where = _probes(h, offs)
    if read is None:
        at = in_sorted(model["keys"], word)
        known, other = at >= 0, at < 0
        read = []
        for key, top in ((word, model["top_words"]), (short, model["top_follow"])):
            q = np.empty(len(key), np.int64)
            q[known], q[other] = top[at[known]], model["words"].probe(key[other], segment(key[other], model["few"]))
            read.append(q)
        read.append(model["pairs"].probe(pair, segment(pair, model["segments"])))
    count, follow = class_value(read[0], WORD_BASE), class_value(read[1], WORD_BASE)
    single = (count + 1) / (model["n"] + model["v"] + 1)
    both = class_value(read[2], PAIR_BASE)[where]
    t, c = follow[there], np.maximum(count[there], both)
    p = np.where(t > 0, (both + t * single[here]) / np.maximum(c + t, 1), single[here])
    return np.log10(np.minimum(p, 1.0))


SCORES = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rest array<long>"


def _scored(ids: pa.Array, held_out: pa.Array, h: np.ndarray, toffs: np.ndarray, m: dict, read=None) -> pa.RecordBatch:
    n = len(ids)
    row = row_of(toffs, np.arange(len(h)))
    score = np.bincount(row, log_probability(h, toffs, m, read), n).astype(np.float64)
    at = in_sorted(m["keys"], h)
    known = at >= 0
    base = np.bincount(row[known], np.log10(m["counts"][at[known]] + 1.0), n).astype(np.float64)
    return pa.record_batch([ids, held_out, pa.array(np.diff(toffs)), pa.array(np.bincount(row[known], minlength=n)), pa.array(base),
                            pa.array(score), list_array(as_long(h[~known]), np.bincount(row[~known], minlength=n))], ["doc_id", "held_out", "n_tokens", "known", "base", "score", "rest"])


def _score(shared):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            h, toffs = tokens(buf, offs)
            yield _scored(rows.column("doc_id"), rows.column("held_out"), h, toffs, shared.value)
    return kernel


# -- probes that travel to their segments

def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slice of text: the ids, marks and texts of its rows."""
    for rows, _, _ in text_slices(batches, most=PROBE_BYTES):
        one = np.array([rows.num_rows])
        yield pa.record_batch([list_array(rows.column(x), one) for x in ("doc_id", "held_out", "text")], ["ids", "marks", "texts"])


def _slice_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b, i, *tokens(*buffers(b.column("texts").slice(i, 1).flatten()))


def _asked(h: np.ndarray, toffs: np.ndarray, few: int, segments: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, task, positions among the distinct probes, keys): words, first words and pairs of a slice."""
    for kind, (key, n) in enumerate(zip(_probes(h, toffs)[:3], (few, few, segments), strict=True)):
        task = segment(key, n) // SEGMENTS_PER_TASK
        order = np.argsort(task, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(task[order])) + 1) if len(order) else []:
            yield kind, int(task[part[0]]), part, key[part]


def _ask(few: int, segments: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, h, toffs in _slice_tokens(batches):
            got = [(kind, task, key) for kind, task, _, key in _asked(h, toffs, few, segments)]
            # pairs are 40 bits wide
            keys = [key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5 if kind == 2 else 8].tobytes() for kind, _, key in got]
            m = len(got)
            yield pa.record_batch([pa.array([int(kind == 2) for kind, _, _ in got], pa.int32()), pa.array([t for _, t, _ in got], pa.int32()), pa.nulls(m, pa.int32()), pa.array([b.column("slice")[i].as_py()] * m, pa.int64()),
                                   pa.array([kind for kind, _, _ in got], pa.int32()), pa.array(keys, pa.binary())], ["pairs", "task", "seg", "slice", "kind", "blob"])
    return kernel


def _answer(few: int, segments: int):
    """Rows sorted by (pairs, task, slice), segments first: the classes of the keys asked for, in their order."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, filt = None, {}, None
        for b in batches:
            for which, task, seg, sl, kind, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (which, task) != at:
                    at, held, filt = (which, task), {}, None
                if sl is None:
                    held[seg % SEGMENTS_PER_TASK] = np.frombuffer(blob, np.uint8)
                    continue
                if filt is None:
                    filt = Filter([held.get(j, np.zeros(8, np.uint8)) for j in range(SEGMENTS_PER_TASK)])
                width = 5 if kind == 2 else 8
                wide = np.zeros((len(blob) // width, 8), np.uint8)
                wide[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
                key = wide.view("<u8").ravel().astype(U64)
                q = filt.probe(key, segment(key, segments if which else few) % SEGMENTS_PER_TASK)
                yield pa.record_batch([pa.array([sl], pa.int64()), pa.array([kind], pa.int32()), pa.array([task], pa.int32()), pa.array([q.astype("<u2").tobytes()], pa.binary())], ["slice", "kind", "task", "classes"])
    return kernel


def _score_read(shared):
    """Rows (slice, ids, marks, texts, got): scores by the classes that came back."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b, i, h, toffs in _slice_tokens(batches):
            back = {(g["kind"], g["task"]): g["classes"] for g in b.column("got")[i].as_py() or []}
            read = [np.zeros(len(x), np.int64) for x in _probes(h, toffs)[:3]]
            for kind, task, part, _ in _asked(h, toffs, m["few"], m["segments"]):
                read[kind][part] = np.frombuffer(back[kind, task], "<u2")
            yield _scored(b.column("ids").slice(i, 1).flatten(), b.column("marks").slice(i, 1).flatten(), h, toffs, m, read)
    return kernel


def _score_by_shuffle(docs: DataFrame, model: dict, pair_bits: DataFrame, word_bits: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_table(spark, "slices")
    docs.mapInArrow(_slices, "ids array<long>, marks array<boolean>, texts array<string>") \
        .withColumn("slice", F.monotonically_increasing_id()).write.parquet(path)
    slices = spark.read.parquet(path)
    few, segments = model["few"], model["segments"]
    schema = "pairs int, task int, seg int, slice long, kind int, blob binary"
    bits = [df.select(F.lit(k).alias("pairs"), F.floor(F.col("seg") / SEGMENTS_PER_TASK).cast("int").alias("task"), "seg", F.lit(None).cast("long").alias("slice"),
                      F.lit(None).cast("int").alias("kind"), F.col("bits").alias("blob")) for k, df in enumerate((word_bits, pair_bits))]
    asked = slices.select("slice", "texts").mapInArrow(_ask(few, segments), schema)
    tasks = segments // SEGMENTS_PER_TASK + few // SEGMENTS_PER_TASK + 2
    got = bits[0].union(bits[1]).union(asked).repartition(tasks, "pairs", "task").sortWithinPartitions("pairs", "task", F.col("slice").asc_nulls_first()) \
        .mapInArrow(_answer(few, segments), "slice long, kind int, task int, classes binary")
    back = got.groupBy("slice").agg(F.collect_list(F.struct("kind", "task", "classes")).alias("got"))
    return slices.join(back, "slice", "left").select("ids", "marks", "texts", "got").mapInArrow(_score_read(spark.sparkContext.broadcast(model)), SCORES)


def train(docs: DataFrame, exact_entries: int) -> tuple[dict, DataFrame, DataFrame, DataFrame]:
    """The model without its segments, the written table of exact word counts (h, c), the segments (seg, bits) of pairs and of words."""
    spark = docs.sparkSession
    texts = docs.where(~F.col("held_out")).select("text")
    path = scratch_table(spark, "words")
    texts.mapInArrow(_count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).write.parquet(path)
    counts = spark.read.parquet(path)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("h")).first()
    starts = counts.where(F.col("h") == int(END.view(np.int64))).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]

    segments = n // TOKENS_PER_SEGMENT + 1
    pairs = scratch_table(spark, "pairs")
    texts.mapInArrow(_count_pairs(segments), "seg int, pairs binary").repartition(segments, "seg") \
        .mapInArrow(_pair_segments, "seg int, bits binary, v long, t long").write.parquet(pairs)
    made = spark.read.parquet(pairs)
    follow = made.where("v is not null").groupBy("v").agg(F.sum("t").alias("c"))

    few = segments // 4 + 1
    events = counts.union(spark.createDataFrame([(int(START.view(np.int64)), int(starts))], "h long, c long")).where("c > 0").mapInArrow(_keyed(few, U64(1)), "seg int, h long, c long") \
        .union(follow.select(F.col("v").alias("h"), "c").mapInArrow(_keyed(few, FOLLOW), "seg int, h long, c long"))
    path = scratch_table(spark, "word_segments")
    events.repartition(few, "seg").mapInArrow(_word_segments, "seg int, bits binary").write.parquet(path)

    per_count = counts.groupBy("c").agg(F.count("h").alias("m"))
    least = _least_count(per_count, exact_entries)
    top = counts.where(F.col("c") >= least).toPandas()
    keys = top["h"].to_numpy(np.int64).view(U64)
    order = np.argsort(keys)
    model = {"n": n, "v": v, "segments": segments, "few": few, "least": least, "keys": keys[order], "counts": top["c"].to_numpy(np.int64)[order].astype(np.float64)}
    return model, counts, made.where("bits is not null").select("seg", "bits"), spark.read.parquet(path)


def _keyed(n: int, salt: np.uint64):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy().view(U64) * salt
            yield pa.record_batch([pa.array(segment(h, n).astype(np.int32)), as_long(h), b.column("c")], ["seg", "h", "c"])
    return kernel


def _segments(made: DataFrame, n: int) -> Filter:
    """The segments on the driver; their sum has been checked."""
    parts = [np.zeros(8, np.uint8)] * n
    for r in made.toLocalIterator():
        parts[r["seg"]] = np.frombuffer(r["bits"], np.uint8)
    return Filter(parts)


def _least_count(per_count: DataFrame, entries: int) -> int:
    """The smallest count c such that at most ``entries`` words have c or more."""
    rows = per_count.withColumn("k", F.floor(F.log2("c") * 8)).groupBy("k").agg(F.min("c").alias("c"), F.sum("m").alias("m")).orderBy(F.desc("k")).collect()
    total, least = 0, 2**63 - 1
    for r in rows:
        total += r["m"]
        if total > entries:
            return least
        least = r["c"]
    return 1


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
              filter_bytes: int = 96 << 20, exact_entries: int = 250_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    docs = id_and_text(docs, id_col, text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model, counts, pair_bits, word_bits = train(docs, exact_entries)
    size = pair_bits.union(word_bits).agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
    path = scratch_table(spark, "scores")
    if size <= filter_bytes:
        model |= {"pairs": _segments(pair_bits, model["segments"]), "words": _segments(word_bits, model["few"])}
        # the most frequent words have the longest chains of probes: they are read once, not in each slice
        for name, key in (("top_words", model["keys"]), ("top_follow", (model["keys"] >> SHORT) * FOLLOW)):
            model[name] = model["words"].probe(key, segment(key, model["few"])).astype(np.uint16)
        scored = docs.mapInArrow(_score(spark.sparkContext.broadcast(model)), SCORES)
    else:
        scored = _score_by_shuffle(docs, model, pair_bits, word_bits)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows_a_batch = spark.conf.get(key)
    if size > filter_bytes:
        small_batches(spark, 16)  # a row holds a slice or a segment
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    spark.conf.set(key, rows_a_batch)
    rows = spark.read.parquet(path)
    rare = counts.where(F.col("c") < model["least"])
    more = rows.where(F.size("rest") > 0).select("row", F.explode("rest").alias("h")).join(rare, "h") \
        .groupBy("row").agg(F.count("h").alias("more_known"), F.sum(F.log10(F.col("c") + 1)).alias("more_base"))
    total = float(model["n"] + model["v"] + 1)
    return rows.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(total))).alias("base_score"), "score")
