"""N-gram Jaccard join by a grouped prefix join.

A document's set holds its distinct k-word shingles. Equal sets collapse first.
Shingles are ordered rare before frequent, then by hash; two sets of Jaccard
similarity t or more share a shingle within their first |x| - ceil(t |x|) + 1
ones, their prefix. Sets with identical prefixes and size form one group;
groups that share a prefix shingle and pass the size and position filters are
candidate pairs; pairs are expanded to members, filtered by a bitmap of each
set (a bound on the difference) and verified on the whole sets.

Hot lists (a shingle with more than ``list_most`` groups in a band of sizes) never
become all pairs: every group is compared with the list's pivot first, links
make components, and only groups outside the pivot's component are compared
with the others, until nothing can add a link between components. Components are
exact: a pair is left out only where a bound excludes it or where both are
already connected.

The number of links is counted after that: linked sets share a component, so
the sets of every component that isn't complete already are put in order of
size, cut into blocks of bounded size, and all pairs of blocks whose sizes
allow a link are counted whole against whole; only the sums leave a task.

Defined cases: a text of fewer than k words is one shingle; a text without words
and a NULL text have the empty set and link with nothing; the component of rows
with NULL ids only is NULL; repeated rows are equal sets; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.textcols import U64, id_and_text, in_sorted, list_array, mix, row_key, row_of, shingles, small, small_batches, text_slices, words
from demandlab.session import scratch_table, ship_package

SKETCH = 16
#: Ratio of the sizes of a band, as a multiple of 1 / t: linked sets are at most one band apart.
BAND = 1.008
BROADCAST = 1_000_000
#: Shingles of a block of sets that is counted against another; a set weighs SET_WEIGHT more.
BLOCK, SET_WEIGHT = 2_000_000, 1000
DENSE_COLUMNS = 2048


def prefix_size(n, num: int, den: int):
    """|x| - ceil(t |x|) + 1 for t = num / den, over numpy arrays or columns."""
    return n - (num * n + den - 1) // den + 1


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row and their offsets."""
    h, woffs = words(buf, offs)
    count = np.diff(woffs)
    sh, ok = shingles(h, woffs, k)
    at = np.flatnonzero(ok)
    row, key = row_of(woffs, at), sh[at]
    for m in range(1, k):
        few = np.flatnonzero(count == m)
        if len(few):
            acc = np.full(len(few), U64(m * 0xD6E8FEB86659FD93 % 2**64))
            for j in range(m):
                acc = mix(acc) + h[woffs[few] + j]
            row, key = np.concatenate([row, few]), np.concatenate([key, mix(acc)])
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    row, key = row[new], key[new]
    return key, np.searchsorted(row, np.arange(len(offs)))


def _sketches(key: np.ndarray, soffs: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each of 64 * SKETCH cells."""
    n = len(soffs) - 1
    cell = (key >> U64(40)) % U64(64 * SKETCH)
    row = row_of(soffs, np.arange(len(key)))
    odd = np.bincount(row * 64 * SKETCH + cell.astype(np.int64), minlength=n * 64 * SKETCH) & 1
    return np.packbits(odd.astype(bool).reshape(-1, 64), axis=1, bitorder="little").view(np.int64).ravel()


def _digest(part: np.ndarray) -> bytes:
    return hashlib.blake2b(part.tobytes(), digest_size=16).digest()


def _read_sets(k: int):
    """Per row: size and digest of its set."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            key, soffs = shingle_sets(buf, offs, k)
            sid = pa.array([_digest(key[a:b]) for a, b in zip(soffs[:-1], soffs[1:], strict=True)], pa.binary())
            yield pa.record_batch([rows.column("doc_id"), rows.column("key"), pa.array(np.diff(soffs)), sid], ["doc_id", "key", "n", "sid"])
    return kernel


def _firsts(offs: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Positions of the first entries of each row."""
    return np.repeat(offs[:-1], take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)


def _with_sid(k: int, num: int, den: int):
    """Per distinct set: digest, size, bitmap and the smallest hashes (twice the prefix, or all)."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            key, soffs = shingle_sets(buf, offs, k)
            n = np.diff(soffs)
            take = np.minimum(n, 2 * prefix_size(n, num, den) + 8)
            sid = pa.array([_digest(key[a:b]) for a, b in zip(soffs[:-1], soffs[1:], strict=True)], pa.binary())
            yield pa.record_batch([sid, rows.column("key"), pa.array(n), list_array(pa.array(_sketches(key, soffs)), np.full(len(n), SKETCH)),
                                   list_array(pa.array(key[_firsts(soffs, take)].view(np.int64)), take)], ["sid", "key", "n", "sketch", "head"])
    return kernel


def _other_counts(k: int, frequent):
    """Shingles that are not known as frequent, with the number of these texts that hold them."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        for _, buf, offs in text_slices(batches):
            key, _ = shingle_sets(buf, offs, k)
            held.append(key[in_sorted(frequent.value, key) < 0])
            n += len(held[-1])
            if n > 1_000_000:
                yield out()
                held, n = [], 0
        if held:
            yield out()
    return kernel


def _ordered(key: np.ndarray, offs: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes, rare ones first; how many are rare."""
    row = row_of(offs, np.arange(len(key)))
    often = in_sorted(frequent, key) >= 0
    order = np.lexsort((key, often, row))
    return key[order], np.bincount(row[~often], minlength=len(offs) - 1)


def _prefixes(frequent, num: int, den: int):
    """The prefix where the smallest hashes decide it, else NULL."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, head = b.column("n").to_numpy(), b.column("head")
            have = head.value_lengths().to_numpy()
            offs = np.concatenate([[0], np.cumsum(have)])
            key, rare = _ordered(head.flatten().to_numpy().view(U64), offs, frequent.value)
            p = prefix_size(n, num, den)
            known = (rare >= p) | (have == n)
            out = [key[o:o + m].view(np.int64) if ok else None for o, m, ok in zip(offs[:-1], p, known, strict=True)]
            yield pa.record_batch([b.column("sid"), b.column("n"), b.column("sketch"), b.column("key"), pa.array(out, pa.list_(pa.int64()))], ["sid", "n", "sketch", "key", "prefix"])
    return kernel


def _whole(k: int, num: int, den: int, frequent):
    """Prefixes from whole texts, or with ``frequent`` None the whole sets."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_slices(batches):
            key, soffs = shingle_sets(buf, offs, k)
            n = np.diff(soffs)
            if frequent is None:
                yield pa.record_batch([rows.column("sid"), list_array(pa.array(key.view(np.int64)), n)], ["sid", "items"])
                continue
            key, _ = _ordered(key, soffs, frequent.value)
            p = np.minimum(n, prefix_size(n, num, den))
            yield pa.record_batch([rows.column("sid"), list_array(pa.array(key[_firsts(soffs, p)].view(np.int64)), p)], ["sid", "prefix"])
    return kernel


def overlaps(x: np.ndarray, xoffs: np.ndarray, y: np.ndarray, yoffs: np.ndarray) -> np.ndarray:
    """Common items of each set of x with each set of y."""
    n, m = len(xoffs) - 1, len(yoffs) - 1
    out = np.zeros((n, m), np.int64)
    common = np.intersect1d(x, y)
    at, bt = in_sorted(common, x), in_sorted(common, y)
    xr, yr = row_of(xoffs, np.arange(len(x)))[at >= 0], row_of(yoffs, np.arange(len(y)))[bt >= 0]
    at, bt = at[at >= 0], bt[bt >= 0]
    cx, cy = np.bincount(at, minlength=len(common)), np.bincount(bt, minlength=len(common))
    # items of many sets by matrix products, the others pair by pair
    dense = cx * cy * 100 > n * m
    column = np.cumsum(dense) - 1
    xd, yd = dense[at], dense[bt]
    xc, xrd, yc, yrd = column[at[xd]], xr[xd], column[bt[yd]], yr[yd]
    xo, yo = np.argsort(xc, kind="stable"), np.argsort(yc, kind="stable")
    xc, xrd, yc, yrd = xc[xo], xrd[xo], yc[yo], yrd[yo]
    for c in range(0, int(dense.sum()), DENSE_COLUMNS):
        a, b = np.zeros((n, DENSE_COLUMNS), np.float32), np.zeros((m, DENSE_COLUMNS), np.float32)
        for mat, col, row in ((a, xc, xrd), (b, yc, yrd)):
            lo, hi = np.searchsorted(col, [c, c + DENSE_COLUMNS])
            mat[row[lo:hi], col[lo:hi] - c] = 1
        out += (a @ b.T).astype(np.int64)
    order = np.argsort(bt[~yd], kind="stable")
    yr, cy = yr[~yd][order], np.where(dense, 0, cy)
    start, at, xr = np.cumsum(cy) - cy, at[~xd], xr[~xd]
    total = np.cumsum(cy[at])
    lo = 0
    while lo < len(at):  # at most about a million pairs, or one item's, at once
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + 1_000_000)))
        take = cy[at[lo:hi]]
        held = np.repeat(start[at[lo:hi]], take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
        pair, c = np.unique(np.repeat(xr[lo:hi], take) * m + yr[held], return_counts=True)
        out.ravel()[pair] += c
        lo = hi
    return out


def _degrees(num: int, den: int):
    """Per pair of blocks (rows sorted by ``task``): how many sets of the other block each set links with."""
    def count(got: list) -> pa.RecordBatch:
        sides = []
        for side in (0, 1):
            rows = [(sid, items) for sid, which, items in got if which == side]
            offs = np.concatenate([[0], np.cumsum([len(items) for _, items in rows])]).astype(np.int64)
            sides.append(([sid for sid, _ in rows], np.concatenate([np.empty(0, np.int64), *(items for _, items in rows)]), offs))
        (a, x, xo), (b, y, yo) = sides if sides[1][0] else (sides[0], sides[0])
        linked = overlaps(x, xo, y, yo) * (num + den) >= num * np.add.outer(np.diff(xo), np.diff(yo))
        if not sides[1][0]:
            np.fill_diagonal(linked, False)
            return pa.record_batch([pa.array(a, pa.binary()), pa.array(linked.sum(1))], ["sid", "c"])
        return pa.record_batch([pa.array(a + b, pa.binary()), pa.array(np.concatenate([linked.sum(1), linked.sum(0)]))], ["sid", "c"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, got = None, []
        for batch in batches:
            items = batch.column("items")
            offs = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy())])
            flat = items.flatten().to_numpy()
            for j, (t, sid, side) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("task", "sid", "side")), strict=True)):
                if t != task and got:
                    yield count(got)
                    got = []
                task = t
                got.append((sid, side, flat[offs[j]:offs[j + 1]].copy()))
        if got:
            yield count(got)
    return kernel


def _texts_of(docs: DataFrame, wanted: DataFrame, most: int = BROADCAST) -> DataFrame:
    """Texts of the wanted rows (key, sid); broadcast below a checked number of keys."""
    return docs.join(small(wanted.select("key", "sid"), most), "key").select("sid", "text")


def _save(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_table(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """sid, comp: the smallest sid reachable over links (a, b), for every linked sid."""
    edges = _save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = _save(edges.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("m")).select("sid", F.least("sid", "m").alias("comp")), "labels")
    while True:
        near = edges.join(labels.select(F.col("sid").alias("b"), "comp"), "b").groupBy(F.col("a").alias("sid")).agg(F.min("comp").alias("m"))
        step = labels.join(near, "sid").select("sid", F.col("comp").alias("was"), F.least("comp", "m").alias("to"))
        far = labels.select(F.col("sid").alias("to"), F.col("comp").alias("jump"))
        new = _save(step.join(far, "to", "left").select("sid", "was", F.least("to", F.coalesce("jump", "to")).alias("comp")), "labels")
        labels = new.select("sid", "comp")
        if new.where("was <> comp").limit(1).count() == 0:
            return labels


class GroupedPrefixJoin:
    """One run of the join: ``links`` and ``components`` over the distinct sets."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int, list_most: int, frequent_least: int, frequent_most: int):
        self.spark: SparkSession = docs.sparkSession
        self.k, self.num, self.den = k, num, den
        self.list_most, self.frequent_least, self.frequent_most = list_most, frequent_least, frequent_most
        self.docs = docs.withColumn("key", row_key())
        self.rows = _save(self.docs.select("doc_id", "key", "text").mapInArrow(_read_sets(k), "doc_id long, key binary, n long, sid binary"), "sets")
        self.sets = _save(self._with_prefix(), "prefixes")
        self.members = self.sets.select("sid", "n", "gid")
        self.linked = self._links()

    # -- prefixes and groups

    def _distinct(self) -> DataFrame:
        """One row per distinct set, read from one of its texts."""
        lead = self.rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("c"))
        drop = self.rows.select("sid", "key").join(lead.where("c > 1").select("sid", F.col("key").alias("lead")), "sid").where("key <> lead").select("key")
        drop = drop.union(self.rows.where("n = 0").select("key")).distinct()
        texts = self.docs.join(small(drop, BROADCAST), "key", "left_anti")
        self.again = self.rows.where("n > 0").groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").limit(1).count()
        if self.again:  # rows that agree in id and text
            texts = texts.dropDuplicates(["key"])
        return _save(texts.select("key", "text").mapInArrow(_with_sid(self.k, self.num, self.den), "sid binary, key binary, n long, sketch array<long>, head array<long>"), "distinct")

    def _frequent(self, counts: DataFrame) -> np.ndarray:
        """Shingles of many sets; the threshold rises until the table is within its bound."""
        often, least = _save(counts.where(F.col("c") >= self.frequent_least), "frequent"), self.frequent_least
        while often.where(F.col("c") >= least).count() > self.frequent_most:
            least *= 2
        return np.sort(often.where(F.col("c") >= least).select("h").toPandas()["h"].to_numpy(np.int64).view(U64))

    def _with_prefix(self) -> DataFrame:
        one = self._distinct()
        share = self.spark.sparkContext.broadcast
        first = share(self._frequent(one.select(F.explode("head").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"))))
        schema = "sid binary, n long, sketch array<long>, key binary, prefix array<long>"
        # texts made of frequent shingles: their other shingles are counted too
        plain = one.mapInArrow(_prefixes(first, self.num, self.den), schema).where("prefix is null")
        more = _texts_of(self.docs, plain).mapInArrow(_other_counts(self.k, first), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
        frequent = share(np.union1d(first.value, self._frequent(more)))
        near = one.mapInArrow(_prefixes(frequent, self.num, self.den), schema)
        far = near.where("prefix is null").select("sid", "n", "sketch", "key")
        texts = _texts_of(self.docs, far).mapInArrow(_whole(self.k, self.num, self.den, frequent), "sid binary, prefix array<long>").dropDuplicates(["sid"])
        all_ = near.where("prefix is not null").union(far.join(texts, "sid").select("sid", "n", "sketch", "key", "prefix"))
        all_ = all_.withColumn("gkey", F.unhex(F.md5(F.concat_ws(",", F.col("prefix").cast("array<string>"), F.col("n").cast("string")))))
        group = all_.groupBy("gkey").agg(F.min("sid").alias("gid"))
        return all_.join(group, "gkey").drop("gkey")

    # -- filters

    def _need(self, na: Column, nb: Column) -> Column:
        """The least overlap of a linked pair: ceil(t / (1 + t) (na + nb))."""
        return F.ceil((na + nb) * self.num / F.lit(float(self.num + self.den)) - F.lit(1e-9))

    def _may_link(self, x: str, y: str) -> Column:
        """Size and position filters on rows with columns n, i under two aliases."""
        na, nb = F.col(f"{x}.n"), F.col(f"{y}.n")
        need = self._need(na, nb)
        small, large = F.least(na, nb), F.greatest(na, nb)
        return (small * self.den >= large * self.num) & (na - F.col(f"{x}.i") >= need) & (nb - F.col(f"{y}.i") >= need)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of sids that link: bitmaps first, then whole sets."""
        about = self.sets.select("sid", "n", "sketch", "key")
        wide = pairs.join(about.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a") \
            .join(about.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
        apart = F.aggregate(F.zip_with("ka", "kb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
        need = self._need(F.col("na"), F.col("nb"))
        near = _save(wide.where(apart <= F.col("na") + F.col("nb") - 2 * need).select("a", "b", need.cast("long").alias("need")), "near")
        ids = near.select(F.col("a").alias("sid")).union(near.select(F.col("b").alias("sid"))).distinct()
        whole = _save(_texts_of(self.docs, self.sets.select("sid", "key").join(ids, "sid", "left_semi"))
                      .mapInArrow(_whole(self.k, self.num, self.den, None), "sid binary, items array<long>").dropDuplicates(["sid"]), "whole")
        both = near.join(whole.select(F.col("sid").alias("a"), F.col("items").alias("xa")), "a") \
            .join(whole.select(F.col("sid").alias("b"), F.col("items").alias("xb")), "b")
        return _save(both.where(F.size(F.array_intersect("xa", "xb")) >= F.col("need")).select("a", "b"), "links")

    # -- candidates

    def _links(self) -> DataFrame:
        groups = self.sets.where("sid = gid").select("gid", "n", "prefix")
        index = groups.select("gid", "n", F.posexplode("prefix").alias("i", "token"))
        shared = index.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
        band = F.floor(F.log("n") / F.lit(float(np.log(BAND * self.den / self.num)))).cast("int")
        live = _save(index.join(shared, "token").withColumn("band", band), "index")
        # a set meets sets of its own size or larger in its own band and the next
        lists = live.withColumn("at", F.explode(F.array("band", F.col("band") - 1)))
        sizes = _save(lists.groupBy("token", "at").agg(
            F.count(F.lit(1)).alias("c"), F.min(F.struct("i", "n", "gid")).alias("pivot")).where("c > 1"), "lists")
        cold, hot = sizes.where(F.col("c") <= self.list_most), sizes.where(F.col("c") > self.list_most)

        x = live.join(cold.select("token", F.col("at").alias("band")), ["token", "band"]).alias("x")
        y = lists.join(cold.select("token", "at"), ["token", "at"]).alias("y")
        ahead = F.struct("x.n", "x.gid") < F.struct("y.n", "y.gid")
        pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.at")) & ahead & self._may_link("x", "y")) \
            .select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h"))
        star = lists.alias("y").join(hot.select("token", "at", "pivot.*").alias("x"), ["token", "at"]) \
            .where((F.col("x.gid") != F.col("y.gid")) & self._may_link("x", "y")) \
            .select(F.least("x.gid", "y.gid").alias("g"), F.greatest("x.gid", "y.gid").alias("h"))
        pairs = pairs.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).union(star).distinct()
        sizes_of = self.members.groupBy("gid").agg(F.count(F.lit(1)).alias("m"))
        many = sizes_of.where("m > 1").select(F.col("gid").alias("g"), F.col("gid").alias("h"))
        pairs = _save(pairs.union(many), "pairs")

        # members against the other group's first one; only what stays apart is expanded further
        left = self.members.select(F.col("gid").alias("g"), F.col("sid").alias("a"))
        right = self.members.select(F.col("gid").alias("h"), F.col("sid").alias("b"))
        first = pairs.join(left, "g").select("a", F.col("h").alias("b")).union(pairs.join(right, "h").select(F.col("g").alias("a"), "b"))
        links = self._verified(self._pairs(first))
        comps = self._components(links)
        more = self._rest(pairs, comps, sizes_of)
        return self._until_connected(links, more, comps, lists, hot, left, right)

    def degrees(self, comps: DataFrame, block: int = BLOCK) -> DataFrame:
        """sid, n_links for every linked set: all sets it links with."""
        ends = self.linked.select(F.col("a").alias("sid")).union(self.linked.select(F.col("b").alias("sid")))
        found = _save(comps.join(ends.groupBy("sid").agg(F.count(F.lit(1)).alias("n_links")), "sid"), "found")
        open_ = found.groupBy("comp").agg(F.count(F.lit(1)).alias("m"), F.min("n_links").alias("least")).where("least < m - 1").select("comp")
        upto = F.sum(F.col("n") + SET_WEIGHT).over(Window.partitionBy("comp").orderBy("n", "sid").rowsBetween(Window.unboundedPreceding, -1))
        placed = _save(found.join(open_, "comp").join(self.sets.select("sid", "n", "key"), "sid")
                       .select("comp", "sid", "n", "key", F.floor(F.coalesce(upto, F.lit(0)) / block).alias("block")), "blocks")
        sizes = placed.groupBy("comp", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        i, j = sizes.select("comp", F.col("block").alias("i"), "hi"), sizes.select("comp", F.col("block").alias("j"), "lo")
        tasks = i.join(j, "comp").where((F.col("i") <= F.col("j")) & (F.col("hi") * self.den >= F.col("lo") * self.num)) \
            .select("comp", "i", "j", F.concat_ws("-", F.hex("comp"), "i", "j").alias("task"))
        uses = tasks.select("comp", F.col("i").alias("block"), "task", F.lit(0).alias("side")) \
            .union(tasks.where("i < j").select("comp", F.col("j").alias("block"), "task", F.lit(1).alias("side")))
        whole = _texts_of(self.docs, placed).mapInArrow(_whole(self.k, self.num, self.den, None), "sid binary, items array<long>")
        if self.again:
            whole = whole.dropDuplicates(["sid"])
        counted = placed.select("comp", "sid", "block").join(uses, ["comp", "block"]).join(whole, "sid").select("task", "sid", "side", "items") \
            .repartition("task").sortWithinPartitions("task").mapInArrow(_degrees(self.num, self.den), "sid binary, c long")
        return found.join(open_, "comp", "left_anti").select("sid", "n_links").union(counted.groupBy("sid").agg(F.sum("c").alias("n_links")))

    @staticmethod
    def _pairs(rows: DataFrame) -> DataFrame:
        return rows.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _components(self, links: DataFrame) -> DataFrame:
        found = components(links)
        return _save(self.members.select("sid", "gid").join(found, "sid", "left").select("sid", "gid", F.coalesce("comp", "sid").alias("comp")), "comps")

    def _apart(self, pairs: DataFrame, comps: DataFrame) -> DataFrame:
        ca = comps.select(F.col("sid").alias("a"), F.col("comp").alias("ca"))
        cb = comps.select(F.col("sid").alias("b"), F.col("comp").alias("cb"))
        return self._pairs(pairs).join(ca, "a").join(cb, "b").where("ca <> cb").select("a", "b")

    def _rest(self, pairs: DataFrame, comps: DataFrame, sizes_of: DataFrame) -> DataFrame:
        """Member pairs of candidate groups, beyond the first ones, that are still apart."""
        m1 = sizes_of.select(F.col("gid").alias("g"), F.col("m").alias("m1"))
        m2 = sizes_of.select(F.col("gid").alias("h"), F.col("m").alias("m2"))
        one = comps.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        lo = one.select(F.col("gid").alias("g"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
        hi = one.select(F.col("gid").alias("h"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        open_ = pairs.join(m1, "g").join(m2, "h").where("m1 + m2 > 2").join(lo, "g").join(hi, "h") \
            .where("not (lo1 = hi1 and lo2 = hi2 and lo1 = lo2)").select("g", "h")
        left = comps.select(F.col("gid").alias("g"), F.col("sid").alias("a"), F.col("comp").alias("ca"))
        right = comps.select(F.col("gid").alias("h"), F.col("sid").alias("b"), F.col("comp").alias("cb"))
        return open_.join(left, "g").join(right, "h").where("ca <> cb").select("a", "b")

    def _until_connected(self, links: DataFrame, more: DataFrame, comps: DataFrame, lists: DataFrame, hot: DataFrame,
                         left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of hot lists that involve a group outside the pivot's component."""
        one = comps.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        lead = hot.select("token", "at", F.col("pivot.gid").alias("gid")).join(one, "gid") \
            .select("token", "at", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("main"))
        inside = lists.join(lead, ["token", "at"]).join(one, "gid")
        inside = _save(inside.select("token", "at", "gid", "n", "i", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("comp"), "main"), "hot")
        out = inside.where("not (comp <=> main) or comp is null")
        apart = ~F.col("x.comp").eqNullSafe(F.col("y.comp")) | F.col("x.comp").isNull()
        wide = out.alias("x").join(inside.alias("y"), ["token", "at"]).where(apart & self._may_link("x", "y")) \
            .select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h"))
        wide = wide.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).distinct()
        pairs = _save(self._apart(more.union(wide.join(left, "g").join(right, "h").select("a", "b")), comps), "rest")
        if pairs.limit(1).count() == 0:
            return links
        return _save(links.union(self._verified(pairs)), "links")


def one_per_component(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text",
                      list_most: int = 16, frequent_least: int = 6, frequent_most: int = 2_000_000, broadcast_most: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, all columns: of linked rows the one with the smallest id stays (NULL ids last).

    Rows that agree in id and text are linked if they have words; one of them
    stays. Rows without words are never linked and all stay.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    run = GroupedPrefixJoin(id_and_text(docs, id_col, text_col), k, num, den, list_most, frequent_least, frequent_most)
    rows = run.rows.where("n > 0").join(components(run.linked), "sid", "left").select("doc_id", "key", F.coalesce("comp", "sid").alias("comp"))
    lead = rows.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("lead"))
    keys = rows.groupBy("comp", "key").agg(F.count(F.lit(1)).alias("c")).join(lead, "comp")
    dropped = _save(keys.where(F.col("key") != F.col("lead.key")).select(F.col("key").alias("__key")), "dropped")
    twice = _save(keys.where((F.col("key") == F.col("lead.key")) & (F.col("c") > 1)).select(F.col("key").alias("__key")), "twice")
    text, ident = F.coalesce(docs[text_col].cast("string"), F.lit("")), docs[id_col].cast("long")
    keyed = docs.withColumn("__key", row_key(ident, text)).join(small(dropped, broadcast_most), "__key", "left_anti")
    twice = small(twice, broadcast_most)
    once = keyed.join(twice, "__key", "left_anti")
    return once.union(keyed.join(twice, "__key", "left_semi").dropDuplicates(["__key"])).select(*docs.columns)


def ngram_jaccard_join(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text",
                       list_most: int = 16, frequent_least: int = 6, frequent_most: int = 2_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row; a link is Jaccard >= num / den.

    ``n_links`` counts all links between a row's set and other sets.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    run = GroupedPrefixJoin(id_and_text(docs, id_col, text_col), k, num, den, list_most, frequent_least, frequent_most)
    comp = components(run.linked)
    degree = run.degrees(comp)
    sets = run.rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("low")).join(comp, "sid", "left") \
        .select("sid", "low", F.coalesce("comp", "sid").alias("comp"))
    lowest = sets.groupBy("comp").agg(F.min("low").alias("component"))
    found = sets.join(lowest, "comp").join(degree, "sid", "left").select("sid", "component", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = run.rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("sid")).alias("sid"))
    out = rows.where("n > 0").join(found, "sid").select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "n_links")
    alone = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return out.union(alone)
