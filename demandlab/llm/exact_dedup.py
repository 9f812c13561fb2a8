"""Exact dedup against a minimal perfect hash over historical distinct digests.

``history`` rows are reduced to one winner per digest of the normalised text.
Digests are dealt to shards of bounded size; each shard gets a minimal perfect
hash (levels of bit arrays: a digest is placed at the first level where it is
alone in its cell, its slot is the rank of that bit) whose slots hold the full
32-byte digest and the winner's locator. New rows, pre-aggregated by digest,
are looked up shard by shard: a slot answers only if all 32 bytes agree.
Members join the slot's group, nonmembers are grouped among themselves.

Defined cases: a NULL text counts as empty; a NULL doc_id loses ties to any
id; of rows that tie in everything exactly one stays; empty tables give no rows; other columns are
ignored. Rows of a hot group are summed before they are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.textcols import mix
from demandlab.session import scratch_table, ship_package

U64 = np.uint64
LEVELS = 64
GROUP = "digest binary, lead_cp long, lead_none boolean, lead_id long, group_size long"
INDEX = ("shard int, levels array<int>, bits binary, digests binary, lead_cp array<long>, "
         "lead_none array<boolean>, lead_id array<long>, sizes array<long>")


def digests(docs: DataFrame, is_history: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, historical or not, digest of the text without white space, code points of the text."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(is_history, F.lit(False)).alias("old"),
                       F.unhex(F.sha2(F.translate(text, " \t\n\x0b\x0c\r", ""), 256)).alias("digest"),
                       F.length(text).cast("long").alias("cp"))


def _groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest: winner (most code points, smallest id, NULL id last) and size."""
    best = F.min(F.struct((-F.col("cp")).alias("neg"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    return rows.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size")).select(
        F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard"), "digest", (-F.col("b.neg")).alias("lead_cp"),
        F.col("b.none").alias("lead_none"), F.col("b.id").alias("lead_id"), "group_size")


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 32)


def _cells(key: np.ndarray, level: int, size: int) -> np.ndarray:
    k = np.ascontiguousarray(key[:, :16]).view(U64)
    step = U64(level * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(k[:, 0] + step ^ mix(k[:, 1] + U64(level))) % U64(size)).astype(np.int64)


def build_mph(key: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, concatenated bits, and the slot of each of the distinct keys."""
    left, sizes, bits, at = np.arange(len(key)), [], [], np.full(len(key), -1, np.int64)
    base = 0
    while len(left) and len(sizes) < LEVELS:
        size = max(8, int(1.5 * len(left)))
        cell = _cells(key[left], len(sizes), size)
        alone = np.bincount(cell, minlength=size) == 1
        hit = alone[cell]
        at[left[hit]] = base + cell[hit]
        sizes.append(size)
        bits.append(alone)
        base += size
        left = left[~hit]
    if len(left):
        raise ValueError("digests that agree in their first 16 bytes")
    flat = np.concatenate(bits) if bits else np.empty(0, bool)
    rank = np.cumsum(flat) - 1
    return sizes, flat, rank[at] if len(key) else at


def find(key: np.ndarray, sizes: list[int], flat: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """Slot of each key, or -1 unless the slot's 32 bytes equal it."""
    slot, open_, base = np.full(len(key), -1, np.int64), np.arange(len(key)), 0
    rank = np.cumsum(flat) - 1
    for level, size in enumerate(sizes):
        cell = base + _cells(key[open_], level, size)
        hit = flat[cell]
        slot[open_[hit]] = rank[cell[hit]]
        open_ = open_[~hit]
        base += size
    some = slot >= 0
    slot[some] = np.where((stored[slot[some]] == key[some]).all(axis=1), slot[some], -1)
    return slot


def _build(table: pa.Table) -> pa.Table:
    key = _matrix(table["digest"])
    sizes, flat, slot = build_mph(key)
    by_slot = np.argsort(slot)
    table = table.take(pa.array(by_slot))
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
        "levels": pa.array([sizes], pa.list_(pa.int32())), "bits": pa.array([np.packbits(flat).tobytes()]),
        "digests": pa.array([key[by_slot].tobytes()]), "lead_cp": pa.array([table["lead_cp"].to_pylist()], pa.list_(pa.int64())),
        "lead_none": pa.array([table["lead_none"].to_pylist()]), "lead_id": pa.array([table["lead_id"].to_pylist()], pa.list_(pa.int64())),
        "sizes": pa.array([table["group_size"].to_pylist()], pa.list_(pa.int64()))})


def _lookup(new: pa.Table, index: pa.Table) -> pa.Table:
    key = _matrix(new["digest"]) if new.num_rows else np.empty((0, 32), np.uint8)
    mine = [dict(zip(("lead_cp", "lead_none", "lead_id", "group_size"), row, strict=True)) for row in
            zip(*(new[c].to_pylist() for c in ("lead_cp", "lead_none", "lead_id", "group_size")), strict=True)]
    out = {bytes(k): m for k, m in zip(key, mine, strict=True)}
    if index.num_rows:
        x = index.to_pylist()[0]
        stored = np.frombuffer(x["digests"], np.uint8).reshape(-1, 32)
        flat = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=sum(x["levels"])).astype(bool)
        slot = find(key, x["levels"], flat, stored)
        member = {int(s): i for i, s in enumerate(slot) if s >= 0}
        for s in range(len(stored)):
            old = {"lead_cp": x["lead_cp"][s], "lead_none": x["lead_none"][s], "lead_id": x["lead_id"][s], "group_size": x["sizes"][s]}
            if s in member:
                m = mine[member[s]]
                lead = min(old, m, key=lambda r: (-r["lead_cp"], r["lead_none"], r["lead_id"] or 0))
                old = lead | {"group_size": old["group_size"] + m["group_size"]}
            out[stored[s].tobytes()] = old
    return pa.table({"digest": pa.array(list(out), pa.binary())} | {
        c: pa.array([r[c] for r in out.values()], t) for c, t in
        (("lead_cp", pa.int64()), ("lead_none", pa.bool_()), ("lead_id", pa.int64()), ("group_size", pa.int64()))})


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The minimal perfect hash over the history's distinct digests, one row per shard."""
    ship_package(history.sparkSession)
    return _groups(history, shards).groupBy("shard").applyInArrow(_build, INDEX)


def exact_dedup(docs: DataFrame, is_history: Column, id_col: str = "doc_id", text_col: str = "text",
                keys_per_shard: int = 50_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row, historical or new.

    ``is_history`` marks the rows whose digests form the index. The number of
    shards follows the number of rows, so a shard's index stays bounded.
    """
    spark = docs.sparkSession
    path = scratch_table(spark, "digests")
    digests(docs, is_history, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    shards = rows.count() // keys_per_shard + 1
    index = build_index(rows.where("old"), shards)
    new = _groups(rows.where(~F.col("old")), shards)
    groups = new.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_lookup, GROUP)
    same = rows.groupBy("doc_id", "digest", "cp").agg(F.count(F.lit(1)).alias("n"))
    out = same.join(groups, "digest").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    lead = F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("cp") == F.col("lead_cp")) & (F.col("i") == 1)
    return out.select("doc_id", F.col("lead_id").alias("keep_id"), "group_size", lead.alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
