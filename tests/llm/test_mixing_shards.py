"""Operators 3 and 8 against brute force and exact round trips."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import mixing as mx
from demandlab.llm import token_shards as ts
from demandlab.session import scratch_table

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE, PATTERN = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def _fill(children, budget):
    """Water-filling by repetition: (name, weight, cap) -> quota."""
    got = {n: 0.0 for n, _, _ in children}
    open_ = [c for c in children if c[1] > 0]
    while open_ and budget > 1e-9:
        total = sum(w for _, w, _ in open_)
        full = [(n, w, c) for n, w, c in open_ if c - got[n] <= budget * w / total + 1e-12]
        if not full:
            for n, w, _ in open_:
                got[n] += budget * w / total
            break
        for n, _, c in full:
            budget -= c - got[n]
            got[n] = c
        open_ = [c for c in open_ if c not in full]
    return got


def _tree(leaves, weights, budget, levels, epochs):
    given = {(): budget}
    for i in range(1, levels + 1):
        new = {}
        for parent, b in given.items():
            kids = defaultdict(float)
            for path, t in leaves.items():
                if path[:i - 1] == parent:
                    kids[path[:i]] += t * epochs
            new |= _fill([(k, weights.get("/".join(k), 1.0), c) for k, c in kids.items()], b)
        given = new
    return {k: int(v + 1e-6) for k, v in given.items()}


@pytest.mark.parametrize("budget,epochs", [(100, 1), (3000, 2), (5200, 1), (40000, 3), (10**7, 2), (0, 2)])
def test_mixing(spark, docs, rows, budget, epochs):
    weights = {"en": 3.0, "de": 1.0, "en/src0": 5.0, "de/src5": 0.0, "": 0.5}
    table = spark.createDataFrame(list(weights.items()), "path string, weight double")
    got = mx.mix_sources(docs, {"lang": docs["lang"], "source": docs["source"]}, table, budget=budget, max_epochs=epochs, seed=5).toPandas()
    data = docs.toPandas()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in data.text]
    path = [(a or "", b or "") for a, b in zip(data.lang, data.source, strict=True)]
    leaves = defaultdict(int)
    for p, n in zip(path, size, strict=True):
        leaves[p] += n
    quota = _tree(leaves, weights, budget, 2, epochs)
    want = Counter()
    for leaf, q in quota.items():
        if not leaves[leaf]:
            continue
        whole, more = divmod(q, leaves[leaf])
        own = []
        for i, t, p, n in zip(data.doc_id, data.text, path, size, strict=True):
            if p == leaf and n:
                key = "" if i != i else str(int(i))
                own.append((hashlib.md5(f"5:{whole}:{key}".encode()).hexdigest(), key, n))
                for e in range(whole):
                    want[key, e, n, n] += 1
        for _, key, n in sorted(own):
            if more > 0:
                want[key, whole, n, min(n, more)] += 1
                more -= n
    none = lambda x: "" if x != x else str(int(x))
    assert Counter((none(a), b, c, d) for a, b, c, d in got[["doc_id", "epoch", "n_tokens", "take_tokens"]].itertuples(index=False)) == want
    assert set(docs.columns) <= set(got.columns)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "l1 string, l2 string, tokens long")
    got = {(r.l1, r.l2): r.quota for r in mx.budgets(leaves, None, 100, 2, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 40, ("b", "z"): 50}
    got = {(r.l1, r.l2): r.quota for r in mx.budgets(leaves, None, 2015, 2, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}


def test_mixing_empty(empty):
    assert mx.mix_sources(empty, {"lang": empty["lang"]}, None).count() == 0


# -- shards

@pytest.mark.parametrize("n", [1, 2, 3, 10, 255, 256, 257, 5000])
def test_feistel_is_a_permutation(n):
    a, b = ts.feistel(np.arange(n), n, 1), ts.feistel(np.arange(n), n, 2)
    assert sorted(a.tolist()) == list(range(n))
    assert n < 100 or (a != b).mean() > 0.9 and (a != np.arange(n)).mean() > 0.9


def test_ids_agree_with_the_library():
    r = random.Random(6)
    signs = "aBc'stdrevlm  \n\t.,!0129éÉßÿœŒ'ŉ \u0085|<>-_'re'll'S'T'ſ²½ª\x1c\x1f\x00ıİ日本"
    many = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(4000)] + ["'s it's  we'll\n\n they're x''s 's '", "", "  ", " \n a"]
    enc = ts.Ids(BPE, PATTERN)
    raw = [t.encode() for t in many]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, toffs = enc.rows(buf, offs)
    for i, t in enumerate(many):
        assert ids[toffs[i]:toffs[i + 1]].tolist() == [*enc.enc.encode_ordinary(t), ts.END_ID], t


def _ids_of(enc, many):
    raw = [t.encode() for t in many]
    return enc.rows(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))


def test_ids_of_any_script():
    enc, r = ts.Ids(BPE, PATTERN), random.Random(8)
    signs = "aZ's 't  \n\t.—“”’…€ПриветЁжΣςعربيةहिन्दी한국어ㄱ日本語。、ｶ１２Ⅻ٣🙂👩‍👩‍👧e\u0301\u2003\u3000\u00a0\u2028\u0378\U0001f8ff\U000e0041\U0010ffff\u1161"
    many = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    ids, toffs = _ids_of(enc, many)
    for i, t in enumerate(many):
        assert ids[toffs[i]:toffs[i + 1]].tolist() == [*enc.enc.encode_ordinary(t), ts.END_ID], t


def test_ids_of_every_code_point():
    enc = ts.Ids(BPE, PATTERN)
    many = [f"a{c}{c}A1 {c}'s {c}{c} b" for c in map(chr, [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFF])]
    for i in range(0, len(many), 20_000):
        part = many[i:i + 20_000]
        ids, toffs = _ids_of(enc, part)
        assert [t for k, t in enumerate(part) if ids[toffs[k]:toffs[k + 1]].tolist() != [*enc.enc.encode_ordinary(t), ts.END_ID]] == []


@pytest.mark.parametrize("length,records", [(8, 100), (64, 7), (512, 10**6)])
def test_shards_round_trip(spark, docs, rows, length, records):
    out = scratch_table(spark, "shards")
    total = ts.write_shards(docs, out, BPE, PATTERN, length, records, key=3)
    enc = ts.Ids(BPE, PATTERN)
    want = Counter()
    for i, t in rows:
        ids = [*enc.enc.encode_ordinary(t or ""), ts.END_ID]
        for k in range(0, len(ids), length):
            want[i, k // length, hashlib.sha256(np.array(ids[k:k + length], "<u2").tobytes()).hexdigest()] += 1
    got = ts.read_shards(spark, out, length, records).toPandas()
    assert Counter((None if i != i else int(i), p, s) for i, p, s in got[["doc_id", "piece", "ids_sha256"]].itertuples(index=False)) == want
    assert sorted(got.slot) == list(range(total))
    assert (got.slot // records == got.shard).all()
    # any slot can be read by seeking
    raw = {int(r.path.split("shard=")[1].split("/")[0]): bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out).collect()}
    for r in got.sample(min(20, len(got)), random_state=1).itertuples():
        rec = raw[r.shard][r.byte_offset:r.byte_offset + ts.HEADER + 2 * length]
        assert int.from_bytes(rec[8:12], "little") == r.piece
        assert hashlib.sha256(rec[ts.HEADER:ts.HEADER + 2 * r.n_tokens]).hexdigest() == r.ids_sha256


def test_shards_empty(empty):
    assert ts.token_shards(empty, BPE, PATTERN).count() == 0


def test_word_count(spark):
    got = spark.createDataFrame([("a  b\n c",), ("",), (None,), (" \t",)], "t string").select(mx.word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [3, 0, 0, 0]


def test_shards_of_odd_ids_and_long_texts(spark):
    """A doc_id of -1 is not a missing one; texts over a slice (1 MB) are whole; the session's settings stay."""
    long = "wörd and 42 more " * 90_000
    df = spark.createDataFrame([(-1, "a b"), (None, "a b"), (0, ""), (2**62, long), (-1, "a b")], "doc_id long, text string").repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = scratch_table(spark, "shards")
    total = ts.write_shards(df, out, BPE, PATTERN, 512, 50)
    got = ts.read_shards(spark, out, 512, 50).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    enc = ts.Ids(BPE, PATTERN)
    ids = [*enc.enc.encode_ordinary(long), ts.END_ID]
    assert total == len(got) == 4 + -(-len(ids) // 512)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got if r.doc_id != 2**62) == [(False, -1), (False, -1), (False, 0), (True, 0)]
    whole = {r.piece: r.ids_sha256 for r in got if r.doc_id == 2**62}
    assert whole == {k: hashlib.sha256(np.array(ids[512 * k:512 * k + 512], "<u2").tobytes()).hexdigest() for k in range(-(-len(ids) // 512))}


def test_the_pool_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(ts, "POOL", 50)
    enc = ts.Ids(BPE, PATTERN)
    for k in range(30):
        raw = f"word{k} other{k * 7} und noch ein Text {k}".encode()
        ids, offs = enc.rows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert ids.tolist() == [*enc.enc.encode_ordinary(raw.decode()), ts.END_ID]
