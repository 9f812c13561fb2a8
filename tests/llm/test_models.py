"""Operators 2 and 7: exact parts against brute force, learned parts on held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import bloom_lm as lm
from demandlab.llm import quality as q

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def _tokens(t):
    return TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("entries", [10**6, 5])
def test_base_score_is_exact(docs, rows, entries):
    got = lm.lm_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, exact_entries=entries).toPandas()
    count = Counter(w for i, t in rows if not _held(i) for w in _tokens(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = _tokens(t)
        want.append((i if i is not None else -1, _held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    have = [(int(a) if a == a else -1, bool(b), c, d, e, round(f, 6)) for a, b, c, d, e, f, _ in got.itertuples(index=False)]
    assert sorted(have) == sorted(want)
    assert (got.score < 0).all() and np.isfinite(got.score).all()


def test_model_follows_exact_smoothing(docs, rows):
    """The filter's scores stay near those of the same model with exact counts, and beat the base."""
    got = lm.lm_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).toPandas()
    train = [_tokens(t) for i, t in rows if not _held(i)]
    word = Counter(w for t in train for w in t) + Counter({"<s>": len(train)})
    pair = Counter(p for t in train for p in zip(["<s>", *t], t, strict=False))
    follow = Counter(a for a, _ in pair)
    n, v = sum(len(t) for t in train), len(word) - 1
    exact = {}
    for i, t in rows:
        w, s = _tokens(t), 0.0
        for a, b in zip(["<s>", *w], w, strict=False):
            p = (word[b] + 1) / (n + v + 1)
            s += math.log10((pair[a, b] + follow[a] * p) / (word[a] + follow[a]) if word[a] else p)
        exact.setdefault(i, []).append(s)
    one = got[got.doc_id.notna()]
    off = [abs(s - x) / n for i, s, n in zip(one.doc_id.astype(int), one.score, one.n_tokens, strict=True) for x in exact[i] if len(exact[i]) == 1]
    assert np.median(off) < 0.02 and max(off) < 0.2
    assert got[got.held_out].score.sum() > got[got.held_out].base_score.sum()


@pytest.mark.parametrize("most", [0, 4000])
def test_scores_do_not_depend_on_the_bound_of_the_broadcast(docs, monkeypatch, most):
    """Beyond ``filter_bytes`` probes travel to their segments; nothing is left out."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    monkeypatch.setattr(lm, "TOKENS_PER_SEGMENT", 100)
    order = lambda df: sorted(map(repr, df.collect()))
    want = order(lm.lm_scores(docs, held))
    monkeypatch.setattr(lm, "PROBE_BYTES", 3000)
    assert order(lm.lm_scores(docs, held, filter_bytes=most)) == want


def test_least_count_keeps_an_oversized_top_bucket_off_the_driver(spark):
    per = lambda *rows: spark.createDataFrame(list(rows), "c long, m long")
    assert lm._least_count(per((1, 100)), 10) > 1 and lm._least_count(per((64, 11), (1, 100)), 10) > 64
    assert lm._least_count(per((64, 9), (1, 100)), 10) == 64 and lm._least_count(per((64, 9), (1, 1)), 10) == 1


def test_counts_are_never_read_too_small():
    r = np.random.default_rng(3)
    key = np.unique(r.integers(0, 2**63, 20000, dtype=np.int64).astype(np.uint64))
    c = r.zipf(1.6, len(key)).clip(1, 10**6)
    cls = lm.classes(c, lm.PAIR_BASE)
    seg = lm.segment(key, 3)
    f = lm.Filter([lm.build_segment(key[seg == s], cls[seg == s], 1 << 20) for s in range(3)])
    got = f.probe(key, seg)
    assert (got >= cls).all() and (got == cls).mean() > 0.9
    absent = np.setdiff1d(r.integers(0, 2**63, 20000, dtype=np.int64).astype(np.uint64), key)
    assert (f.probe(absent, lm.segment(absent, 3)) > 0).mean() < 0.1


def test_small_filter_drops_low_classes_only():
    key = np.arange(1, 10001, dtype=np.uint64)
    cls = np.where(key <= 100, 8, 1).astype(np.int64)
    bits = lm.build_segment(key, cls, 1000)
    f = lm.Filter([bits])
    assert len(bits) <= 1000 and (f.probe(key[:100], np.zeros(100, np.int64)) >= 8).all()


def test_classes_cover_counts():
    c = np.arange(1, 5000)
    for base in (lm.WORD_BASE, lm.PAIR_BASE):
        v = lm.class_value(lm.classes(c, base), base)
        assert (abs(v - c) <= np.maximum(1, c * (base - 1))).all()
    assert lm.class_value(np.array([0, 1]), 1.6).tolist() == [0.0, 1.0]


def _junk(r, k):
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(r.randint(30, 200))]
    return [" ".join(words), " ".join(w.upper() + "!!" for w in words), " | ".join(words), " ".join(words[:1] * len(words)), " ".join(w + "&&&" for w in words)][k]


def test_quality_on_held_out_rows(spark):
    import random
    r = random.Random(4)
    data = [(i, _junk(r, 0 if i % 2 else 1 + i // 2 % 4), i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in data] + [(1000, "", "x"), (None, None, "y")], "doc_id long, text string, x string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in data] + [(1, 1, 0), (None, 0, 1), (2000, 0, 0)], "doc_id long, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = q.quality_scores(docs, labels, held).toPandas()
    assert len(got) == 402 and got.score.between(0, 1).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    known = got[got.held_out & (got.doc_id < 1000)]
    assert (known.predicted == known.doc_id.astype(int) % 2).mean() > 0.95
    assert [bool(x) for x in got[got.doc_id.isna()].held_out] == [False]


def test_quality_cut_covers_all_labelled_rows(spark):
    """Whatever few rows the fit takes, as many labelled rows are rejected as have label 0."""
    import random
    r = random.Random(6)
    data = [(i, _junk(r, 0), int(i % 10 > 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, quality int")
    got = [q.quality_scores(docs, labels, F.lit(False), max_labels=most).where("predicted = 0").count() for most in (25, 40, 60)]
    assert got == [30, 30, 30]


def test_value_at_every_rank(spark):
    s = [0.0, -1e9, 3.5, 3.5, 3.5, 3.5 + 1e-12, 1e9, -2.25, 1e-300]
    rows = spark.createDataFrame([(x,) for x in s], "s double")
    assert [q.value_at(rows, k) for k in range(len(s))] == sorted(s)


def test_quality_without_labels(spark, docs, rows, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = q.quality_scores(docs, none, F.lit(False)).toPandas()
    assert len(got) == len(rows) and (got.score == 0.5).all() and (got.predicted == 0).all()
    assert q.quality_scores(empty, none, F.lit(False)).count() == 0
    assert lm.lm_scores(empty, F.lit(False)).count() == 0


def test_all_held_out(docs, rows):
    got = lm.lm_scores(docs, F.lit(True)).toPandas()
    assert (got.train_tokens == 0).all() and (got.n_known == 0).all() and (got.base_score == 0).all()
