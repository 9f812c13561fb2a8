"""Operator 1: the suffix array and the removed bytes against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from demandlab.llm import suffix_dedup as sd

from .conftest import frame


def _brute(rows, window):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(r[p:p + window] for r in raw for p in range(len(r) - window + 1))
    out = Counter()
    for (i, _), r in zip(rows, raw, strict=True):
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - window + 1):
            if count[r[p:p + window]] > 1:
                gone[p:p + window] = True
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone.tolist(), strict=True) if not g)
        out[i, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def _got(df):
    return Counter((None if i != i else int(i), *r) for i, *r in df.toPandas().itertuples(index=False))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("depth", [1, 3])
def test_suffix_ranks(spark, seed, depth):
    """Ranks agree with the order over 3 ** depth symbols, terminators ending nothing but themselves."""
    r = random.Random(seed)
    strings = [[r.choice([0, 1, 1, 2, 2, 3]) for _ in range(r.randint(1, 40))] for _ in range(30)] + [[1] * 30, [1, 2] * 15]
    df = spark.createDataFrame([(k, 0, s) for k, s in enumerate(strings)], "id long, code long, s array<long>")
    got = {r.id: r.rank for r in sd.suffix_ranks(df, depth).collect()}
    keys = {}
    for k, s in enumerate(strings):
        rank = list(got.get(k, [])) + [0] * len(s)
        for i, x in enumerate(s):
            if x:
                cut = s[i:i + 3**depth]
                keys[k, i] = ((cut + [0] * 3**depth)[:3**depth], rank[i])
            else:
                assert rank[i] == 0
    # up to the first terminator the order must be that of the symbols
    head = lambda c: tuple(c[:c.index(0)] if 0 in c else c)
    items = list(keys.values())
    for a, ra in items:
        for b, rb in items:
            x, y = head(a), head(b)
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                assert (x[:n] < y[:n]) == (ra < rb)


def test_equal_windows_share_chosen_positions():
    r = random.Random(8)
    body = r.randbytes(3000)
    a, b = r.randbytes(700) + body + r.randbytes(300), r.randbytes(123) + body + r.randbytes(900)
    qa = sd.chosen(np.frombuffer(a, np.uint8), np.array([0, len(a)])) - 700
    qb = sd.chosen(np.frombuffer(b, np.uint8), np.array([0, len(b)])) - 123
    inside = lambda q: set(q[(q >= sd.BEFORE) & (q <= len(body) - sd.AFTER)].tolist())
    assert inside(qa) == inside(qb) and len(inside(qa)) > 30
    assert np.diff(qa).min() > sd.NEAR


@pytest.mark.parametrize("full,broadcast_most", [(False, 10**6), (True, 0)])
def test_suffix_dedup(docs, rows, monkeypatch, full, broadcast_most):
    """With bitmaps whose every bit is set, too, and joins instead of broadcasts."""
    if full:
        monkeypatch.setattr(sd, "bitmap", lambda cells: np.full(1 << sd.CELL_BITS - 6, -1, np.int64))
    assert _got(sd.suffix_dedup(docs, broadcast_most=broadcast_most)) == _brute(rows, 400)


@pytest.mark.parametrize("seed", range(4))
def test_passages_and_edits(spark, seed):
    """Overlapping passages cut at all offsets, near copies, periodic text, exact copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(r.choice([60, 80, 150, 400])) for _ in range(5)]
    out = []
    for k in range(40):
        parts = [text(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            q = r.choice(passages)
            a = r.randint(0, max(0, len(q) - 405)) if r.random() < 0.6 else 0
            b = r.randint(a, len(q)) if r.random() < 0.6 else len(q)
            parts += [q[a:b], text(r.randint(0, 30))]
        out.append((k, r.choice(["", " "]).join(parts)))
    for k in range(12):
        w = list(out[r.randrange(40)][1])
        for _ in range(r.randint(0, 3)):
            if w:
                w[r.randrange(len(w))] = "#"
        out.append((100 + k, "".join(w)))
    out += [(200, "ab" * 700), (201, "ba" * 300 + text(20)), (202, "q" * 399), (203, "q" * 401), (204, text(10) + "ab" * 250), (205, None)]
    out += [(300 + j, passages[3]) for j in range(3)] + [(300, passages[3]), (310, passages[4][:399]), (311, passages[4][:400]), (None, passages[4][1:402])]
    assert _got(sd.suffix_dedup(frame(spark, out).repartition(3))) == _brute(out, 400)


@pytest.mark.parametrize("hot", [2, 6])
def test_hot_window_hashes(docs, rows, monkeypatch, hot):
    """Hashes that count as hot are found by broadcast: the same rows, with all of them hot or some."""
    monkeypatch.setattr(sd, "HOT_WINDOWS", hot)
    assert _got(sd.suffix_dedup(docs)) == _brute(rows, 400)


def test_texts_without_repeats_stay(spark, monkeypatch, tmp_path):
    """Phrases and texts of documents without repeats are neither written again nor shuffled."""
    r = random.Random(3)
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared = text(100)
    rows = [(k, text(300)) for k in range(100)] + [(200 + k, text(50) + shared + text(50)) for k in range(3)]
    monkeypatch.setattr(sd, "scratch_table", lambda s, name: f"{tmp_path}/{name}-{r.random()}")
    joined = []
    meeting = sd._meeting
    monkeypatch.setattr(sd, "_meeting", lambda *a: joined.append(meeting(*a)) or joined[-1])
    assert _got(sd.suffix_dedup(frame(spark, rows), broadcast_most=0)) == _brute(rows, 400)
    written = next(p for p in tmp_path.iterdir() if p.name.startswith("reaches-"))
    assert spark.read.parquet(str(written)).count() == 3
    assert [(held.count(), rest.count()) for held, _, rest in joined] == [(3, 100), (3, 100)]


def test_ranges_of_removed_bytes():
    """Overlapping and touching runs of windows, texts without any, runs in any order."""
    r = random.Random(5)
    rows, masks = [], []
    for k in range(50):
        draw = lambda: [(a, a + r.randint(1, 9)) for a in (r.randint(0, 300) for _ in range(r.choice([0, 0, 1, 6])))]
        sure, more = draw(), draw() or None
        mask = np.zeros(400, bool)
        for a, b in sure + (more or []):
            mask[a:b + 19] = True
        masks.append(mask)
        rows.append({"tid": bytes([k]), "sure_a": [a for a, _ in sure], "sure_b": [b for _, b in sure], "more": more and [{"p": a, "n": b - a} for a, b in more]})
    kind = pa.schema([("tid", pa.binary()), ("sure_a", pa.list_(pa.int32())), ("sure_b", pa.list_(pa.int32())), ("more", pa.list_(pa.struct([("p", pa.int32()), ("n", pa.int32())])))])
    got = [x for b in sd._covers(20)(iter([pa.RecordBatch.from_pylist(rows, kind)])) for x in b.to_pylist()]
    for g, mask in zip(got, masks, strict=True):
        out = np.zeros(400, bool)
        for a, b in zip(g["a"], g["b"], strict=True):
            assert not out[a:b].any()
            out[a:b] = True
        assert (out == mask).all()


def test_empty(spark, empty):
    assert sd.suffix_dedup(empty).count() == 0
    got = sd.suffix_dedup(frame(spark, [(1, "a"), (2, None), (3, "b" * 300)])).toPandas()
    assert got.n_removed.sum() == 0 and len(got) == 3
