"""Texts longer than one slice (1 MB) against brute force, and the features and fit of operator 7."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import bloom_lm as lm
from demandlab.llm import chunk_dedup as cd
from demandlab.llm import decontaminate as dc
from demandlab.llm import exact_dedup as ed
from demandlab.llm import ngram_join as nj
from demandlab.llm import quality as q
from demandlab.llm import suffix_dedup as sd
from demandlab.llm.textcols import SLICE_BYTES

from .conftest import frame
from .test_dedup import _chunk_brute, _chunk_result, _components
from .test_dedup import _got as _joined
from .test_models import _held, _junk, _tokens


@pytest.fixture(scope="module")
def long_rows():
    """A long text, its copy with edits before and after the end of the first slice, a spaced copy, passages of it."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    a = [word() for _ in range(190_000)]
    b = list(a)
    b[20_000], b[178_000] = "EDITED", "CHANGED,"
    text = " ".join(a)
    assert len(text) > SLICE_BYTES + 50_000
    return [(1, text), (2, " ".join(b)), (3, text[:700_000] + "\n" + text[700_000:]), (4, text[-1500:] + " " + " ".join(word() for _ in range(40))),
            (5, text[SLICE_BYTES - 700:SLICE_BYTES + 700]), (6, " ".join(word() for _ in range(100))), (7, None), (8, "")]


def _removed(rows, window):
    raw = [(t or "").encode() for _, t in rows]
    starts = [[hash(x[p:p + window]) for p in range(len(x) - window + 1)] for x in raw]
    count = Counter(h for s in starts for h in s)
    out = Counter()
    for (i, _), x, s in zip(rows, raw, starts, strict=True):
        edge = np.zeros(len(x) + 1, np.int64)
        for p, h in enumerate(s):
            if count[h] > 1:
                edge[p] += 1
                edge[p + window] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out[i, len(x), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_dedup(spark, long_rows):
    got = sd.suffix_dedup(frame(spark, long_rows)).toPandas()
    assert Counter(tuple(x) for x in got.itertuples(index=False)) == _removed(long_rows, 400)


def test_exact_dedup(spark, long_rows):
    got = ed.exact_dedup(frame(spark, long_rows), F.lit(True)).toPandas().set_index("doc_id")
    assert got.keep_id.to_dict() == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7}
    for i, t in long_rows:
        assert got.text_sha256[i] == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()


def test_decontaminate(spark, long_rows):
    """One item across the end of the first slice, one in the tail, one that occurs nowhere."""
    text = long_rows[0][1]
    items = [("b1", text[SLICE_BYTES - 150:SLICE_BYTES + 150]), ("b2", text[-300:]), ("b3", "nowhere to be found " * 4)]
    got = dc.decontaminate(frame(spark, long_rows), spark.createDataFrame(items, "item_id string, text string")).toPandas()
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = Counter()
    windows = {}
    for item, t in items:
        x = pat.findall(t.lower())
        for k in range(len(x) - 9):
            windows.setdefault(tuple(x[k:k + 10]), set()).add(item)
    for i, t in long_rows:
        w, hit, found = pat.findall((t or "").lower()), set(), set()
        for k in range(len(w) - 9):
            if tuple(w[k:k + 10]) in windows:
                hit.update(range(k, k + 10))
                found |= windows[tuple(w[k:k + 10])]
        want[i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    assert Counter(tuple(x) for x in got.itertuples(index=False)) == want


def test_ngram_join(spark, long_rows):
    assert _joined(nj.ngram_jaccard_join(frame(spark, long_rows))) == _components(long_rows)


def test_chunk_dedup(spark, long_rows):
    assert _chunk_result(cd.chunk_dedup(frame(spark, long_rows))) == _chunk_brute(long_rows)


def test_base_score(spark, long_rows):
    got = lm.lm_scores(frame(spark, long_rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).toPandas().set_index("doc_id")
    count = Counter(w for i, t in long_rows if not _held(i) for w in _tokens(t))
    n, v = sum(count.values()), len(count)
    for i, t in long_rows:
        w, g = _tokens(t), got.loc[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (_held(i), len(w), sum(x in count for x in w), n)
        assert g.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert np.isfinite(g.score) and g.score < 0


def _features(text):
    """The features of one text, byte by byte and line by line."""
    raw = (text or "").encode()
    over = lambda part, whole: part / max(whole, 1)
    upper = lambda x: sum(65 <= c <= 90 for c in x)
    letters = lambda x: sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in x)
    blanks = b" \t\n\v\f\r"
    odd = [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?"]
    signs = lambda x: sum(c in odd for c in x)
    out = [np.log1p(100 * over(raw.count(c), len(raw))) for c in range(33, 127) if not chr(c).isalnum()]
    blank = sum(c in blanks for c in raw)
    out += [over(upper(raw), letters(raw)), over(signs(raw), len(raw)), over(sum(48 <= c <= 57 for c in raw), len(raw)),
            over(blank, len(raw)), over(sum(c >= 128 for c in raw), len(raw))]
    before, repeats, total, lines = None, 0, 0, []
    for line in raw.split(b"\n"):
        words = re.findall(rb"[^\x20\x09-\x0D]+", line.lower())
        same = 0
        for w in words:
            same += w == before
            before = w
        repeats, total = repeats + same, total + len(words)
        if line:
            lines.append((len(line), over(upper(line), letters(line)), signs(line) / len(line), over(same, len(words))))
    out += [over(repeats, total), over(len(raw) - blank, total) / 10, np.log1p(total) / 10]
    for k, most in ((1, 0.5), (2, 0.05), (3, 0.5)):
        out += [max([x[k] for x in lines if x[0] >= 20], default=0.0), over(sum(x[0] for x in lines if x[k] > most), len(raw))]
    return np.array(out)


def test_quality_features(spark, rows, long_rows):
    r = random.Random(2)
    many = [(i, t) for i, (_, t) in enumerate([*rows, *((0, _junk(r, k % 5)) for k in range(20)), (0, "\n\nA\n\nlast line of a text && a a a a a a\n"), long_rows[2]])]
    docs = spark.createDataFrame(many, "doc_id long, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = {x.doc_id: x.x for x in docs.mapInArrow(q._extract, "doc_id long, x array<float>").collect()}
    assert len(got) == len(many)
    for i, t in many:
        np.testing.assert_allclose(got[i], _features(t), rtol=2e-5, atol=1e-6)


def test_quality_fit_and_cut(spark, tmp_path):
    """The fitted weights reach the least penalised loss that Newton steps find; the cut lies between two scores."""
    r = random.Random(5)
    data = [(i, _junk(r, 0 if r.random() < 0.5 else r.randint(1, 4))) for i in range(160)]
    rated = [(i, [float(v) for v in _features(t)], int(r.random() < (0.9 if "!!" not in t and "|" not in t else 0.2))) for i, t in data]
    path = str(tmp_path / "sample")
    spark.createDataFrame(rated, "doc_id long, x array<float>, quality int").withColumn("pick", F.xxhash64("doc_id")).write.parquet(path)
    sample = spark.read.parquet(path)
    weights = q.fit(sample)
    pairs = q.preference_pairs(sample).collect()
    x, y = np.array([p.features.toArray() for p in pairs]), np.array([p.label for p in pairs])
    assert len(x) == q.FIT_PAIRS * max(Counter(z for *_, z in rated).values()) and abs(y.mean() - 0.5) < 0.01
    sd_ = x.std(0, ddof=1)
    use = sd_ > 0
    z = x[:, use] / sd_[use]

    def loss(w):
        return np.logaddexp(0, -(2 * y - 1) * (z @ w)).mean() + 0.5e-4 * (w @ w)
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(z @ w)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) / len(z) + 1e-4 * np.eye(len(w)), z.T @ (p - y) / len(z) + 1e-4 * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    assert loss(weights[use] * sd_[use]) < loss(w) + 2e-3
    cut = q.quantile_cut(sample, weights)
    scores = np.sort(np.array([np.float32(v) for _, v, _ in rated], np.float64) @ weights)
    worse = sum(z_ == 0 for *_, z_ in rated)
    assert cut == pytest.approx((scores[worse - 1] + scores[worse]) / 2, abs=1e-6)
