"""Operators 6 and 9 against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import xxhash
import pytest

from demandlab.llm import chunk_dedup as cd
from demandlab.llm import ngram_join as nj

from .conftest import frame


def _sets(rows, k=3):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def _components(rows, num=9, den=10):
    sets = _sets(rows)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return Counter((d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def _got(df):
    none = lambda x: None if x is None or x != x else int(x)
    return Counter((none(a), b, none(c)) for a, b, c in df.toPandas()[["doc_id", "n_shingles", "component_id"]].itertuples(index=False))


@pytest.mark.parametrize("most", [16, 1])
def test_ngram_join(docs, rows, most):
    assert _got(nj.ngram_jaccard_join(docs, list_most=most)) == _components(rows)


@pytest.mark.parametrize("seed,most,near", [(1, 2, 3), (2, 1, 6), (3, 4, 2), (4, 3, 12)])
def test_ngram_join_near_copies(spark, seed, most, near):
    """Families of near copies around the threshold, sharing a common passage; hot lists throughout."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(25)]
    rows = []
    for f in range(5):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.choice([40, 70, 120]))]
        for _ in range(r.choice([3, 9, 14])):
            w = list(base)
            for _ in range(r.randint(0, near)):
                w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
            if r.random() < 0.2:
                w = w[:-r.randint(1, 5)]
            rows.append((len(rows), " ".join(w + (common if f % 2 else []))))
    rows += [(len(rows) + j, " ".join(common + [f"z{j}"] * (j % 3))) for j in range(12)]
    r.shuffle(rows)
    assert _got(nj.ngram_jaccard_join(frame(spark, rows), list_most=most)) == _components(rows)


def _linked(rows, k, num, den):
    """Component and number of links (other sets of this similarity) of each id, by brute force."""
    sets = _sets(rows, k)
    near = [[bool(a & b) and den * len(a & b) >= num * len(a | b) for b in sets] for a in sets]
    out = {}
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = {b for b in range(len(rows)) if near[todo[-1]][b]} - seen
            todo.pop()
            seen |= new
            todo += new
        out[d] = (min(rows[b][0] for b in seen), len({frozenset(sets[b]) for b in range(len(rows)) if near[i][b] and sets[b] != sets[i]}))
    return out


@pytest.mark.parametrize("most", [16, 2])
def test_ngram_join_finds_copies_of_other_sizes(spark, most):
    """Copies that are 13-25 % longer than their original, at thresholds down to 1/2, all against brute force."""
    rows = []
    for f, n in enumerate([60, 80, 100, 130, 177, 240]):
        base = [f"f{f}w{i}" for i in range(n + 4)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base + [f"f{f}x{i}" for i in range(n * (13 + 2 * f) // 100)])),
                 (len(rows) + 2, " ".join(base + [f"f{f}y{i}" for i in range(n // 4 + f % 2)])), (len(rows) + 3, " ".join([f"f{f}z{i}" for i in range(n * 7 // 10)] + base))]
    for num, den in [(4, 5), (1, 2)]:
        got = nj.ngram_jaccard_join(frame(spark, rows), k=5, num=num, den=den, list_most=most).collect()
        assert {r.doc_id: r.component_id for r in got} == {d: c for d, (c, _) in _linked(rows, 5, num, den).items()}
    kept = {r.doc_id for r in nj.one_per_component(frame(spark, rows), k=5, num=4, den=5, list_most=most).collect()}
    assert kept == {c for c, _ in _linked(rows, 5, 4, 5).values()}


@pytest.mark.parametrize("most,block", [(16, None), (2, 5000)])
def test_ngram_join_counts_every_link(spark, monkeypatch, most, block):
    """Families of different near copies of several sizes, above and below the length of a hot list, in one and in many blocks."""
    if block:
        monkeypatch.setattr(nj.GroupedPrefixJoin, "degrees", lambda run, comps, whole=nj.GroupedPrefixJoin.degrees: whole(run, comps, block))
    r, rows = random.Random(5), []
    for f, copies in enumerate([2, 3, 9, 25, 40]):
        base = [f"f{f}w{i}" for i in range(90 + 10 * f)]
        for c in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = f"e{len(rows)}"
            rows.append((len(rows), " ".join(w + [f"t{len(rows)}x{j}" for j in range(c % 7)])))
    rows += [(len(rows) + j, rows[5 + j][1].upper()) for j in range(3)]
    got = nj.ngram_jaccard_join(frame(spark, rows), list_most=most).collect()
    assert {g.doc_id: (g.component_id, g.n_links) for g in got} == _linked(rows, 3, 9, 10)


def test_overlaps_against_sets():
    r = np.random.default_rng(2)
    for n, m, most in [(40, 30, 60), (3, 50, 5000), (200, 150, 40000)]:
        x, y = ([np.unique(r.integers(0, most, r.integers(1, 90)) * r.integers(0, 2, 1)) for _ in range(c)] for c in (n, m))
        offs = [np.concatenate([[0], np.cumsum([len(s) for s in z])]) for z in (x, y)]
        got = nj.overlaps(np.concatenate(x), offs[0], np.concatenate(y), offs[1])
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]


def test_ngram_join_empty(empty):
    assert nj.ngram_jaccard_join(empty).count() == 0


def test_components_of_a_long_chain(spark):
    n = 70
    ids = [hashlib.md5(bytes([i])).digest() for i in range(n)]
    links = spark.createDataFrame([(bytearray(ids[i]), bytearray(ids[i + 1])) for i in range(n - 1) if i != 40], "a binary, b binary")
    got = {bytes(s): bytes(c) for s, c in nj.components(links).collect()}
    assert got == {x: min(ids[:41]) if i <= 40 else min(ids[41:]) for i, x in enumerate(ids)}


# -- content-defined chunks

def _cut_brute(raw):
    """One byte after the other: a 32-bit gear hash, a cut where its five top bits are 0, chunks of 32 to 512 bytes."""
    out, last, h = [], 0, 0
    for p, byte in enumerate(raw, 1):
        h = (2 * h + int(cd.GEAR[byte])) % 2**32
        if (p - last >= 32 and h < 2**27) or p - last == 512 or p == len(raw):
            out.append((last, p))
            last = p
    return out


def _chunk_brute(rows, min_run=96):
    """Rows by id, text hash and place in the list; each chunk seen before goes if its run is long or the whole text."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    texts.sort(key=lambda x: (x[0] is None, x[0] or 0, int(np.array(xxhash.xxh64_intdigest(x[1], 42), np.uint64).view(np.int64))))
    total = Counter(raw[a:b] for _, raw in texts for a, b in _cut_brute(raw))
    seen, want = set(), Counter()
    for i, raw in texts:
        cuts = _cut_brute(raw)
        kept, removed, spans, open_ = b"", 0, 0, False
        j = 0
        while j < len(cuts):
            k = j
            while k < len(cuts) and total[raw[slice(*cuts[k])]] > 1:
                k += 1
            long = k > j and (cuts[k - 1][1] - cuts[j][0] >= min_run or (j == 0 and k == len(cuts)))
            for a, b in cuts[j:max(k, j + 1)]:
                gone = long and raw[a:b] in seen
                seen.add(raw[a:b])
                spans += gone and not open_
                open_ = gone
                removed += (b - a) * gone
                kept += b"" if gone else raw[a:b]
            j = max(k, j + 1)
        want[i, len(raw), removed, spans, hashlib.sha256(kept).hexdigest()] += 1
    return want


def _chunk_result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_chunks_depend_on_nearby_bytes_only():
    r = random.Random(9)
    body = r.randbytes(20000)
    a = np.frombuffer(body, np.uint8)
    b = np.frombuffer(body[:500] + b"inserted" + body[500:], np.uint8)
    both = np.concatenate([a, b])
    ends, count = cd.chunks(both, np.array([0, len(a), len(both)]))
    assert ends[count[0] - 1] == len(a) and ends[-1] == len(both)
    one = {body[x:y] for x, y in zip([0, *ends[:count[0] - 1]], ends[:count[0]], strict=True)}
    two = [both[x:y].tobytes() for x, y in zip(ends[count[0] - 1:-1], ends[count[0]:], strict=True)]
    assert sum(c not in one for c in two) <= 12
    sizes = np.diff(np.concatenate([[0], ends[:count[0]]]))
    assert sizes.max() <= cd.MAX and sizes[:-1].min() >= cd.MIN
    alone, _ = cd.chunks(a, np.array([0, len(a)]))
    assert (alone == ends[:count[0]]).all()


@pytest.mark.parametrize("min_run", [1, 96, 400])
def test_chunk_dedup(docs, rows, min_run):
    got = _chunk_result(cd.chunk_dedup(docs, min_run))
    assert got == _chunk_brute(rows, min_run)
    assert any(x[2] > 0 for x in got)


@pytest.mark.parametrize("hot", [10_000, 2])
def test_chunk_dedup_equal_rows_short_copies_and_hot_digests(spark, monkeypatch, hot):
    monkeypatch.setattr(cd, "HOT_CHUNKS", hot)
    monkeypatch.setattr(cd, "COPIES", 3)
    r = random.Random(12)
    body = "".join(r.choice("abcdefgh ") for _ in range(3000))
    rows = [(7, body)] * 9 + [(None, body)] * 4 + [(7, body[:900]), (7, ""), (7, ""), (8, None)]
    rows += [(20 + k, "a short text") for k in range(5)] + [(20, "a short text")] * 2 + [(None, "alone")] * 3
    rows += [(40 + k, "".join(r.choice("xyz ") for _ in range(60 * k)) + body[500:500 + 130 * k] + str(k) * 40) for k in range(12)]
    rows += [(60, "ab" * 2000), (61, "ab" * 700 + body[:333])]
    rows += [(70, "".join(r.choice("klmn ") for _ in range(1_100_000)) + body)]   # longer than a slice
    got = _chunk_result(cd.chunk_dedup(frame(spark, rows).repartition(5)))
    assert got == _chunk_brute(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert got[7, 3000, 3000, 1, empty] == 8 and got[7, 3000, 0, 0, hashlib.sha256(body.encode()).hexdigest()] <= 1


def test_chunk_dedup_empty(empty):
    assert cd.chunk_dedup(empty).count() == 0
