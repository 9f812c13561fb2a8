"""Operators 11, 12 and 13 against brute force, with NULLs, ties, repeated rows, long values and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import conversation_repair as cr
from demandlab.llm import hard_negatives as hn
from demandlab.llm import turn_grammar as tg
from demandlab.llm import url_filter as uf

# ------------------------------------------------------------------ hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, rid long, q binary, wave int"


def _vectors(seed, n=260, dim=16):
    r = random.Random(seed)
    centre = [[r.gauss(0, 0.3) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        c = r.randrange(4)
        v = [x + r.gauss(0, 0.15) for x in centre[c]]
        if i % 3 == 0:
            v = list(centre[0])     # a third of all rows share one vector
        out.append([i, v, r.choice([c, c, c, r.randrange(10)])])
    return out + [[None, centre[1], 1], [None, centre[1], 3], [300, None, 1], [400, [1.0] * dim, None], [500, [None] + [1.0] * (dim - 1), 2],
                  [600, [float("nan")] * dim, 2], [700, [float("inf")] * dim, 2], [100, centre[2], 2], [100, centre[2], 2], [800, [], 1], [900, [3.0e4] * dim, 1],
                  [901, [2.5e4] * dim, 2], [7, [0.5] * 3, 1], [1000, [-1.0] * dim, 5], [1001, [1.0] * dim, 5]]


def _mined(rows, k=5):
    e = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        q = [int(x) for x in np.floor(256.0 * np.array(v, np.float32).astype(float))]
        e.append((i, label, q))
    out = []
    for a, (i, la, qa) in enumerate(e):
        if i is None or i % 100:
            continue
        s = [(-sum(x * y for x, y in zip(qa, q, strict=False)), j is None, j or 0, lb == la) for b, (j, lb, q) in enumerate(e) if b != a]
        for p in sorted(x for x in s if x[3])[:k]:
            found = sorted(x for x in s if not x[3] and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0])[:k]
            out += [(i, None if p[1] else p[2], r, None if x[1] else x[2], -p[0], -x[0]) for r, x in enumerate(found, 1)]
    return Counter(out)


def _label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("seed,wave", [(1, 8 << 20), (2, 3000)])
def test_hard_negatives(spark, seed, wave):
    rows = _vectors(seed)
    df = spark.createDataFrame([(*x, k, b"q", 0) for k, x in enumerate(rows)], VECTORS).repartition(3)
    got = hn.hard_negatives(df, F.col("vec_id") % 100 == 0, _label(), wave_bytes=wave).collect()
    assert Counter(tuple(r) for r in got) == _mined(rows)


def test_hard_negatives_empty(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hn.hard_negatives(none, F.col("vec_id") % 100 == 0, _label()).count() == 0


@pytest.mark.parametrize("dim", [4, 8, 12, 64, 7])
def test_summaries_bound_scores(dim):
    g = np.random.default_rng(dim)
    a, b = (np.floor(g.normal(0.2, 30, (50, dim))) for _ in range(2))
    score = a @ b.T
    va, vb = (hn.Vectors.stored(x, hn.summaries(x)) for x in (a, b))
    for (ma, da), (mb, db) in zip(va.sums, vb.sums, strict=True):
        assert (np.abs(score - ma @ mb.T) <= da @ db.T + 1e-6).all()
    low = np.sort(score, axis=1)[:, -3]
    for high in (np.full(50, np.inf), low + 5):
        open_ = hn.open_pairs(va, vb, low, high, np.ones((50, 50), bool))
        assert open_[(score >= low[:, None]) & (score <= high[:, None])].all()


# ------------------------------------------------------------------ URL filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = [None, "", "no scheme/en/", "http://example.net", "http://example.net/", "HTTPS://EXAMPLE.Net/en/x", "http://a.b.example.net/en/?q=1", "http://badexample.net/en/",
        "http://example.com/de/", "http://example.com/DE/", "http://x.org/fr/1#f", "http://x.org/fr?x", "http://net/", "http://x.net:80/", "http://x.com?a=1&ref=2", "http://x.com#?ref=1",
        "http://www.x.com/?a=1", "https://x.com/a//?utm_source=1&b=2&a=1#z", "http://X.com/a?a=1&b=2", "file:///en/x", "http://é.com/ß?ü=1", "a://b://c.net/x", "http://x.com/\n/",
        "http://x.com/" + "/" * 3000, "http://x.com/" + "y/" * 600_000 + "z?ref=1"]


def _canonical(u):
    if u is None or "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    before = rest.split("#", 1)[0]
    query = before.split("?", 1)[1] if "?" in before else ""
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(ref|utm_[a-z]+)(=|\Z)", p))
    return low, path, low.removeprefix("www.") + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def _judged(urls, listed):
    bad = {_canonical(u)[2] for u in listed} - {None}
    out = Counter()
    for i, u in urls:
        host, path, whole = _canonical(u)
        fit = max(((len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        out[i, host, path, fit and fit[1], fit[2] if fit else "block" if whole in bad else "allow"] += 1
    return out


@pytest.mark.parametrize("hot,blocks", [(10_000, 1 << 18), (2, 1)])
def test_url_filter(spark, hot, blocks):
    r = random.Random(5)
    urls = [(k if k % 9 else None, u) for k, u in enumerate(URLS * 2)] + [(100, "http://hot.com/?ref=9"), (100, "http://hot.com/?ref=9")] + [(200 + k, "http://hot.com") for k in range(80)]
    urls += [(500 + k, f"http://h{r.randrange(40)}.com/{r.randrange(20)}{r.choice(['', '?ref=1', '/'])}") for k in range(400)]
    df = spark.createDataFrame([(i, u, "h", "p", "c", 1) for i, u in urls], "page_id long, url string, host string, path string, canonical string, _block int").repartition(3)
    listed = df.where(F.col("url").rlike("^[^#]*[?&]ref="))
    got = uf.url_filter(df, RULES, listed, hot=hot, most_blocks=blocks)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(tuple(x) for x in got.collect()) == _judged(urls, [u for _, u in urls if u and re.match("[^#]*[?&]ref=", u)])


def test_url_filter_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    assert uf.url_filter(none, RULES, some).count() == 0
    assert uf.url_filter(some, [], none).first().verdict == "allow"


def test_url_filter_is_native(spark):
    df = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    plan = uf.url_filter(df, RULES, df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ------------------------------------------------------------------ conversations

MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _cheapest(letters):
    """Plain DP over whole audits, without matrices."""
    def inserts(st):
        for _ in range(3):
            for (a, m), b in MOVES.items():
                if m != "s" and a in st:
                    st[b] = min(st.get(b, (10**9, "")), (st[a][0] + 3, st[a][1] + "I"))
        return st
    st = inserts({0: (0, "")})
    for c in letters:
        at = tg.LETTERS.index(c)
        new: dict = {}
        for a, (cost, audit) in st.items():
            ways = [(a, 4, "D")]
            if at < 8:
                extra = 3 if at >= 4 else 0
                for (q, m), b in MOVES.items():
                    if q == a and "suax"[at % 4] == m:
                        ways.append((b, extra, "K"))
                    elif q == a and m != "s":
                        ways.append((b, 3 + extra, "R"))
            for b, more, edit in ways:
                new[b] = min(new.get(b, (10**9, "")), (cost + more, audit + edit))
        st = inserts(new)
    return min(st[q] for q in (0, 3) if q in st)


def test_grammar_matches_plain_dp():
    r = random.Random(4)
    texts = ["".join(t) for n in range(4) for t in itertools.product("sua1xS", repeat=n)]
    texts += ["".join(r.choice(tg.LETTERS) for _ in range(r.randint(1, 80))) for _ in range(300)] + ["ua" * 300, "xu" * 200, "s" * 150 + "x" * 150]
    rules = []
    for _ in range(40):
        counts: dict = {}
        for t in texts:
            tg.pair_counts(tg.compressed(t, rules), counts)
        rules.append(max(counts, key=lambda p: (counts[p], p)))
    table = tg.matrices(rules)
    for t in texts:
        assert tg.repair(tg.compressed(t, rules), table) == _cheapest(t) == tg.repair(t, table), t


def test_all_small_edit_sequences():
    """Every edit sequence of short inputs tried out: cost and audit are the least."""
    for t in map("".join, itertools.product("sua14xS", repeat=2)):
        best = []
        for ins in itertools.product(["", "I", "II"], repeat=3):
            for edits in itertools.product("DKR", repeat=2):
                audit = ins[0] + edits[0] + ins[1] + edits[1] + ins[2]
                made = len(audit) - audit.count("D")
                want = ("s" if made % 2 else "") + "ua" * (made // 2)
                if want == "s":
                    continue
                cost, k, i, ok = 0, 0, 0, True
                for e in audit:
                    at = tg.LETTERS.index(t[i]) if e != "I" else 0
                    if e == "I":
                        ok &= want[k] != "s"
                        cost, k = cost + 3, k + 1
                        continue
                    i += 1
                    if e == "D":
                        cost += 4
                        continue
                    ok &= at < 8 and (("suax"[at % 4] == want[k]) if e == "K" else want[k] != "s")
                    cost, k = cost + (3 if 4 <= at < 8 else 0) + (3 if e == "R" else 0), k + 1
                if ok:
                    best.append((cost, audit))
        assert min(best) == tg.repair(t, tg.matrices([])), t


def _repaired(rows):
    convs = {r[0]: [] for r in rows}
    for c, t, ro, x in rows:
        ro, x = (" " if v is None else v for v in (ro, x))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            convs[c] += [(t, "user" if k == 4 else ro, x)] * (2 if k == 3 else 1)
    out = set()
    for c, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        ts = [r[0] for r in rs if r[0] is not None]
        seen, letters, n = set(), "", Counter()
        for _, ro, x in rs:
            bare = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (ro, x) in seen else "truncated" if bare[-1] not in ".!?" else "fine"
            seen.add((ro, x))
            n[fault] += 1
            at = "sua".find(ro[:1]) if ro[:1] else 3
            letters += ("suax" if fault == "fine" else "1234" if fault == "truncated" else "SUAX")[at if at >= 0 else 3]
        first = [r[1][:1] for r in rs]
        cost, audit = _cheapest(letters)
        made, lines, i = len(audit) - audit.count("D"), [], 0
        for e in audit:
            turn = "user" if (len(lines) - made % 2) % 2 == 0 else "assistant"
            if e == "I":
                lines.append(turn + ":")
                continue
            _, ro, x = rs[i]
            i += 1
            if e != "D":
                lines.append((ro if e == "K" else turn) + ":" + x)
        out.add((c, max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, n["blank"], n["duplicate"], n["truncated"],
                 sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


CHATS = "conv_id long, turn long, role string, text string, letters string, conv string, n long, audit string"


def _chats(seed):
    r = random.Random(seed)
    texts = ["Hi.", "ok", "What?! ", "no end", "", " \t\n\x0b", "Ja!", None, "x.\n\n", "é…", "日本。", "long " * 300 + "."]
    rows = []
    for c in [None, *range(60)]:
        for t in range(r.choice([0, 1, 2, 5, 9])):
            rows.append((c, t if r.random() > 0.1 else None, r.choice(["system" if t == 0 else "user", "user" if t % 2 else "assistant", "assistant", "tool", "", None, "User"]), r.choice(texts)))
    rows += [rows[3], rows[3], rows[10]] + [(70, t % 50, "user", "again.") for t in range(400)] + [(71, -2**62, "user", "a."), (71, 2**62, "assistant", "b.")]
    return rows + [(72, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(500)] + [(73, 1, "user", "y" * 1_200_000 + "."), (73, 2, "assistant", "z" * 1_100_000)]


@pytest.mark.parametrize("seed,hot", [(1, 10_000), (2, 3)])
def test_conversation_repair(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(cr, "attach", lambda rows, table, keys, f=cr.attach: f(rows, table, keys, hot=hot))
    rows = _chats(seed)
    df = spark.createDataFrame([(*x, "l", "c", 1, "a") for x in rows], CHATS).repartition(5)
    chats = cr.rows_of(df)
    got = cr.conversation_repair(chats, cr.damaged(chats)).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {tuple(r) for r in got} == _repaired(rows)


def test_conversation_repair_empty(spark):
    chats = cr.rows_of(spark.createDataFrame([], CHATS))
    assert cr.conversation_repair(chats, cr.damaged(chats)).count() == 0
    lost = cr.rows_of(spark.createDataFrame([(2, t, "user", "x.", "", "", 0, "") for t in range(200) if zlib.crc32(f"2:{t}".encode()) % 20 == 0], CHATS))
    assert tuple(cr.conversation_repair(lost, cr.damaged(lost)).first()) == (2, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
