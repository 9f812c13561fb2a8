"""Operators 4, 5, 10 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.llm import decontaminate as dc
from demandlab.llm import exact_dedup as ed
from demandlab.llm import token_counts as tc

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


def test_minimal_perfect_hash_is_minimal_and_perfect():
    key = np.frombuffer(random.Random(1).randbytes(32 * 5000), np.uint8).reshape(-1, 32)
    sizes, flat, slot = ed.build_mph(key)
    assert sorted(slot.tolist()) == list(range(5000))
    stored = key[np.argsort(slot)]
    assert (ed.find(key, sizes, flat, stored) == slot).all()
    other = np.frombuffer(random.Random(2).randbytes(32 * 500), np.uint8).reshape(-1, 32)
    assert (ed.find(other, sizes, flat, stored) == -1).all()
    assert ed.build_mph(key[:0])[0] == []


@pytest.mark.parametrize("history", ["all", "none", "some"])
def test_exact_dedup(docs, rows, history):
    old = {"all": F.lit(True), "none": F.lit(None).cast("boolean"), "some": F.crc32(docs["doc_id"].cast("string")) % 2 == 0}[history]
    got = ed.exact_dedup(docs, old, keys_per_shard=20).toPandas()
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    assert len(got) == len(rows)
    assert got.kept.sum() == len(groups)
    want = Counter()
    for bare, members in groups.items():
        for m in members:
            want[m[3], min(members)[3], len(members), hashlib.sha256(bare.encode()).hexdigest()] += 1
    none = lambda x: None if x != x or x is None else int(x)
    assert Counter((none(a), none(b), c, d) for a, b, c, d in zip(got.doc_id, got.keep_id, got.group_size, got.text_sha256, strict=True)) == want


def _brute_hits(text, items):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    w = pat.findall(low(text))
    hit, found = set(), set()
    for item, t in items:
        x = pat.findall(low(t))
        n = min(10, len(x))
        for k in range(len(x) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == x[k:k + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("bound", [10**6, 0])
def test_decontaminate(spark, docs, rows, bound):
    long_words = rows[17][1].split()
    items = [(1, rows[3][1]), (2, " ".join(long_words[2:13])), (10, "one two"), (11, "ONE"), (12, None), (13, "!!"), (14, " ".join(rows[24][1].split()[:9])), (2, "ab ab ab")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, fp long")
    got = dc.decontaminate(docs, bench, broadcast_windows=bound).toPandas()
    want = Counter((i, *_brute_hits(t, items)) for i, t in rows)
    assert Counter((None if i != i else int(i), *r) for i, *r in got.itertuples(index=False)) == want
    assert got.contaminated.any() and not got.contaminated.all()


def test_winnowing_guarantee():
    r = np.random.default_rng(5)
    h = r.integers(0, 2**63, 400, dtype=np.int64).astype(np.uint64)
    _, chosen, _, ok = dc.fingerprints(h, np.array([0, 400]))
    for j in range(391):
        assert ok[j] and chosen[j:j + dc.GRAMS_IN_WINDOW].any()


def test_token_counts(docs, rows):
    got = tc.token_counts(docs, WORDS, limit=100, entries=50).toPandas()
    enc = tc.Encoder(WORDS)
    want = Counter()
    for i, t in rows:
        n = enc.text(t or "")
        want[i, len((t or "").encode()), n, n > 100] += 1
    assert Counter((None if i != i else int(i), *r) for i, *r in got.itertuples(index=False)) == want


def _slice(many):
    raw = [t.encode() for t in many]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])


def _piecewise(enc, many):
    """Token counts by pieces, the number of pieces and of those that the library judged."""
    cp, coffs, s, e, own = tc.split_rows(*_slice(many), enc.special)
    words = np.array(tc.strings_of(cp, s, e), object)
    size = np.zeros(len(s), np.int64)
    for kind, count in ((own, enc.texts), (~own, enc.pieces)):
        if kind.any():
            size[kind] = count(words[kind].tolist())
    total, at = np.concatenate([[0], np.cumsum(size)]), np.searchsorted(s, coffs)
    return total[at[1:]] - total[at[:-1]], len(s), int(own.sum())


SIGNS = "aBc'stdrevlm  \n\t.,!0129éÉßÿœŒ'ŉ \u0085|<>-_'re'll'S'T'ſ²½ª\x1c\x1f\x00ıİ"
SCRIPTS = "aZ's 't  \n.—“”’…€§ПриветЁжΣσςἈάلعربيةहिन्दी한국어각ㄱ日本語。、カナｶﾅ１２Ⅻ٣🙂👩‍👩‍👧🇫🇷e\u0301n\u0303\u2003\u3000\u2000\u2028\u212b\ua7cb\u0378\U0001f8ff\U000e0041\U0010ffff\u1161\u11a8\u0338<=>"


def test_pre_tokens_agree_with_the_library():
    r = random.Random(5)
    many = ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    many += ["<|endoftext|> hi", "a<|startoftext|>b", "'S it's we'll they're x''s 's 't't", "<|endof", "text|>", "<|endoftext|><|endoftext|>s'S", "<|ENDOFTEXT|> É"]
    enc = tc.Encoder(WORDS)
    got, _, _ = _piecewise(enc, many)
    assert got.tolist() == [enc.text(t) for t in many]


def test_pre_tokens_of_any_script():
    r = random.Random(6)
    many = ["".join(r.choice(SCRIPTS) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    enc = tc.Encoder(WORDS)
    got, _, _ = _piecewise(enc, many)
    assert [t for t, n in zip(many, got.tolist(), strict=True) if n != enc.text(t)] == []
    # whole scripts pass the table: only stretches with a combining mark or the like are left to the library
    plain = ["Привет, мир — “так”… 5 €", "日本語の文章。", "Ελληνικά κείμενα", "한국어 문장", "🙂 ok"] * 3
    assert _piecewise(enc, plain)[2] == 0
    assert _piecewise(enc, ["one cafe\u0301 in many words"])[1:] == (5, 1)


def test_every_code_point_agrees_with_the_library():
    enc = tc.Encoder(WORDS)
    many = [f"a{c}{c}A1 {c}'s!" for c in map(chr, [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFF])]
    for i in range(0, len(many), 20_000):
        part = many[i:i + 20_000]
        got, _, _ = _piecewise(enc, part)
        assert [hex(ord(t[1])) for t, n in zip(part, got.tolist(), strict=True) if n != enc.text(t)] == []


def test_token_counts_of_any_script_and_long_texts(spark):
    r = random.Random(7)
    rows = [(i, "".join(r.choice(SCRIPTS) for _ in range(r.randint(0, 300)))) for i in range(60)]
    rows += [(100, "".join(r.choice(SCRIPTS + " words and words ") for _ in range(900_000))), (101, "plain words, many of them. " * 60_000), (102, "x" * 1_300_000)]
    enc = tc.Encoder(WORDS)
    got = {g.doc_id: (g.n_bytes, g.n_tokens) for g in tc.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()}
    assert got == {i: (len(t.encode()), enc.text(t)) for i, t in rows}


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert ed.exact_dedup(empty, F.lit(True)).count() == 0
    assert dc.decontaminate(empty, bench).count() == 0
    assert tc.token_counts(empty, WORDS).count() == 0


def test_empty_benchmark(spark, docs, rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(docs, bench).where("contaminated").count() == 0
