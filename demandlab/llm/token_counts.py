"""Token counts by a two-tier lookup of pre-token lengths, all on the map side.

A text is split into pre-tokens; its count is the sum of their token counts.
Tier one is a compact broadcast table (hash -> number of tokens) of frequent
pre-tokens; tier two is a bounded cache in each worker, filled by encoding the
misses with the tokenizer itself. Pre-tokens are never shuffled: the frequent
ones come from summaries of bounded size, the heaviest of each task's tables.

The vectorised splitter knows the pattern of the lower-casing word BPE
(contractions, letter runs, single digits, runs of other signs) over all code
points that the library's normaliser leaves alone but for their case. A stretch
between blanks that holds another one (a combining mark, say) or one of the
file's special strings is a piece of its own: the library counts it in whole, and
its count is cached like any other, so every count is the library's own.

Defined cases: NULL counts as empty (0 tokens); NULL ids are returned;
repeated rows count each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.llm.codepoints import BLANK, DIGIT, LETTER, OTHER, code_points, holds, inside_stretches, tables
from demandlab.llm.textcols import SLICE_BYTES, U64, id_and_text, in_sorted, mix, small_batches, text_slices
from demandlab.session import ship_package

RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
CACHE = 2_000_000
FRONT = 20  # bits of the front table

_mult = 0x9E3779B97F4A7C15
_table: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_table.get("pw", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        pw, inv = np.full(size, _mult, U64), np.full(size, pow(_mult, -1, 2**64), U64)
        pw[0] = inv[0] = 1
        _table["pw"], _table["inv"] = np.cumprod(pw, dtype=U64), np.cumprod(inv, dtype=U64)
    return _table["pw"], _table["inv"]


def pre_tokens(cp: np.ndarray, offs: np.ndarray, wild: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of lower-cased code points; rows end at ``offs``.

    A stretch between blanks with a ``wild`` code point is one piece.
    """
    n = len(cp)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = tables().kind[cp]
    any_wild = wild.any()
    if any_wild:
        cls[wild] = OTHER
    first = np.zeros(n + 1, bool)
    first[offs[:-1][offs[:-1] < n]] = True
    first[0] = first[n] = True
    first[1:n] |= (cls[1:] != cls[:-1]) | (cls[1:] == DIGIT)
    row_end = np.zeros(n + 4, bool)
    row_end[offs[1:]] = True
    # an apostrophe alone before letters may be a contraction
    q = np.flatnonzero((cp == 0x27) & first[:n] & first[1:])
    q = q[(q + 1 < n)]
    q = q[(cls[q + 1] == LETTER) & ~row_end[q + 1]]
    if len(q):
        far = np.append(cp, np.zeros(3, cp.dtype))
        c1, c2 = far[q + 1], far[q + 2]
        one = np.isin(c1, [ord(x) for x in "stmd"])
        pair = ~first[np.minimum(q + 2, n)]
        two = pair & (((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l"))))
        for hit, k in ((one, 2), (two & ~one, 3)):
            at = q[hit]
            first[at + 1] = False
            end = np.minimum(at + k, n)
            first[end] = True
    if any_wild:
        first[:n] &= ~inside_stretches(cls != BLANK, wild, offs)
    at = np.flatnonzero(first)
    starts, ends = at[:-1], at[1:]
    keep = cls[starts] != BLANK
    return starts[keep], ends[keep]


def span_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    pw, inv = _powers(len(cp) + 1)
    prefix = np.zeros(len(cp) + 1, U64)
    np.cumsum(tables().symbol[cp] * pw[:len(cp)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inv[starts] ^ ((ends - starts).astype(U64) * U64(0xA24BAED4963EE407)))


def split_rows(buf: np.ndarray, offs: np.ndarray, special: Special) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, row offsets, starts and ends of the pieces, and which pieces only the library may judge.

    Code points are lower-cased, but as given in pieces of the last kind.
    """
    raw, coffs = code_points(buf, offs)
    t = tables()
    wild = t.wild[raw]
    for a, b in special.spans(raw):
        wild[a:b] = True
    cp = t.low[raw]
    s, e = pre_tokens(cp, coffs, wild)
    own = holds(wild, s, e)
    if own.any():
        step = np.zeros(len(cp) + 1, np.int8)
        step[s[own]] += 1
        step[e[own]] -= 1
        given = np.cumsum(step[:-1], dtype=np.int8) > 0
        cp[given] = raw[given]
    return cp, coffs, s, e, own


class Special:
    """The strings that the tokenizer file gives tokens of their own."""

    def __init__(self, tok):
        added = [t for t in tok.get_added_tokens_decoder().values() if t.content]
        names = "|".join(re.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content)))
        flags = re.IGNORECASE if any(t.normalized for t in added) else 0
        self.one, self.every = (re.compile(x, flags) for x in (names, f"(?=({names}))")) if names else (None, None)

    def spans(self, cp: np.ndarray) -> list[tuple[int, int]]:
        """Where they are, overlapping ones too."""
        if self.one is None:
            return []
        text = cp.tobytes().decode("utf-32-le")
        return [m.span(1) for m in self.every.finditer(text)] if self.one.search(text) else []


class KeyCache:
    """A bounded map of 64-bit keys to values: a sorted table and a small sorted one of late keys.

    A direct-mapped table in front of them answers most lookups with one access.
    """

    def __init__(self):
        self.front, self.front_values = np.zeros(1 << FRONT, U64), np.zeros(1 << FRONT, np.int64)
        self.keys, self.values = np.empty(0, U64), np.empty(0, np.int64)
        self.late, self.late_values = np.empty(0, U64), np.empty(0, np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        out = np.full(len(key), -1, np.int64)
        for keys, values in ((self.keys, self.values), (self.late, self.late_values)):
            at = in_sorted(keys, key)
            out[at >= 0] = values[at[at >= 0]]
        return out

    def quick(self, key: np.ndarray) -> np.ndarray:
        """Values of the keys that the front table holds, -1 for others."""
        at = key >> U64(64 - FRONT)
        return np.where(self.front[at] == key, self.front_values[at], -1)

    def show(self, key: np.ndarray, value: np.ndarray) -> None:
        """Let the front table hold these keys."""
        at = key >> U64(64 - FRONT)
        self.front_values[at] = value
        self.front[at] = key
        wrong = self.front[at] != key  # of keys for one place the last one stays, with its own value
        if wrong.any():
            self.front[at[wrong]] = 0

    def full(self, more: int) -> bool:
        return len(self.keys) + len(self.late) + more > CACHE

    def put(self, key: np.ndarray, value: np.ndarray) -> None:
        """Add keys that are not there yet."""
        key, value = np.concatenate([self.late, key]), np.concatenate([self.late_values, value])
        if len(key) > 50_000 + len(self.keys) // 4:
            key, value = np.concatenate([self.keys, key]), np.concatenate([self.values, value])
            self.late, self.late_values = np.empty(0, U64), np.empty(0, np.int64)
            order = np.argsort(key, kind="stable")
            self.keys, self.values = key[order], value[order]
        else:
            order = np.argsort(key, kind="stable")
            self.late, self.late_values = key[order], value[order]


class Encoder:
    """Token counts of pre-tokens and texts by the library, loaded once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = Special(self.tok)
        self.cache = KeyCache()

    def text(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        return np.array([len(e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)], np.int32)

    def pieces(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each pre-token: encoded together with blanks between, told apart by word number."""
        out = np.zeros(len(pieces), np.int32)
        for i in range(0, len(pieces), 2000):
            part = pieces[i:i + 2000]
            ids = self.tok.encode(" ".join(part), add_special_tokens=False).word_ids
            n = np.bincount(np.array(ids, np.int64), minlength=len(part)) if ids else np.zeros(0, np.int64)
            if len(n) != len(part) or (n == 0).any():
                n = self.texts(part)
            out[i:i + len(part)] = n
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def strings_of(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    text = cp.tobytes().decode("utf-32-le")
    return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _heavy(path: str, top: int):
    """Each task's heaviest pre-tokens: a table of bounded size, thinned when it doubles."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        name: dict[int, str] = {}
        special = encoder(path).special
        for _, buf, offs in text_slices(batches):
            cp, _, s, e, own = split_rows(buf, offs, special)
            if own.any():
                s, e = s[~own], e[~own]
            key, at, n = np.unique(span_hashes(cp, s, e), return_index=True, return_counts=True)
            best = np.argsort(-n, kind="stable")[:top]
            known = [(k, c, i) for k, c, i in zip(key[best].tolist(), n[best].tolist(), at[best].tolist(), strict=True)]
            for k, c, i in known:
                if k not in count:
                    name[k] = cp[s[i]:e[i]].tobytes().decode("utf-32-le")
                count[k] = count.get(k, 0) + c
            if len(count) > 4 * top:
                keep = sorted(count, key=lambda k: -count[k])[:top]
                count, name = {k: count[k] for k in keep}, {k: name[k] for k in keep}
        keep = sorted(count, key=lambda k: -count[k])[:top]
        if keep:
            yield pa.record_batch([pa.array(np.array(keep, U64).view(np.int64)), pa.array([name[k] for k in keep]), pa.array([count[k] for k in keep], pa.int64())], ["key", "piece", "n"])
    return kernel


def frequent_lengths(docs: DataFrame, path: str, entries: int = 65_536, per_task: int = 8_192) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and token counts of at most ``entries`` frequent pre-tokens."""
    heavy = docs.select("text").mapInArrow(_heavy(path, per_task), "key long, piece string, n long")
    rows = heavy.groupBy("key").agg(F.sum("n").alias("n"), F.min("piece").alias("piece")) \
        .orderBy(F.desc("n"), "key").limit(entries).select("key", "piece").collect()
    keys = np.array([r["key"] for r in rows], np.int64).view(U64)
    sizes = encoder(path).pieces([r["piece"] for r in rows]) if rows else np.empty(0, np.int32)
    order = np.argsort(keys)
    return keys[order], sizes[order]


def _count(path: str, table, limit: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = table.value
        enc = encoder(path)
        for rows, buf, offs in text_slices(batches):
            cp, coffs, s, e, own = split_rows(buf, offs, enc.special)
            h = span_hashes(cp, s, e)
            n = enc.cache.quick(h)
            miss = np.flatnonzero(n < 0)
            if len(miss):
                key, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
                at = in_sorted(keys, key)
                size = np.where(at >= 0, sizes[at] if len(sizes) else 0, -1).astype(np.int64)
                late = np.flatnonzero(size < 0)
                size[late] = enc.cache.get(key[late])
                new = np.flatnonzero(size < 0)
                if len(new):
                    i = miss[one[new]]
                    for kind, tokens_of in ((own[i], enc.texts), (~own[i], enc.pieces)):
                        if kind.any():
                            size[new[kind]] = tokens_of(strings_of(cp, s[i[kind]], e[i[kind]]))
                    if enc.cache.full(len(new)):
                        enc.cache = KeyCache()
                    enc.cache.put(key[new], size[new])
                enc.cache.show(key, size)
                n[miss] = size[back]
            total = np.concatenate([[0], np.cumsum(n)])
            ends = np.searchsorted(s, coffs)
            tokens = total[ends[1:]] - total[ends[:-1]]
            yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(offs)), pa.array(tokens), pa.array(tokens > limit)],
                                  ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return kernel


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 entries: int = 65_536) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, with the tokenizer file at ``path``."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    docs = id_and_text(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, entries))
    return docs.mapInArrow(_count(path, table, limit), RESULT)
