"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.bloom_lm import lm_scores
from demandlab.llm.chunk_dedup import chunk_dedup
from demandlab.llm.conversation_repair import conversation_repair, damaged, rows_of
from demandlab.llm.decontaminate import decontaminate
from demandlab.llm.exact_dedup import exact_dedup
from demandlab.llm.hard_negatives import hard_negatives
from demandlab.llm.mixing import mix_sources
from demandlab.llm.ngram_join import ngram_jaccard_join
from demandlab.llm.quality import quality_scores
from demandlab.llm.suffix_dedup import suffix_dedup
from demandlab.llm.token_counts import token_counts
from demandlab.llm.token_shards import token_shards
from demandlab.llm.url_filter import url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _remainder(docs: DataFrame, n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, _remainder(docs, 7) == 2)


def domain(source: Column) -> Column:
    """Four domains, told by the number in the source's name."""
    return F.concat(F.lit("d"), (F.regexp_extract(source, "([0-9]+)", 1).try_cast("int") % 4).cast("string"))


#: Target weights of the tree's nodes; sources share their language's budget equally.
WEIGHTS = [("d0", 4.0), ("d1", 3.0), ("d2", 2.0), ("d3", 1.0),
           *((f"d{d}/{lang}", w) for d in range(4) for lang, w in (("en", 5.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0)))]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 3, 7


def mixed(docs: DataFrame) -> DataFrame:
    weights = docs.sparkSession.createDataFrame(WEIGHTS, "path string, weight double")
    levels = {"domain": domain(docs["source"]), "lang": docs["lang"], "source": docs["source"]}
    return mix_sources(docs, levels, weights, share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "epoch", "n_tokens", "take_tokens")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32(doc_id) is even are the history, all others are new."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, F.crc32(docs["doc_id"].cast("string")) % 2 == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, table(spark, sf_dir, "labels"), _remainder(docs, 4) == 2)


def byte_bpe() -> tuple[str, str]:
    """Rank file and pattern of the byte-level BPE."""
    import public_tokenizers

    return _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents"), *byte_bpe())


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector is an anchor; every seventh has its label moved on."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first; the list holds every page that is reached by a referral link (``ref=``)."""
    pages = table(spark, sf_dir, "pages")
    return url_filter(pages, URL_RULES, pages.where(pages["url"].rlike(r"^[^#]*[?&]ref=")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = rows_of(table(spark, sf_dir, "conversations"))
    return conversation_repair(chats, damaged(chats))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bloom_lm": op2_bloom_lm,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality": op7_quality,
    "op8_token_shards": op8_token_shards,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_url_filter": op12_url_filter,
    "op13_conversation_repair": op13_conversation_repair,
}

def _mix_level(i: int) -> str:
    """One level of the tree: the parent's budget shared among its children, full ones first."""
    own = ", ".join(f"l{k}" for k in range(1, i + 1))
    up = ", ".join(f"l{k}" for k in range(1, i))
    path = " || '/' || ".join(f"l{k}" for k in range(1, i + 1))
    given = f"(SELECT {MIX_SHARE} * sum(tokens) FROM leaf)" if i == 1 else "p.given"
    parent = "" if i == 1 else f"JOIN n{i - 1} p USING ({up})"
    over = f"PARTITION BY {up}" if up else "PARTITION BY 1"
    return f"""
c{i} AS (
  SELECT c.*, {given} AS budget, coalesce(w.weight, 1.0) AS weight, {path} AS path
  FROM (SELECT {own}, sum(tokens) * {float(MIX_EPOCHS)} AS cap FROM leaf GROUP BY ALL) c {parent} LEFT JOIN w ON w.path = {path}),
f{i} AS (
  SELECT *, cap * sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= weight * (budget - (sum(cap) OVER (up ROWS UNBOUNDED PRECEDING) - cap)) AS is_full
  FROM c{i} WINDOW up AS ({over} ORDER BY cap / weight, path)),
n{i} AS (
  SELECT {own}, CASE WHEN is_full THEN cap
    ELSE least(cap, (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER par) * weight / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER par) END AS given
  FROM f{i} WINDOW par AS ({over}))"""


def _mix_sql() -> str:
    weights = ", ".join(f"('{p}', {w})" for p, w in WEIGHTS)
    return rf"""
WITH d AS (
  SELECT *, coalesce('d' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) % 4 AS VARCHAR), '') AS l1,
         coalesce(lang, '') AS l2, coalesce(source, '') AS l3, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n
  FROM documents),
w(path, weight) AS (VALUES {weights}),
leaf AS (SELECT l1, l2, l3, CAST(sum(n) AS DOUBLE) AS tokens FROM d GROUP BY ALL),{_mix_level(1)},{_mix_level(2)},{_mix_level(3)},
q AS (
  SELECT l1, l2, l3, CAST(floor(floor(given + 1e-6) / tokens) AS BIGINT) AS whole, floor(given + 1e-6) - floor(floor(given + 1e-6) / tokens) * tokens AS more
  FROM n3 JOIN leaf USING (l1, l2, l3) WHERE tokens > 0),
o AS (
  SELECT d.*, whole, more, sum(n) OVER (PARTITION BY l1, l2, l3 ORDER BY md5('{MIX_SEED}:' || whole || ':' || k), k, n ROWS UNBOUNDED PRECEDING) - n AS had
  FROM d JOIN q USING (l1, l2, l3) WHERE n > 0)
SELECT doc_id, lang, source, CAST(e AS INTEGER) AS epoch, n AS n_tokens, n AS take_tokens
FROM (SELECT *, unnest(range(0, whole)) AS e FROM o)
UNION ALL
SELECT doc_id, lang, source, CAST(whole AS INTEGER), n, CAST(least(n, more - had) AS BIGINT) FROM o WHERE had < more"""


def _repair_sql() -> str:
    """The edits as a fold over each conversation's rows: four states, each the least (cost, audit); '+' stands for inserts."""
    worst = 10**15
    start = ", ".join(f"'p{i}': {{'c': CAST({0 if i == 0 else worst} AS BIGINT), 'a': ''}}" for i in range(4))

    def then(i: int, cost: str, letters: str) -> str:
        return f"{{'c': acc.p{i}.c + {cost}, 'a': acc.p{i}.a || '{letters}'}}"

    def row(state: int, came: list[tuple[int, str]]) -> str:
        ways = [then(state, "4", "D")]
        for i, role in came:
            ways.append(then(i, f"(CASE WHEN x.role = '{role}' THEN x.extra ELSE {worst} END)", "K"))
            if role != "s":
                ways.append(then(i, "3 + x.extra", "R"))
        return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]

    rows = [row(0, []), row(1, [(0, "s")]), row(2, [(0, "u"), (1, "u"), (3, "u")]), row(3, [(2, "a")])]
    inserts = ["acc.p0", "acc.p1", f"least(acc.p2, {then(0, '3', 'I')}, {then(1, '3', 'I')}, {then(3, '3', 'I')})",
               f"least(acc.p3, {then(2, '3', 'I')}, {then(0, '6', 'II')}, {then(1, '6', 'II')})"]
    step = ", ".join(f"'p{i}': CASE WHEN x.kind = '+' THEN {a} ELSE {b} END" for i, (a, b) in enumerate(zip(inserts, rows, strict=True)))
    blank = r"'[^\x20\x09-\x0D]'"
    return rf"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda h: CAST(ascii(h) AS BIGINT))),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
               lambda v, bit: xor(v >> 1, CASE WHEN v & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))), 4294967295) % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM d),
f AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, {blank}) THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'fine' END AS fault,
         lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS after
  FROM o),
g AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (after IS NOT NULL AND initial || after NOT IN ('su', 'ua', 'au')) AS illegal,
         list_reduce(list_prepend({{'kind': '', 'role': '', 'extra': CAST(0 AS BIGINT), {start}}},
           list_prepend({{'kind': '+', 'role': '', 'extra': CAST(0 AS BIGINT), {start}}},
             flatten(list([{{'kind': 'row', 'role': initial, 'extra': CAST(CASE fault WHEN 'fine' THEN 0 WHEN 'truncated' THEN 3 ELSE {worst} END AS BIGINT), {start}}},
                           {{'kind': '+', 'role': '', 'extra': CAST(0 AS BIGINT), {start}}}] ORDER BY pos)))),
           lambda acc, x: {{'kind': '', 'role': '', 'extra': CAST(0 AS BIGINT), {step}}}) AS fold
  FROM f GROUP BY conv_id),
b AS (SELECT *, least(fold.p0, fold.p3) AS best FROM g),
e AS (
  SELECT conv_id, i, best.a[i] AS edit, length(replace(best.a, 'D', '')) AS made,
         length(replace(left(best.a, i), 'I', '')) AS pos, length(replace(left(best.a, i), 'D', '')) AS nth
  FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS i FROM b)),
w AS (
  SELECT e.conv_id, string_agg(CASE WHEN edit = 'K' THEN f.role WHEN (nth - made % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                               CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY i) AS repaired
  FROM e LEFT JOIN f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.pos = f.pos AND edit <> 'I' WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN w ON c.conv_id IS NOT DISTINCT FROM w.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op3_mixing": _mix_sql(),
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents),
g AS (
  SELECT bare, count(*) AS group_size,
         arg_min(doc_id, {'a': -cp, 'b': doc_id}) AS keep_id
  FROM d GROUP BY bare)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       d.doc_id = g.keep_id AS kept, sha256(d.bare) AS text_sha256
FROM d JOIN g ON d.bare = g.bare""",
    "op5_decontaminate": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM grams g JOIN win ON g.t = win.t AND g.n = win.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit
       FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(hi.items, '')) AS items_sha256,
       coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= 5""",
    "op12_url_filter": r"""
WITH u AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '&'),
                               lambda p: p <> '' AND NOT regexp_matches(p, '^(ref|utm_[a-z]+)(=|$)'))) AS params
  FROM pages),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
    (CASE WHEN starts_with(host, 'www.') THEN host[5:] ELSE host END) || rtrim(path, '/') || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM u),
listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(url, '^[^#]*[?&]ref=') AND canonical IS NOT NULL),
r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
j AS (
  SELECT page_id, c.host, c.path, canonical,
         (SELECT arg_max({'rule': r.host || r.path, 'verdict': r.verdict}, length(r.host || r.path)) FROM r
          WHERE (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)) AS best
  FROM c)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM j""",
    "op13_conversation_repair": _repair_sql(),
}
