"""URL filter: rules by host and path, then a list of URLs behind a blocked Bloom filter.

DataFrame functions only. A rule (verdict, host, path) fits the URLs of its host
and of all its subdomains whose path starts with the rule's; of several that fit
the longest (host and path together) wins, at equal length block before allow.
URLs without a rule are judged by the list of canonical URLs:

1. The distinct canonical URLs of the list set one bit in each of the eight
   64-bit words of their block (512 bits, some 24 for each URL). The words are
   gathered by ``bit_or``, partly before the shuffle. The filter has at most
   ``most_blocks`` blocks, so its broadcast is bounded; beyond that number of
   URLs it only lets more false positives through.
2. Each row finds its block by a broadcast join. Rows that lack a bit are not
   in the list. The others, possible hits, are written.
3. The distinct canonical URLs of the possible hits, with their numbers of rows,
   are joined with the list itself; false positives end here. The rows get the
   answer back, those of very frequent URLs by a broadcast of checked size.

Canonical form: host without a leading ``www.``, path without trailing slashes,
``?`` and the sorted query parameters except empty ones, ``ref`` and ``utm_*``;
no scheme, no fragment.

Defined cases: NULL URLs and URLs without ``://`` have an empty host and path, no
rule fits them and they are in no list (allow). NULL ids stay. Repeated rows are
judged one by one. An empty list blocks nothing, an empty table gives no rows.
Only the id and URL columns are read; other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.llm.hotjoin import HOT_ROWS, attach
from demandlab.session import scratch_table

WORDS, URLS_PER_BLOCK, MOST_BLOCKS = 8, 21, 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form; NULL for URLs without ``://``."""
    host = host_of(url)
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(ref|utm_[a-z]+)(=|\z)")))
    bare = F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)
    whole = F.concat(bare, F.rtrim(path_of(url), F.lit("/")), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(F.instr(url, "://") > 0, whole)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, NULL without one."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in order]
    none = F.lit(None).cast("string")
    return (F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, order, strict=True)], none),
            F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, order, strict=True)], none))


def _bits(key: Column) -> list[Column]:
    """One bit for each word of the block."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def bloom_blocks(urls: DataFrame, n_blocks: int) -> DataFrame:
    """_block, _w0 .. _w7 of the distinct ``canonical`` URLs."""
    keyed = urls.select(_block(F.col("canonical"), n_blocks), *[b.alias(f"_w{i}") for i, b in enumerate(_bits(F.col("canonical")))])
    return keyed.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("_block")


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               listed_col: str = "url", most_blocks: int = MOST_BLOCKS, hot: int = HOT_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict (block or allow)."""
    spark = pages.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_table(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    urls = written(listed.select(canonical(listed[listed_col]).alias("canonical")).where("canonical is not null").distinct(), "listed_urls")
    n_blocks = max(1, min(most_blocks, -(-urls.count() // URLS_PER_BLOCK)))
    bloom = F.broadcast(bloom_blocks(urls, n_blocks))

    url = pages[url_col].cast("string")
    parts = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("*", rule.alias("rule"), verdict.alias("verdict"))
    found = ruled.withColumn("_block", F.when(F.col("rule").isNull(), _block(F.col("canonical"), n_blocks))).join(bloom, "_block", "left")
    passes = F.lit(True)
    for i, b in enumerate(_bits(F.col("canonical"))):
        passes = passes & (F.col(f"_w{i}").bitwiseAND(b) != 0)
    flagged = found.select(*ruled.columns, F.coalesce(F.col("rule").isNull() & F.col("canonical").isNotNull() & passes, F.lit(False)).alias("_hit"))

    hits = written(flagged.where("_hit").drop("_hit", "verdict"), "url_hits")
    asked = hits.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"))
    known = written(asked.join(urls.select("canonical", F.lit("block").alias("verdict")), "canonical", "left"), "url_known")
    out = ["page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")]
    return flagged.where(~F.col("_hit")).select(*out).unionByName(attach(hits, known, ["canonical"], hot=hot).select(*out))
