"""Every pipeline stage against brute force on its own input, and the whole run."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from demandlab.llm import queries
from demandlab.llm.quality import quality_scores

from .conftest import SCHEMA
from .test_counts import _brute_hits
from .test_dedup import _sets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(df):
    return Counter(tuple(None if x != x else x for x in r) for r in df.select(*COLUMNS).toPandas().itertuples(index=False))


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Each stage's input and output over the smallest tables."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def test_stages_keep_the_columns(kept):
    for name, (before, after) in list(kept.items())[:-1]:
        assert after.columns == before.columns, name
        assert after.count() > 0


def test_quality(spark, kept):
    before, after = kept["quality"]
    score = quality_scores(before, spark.read.parquet(f"{SF}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    good = {r.doc_id for r in score.where("predicted = 1").collect()}
    assert {r.doc_id for r in after.select("doc_id").collect()} == good
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    agree = [(i in good) == bool(q) for i, q in labels.items()]
    assert sum(agree) / len(agree) > 0.95


def test_near_duplicates(kept):
    before, after = kept["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    sets = _sets(rows, 5)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    lead = {}
    for k, (i, _) in enumerate(rows):
        lead[root(k)] = min(lead.get(root(k), i), i)
    assert {r.doc_id for r in after.select("doc_id").collect()} == set(lead.values())


def test_decontaminate(spark, kept):
    before, after = kept["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before.collect() if not _brute_hits(r.text, items)[4]}
    assert {r.doc_id for r in after.select("doc_id").collect()} == clean


def test_mix(kept):
    before, after = kept["mix"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    want = Counter(con.execute(f"SELECT doc_id FROM ({queries.ORACLE_SQL['op3_mixing']})").df().doc_id)
    assert Counter(r.doc_id for r in after.select("doc_id").collect()) == want


def test_tokens(spark, kept):
    import numpy as np

    from demandlab.llm.token_shards import END_ID, Ids
    before, after = kept["tokens"]
    enc = Ids(*queries.byte_bpe()).enc
    want = Counter()
    for r in before.collect():
        n = len(enc.encode_ordinary(r.text)) + 1
        want.update((r.doc_id, k, min(512, n - 512 * k)) for k in range(-(-n // 512)))
    got = after.toPandas()
    assert Counter(zip(got.doc_id, got.piece, got.n_tokens, strict=True)) == want
    assert sorted(got.slot) == list(range(len(got))) and END_ID == 50256 and np.all(got.byte_offset >= 0)


def test_run(spark, kept):
    got = cp.run(spark, SF)
    assert sorted(got.columns) == sorted(kept["tokens"][1].columns)
    assert got.count() == kept["tokens"][1].count()


def test_stages_take_odd_rows(spark, docs, rows):
    """NULLs, repeated rows, empty and long texts, columns with names used inside."""
    keyed = docs.toPandas()
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.toPandas()
        assert set(got.doc_id.dropna()) <= set(keyed.doc_id.dropna())
    near = cp.near_duplicates(spark, docs, SF).toPandas()
    empty = [i for i, t in rows if not re.search(r"[^\x20\x09-\x0D]", t or "")]
    assert set(empty) <= set(near.doc_id)
    copied = Counter(i for i, t in rows)
    assert all(Counter(near.doc_id)[i] <= 1 for i, c in copied.items() if c > 1 and i not in empty)


def test_stages_take_empty_tables(spark):
    import tempfile
    path = tempfile.mkdtemp() + "/none"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    none = spark.read.parquet(path)
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0
