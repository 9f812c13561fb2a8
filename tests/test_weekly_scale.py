"""The weekly roll-up does not shuffle its rows, and the CSV panel takes little disk."""
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandlab.operators import panel as P
from demandlab.plans import registry_models as M
from demandlab.sources import io
from tests.test_panel import CFG


@pytest.fixture(scope="module")
def daily(spark):
    """Seven days of 400 articles in 40 categories of level 2, one line; every third article has no price."""
    a = spark.range(400).select(F.col("id").alias("key_article"), (F.col("id") % 40).cast("string").alias("article_cat_2"))
    d = a.select("*", F.explode(F.sequence(F.lit(CFG.start), F.lit(CFG.end))).alias("date"))
    price = F.when(F.col("key_article") % 3 > 0, F.col("key_article"))
    return d.select("*", P.key_of_date(F.to_date(F.date_trunc("week", "date"))).alias("key_week"), F.lit("PPL1").alias("ppl"),
                    F.lit(1.5).alias("sum_regular_art_sales_ppl"), F.lit(1).cast("long").alias("nr_orders_day_ppl"),
                    price.alias("price_in_cents"), price.alias("price_in_cents_default"), F.lit(0.1).alias("unavailability_perc"),
                    F.lit(12.25).alias("avg_high_temp"), F.lit(0).alias("promo_dummy"), F.lit("Drinks").alias("article_cat_1"),
                    *[F.lit("x").alias(c) for c in ("article_name", "article_tier", "article_cat_3", "article_cat_4", "article_id")],
                    F.lit(1.0).alias("art_content_volume"), F.lit(1).alias("art_is_multipack"))


def test_weekly_rows_are_not_shuffled(spark, daily):
    """With the counts planned by estimate, a large weekly table was shuffled to them; here its least size counts as large."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        w = P.weekly(daily, CFG)
        plan = w._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        got = {(r.article_cat_2, r.nr_articles_in_cat, r.nr_articles_in_cat_2) for r in w.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    priced = [i for i in range(400) if i % 3 > 0]
    assert got == {(str(c), len(priced), len([i for i in priced if i % 40 == c])) for c in range(40)}


def test_ordered_rows_are_the_same(daily):
    assert Counter(P.weekly(daily, CFG, ordered=True).collect()) == Counter(P.weekly(daily, CFG).collect())


def test_csv_panel_is_compressed(spark, tmp_path, monkeypatch):
    seen = {}
    real = io.write_panel

    def spy(df, path, **kw):
        seen["path"], seen["rows"] = path, df.count()
        real(df, path, **kw)
    monkeypatch.setattr(io, "write_panel", spy)
    out = M.q_weekly_csv(spark, "/root/testdata/sf0.001")
    assert out.count() == seen["rows"] > 0
    size = sum(os.path.getsize(os.path.join(seen["path"].removeprefix("file:"), f)) for f in os.listdir(seen["path"].removeprefix("file:")))
    assert size < 30 * seen["rows"]      # some 140 bytes a row as plain text


def test_compressed_files_are_bounded_and_read_back(spark, tmp_path):
    df = spark.range(95, numPartitions=1).select("id", (F.col("id") / 4).alias("x"))
    io.write_panel(df, str(tmp_path / "c"), fmt="csv", compression="gzip", file_rows=20)
    assert len([f for f in os.listdir(tmp_path / "c") if f.endswith(".csv.gz")]) == 5
    assert Counter(io.read_panel_csv(spark, str(tmp_path / "c"), "id long, x double").collect()) == Counter(df.collect())


def test_typed_read_of_missing_and_odd_entries(spark, tmp_path):
    """The casts give what casting the trimmed entry that isn't a missing word gives."""
    words = ["", "nan", " NaN", "inf", "-Inf ", "+inf", "Infinity", "-infinity", "null", "None", "na", "7", " 8 ", "-3", "1.5", "1e3", "1e999",
             "-1e999", "+infinity", "x", "2020-01-02", " 2020-01-03 ", "300", "9999999999", "true"]
    kinds = ["tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean", "decimal(10,2)", "string"]
    path = tmp_path / "odd.csv"
    path.write_text("".join(",".join([w] * n) + "\n" for w, n in [(",".join(f"c{i}" for i in range(len(kinds))), 1)]) +
                    "".join(",".join([f'"{w}"'] * len(kinds)) + "\n" for w in words))
    raw = spark.read.option("header", True).csv(str(path))
    known = {c: F.when(~F.lower(F.trim(F.col(c))).isin(*io.MISSING), F.trim(F.col(c))) for c in raw.columns}
    want = raw.select(*[F.col(c) if k == "string" else known[c].try_cast(k).alias(c) for c, k in zip(raw.columns, kinds)])
    got = io.read_panel_csv(spark, str(path), ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
    assert [str(r) for r in got.collect()] == [str(r) for r in want.collect()] and got.count() == len(words)
