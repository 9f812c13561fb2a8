"""The daily table's rows are made from arrays by day: no join or rounding per row, and the same rows."""
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from demandlab.operators import panel as P
from tests.test_panel import CFG, WH


@pytest.fixture(scope="module")
def wh(spark):
    """Article 1 twice under other names, article 4 without facts, the 5th missing from the calendar,
    prices and promotions reaching over the period's ends."""
    from datetime import datetime
    w = WH(spark)
    a = w.dm_article.where("key_article = 1")
    w.dm_article = (w.dm_article.unionByName(a.withColumn("art_supply_chain_name", F.lit("cola 2")))
                    .unionByName(a.withColumn("key_article", F.lit(4))))
    w.dm_date = w.dm_date.where("date <> DATE '2021-01-05'")
    w.ft_price = w.ft_price.unionByName(spark.createDataFrame(
        [(1, "PPL2", "P", 60, datetime(2020, 1, 1), datetime(2020, 12, 31)), (1, "PPL2", "P", 65, datetime(2021, 1, 7), datetime(2022, 1, 1)),
         (1, "PPL1", "P", None, datetime(2021, 1, 6), datetime(2021, 1, 8)), (1, None, "P", 5, datetime(2021, 1, 1), datetime(2021, 1, 7))], w.ft_price.schema))
    w.ft_promotion_article_history = w.ft_promotion_article_history.unionByName(spark.createDataFrame(
        [(7, 1, datetime(2021, 1, 6), datetime(2030, 1, 1), "no")], w.ft_promotion_article_history.schema))
    return w


def _key(d):
    return d.year * 10000 + d.month * 100 + d.day


def test_rows_match_the_operators(spark, wh):
    """Each fact of a row is the one its own operator gives for that article, day and line."""
    rows = P.daily_features(wh, CFG).collect()
    days = [date(2021, 1, d) for d in (1, 2, 3, 4, 6, 7)]
    assert Counter((r.key_article, r.article_name, r.date, r.ppl) for r in rows) == Counter(
        (a, n, d, p) for a, n in ((1, "cola"), (1, "cola 2"), (4, "cola")) for d in days for p in ("PPL1", "PPL2"))
    price = {(r.key_article, r.ppl, r.date): r.price_in_cents for r in P.latest_price_per_day(wh.ft_price, CFG).collect()}
    rate = {(r.key_article, r.ppl, r.key_order_date): r for r in P.aor(wh.ft_orderline, wh.dm_order, CFG).collect()}
    promo = {tuple(r) for r in P.promo_flags(wh.ft_promotion_article_history, wh.dm_promotion, wh.dm_article, wh.dm_date, CFG).collect()}
    unav = {(r.key_article, r.key_date): r.unavailability_perc for r in P.unavailability(wh.ft_warehouse_article_daily, wh.dm_article, wh.dm_date, CFG).collect()}
    wx = {r.key_date: r for r in P.weather(wh.dm_weather_daily, wh.dm_date, CFG).collect()}
    for r in rows:
        own, default = (price.get((r.key_article, p, r.date)) for p in (r.ppl, "default"))
        o, w, late = rate.get((r.key_article, r.ppl, r.key_date)), wx.get(r.key_date), r.date > CFG.shift_date
        assert r.key_date == _key(r.date) and (r.shift, r.ppln) == (("post", "postPPL1" if r.ppl == "PPL1" else None) if late else ("pre", r.ppl))
        assert (r.price_in_cents, r.price_in_cents_default) == (own if own is not None else default, default)
        assert (r.aor, r.nr_orders_day_ppl, r.sum_regular_art_sales_ppl) == ((o.aor, o.nr_orders_day_ppl, o.sum_regular_art_sales_ppl) if o else (None,) * 3)
        assert r.promo_dummy == int((r.key_article, r.key_date) in promo)
        assert r.unavailability_perc == unav.get((r.key_article, r.key_date))
        assert (r.avg_high_temp, r.weather_type) == ((w.avg_high_temp, w.weather_type) if w else (None, None))


def test_no_join_per_row(wh):
    """Everything above the join of articles and facts is made without a lookup: the weather was joined to every day."""
    plan = P.daily_features(wh, CFG)._jdf.queryExecution().executedPlan().toString()
    above = [x.strip() for x in plan[:plan.index("ShuffledHashJoin")].splitlines() if ":" not in x[:len(x) - len(x.lstrip(" :"))]]
    assert not [x for x in above if x.startswith("+- ") and "Join" in x[:40]] and any("Generate inline" in x for x in above)


def test_rounding_once_is_rounding_each_row(wh):
    doubles = ("aor", "unavailability_perc", "avg_high_temp", "sum_regular_art_sales_ppl", "art_content_volume")
    plain = P.daily_features(wh, CFG)
    want = plain.select(*[F.round(c, 1).alias(c) if c in doubles else F.col(c) for c in plain.columns])
    assert Counter(P.daily_features(wh, CFG, digits=1).collect()) == Counter(want.collect())


def test_packed_attributes_roll_up_alike(wh):
    flat, packed = (P.weekly(P.daily_features(wh, CFG, packed=x), CFG) for x in (False, True))
    assert flat.columns == packed.columns and flat.schema.simpleString() == packed.schema.simpleString()
    assert Counter(flat.collect()) == Counter(packed.collect())


def test_rounded_keeps_whole_numbers(spark):
    from demandlab.plans.registry import rounded
    vals = [0.0, -0.0, 3.0, -2.0, 1.23456789, 2.5e17, 0.0000005, float("nan"), float("inf"), None, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [str(r.x) for r in rounded(df).orderBy("i").collect()]
    assert got == [str(r.x) for r in df.select("i", F.round("x", 6).alias("x")).orderBy("i").collect()]
