"""Panel operators on hand-written warehouse rows: NULLs, ties, interval edges."""
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from demandlab.config import PanelConfig
from demandlab.operators import panel as P

CFG = PanelConfig(start=date(2021, 1, 1), end=date(2021, 1, 7), holdout_start=date(2021, 1, 1),
                  holdout_end=date(2021, 1, 7), category="Drinks", in_assortment_from=date(2020, 12, 1),
                  in_assortment_to=date(2021, 1, 7), default_line="default", price_type="P",
                  shift_date=date(2021, 1, 3), regime_lines=("PPL1",))


class WH:
    def __init__(self, spark):
        ts = lambda s: datetime.fromisoformat(s)
        self.dm_article = spark.createDataFrame([
            (1, "A1", "cola", ts("2020-01-01"), None, "Drinks", "Cola", "c3", "c4", "Good", 1.5, "liter", "yes"),
            (2, "A2", "fanta", ts("2020-01-01"), ts("2021-01-05"), "Drinks", "Fanta", "c3", "c4", "Best", 330.0, "ml", "no"),
            (3, "A3", "brie", ts("2020-01-01"), None, "Cheese", "Soft", "c3", "c4", "Good", 1.0, "kg", None),
        ], "key_article long, article_id string, art_supply_chain_name string, art_in_store_date_last_added timestamp_ntz, "
           "art_in_store_date_last_removed timestamp_ntz, art_p_cat_lev_1 string, art_p_cat_lev_2 string, "
           "art_p_cat_lev_3 string, art_p_cat_lev_4 string, art_quality_tier string, art_content_volume double, "
           "art_content_volume_uom string, art_is_multipack string")
        days = [date(2020, 12, 31 - i) for i in range(0, 3)] + [date(2021, 1, d) for d in range(1, 11)]
        self.dm_date = spark.createDataFrame(
            [(d.year * 10000 + d.month * 100 + d.day, 0, d) for d in days], "key_date int, key_week int, date date") \
            .withColumn("key_week", P.key_of_date(F.to_date(F.date_trunc("week", "date"))))
        self.ft_price = spark.createDataFrame([
            (1, "PPL1", "P", 100, ts("2021-01-01 08:00"), ts("2021-01-02 10:00")),
            (1, "PPL1", "P", 120, ts("2021-01-02 00:00"), ts("2021-01-02 10:00")),  # tie on end: later start wins
            (1, "PPL1", "X", 999, ts("2021-01-01 00:00"), ts("2021-01-09 00:00")),  # other price type
            (1, "default", "P", 90, ts("2021-01-01 00:00"), ts("2021-01-03 00:00")),
            (1, "PPL2", "P", 80, ts("2021-01-04 00:00"), ts("2021-01-04 00:00")),   # start = end = one day
            (1, "PPL2", "P", 70, ts("2021-01-05 00:00"), None),                    # NULL end never matches
        ], "key_article long, price_line_type string, price_type string, price_in_cents long, "
           "price_start_date_time timestamp_ntz, price_end_date_time timestamp_ntz")
        self.dm_order = spark.createDataFrame([(10, "PPL1"), (11, "PPL1"), (12, "PPL2"), (13, None)],
                                              "key_order long, order_price_line_type string")
        self.ft_orderline = spark.createDataFrame([
            (1, 10, 20210102, 2.0, 0.0), (1, 10, 20210102, 1.0, 1.0), (2, 11, 20210102, -5.0, 0.0),
            (1, 12, 20210103, 4.0, 0.0), (1, 13, 20210103, 1.0, 0.0), (1, 10, 20201231, 9.0, 0.0),
        ], "key_article long, key_order long, key_order_date int, orig_regular_sales_qty double, orig_promo_qty double")
        self.ft_promotion_article_history = spark.createDataFrame([
            (7, 1, ts("2021-01-02 00:00"), ts("2021-01-03 00:00"), "no"),
            (8, 1, ts("2021-01-03 00:00"), ts("2021-01-03 00:00"), "no"),   # overlaps: two promos on the 3rd
            (7, 2, ts("2021-01-02 00:00"), ts("2021-01-02 00:00"), "yes"),  # deleted
        ], "key_promotion long, key_article long, promo_art_active_start_date timestamp_ntz, "
           "promo_art_active_end_date timestamp_ntz, promo_art_is_deleted string")
        self.dm_promotion = spark.createDataFrame([(7, "pct", "ten"), (8, "bundle", "2for1")],
                                                  "key_promotion long, promo_mechanism string, promo_name string")
        self.ft_warehouse_article_daily = spark.createDataFrame([
            (20210102, 1, 1, 3), (20210102, 1, None, 1), (20210103, 1, None, 2), (20210104, 1, 0, 0),
        ], "key_date int, key_article long, event_date_unavailable_deliveryline_count long, "
           "order_date_orderline_count long")
        self.dm_weather_daily = spark.createDataFrame([
            (date(2021, 1, 2), 10.0, "sun"), (date(2021, 1, 2), 20.0, "rain"), (date(2021, 1, 3), 5.0, "snow"),
        ], "wthr_dly_date date, wthr_dly_temperature_high double, wthr_dly_icon string")


@pytest.fixture(scope="module")
def wh(spark):
    return WH(spark)


def test_assortment_and_skeleton_size(wh):
    arts = [r.key_article for r in P.select_articles(wh.dm_article, CFG).collect()]
    assert arts == [1]          # 2 removed inside the window, 3 other category
    lines = P.price_lines(wh.ft_price, CFG)
    sk = P.skeleton(wh.dm_article, wh.dm_date, lines, CFG)
    assert sk.count() == 1 * 7 * len(lines)
    assert sk.select("key_article", "date", "ppl").distinct().count() == sk.count()


def test_aor_right_join_semantics(wh):
    rows = {(r.key_article, r.key_order_date, r.ppl): r for r in P.aor(wh.ft_orderline, wh.dm_order, CFG).collect()}
    r = rows[(1, 20210102, "PPL1")]
    assert (r.nr_orders_day_ppl, r.sum_regular_art_sales_ppl, r.aor) == (2, 3.0, 1.5)
    assert rows[(2, 20210102, "PPL1")].sum_regular_art_sales_ppl == 0.0   # negative sum clamped
    assert rows[(None, None, None)].nr_orders_day_ppl == 1                  # NULL line keeps its totals row
    assert (1, 20201231, "PPL1") not in rows                               # outside the period


def test_price_in_force_ties_and_edges(wh):
    lines = P.price_lines(wh.ft_price, CFG)
    sk = P.skeleton(wh.dm_article, wh.dm_date, lines, CFG)
    got = {(r.date.day, r.ppl): (r.price_in_cents_ppl, r.price_in_cents_default) for r in P.prices(sk, wh.ft_price, CFG).collect()}
    assert got[(1, "PPL1")] == (100, None)
    assert got[(2, "PPL1")] == (120, None)        # same end time, later start
    assert got[(3, "PPL1")] == (None, None)
    assert got[(4, "PPL2")] == (80, None)         # start = end = panel day
    assert got[(5, "PPL2")] == (None, None)       # NULL end
    assert got[(3, "default")] == (None, 90)
    d = {(r.date.day, r.ppl): r.price_in_cents_default for r in P.default_prices(sk, wh.ft_price, CFG).collect()}
    assert d[(2, "PPL1")] == 90 and d[(4, "PPL1")] is None


def test_unavailability_nulls(wh):
    got = {r.key_date: r.unavailability_perc for r in P.unavailability(wh.ft_warehouse_article_daily, wh.dm_article, wh.dm_date, CFG).collect()}
    assert got[20210102] == pytest.approx(1 / 5)   # sums taken separately: 1 / (4 + 1)
    assert got[20210103] is None                    # unavailable sum is NULL
    assert got[20210104] is None                    # zero denominator


def test_weather_mode_tie_smallest(wh):
    got = {r.key_date: (r.avg_high_temp, r.weather_type) for r in P.weather(wh.dm_weather_daily, wh.dm_date, CFG).collect()}
    assert got[20210102] == (15.0, "rain")


def test_promo_days_fan_out_and_daily_dedupe(wh):
    promo = P.promo_days(wh.ft_promotion_article_history, wh.dm_promotion, wh.dm_article, wh.dm_date, CFG)
    assert promo.where("key_date = 20210103").count() == 2
    daily = P.daily_features(wh, CFG)
    assert daily.count() == daily.select("key_article", "key_date", "ppl").distinct().count()
    assert daily.where("key_date = 20210103 and ppl = 'PPL1'").first().promo_dummy == 1
    r = daily.where("key_date = 20210102 and ppl = 'PPL1'").first()
    assert (r.aor, r.price_in_cents, r.shift, r.ppln, r.art_content_volume, r.art_is_multipack) == \
        (1.5, 120, "pre", "PPL1", 1500.0, 1)
    r2 = daily.where("key_date = 20210104 and ppl = 'PPL1'").first()
    assert (r2.shift, r2.ppln, r2.price_in_cents) == ("post", "postPPL1", None)
    assert daily.where("ppl = 'default'").count() == 0


def test_weekly_rollup(wh):
    w = P.weekly(P.daily_features(wh, CFG)).where("ppl = 'PPL1'").orderBy("key_week").collect()
    assert w[0].product_order_amt == 3.0 and w[0].promo_dummy == 1


def _random_intervals(seed, n=400):
    import random
    from datetime import timedelta
    r = random.Random(seed)
    base = datetime(2020, 12, 28)
    out = []
    for _ in range(n):
        s = base + timedelta(hours=r.randrange(24 * 14))
        e = s + timedelta(hours=r.choice([-30, 0, 5, 24, 48, 100, 500]))
        out.append((r.choice([1, 1, 1, 2]), r.choice(["PPL1", "PPL1", "default"]), "P", r.randrange(50, 60), s if r.random() > 0.03 else None, e if r.random() > 0.03 else None))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_price_spans_match_brute_force(wh, spark, seed):
    from datetime import timedelta
    entries = _random_intervals(seed)
    df = spark.createDataFrame(entries, wh.ft_price.schema).repartition(5)
    want = {}
    for a, line, _, c, s, e in entries:
        if s is None or e is None:
            continue
        for i in range(7):
            day = CFG.start + timedelta(days=i)
            if s.date() <= day <= e.date():
                want[a, line, day] = max(want.get((a, line, day), (datetime.min,)), (e, s, c))
    spans = P.price_spans(df, CFG)
    got = [((r.key_article, r.ppl, r.date), r.price_in_cents) for r in P.latest_price_per_day(df, CFG).collect()]
    assert len(got) == len(want) and dict(got) == {k: v[2] for k, v in want.items()}
    # the spans are the winners only: never more than the days of the period
    assert spans.groupBy("key_article", "ppl").count().agg(F.max("count")).first()[0] <= CFG.period_days


@pytest.mark.parametrize("seed", [4, 5])
def test_promo_flags_match_brute_force(wh, spark, seed):
    entries = [(7 + (i % 3), a, s, e, "no" if i % 9 else "yes") for i, (a, _, _, _, s, e) in enumerate(_random_intervals(seed, 120))]
    df = spark.createDataFrame(entries, wh.ft_promotion_article_history.schema).repartition(4)
    flags = P.promo_flags(df, wh.dm_promotion, wh.dm_article, wh.dm_date, CFG)
    rows = [tuple(r) for r in flags.select("key_article", "key_date").collect()]
    every = P.promo_days(df, wh.dm_promotion, wh.dm_article, wh.dm_date, CFG).select("key_article", "key_date").distinct().collect()
    assert len(rows) == len(set(rows)) and set(rows) == {tuple(r) for r in every}
