"""The dense panel is joined on ``key_article`` alone, the key it is partitioned by, whatever
``spark.sql.requireAllClusterKeysForCoPartition`` says (its default shuffled every dense row)."""
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandlab.operators import panel as P
from tests.test_panel import CFG, WH, _random_intervals

ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@pytest.fixture(scope="module")
def wh(spark):
    return WH(spark)


@pytest.fixture
def spark_default(spark):
    held = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "true")
    yield spark
    spark.conf.set(ALL_KEYS, held)


def _skeleton(spark):
    """Articles 1 to 3 and a missing one, every day of the period, two lines."""
    arts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "key_article long").repartition(8, "key_article")
    days = F.explode(F.sequence(F.lit(CFG.start), F.lit(CFG.end))).alias("date")
    return arts.select("key_article", days).select("*", F.explode(F.array(F.lit("PPL1"), F.lit("default"))).alias("ppl"))


def _dense_shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(key_article#\d+L?, (?:ppl#\d+, date|date|key_date)#\d+, \d+\)", plan)


def test_dense_rows_are_not_shuffled_by_default(spark_default, wh):
    sk = _skeleton(spark_default)
    assert not _dense_shuffles(P.prices(sk, wh.ft_price, CFG, partitions=8))
    assert not _dense_shuffles(P.default_prices(sk, wh.ft_price, CFG, partitions=8))
    assert not [x for x in _dense_shuffles(P.daily_features(wh, CFG)) if "key_date" in x]


@pytest.mark.parametrize("seed", [6, 7, 8])
def test_prices_match_brute_force(spark, wh, seed):
    entries = [*_random_intervals(seed, 60), (1, None, "P", 1, datetime(2020, 1, 1), datetime(2030, 1, 1)),
               (None, "PPL1", "P", 1, datetime(2020, 1, 1), datetime(2030, 1, 1))]
    df = spark.createDataFrame(entries, wh.ft_price.schema)
    force = {}
    for a, line, _, c, s, e in entries:
        for i in range((CFG.end - CFG.start).days + 1):
            day = CFG.start + timedelta(days=i)
            if None not in (a, line, s, e) and s.date() <= day <= e.date():
                force[a, line, day] = max(force.get((a, line, day), (datetime.min,)), (e, s, c))
    price = lambda a, line, day: force.get((a, line, day), (None,) * 3)[2]
    sk = _skeleton(spark)
    keys = [(r.key_article, r.date, r.ppl) for r in sk.collect()]
    own = {(r.key_article, r.date, r.ppl): (r.price_in_cents_ppl, r.price_in_cents_default) for r in P.prices(sk, df, CFG).collect()}
    assert own == {(a, d, p): ((None, price(a, p, d)) if p == "default" else (price(a, p, d), None)) for a, d, p in keys}
    default = {(r.key_article, r.date, r.ppl): r.price_in_cents_default for r in P.default_prices(sk, df, CFG).collect()}
    assert default == {(a, d, p): price(a, "default", d) for a, d, p in keys}


def test_days_outside_the_period_have_no_price(spark, wh):
    df = spark.createDataFrame([(1, "PPL1", "P", 5, datetime(2000, 1, 1), datetime(2030, 1, 1))], wh.ft_price.schema)
    sk = spark.createDataFrame([(1, CFG.start - timedelta(days=1), "PPL1"), (1, CFG.start, "PPL1"), (1, CFG.end, "PPL1"),
                                (1, CFG.end + timedelta(days=1), "PPL1"), (1, None, "PPL1")], "key_article long, date date, ppl string")
    got = {r.date: r.price_in_cents_ppl for r in P.prices(sk, df, CFG).collect()}
    assert [got[d] for d in sorted(got, key=lambda d: d or date.min)] == [None, None, 5, 5, None]


def test_daily_rows_are_gap_free(spark, wh):
    """An article's days before, between and after its facts are there once, with only their own facts."""
    daily = P.daily_features(wh, CFG).where("ppl = 'PPL1'").orderBy("date").collect()
    assert [r.date for r in daily] == [CFG.start + timedelta(days=i) for i in range(7)]
    facts = {(r.date, r.price_in_cents_ppl) for r in P.prices(_skeleton(spark).where("key_article = 1 and ppl = 'PPL1'"), wh.ft_price, CFG).collect()}
    default = {r.date: r.price_in_cents_default for r in daily}
    assert {(r.date, r.price_in_cents if r.price_in_cents != default[r.date] else None) for r in daily} == facts
