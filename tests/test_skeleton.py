"""The skeleton's rows against brute force, and how they are dealt to tasks."""
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandlab.operators import panel as P
from tests.test_panel import CFG

ARTICLE = ("key_article long, art_in_store_date_last_added timestamp_ntz, art_in_store_date_last_removed timestamp_ntz, "
           "art_p_cat_lev_1 string")
LINES = ["PPL1", "default"]


def _key(d):
    return d.year * 10000 + d.month * 100 + d.day


@pytest.fixture(scope="module")
def articles(spark):
    rows = [*range(1, 41), 1, 2, None, None]   # repeated and missing keys count once
    return spark.createDataFrame([(k, datetime(1990, 1, 1), None, CFG.category) for k in rows], ARTICLE)


@pytest.fixture(scope="module")
def calendar(spark):
    """From before the period to after it, with a day missing and a day twice."""
    days = [CFG.start + timedelta(days=i) for i in range(-3, CFG.period_days + 3) if i != 2]
    rows = [*days, CFG.start]
    return [(_key(d), _key(d) - 1, d) for d in rows], spark.createDataFrame(
        [*[(_key(d), _key(d) - 1, d) for d in rows], (_key(CFG.start), 7, None), (_key(CFG.start), 7, date(1980, 1, 1))],
        "key_date int, key_week int, date date")


def test_rows_match_brute_force(articles, calendar):
    rows, cal = calendar
    got = Counter(tuple(r) for r in P.skeleton(articles, cal, LINES, CFG, 4).collect())
    assert got == Counter((a, k, w, d, line) for a in [None, *range(1, 41)] for k, w, d in rows if CFG.start <= d <= CFG.end for line in LINES)
    assert not P.skeleton(articles, cal.where("false"), LINES, CFG, 4).count()


def test_rows_are_made_by_many_tasks(spark, articles, calendar):
    """With as many partitions as Spark's default, the short article list used to be coalesced into one task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sk = P.skeleton(articles, calendar[1], LINES, CFG, n)
    assert sk.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_no_lookup_per_generated_row(articles, calendar):
    assert "Join" not in P.skeleton(articles, calendar[1], LINES, CFG, 4)._jdf.queryExecution().executedPlan().toString()
