"""Plan-shape guards for the scale design (the dense panel is never shuffled)."""
import re

import pytest

from demandlab.operators import panel as P
from demandlab.plans.panel_plan import warehouse
from demandlab.plans.registry import CFG

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    import os
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return warehouse(spark, SF)


def test_daily_dense_side_not_shuffled(wh):
    plan = _plan(P.daily_features(wh, CFG))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # the only exchanges keyed by article alone are the two co-partitioning repartitions
    assert len(re.findall(r"Exchange hashpartitioning\(key_article#\d+L?, \d+\), REPARTITION_BY_NUM", plan)) == 2
    # no range-condition join anywhere: validity intervals are exploded to days
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_skeleton_is_generated(wh):
    plan = _plan(P.skeleton(wh.dm_article, wh.dm_date, P.price_lines(wh.ft_price, CFG), CFG))
    assert "Generate explode" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_daily_reads_its_facts_once(spark, wh):
    """Order lines feed the order rate's detail and its totals; every other fact is scanned once."""
    plan = _plan(P.daily_features(wh, CFG))
    scans = lambda cols: len([x for x in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if all(c in x for c in cols)])
    # prices, promotions and order lines come from line items with these columns
    assert scans(["l_extendedprice", "l_shipdate"]) <= 1
    assert plan.count("REPARTITION_BY_NUM") == 2
