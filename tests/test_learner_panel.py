"""The learners' panel is written once: a fit reads it and does not join or aggregate the tables again."""
from demandlab.operators import features as FE
from demandlab.operators import trees
from demandlab.plans import registry_learners as L
from demandlab.sources.fixtures import regression_panel
from demandlab.sources.io import Tables

SF = "/root/testdata/sf0.001"


def test_learner_panel_is_read_not_made_again(spark):
    plan = L._panel(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan
    assert not any(step in plan for step in ("Join", "Exchange", "Aggregate", "Window"))


def test_written_panel_has_the_same_rows(spark):
    p, _ = trees.with_missing_indicators(FE.add_lags(regression_panel(Tables(spark, SF)), ["y"], 1, L.SERIES, "week"), ["y_t_1"])
    got = L._panel(spark, SF)
    assert got.schema.simpleString() == p.schema.simpleString()
    rows = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.collect())
    assert rows(got) == rows(p) and got.count() > 0
