"""The registered grid searches fit boosting at the reference's size, not a short stand-in."""
import pytest

from demandlab.operators import trees
from demandlab.plans import registry_learners as L


@pytest.fixture
def searched(monkeypatch):
    """Estimator and grid that a query hands to the search; nothing is fitted."""
    seen = []

    def search(df, estimator, features, label, grid, **kw):
        seen.append((estimator, grid))
        return None, df
    monkeypatch.setattr(trees, "grid_search", search)
    monkeypatch.setattr(trees, "tuned_against_default", lambda train, test, *a, **kw: search(train, *a, **kw)[1])
    monkeypatch.setattr(L, "_panel", lambda spark, d: spark.createDataFrame([(0, 1.0)], "is_test int, y double"))
    return seen


def _sizes(estimator, grid, param):
    return grid.get(param) or [estimator.getOrDefault(param)]


def test_grid_search_has_the_reference_size(spark, searched):
    L.q_grid_search(spark, "")
    (est, grid), = searched
    assert _sizes(est, grid, "maxIter") == [500] and _sizes(est, grid, "maxDepth") == [6]
    assert grid["stepSize"] == [0.15, 0.2]


def test_grid_search_test_has_the_reference_size(spark, searched):
    L.q_grid_search_test(spark, "")
    (est, grid), = searched
    assert (est.getMaxIter(), est.getMaxDepth()) == (500, 6)
    assert _sizes(est, grid, "maxIter") == [500] and max(_sizes(est, grid, "maxDepth")) == 6
    assert len(grid["stepSize"]) * len(grid["maxDepth"]) == 4
