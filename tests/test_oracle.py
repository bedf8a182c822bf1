"""Every query with SQL equals it on the small tables; the others return rows."""

import pytest

from tests.oracle import compare, connect, plan_nodes
from ticketspark.catalog import ORACLES, QUERIES

# fits that take long; the oracle harness covers them
SLOW = {"l2_lasso_cv", "l3_random_forest_importances", "l4_gradient_boosted_trees", "l5_train_models_by_horizon", "l11_learning_curve"}


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    assert plan_nodes(df) == []
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_returns_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
