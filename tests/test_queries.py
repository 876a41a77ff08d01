"""Every query with a SQL twin against DuckDB on the same tables."""

import pytest

import oracle
from indexloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_like_sql(spark, con, name):
    assert oracle.compare(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_stay_in_the_jvm(spark):
    """No row-at-a-time Python and no cross product in the bilateral methods."""
    for name in ("rygeks_fisher", "jevons_chained", "impute_ffill", "distributions"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "CartesianProduct" not in plan
