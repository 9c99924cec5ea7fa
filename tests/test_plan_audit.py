"""Plan audit over every catalogue query: no cartesian products, nested-loop joins or Python UDFs."""

import pytest

from conftest import SF_SMALL
from pulseward.plans.catalog import QUERIES


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"score_texts"}))
def test_no_cartesian_nested_loop_or_python_udf(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan          # no Python UDF in any batch query (BatchEvalPython / ArrowEvalPython)
