"""Plan invariants over every registered query: no cross joins, no nested-loop joins."""

import pytest

from __spark_entry__ import queries
from conftest import SF_SMALL

HEAVY = {"grid_search_planted", "training_stratified_planted", "training_noisy_planted"}


@pytest.mark.parametrize("name", sorted(n for n in queries() if n not in HEAVY))
def test_no_cartesian_or_nested_loop(spark, name):
    df = queries()[name](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    plans = qe.optimizedPlan().toString() + qe.executedPlan().toString()
    assert "CartesianProduct" not in plans
    assert "BroadcastNestedLoopJoin" not in plans
    assert "Join Cross" not in plans and "CrossJoin" not in plans
