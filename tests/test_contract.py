"""Driver contract: entry() runs; every registered query matches its DuckDB oracle at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from compare_oracle import compare, duck  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

from surveyspark.plans.catalog import QUERIES  # noqa: E402
from surveyspark.plans.oracle import ORACLE_SQL  # noqa: E402

SLOW = {"grid_search_planted", "training_stratified_planted", "training_noisy_planted"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_runs(spark):
    df = entry(spark)
    out = df.collect()
    assert df.columns == ["age_range", "condicion_ocupacion", "n"] and len(out) > 0


def test_every_query_has_an_oracle():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q) and set(ORACLE_SQL) <= set(o)
    assert set(QUERIES) == set(ORACLE_SQL)
    assert len(QUERIES) == 116


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SLOW))
def test_query_matches_oracle(spark, con, name):
    status, ns, nd, _, msg = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF_SMALL)
    assert status in ("OK", "ROWS"), f"{name}: {status} {msg}"
    assert ns is not None
