"""Every registered query equals its SQL on the shared test tables."""

from __future__ import annotations

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

# The optional subpackage has its own tests.
OWN = sorted(n for n in queries() if n != "pipeline" and not re.match(r"op\d+_", n))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    assert compare(result, duck, oracle_sql()[name]) > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def test_every_query_has_sql():
    assert set(OWN) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
