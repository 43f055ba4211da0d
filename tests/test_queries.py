"""Every registered query against its SQL, and the shape of the plans."""

import os

import pytest

import __spark_entry__ as entry
from millpulse.plans.oracle import ORACLE
from millpulse.plans.registry import QUERIES
from tests.oracle_check import compare

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")

IN_PYTHON = ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "MapInArrow", "FlatMapGroups")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert compare(spark, entry.queries()[name], entry.oracle_sql().get(name), SMALL) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_no_python_in_plans(spark):
    streamed = ("ingest", "merged_window", "compacted", "stream_", "catalog_", "two_streams", "windowed_table")
    for name, query in QUERIES.items():
        if not name.startswith(streamed):
            plan = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            assert not any(node in plan for node in IN_PYTHON), name
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
