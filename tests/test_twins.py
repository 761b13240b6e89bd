"""Every query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as workload
from workload.registry import ORACLES, QUERIES
from tools.compare import compare, connect

SF = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# The Python hooks, and one random weight per batch.
PYTHON = {"apply_rows", "mixup_random_weight"}
# Texts looked up in their own row by an Arrow function; all else stays in the JVM.
ARROW = {
    "detect_language", "detect_language_unlabelled", "filter_texts", "encode", "encode_windows", "prepare_training", "assemble_samples",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    def inspect(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        if name in ARROW:
            assert "BatchEvalPython" not in plan and "InPandas" not in plan
        elif name not in PYTHON:
            assert "Python" not in plan and "InPandas" not in plan

    query, sql = QUERIES[name], ORACLES.get(name)
    ok, text = compare(spark, con, name, query, sql, SF, inspect)
    assert ok, text


def test_every_twin_has_a_query():
    assert set(workload.oracle_sql()) <= set(workload.queries())


def test_entry_has_rows(spark):
    assert workload.entry(spark).count() == 4
