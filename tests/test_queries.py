"""Every registered query against its SQL on the smallest data, and properties of its plan."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusprep.plans.registry import oracle_sql, queries  # noqa: E402
from tools.check import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    ok, note = compare(spark, duck, FOLDER, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_product(spark, name):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_narrow_query_reads_narrow_columns(spark):
    plan = queries()["series_count"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_filter_reaches_the_scan(spark):
    plan = queries()["json_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan


def test_entry_runs(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.count() > 0
    assert set(contract.queries()) >= set(queries())
