"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as driver
from oracle import compare, connect

from millrace.plans.oracles import ORACLES as SQL
from __spark_entry__ import QUERIES


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["bucket", "records"] and df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, db, name):
    df = QUERIES[name](spark, small)
    compare(df, db, SQL[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_filters_reach_the_parquet_scan(spark, small):
    df = QUERIES["error_events"](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(event_type,error)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_formatting_reads_two_columns_without_a_shuffle(spark, small):
    df = QUERIES["format_event_records"](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    assert "Exchange" not in plan and "Python" not in plan
