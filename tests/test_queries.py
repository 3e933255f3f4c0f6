"""Registered queries agree with their SQL, and their plans keep their shape."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import check
from oracles import oracles
from tidemark.plans import readings
from tidemark.plans.catalog import all_queries
from tidemark.operators import daily, dedupe, eventtime

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(oracles())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, tables, name):
    status, detail, _ = check.compare(
        spark, tables, name, all_queries()[name], oracles()[name], SF)
    assert status == "ok", detail


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_aggregates_gather_blocks_only(spark):
    """A single-partition exchange may only hold block values, never event rows."""
    for df in (eventtime.observe(readings.deliveries(spark, SF)),
               daily.daily_by_event_time(
                   dedupe.flag_first_arrivals(readings.deliveries(spark, SF)))):
        plan = _plan(df)
        for line in re.findall(r"Exchange SinglePartition.*\n(.*)\n", plan):
            assert "HashAggregate" in line or "Project" in line, line


def test_scans_read_only_needed_columns(spark):
    plan = _plan(daily.daily_aggregates(readings.readings(spark, SF)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "ts", "user_id", "value"}
