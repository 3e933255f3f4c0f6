"""Stored tables: what a plan skips, defaults of added columns, and distinct sketches that unite."""

from __future__ import annotations

import datetime as dt
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dedupe
from tidemark.plans import readings
from tidemark.plans.catalog import all_queries
from tidemark.sources.stored import StoredTable

START = dt.datetime(2026, 8, 1)


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.concat(F.lit("c-"), (F.col("id") % 500).cast("string")).alias("customer_id"),
        (F.lit(START).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 14_400).cast("int"))).alias("event_time"),
        F.col("id").alias("value"))
    found = StoredTable(str(tmp_path / "t"), rows.schema, "event_time", "event_date", ("customer_id",))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found.write(rows)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return found, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_come_back(spark, table):
    found, rows = table
    assert found.read(spark).drop("event_date").exceptAll(rows).count() == 0
    assert found.read(spark).count() == 20_000


def test_a_time_range_prunes_folders(spark, table):
    found, rows = table
    start, end = F.lit(START + dt.timedelta(days=2, hours=6)), F.lit(START + dt.timedelta(days=4))
    some = found.between(spark, start, end)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(some)).group(1)
    assert "event_date" in filters
    assert {f.split("event_date=")[1][:10] for f in {r[0] for r in some.select(F.input_file_name()).distinct().collect()}} <= {
        "2026-08-03", "2026-08-04"}
    assert some.count() == rows.where((F.col("event_time") >= start) & (F.col("event_time") < end)).count()


def test_a_key_is_pushed_down_and_files_hold_narrow_ranges_of_it(spark, table):
    found, _ = table
    one = found.read(spark).where(F.col("customer_id") == "c-7")
    assert re.search(r"PushedFilters: \[.*EqualTo\(customer_id,c-7\)", plan_of(one))
    assert one.count() == 40
    files = [f.replace("file://", "") for f in found.read(spark).inputFiles()]
    holding = 0
    for f in files:
        column = pq.ParquetFile(f).metadata.row_group(0).column(0)
        assert column.path_in_schema == "customer_id"
        holding += column.statistics.min <= "c-7" <= column.statistics.max
    assert holding < len(files)


def test_a_lookup_reads_only_the_dates_of_its_keys(spark, table):
    found, rows = table
    keys = rows.where("value IN (3, 4)")
    hits = found.lookup(spark, keys, ["customer_id", "event_time"])
    assert sorted(r.value for r in hits.collect()) == sorted(
        r.value for r in rows.join(keys.select("customer_id", "event_time"), ["customer_id", "event_time"], "left_semi").collect())
    assert "dynamicpruning" in plan_of(hits)


def test_a_column_added_later_has_its_default_in_old_files(spark, table):
    found, _ = table
    wider = found.with_column("is_open", T.BooleanType(), "true").with_column("grade", T.IntegerType(), "7")
    assert wider.with_column("grade", T.IntegerType(), "8") == wider
    wider.write(spark.createDataFrame([("new", START, 1, None, 2)], "customer_id string, event_time timestamp, value long, is_open boolean, grade int"))
    got = {tuple(r) for r in wider.read(spark).where("customer_id IN ('new', 'c-7')").select("customer_id", "is_open", "grade").collect()}
    assert got == {("new", None, 2), ("c-7", True, 7)}
    assert wider.read(spark).where("grade = 7").count() == 20_000


def test_reports_scan_the_stored_tables(spark):
    queries = all_queries()
    history = plan_of(queries["customer_history"](spark, "/root/testdata/sf0.001"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(customer_id,customer-7\)", history)
    assert "Exchange hashpartitioning(event_id" not in history
    ranged = plan_of(queries["abnormal_in_range"](spark, "/root/testdata/sf0.001"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", ranged)


def test_sketches_of_ticks_unite_within_their_error(spark):
    rows = readings.deliveries(spark, "/root/testdata/sf0.01")
    by_tick = dedupe.distinct_sketches(rows, ["tick"])
    whole = dedupe.united(by_tick).first()
    exact = dedupe.duplicate_summary(rows).first()
    assert whole.rows == exact.stored
    assert abs(whole.estimate - exact.distinct_ids) <= dedupe.SKETCH_ERROR * exact.distinct_ids
    few = dedupe.united(by_tick.where("tick < 3")).first()
    some = rows.where("tick < 3").select("event_id").distinct().count()
    assert abs(few.estimate - some) <= max(1, dedupe.SKETCH_ERROR * some)
    assert abs(dedupe.duplicate_summary(rows, approx=True).first().distinct_ids - exact.distinct_ids) <= (
        dedupe.SKETCH_ERROR * exact.distinct_ids)
    assert tuple(dedupe.united(by_tick.limit(0)).first()) == (0, 0)
