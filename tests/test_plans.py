"""The physical plans: no nested-loop or cross joins, no window or sort of all rows in one task."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
JOINS = [
    "spatial_nn", "asof_nearest", "asof_unkeyed", "fuse_aerosol", "fuse_weather", "fuse_all", "fuse_sound", "match_update",
    "real_load", "pm_left_merge", "pm_time_merge", "grid_skeleton", "coverage_gaps", "lookup_default",
]
ORDERED = ["interpolate_linear", "interpolate_whole_table", "impute", "prediction_trend", "split_exact", "split_ordered"]


def plan_of(spark, name):
    return entry_point.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JOINS)
def test_joins_are_equi_joins(spark, name):
    plan = plan_of(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ORDERED)
def test_order_dependent_operators_have_no_single_task_over_rows(spark, name):
    plan = plan_of(spark, name)
    # A one-task exchange may only carry the table of shard sizes.
    for line in re.findall(r"Exchange SinglePartition.*\n.*", plan):
        assert "_shard" in line and "event_id" not in line
    assert "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = plan_of(spark, "date_range_scan")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "user_id" not in plan


@pytest.mark.parametrize("name", ["date_range_scan", "month_scan"])
def test_periods_prune_the_folders_of_days(spark, name):
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(spark, name)).group(1)
    assert "(date#" in filters and ">=" in filters


def test_box_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(lat,10.0)" in plan_of(spark, "bbox_filter")


def test_update_reads_the_events_three_times_at_most(spark):
    df = entry_point.queries()["match_update"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    scans = [line for line in final.split("\n") if "FileScan" in line and "event_id" in line]
    assert len(scans) <= 3, len(scans)
