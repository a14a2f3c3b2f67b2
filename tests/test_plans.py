"""Plan shape: push-down, shuffles and what is broadcast."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "scan_project_filter")
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "LessThan(l_shipdate" in pushed and "GreaterThanOrEqual(l_quantity,25.0)" in pushed
    assert "l_partkey" not in text
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["user_events_enriched", "ride_rules", "bucket_hash", "truncate_int", "route_static", "debezium_flatten",
                                  "validate_orders", "delete_cow", "update_cow", "image_to_changes"])
def test_row_transforms_do_not_shuffle_or_leave_the_jvm(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Python" not in text and "InPandas" not in text


def test_bucketed_tables_join_without_shuffle(spark):
    text = plan(spark, "bucketed_join")
    assert "SortMergeJoin" in text and "Exchange" not in text


@pytest.mark.parametrize("name", ["changelog_carryover", "win_min_slide", "bid_events_aggregated", "column_metrics", "diff_versions"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)
