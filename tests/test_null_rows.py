"""Rows with missing parts, and names at their boundaries, are neither lost nor mixed up."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarn.operators import changes, maintenance, windows


def test_a_change_without_operation_writes_its_row(spark, rows):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, at int")
    stream = spark.createDataFrame([(1, "new", 1, None), (2, "b", 1, "INSERT")], "k int, v string, at int, op string")
    assert rows(changes.apply_cdc(target, stream, ["k"], ["at"], "op")) == [(1, "new", 1), (2, "b", 1)]


def test_an_event_without_sensors_counts(spark):
    at = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([("v", at, {"a": 10}, ["w"]), ("v", at, None, None)], "vin string, ts timestamp, s map<string,bigint>, w array<string>")
    got = windows.vehicle_windows(events, "vin", "ts", "1 minute", "s", "w").first()
    assert got["sensor_average"] == {"a": 5} and got["warning_count"] == 1


def test_a_prefix_ends_at_a_separator(spark, rows):
    files = spark.createDataFrame([("/a/b/f", 1)], "file_path string, sequence_number int")
    assert rows(maintenance.rewrite_paths(files, "/a/b", "/z")) == [("/a/b/f", "/z/f")]
    with pytest.raises(Exception, match="outside the source prefix"):
        maintenance.rewrite_paths(spark.createDataFrame([("/a/bc/f", 1)], "file_path string, sequence_number int"), "/a/b", "/z").collect()


def test_schemes_have_no_case(spark):
    listing = spark.createDataFrame([("S3://b/x", dt.datetime(2020, 1, 1))], "file_path string, last_modified timestamp")
    valid = spark.createDataFrame([("s3://b/x",)], "file_path string")
    for mode in ("error", "ignore", "delete"):
        assert maintenance.orphan_files(listing, valid, F.current_timestamp(), mismatch=mode).count() == 0
