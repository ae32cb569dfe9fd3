"""The log table by day: what queries open, and rows equal to those of the plain table."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions.dimensions import dimension, dimension_map
from faretide.operators.day_logs import (
    days_of,
    newest_day_logs,
    read_day_logs,
    recent_day_logs,
    write_logs,
)
from faretide.operators.logs import recent_logs
from faretide.schemas import LOGS
from faretide.session import fresh_path

NOW = datetime(2024, 1, 20, 0, 10)


@pytest.fixture
def logs(spark):
    rows = [
        (k, NOW - timedelta(minutes=17 * k), k % 9, "trace" if k % 3 else "exception", "r", str(k % 2), k % 5, 1.0)
        for k in range(1500)
    ]
    rows += [(9000, None, 1, "trace", "r", "0", 0, 1.0), (9001, NOW, 1, "rare", "r", "0", 0, 1.0)]
    return spark.createDataFrame(rows, LOGS)


@pytest.fixture
def path(spark, logs):
    where = fresh_path(spark, "day_logs")
    for part in range(2):
        write_logs(logs.where(F.col("event_id") % 2 == part), where)
    return where


def opened(df):
    """How many folders of a load and day the plan's scan opens."""
    scan = df._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    return scan.selectedPartitions().partitionCount()


def test_the_last_half_hour_reads_its_days(spark, path, logs):
    found = recent_day_logs(spark, path, kind=None, now=NOW, window="5 minutes")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in plan
    assert opened(found) == 2
    around = read_day_logs(spark, path, NOW - timedelta(minutes=30), NOW)
    assert opened(around) == 4 and opened(read_day_logs(spark, path)) > 36
    for window in ("5 minutes", "30 minutes", "3 days"):
        ours = recent_day_logs(spark, path, now=NOW, window=window, experiment_id="1")
        theirs = recent_logs(logs, now=NOW, window=window.upper(), experiment_id="1")
        assert rows_of(ours) == rows_of(theirs)


def test_the_newest_rows_open_the_latest_days(spark, path, logs):
    for limit, days in ((40, 2), (300, 8), (5000, 20)):
        found = newest_day_logs(spark, path, limit=limit)
        assert rows_of(found) == rows_of(recent_logs(logs, window=None, limit=limit))
        assert opened(found) <= 2 * days
    assert rows_of(newest_day_logs(spark, path, kind="rare", limit=3)) == rows_of(logs.where("kind = 'rare'"))
    assert newest_day_logs(spark, path, kind="none").collect() == []


def test_days_and_rows_without_a_time(spark, path, logs):
    days = days_of(spark, path)
    assert days[0] == "2024-01-20" and days[-1] == "__HIVE_DEFAULT_PARTITION__"
    assert days[:-1] == sorted(days[:-1], reverse=True)
    assert rows_of(read_day_logs(spark, path)) == rows_of(logs)
    assert newest_day_logs(spark, path, limit=10_000).where("ts IS NULL").count() == 1


def test_instants_have_utc_days(spark, logs, zone):
    zone("Asia/Tokyo")
    where = fresh_path(spark, "day_logs")
    instants = logs.where("event_id < 3").withColumn("ts", F.expr("timestamp'2024-01-19 23:30:00Z'"))
    write_logs(instants, where)
    assert days_of(spark, where) == ["2024-01-19"]


def test_an_empty_table(spark, logs):
    where = fresh_path(spark, "day_logs")
    assert days_of(spark, where) == [] and newest_day_logs(spark, where).collect() == []


def test_variants_are_parsed_when_written(spark, logs):
    where = fresh_path(spark, "day_logs")
    texts = ['{"k": 1, "a b": "x", "n": null, "o": {"p": [1]}}', "no json", None, "{}"]
    rows = logs.where("event_id < 4").join(
        spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "event_id long, dims string"), "event_id"
    )
    write_logs(rows, where, dimensions="dims")
    schema = T.StructType([*LOGS.fields, T.StructField("dims", T.VariantType())])
    stored = read_day_logs(spark, where, schema=schema)
    valid = rows.where("event_id <> 1")
    for key in ("k", "a b", "n", "none", "o"):
        ours = stored.select("event_id", dimension(stored, "dims", key).alias("v"))
        theirs = valid.select("event_id", dimension(valid, "dims", key).alias("v"))
        expected = rows_of(theirs) + [(1, None)]
        assert rows_of(ours) == sorted(expected, key=str)
    assert "get_json_object" not in ours._jdf.queryExecution().executedPlan().toString()
    found = {r[0]: r[1] for r in stored.select("event_id", dimension_map(stored, "dims")).collect()}
    assert found[3] == {} and found[0]["k"] == "1" and found[1] is None
