from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.functions.dimensions import dimension, dimension_map, merge_dimensions
from faretide.operators.logs import (
    KINDS,
    combine_logs,
    correlate_logs,
    correlated_rows,
    extend_dimensions,
    operation_logs,
    recent_exceptions,
    recent_logs,
    stage_durations,
)
from faretide.schemas import LOGS

NOW = datetime(2024, 1, 1, 12)


@pytest.fixture
def log(spark):
    def make(rows):
        """Rows of (minutes ago, operation, kind, role, experiment, run, duration)."""
        full = [
            (i, NOW - timedelta(minutes=minutes), op, kind, role, experiment, run, duration)
            for i, (minutes, op, kind, role, experiment, run, duration) in enumerate(rows)
        ]
        return spark.createDataFrame(full, LOGS)

    return make


@pytest.fixture
def few(log):
    return log(
        [
            (1, 1, "trace", "train", "a", 1, None),
            (2, 1, "exception", "train", "a", 1, None),
            (3, 1, "dependency", "train", "a", 1, 2.0),
            (29, 2, "trace", "train", "a", 2, None),
            (30, 2, "trace", "train", "a", 1, None),  # not inside: exactly 30 minutes ago
            (5, 2, "trace", "score", "b", 1, None),
            (6, 2, "dependency", "score", "b", 1, 3.0),
            (90, 1, "dependency", "train", "a", 1, 5.0),
        ]
    )


def ids(df):
    return [row["event_id"] for row in df.collect()]


def test_recent_logs(few):
    assert ids(recent_logs(few, now=NOW)) == [0, 5, 3]
    assert ids(recent_logs(few, experiment_id="a", now=NOW)) == [0, 3]
    assert ids(recent_logs(few, experiment_id="a", run_id=1, now=NOW)) == [0]
    assert ids(recent_logs(few, experiment_id="a", now=NOW, window="1 HOUR")) == [0, 3, 4]
    assert ids(recent_logs(few, kind=None, now=NOW, limit=2)) == [0, 1]
    assert ids(recent_exceptions(few, now=NOW)) == [1]
    assert ids(stage_durations(few, "train", now=NOW)) == [2]
    recent = operation_logs(few, 1, now=NOW, window="30 minutes", limit=10)
    assert ids(recent) == [0, 1, 2]
    # By default an operation's rows of any age.
    assert sorted(ids(operation_logs(few, 1))) == [0, 1, 2, 7]
    latest = few.select(F.max("ts")).scalar()
    assert ids(recent_logs(few, now=latest)) == [0, 5, 3, 4]


def test_now_defaults_to_the_clock(spark, log):
    assert recent_logs(log([(1, 1, "trace", "r", "a", 1, None)])).count() == 0
    fresh = log([(1, 1, "trace", "r", "a", 1, None)]).withColumn(
        "ts", F.lit(str(datetime.now(timezone.utc).replace(tzinfo=None))).cast("timestamp_ntz")
    )
    assert recent_logs(fresh).count() == 1


def test_ties_are_cut_the_same_way(log):
    many = log([(1, 1, "trace", "r", "a", 1, None)] * 50)
    first = ids(recent_logs(many.repartition(7), now=NOW, limit=10))
    assert first == ids(recent_logs(many.coalesce(1), now=NOW, limit=10)) == list(range(49, 39, -1))


def test_correlate(few):
    row = correlate_logs(few).collect()
    assert len(row) == 1
    assert tuple(row[0]) == (
        1, 1, 1, 2, NOW - timedelta(minutes=90), NOW - timedelta(minutes=1),
        NOW - timedelta(minutes=2), 7.0,
    )
    assert sorted(ids(correlated_rows(few))) == [0, 1, 2, 7]


def test_correlation_of_a_hot_operation_stays_one_row(log):
    kinds = ["trace", "exception", "dependency"]
    hot = log([(1, 1, kinds[i % 3], "r", "a", 1, 1.0) for i in range(3000)])
    assert tuple(correlate_logs(hot).first())[:4] == (1, 1000, 1000, 1000)
    assert correlated_rows(hot).count() == 3000


def test_rows_of_a_hot_operation_are_split(spark, splitting):
    logs = spark.range(0, 200_000, 1, 16).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' AS ts",
        "CASE WHEN id % 2 = 0 THEN 1 ELSE id % 5000 END AS operation_id",
        "element_at(array('trace', 'exception', 'dependency'), cast(id % 3 + 1 AS int)) AS kind",
        "'r' AS role", "'e' AS experiment_id", "1L AS run_id", "1.0D AS duration",
    )
    rows = correlated_rows(logs)
    got = rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    kinds = {}
    for row in logs.select("operation_id", "kind").distinct().collect():
        kinds.setdefault(row[0], set()).add(row[1])
    complete = {operation for operation, have in kinds.items() if len(have) == 3}
    expected = logs.filter(F.col("operation_id").isin(*complete)).count()
    assert len(got) == expected and {row["operation_id"] for row in got} == complete


@pytest.mark.parametrize("name", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_the_clock_is_the_same_in_any_zone(spark, few, zone, name):
    zone(name)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = few.first().asDict()
    aged = [row | {"event_id": k, "kind": "trace", "ts": now - timedelta(minutes=m)}
            for k, m in enumerate((5, 180))]
    logs = spark.createDataFrame(aged, few.schema)
    assert ids(recent_logs(logs, limit=None)) == [0]


def test_rows_without_an_operation_are_not_one(few):
    unnamed = few.withColumn("operation_id", F.lit(None).cast("long"))
    assert correlate_logs(unnamed).isEmpty()


def test_three_tables_correlate_like_one(few):
    parts = [few.filter(F.col("kind") == kind).drop("kind") for kind in KINDS]
    assert rows_of(correlate_logs(combine_logs(*parts))) == rows_of(correlate_logs(few))


def test_filters_reach_the_scan(spark, few, tmp_path):
    few.write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    text = recent_logs(stored, None, now=NOW)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-01T11:30)]" in text
    assert "TakeOrderedAndProject(limit=1000" in text


def test_dimensions(spark):
    df = spark.createDataFrame([('{"k": 1, "a b": "x"}',), ("{}",), (None,)], "props string")
    as_map = df.select(dimension_map(df, "props").alias("props"))
    for logs in (df, as_map):
        got = [tuple(r) for r in extend_dimensions(logs, "props", k="k", other="a b").select(
            "k", "other").collect()]
        assert got == [("1", "x"), (None, None), (None, None)]
        assert logs.select(dimension(logs, "props", "none")).first()[0] is None


def test_merge_dimensions(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "2"}, {"b": "3", "c": "4"}), (None, {"x": "1"}), ({"y": "2"}, None),
         (None, None)],
        "d map<string,string>, r map<string,string>",
    )
    merged = [r[0] for r in df.select(merge_dimensions(F.col("d"), F.col("r"))).collect()]
    assert merged == [{"a": "1", "b": "3", "c": "4"}, {"x": "1"}, {"y": "2"}, {}]
