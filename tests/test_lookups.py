from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.functions.times import ceil_minutes
from faretide.operators.lookups import (
    DROPOFF_KEY,
    DROPOFF_NAMES,
    PICKUP_KEY,
    PICKUP_NAMES,
    FeatureLookup,
    exclude_self,
    fare_lookups,
    fits_broadcast,
    lookup_bucketed,
    lookup_features,
    training_set,
)
from faretide.operators.rows import rounded_trips
from faretide.operators.store import (
    bucket_features,
    bucketed_rows,
    compact_features,
    create_feature_table,
    merge_features,
    read_features,
)
from faretide.operators.windows import dropoff_features, pickup_features
from faretide.plans.jobs import feature_job
from faretide.session import stage

START, END = "2024-01-05", "2024-01-20"


@pytest.fixture
def tables(spark, table, sample):
    pickup, dropoff = table(), table()
    create_feature_table(pickup_features(sample, start=START, end=END), pickup)
    create_feature_table(dropoff_features(sample, start=START, end=END), dropoff)
    return pickup, dropoff


def test_training_set(sample, tables):
    rounded = rounded_trips(sample)
    described = training_set(rounded, fare_lookups(*tables))
    df = described.load_df()
    assert df.columns == [
        "event_id", "trip_distance", "pickup_zip", "dropoff_zip",
        "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip",
        "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend", "fare_amount",
    ]
    assert df.count() == sample.count()
    # Features cover the range only; trips outside it stay, without features.
    nulls = df.filter("mean_fare_window_1h_pickup_zip IS NULL").count()
    assert 0 < nulls < sample.count()


def test_all_ways_to_join_agree(sample, tables):
    rounded = rounded_trips(sample)
    ways = [
        {},
        {"max_broadcast_bytes": 0},
        {"prune_months": True},
    ]
    results = [
        rows_of(training_set(rounded, fare_lookups(*tables), **way).load_df()) for way in ways
    ]
    assert results[0] == results[1] == results[2]


def test_broadcast_only_below_the_limit(spark, tables):
    features = spark.table(tables[0]).select("zip", "ts", *PICKUP_NAMES)
    size = features.count() * 16 * 5
    assert fits_broadcast(features, size) and not fits_broadcast(features, size - 1)
    # Text has no bounded width.
    assert not fits_broadcast(spark.table(tables[0]), size * 100)


def test_boundary_trips_look_up_the_window_before(make_trips):
    trips = make_trips(
        [
            ("2024-01-01 10:05:00", "2024-01-01 11:00:00", 1.0, 10.0, 1, 2),
            ("2024-01-01 10:15:00", "2024-01-01 11:00:00", 1.0, 20.0, 1, 2),
            ("2024-01-01 10:16:00", "2024-01-01 11:00:00", 1.0, 30.0, 1, 2),
            ("2024-01-01 13:00:00", "2024-01-01 14:00:00", 1.0, 40.0, 1, 2),
        ]
    )
    joined = lookup_features(
        rounded_trips(trips), pickup_features(trips), PICKUP_KEY, PICKUP_NAMES
    )
    means = {r["fare_amount"]: r[PICKUP_NAMES[0]] for r in joined.collect()}
    assert means == {10.0: 10.0, 20.0: 10.0, 30.0: 20.0, 40.0: None}


def test_exclude_self(make_trips):
    trips = make_trips(
        [
            ("2024-01-01 09:50:00", "2024-01-01 11:00:00", 1.0, 6.0, 1, 2),
            ("2024-01-01 10:05:00", "2024-01-01 11:00:00", 1.0, 10.0, 1, 2),
            ("2024-01-01 10:15:00", "2024-01-01 11:00:00", 1.0, 20.0, 1, 2),
            ("2024-01-01 10:16:00", "2024-01-01 11:00:00", 1.0, 30.0, 1, 2),
            ("2024-01-01 15:01:00", "2024-01-01 16:00:00", 1.0, 40.0, 1, 2),
            # Outside the range, so in no window, but it looks one up.
            ("2024-01-01 15:14:00", "2024-01-01 16:00:00", 1.0, 50.0, 1, 2),
        ]
    )
    end = "2024-01-01 15:10:00"
    at = "tpep_pickup_datetime"
    features = pickup_features(trips, end=end, with_sum=True)
    timed = trips.withColumn("rounded_pickup_datetime", ceil_minutes(trips, at))
    joined = lookup_features(
        timed, features, PICKUP_KEY, (*PICKUP_NAMES, "sum_fare_window_1h_pickup_zip")
    )
    means = {
        r["fare_amount"]: r[PICKUP_NAMES[0]] for r in exclude_self(joined, at, None, end).collect()
    }
    assert means == {
        6.0: None,  # alone in its window
        10.0: 6.0,
        20.0: 8.0,  # on the boundary: the mean of (6, 10), which has not got it
        30.0: 12.0,  # the mean of (6, 10, 20)
        40.0: None,
        50.0: 40.0,
    }


def test_null_keys_match_nothing(make_trips):
    trips = make_trips(
        [
            ("2024-01-01 10:05:00", "2024-01-01 11:00:00", 1.0, 10.0, None, 2),
            (None, "2024-01-01 11:00:00", 1.0, 20.0, 1, 2),
        ]
    )
    joined = lookup_features(
        rounded_trips(trips), pickup_features(trips), PICKUP_KEY, PICKUP_NAMES
    )
    assert joined.count() == 2
    assert joined.filter(F.col(PICKUP_NAMES[1]).isNotNull()).count() == 0


def test_hot_and_null_keys_are_split(spark, sample, splitting):
    """A key, or NULL, with a third of all rows is joined by several tasks."""
    pickup, dropoff = pickup_features(sample), dropoff_features(sample)
    hot = [features.orderBy("zip", "ts").first() for features in (pickup, dropoff)]

    def column(values, other, name):
        """One key for a third of the rows, NULL for another, many for the rest."""
        return f"cast(CASE id % 3 WHEN 0 THEN {values} WHEN 2 THEN {other} END AS int) AS {name}"

    many = "1704067200 + id % 1488 * 1800"
    trips = spark.range(0, 150_000, 1, 16).selectExpr(
        "id",
        column(hot[0]["zip"], "10000 + id % 20", "pickup_zip"),
        column(hot[0]["ts"], many, "rounded_pickup_datetime"),
        column(hot[1]["zip"], "10000 + id % 20", "dropoff_zip"),
        column(hot[1]["ts"], many, "rounded_dropoff_datetime"),
    )
    joined = lookup_features(trips, pickup, PICKUP_KEY, PICKUP_NAMES)
    joined = lookup_features(joined, dropoff, DROPOFF_KEY, DROPOFF_NAMES)
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2
    assert sorted(row["id"] for row in rows) == list(range(150_000))
    found = {"p": [0, 0, 0], "d": [0, 0, 0]}
    for row in rows:
        found["p"][row["id"] % 3] += row[PICKUP_NAMES[1]] is not None
        found["d"][row["id"] % 3] += row[DROPOFF_NAMES[0]] is not None
    assert found["p"][:2] == found["d"][:2] == [50_000, 0]


def test_month_pruning_reaches_the_feature_scan(spark, sample, tables):
    rounded = rounded_trips(sample).filter("rounded_pickup_datetime < 1704500000")
    lookup = FeatureLookup(tables[0], PICKUP_NAMES, PICKUP_KEY)
    df = training_set(rounded, [lookup], prune_months=True).load_df()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(yyyy_mm" in plan
    assert df.count() == rounded.count()


def test_bucketed_features_are_not_shuffled(spark, sample, table):
    names = table(), table()
    feature_job(sample, None, None, explain=False, tables=names)
    expected = rows_of(training_set(rounded_trips(sample), fare_lookups(*names)).load_df())
    for name in names:
        assert bucketed_rows(spark, name) is None
        assert bucket_features(spark, name, 16) == 16
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = rounded_trips(sample)
        trips = trips.unionByName(trips.limit(5).withColumn("pickup_zip", F.lit(None).cast("int")))
        looked_up = training_set(trips, fare_lookups(*names), max_broadcast_bytes=0).load_df()
        plan = looked_up._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SelectedBucketsCount: 16 out of 16") >= 2
        joins = plan.split("SortMergeJoin")[1:] or plan.split("ShuffledHashJoin")[1:]
        assert joins and "BroadcastHashJoin" not in plan
        # From each bucketed scan up to its join there is no exchange.
        lines = plan.split("\n")
        for at, line in enumerate(lines):
            if "SelectedBucketsCount" in line:
                depth = len(line) - len(line.lstrip(" :+-"))
                above = []
                for up in reversed(lines[:at]):
                    deep = len(up) - len(up.lstrip(" :+-"))
                    if deep < depth:
                        depth = deep
                        above.append(up)
                        if "Join" in up:
                            break
                assert "Join" in above[-1] and not any("Exchange" in up for up in above)
        assert looked_up.count() == sample.count() + 5
        usual = training_set(rounded_trips(sample), fare_lookups(*names), max_broadcast_bytes=0)
        assert rows_of(usual.load_df()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_and_missing_keys_of_a_bucketed_lookup(spark, sample, table):
    name = table()
    create_feature_table(pickup_features(sample), name)
    bucket_features(spark, name, 8)
    trips = rounded_trips(sample)
    hot = trips.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    trips = trips.unionByName(hot).unionByName(trips.withColumn("pickup_zip", F.lit(None).cast("int")))
    trips = stage(trips.withColumn("pickup_zip", F.col("pickup_zip").cast("long")))
    plain = lookup_features(trips, read_features(spark, name), PICKUP_KEY, PICKUP_NAMES)
    for hot_rows in (100, 10_000):
        ours = lookup_bucketed(trips, bucketed_rows(spark, name), PICKUP_KEY, PICKUP_NAMES, hot_rows=hot_rows)
        assert rows_of(ours.select(plain.columns)) == rows_of(plain)


def test_a_bucketed_copy_serves_until_the_table_changes(spark, sample, table):
    name = table()
    create_feature_table(pickup_features(sample), name)
    bucket_features(spark, name, 4)
    assert bucketed_rows(spark, name).count() == read_features(spark, name).count()
    merge_features(pickup_features(sample.limit(10)), name, compact=False)
    assert bucketed_rows(spark, name) is None
    bucket_features(spark, name, 4)
    rows = bucketed_rows(spark, name)
    assert rows_of(rows.select("zip", "ts")) == rows_of(read_features(spark, name).select("zip", "ts"))
    compact_features(spark, name)
    assert bucketed_rows(spark, name) is None
    assert rows.count() == read_features(spark, name).count()
