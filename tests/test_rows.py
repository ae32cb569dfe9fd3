from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.operators.rows import (
    filter_by_time,
    hash_percent,
    prepare_trips,
    rounded_trips,
    subsample,
)
from faretide.schemas import TRIPS, validate

AT = "tpep_pickup_datetime"
START, END = "2019-01-01 00:00:00", "2019-01-01 01:45:00"


def test_golden_filter_keeps_seven(golden):
    assert filter_by_time(golden, AT, START, END).count() == 7


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_filter_is_half_open(golden, zone, kind, session_zone):
    zone(session_zone)
    text = F.concat(AT, F.lit("Z")) if kind == "timestamp" else F.col(AT)
    df = golden.withColumn(AT, text.cast(kind))
    for start, end in [
        (START, END),
        (datetime(2019, 1, 1), datetime(2019, 1, 1, 1, 45)),
        (datetime(2019, 1, 1, tzinfo=timezone.utc), datetime.fromisoformat(END + "+00:00")),
    ]:
        kept = filter_by_time(df, AT, start, end)
        assert sorted(row[0] for row in kept.select("fare_amount").collect()) == list(range(1, 8))


def test_empty_arguments_skip_their_bound(golden):
    assert filter_by_time(golden, AT, "", None).count() == 12
    assert filter_by_time(golden, None, START, END).count() == 12
    assert filter_by_time(golden, AT, None, END).count() == 7
    assert filter_by_time(golden, AT, END, None).count() == 5


def test_bounds_reach_the_scan(spark, sample):
    plan = filter_by_time(sample, AT, "2024-01-05", "2024-01-06").select("fare_amount")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05" in text and "LessThan(ts,2024-01-06" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_rounded_trips(spark, make_trips):
    trips = make_trips(
        [
            ("2024-01-01 10:15:00", "2024-01-01 10:30:00", 1.0, 5.0, 1, 2),
            ("2024-01-01 10:15:00.000001", "2024-01-01 10:30:00.000001", 1.0, 6.0, 1, 2),
            (None, "2024-01-01 23:59:00", 1.0, 7.0, 1, 2),
        ]
    )
    rounded = rounded_trips(trips, view="rounded_test")
    assert rounded.columns == [
        "trip_distance", "fare_amount", "pickup_zip", "dropoff_zip",
        "rounded_pickup_datetime", "rounded_dropoff_datetime",
    ]
    base = 1704067200
    got = {row[1]: (row[4], row[5]) for row in spark.table("rounded_test").collect()}
    assert got == {
        5.0: (base + 10 * 3600 + 900, base + 10 * 3600 + 1800),
        6.0: (base + 10 * 3600 + 1800, base + 11 * 3600),
        7.0: (None, base + 24 * 3600),
    }


def test_subsample_is_the_same_for_any_partitioning(sample):
    def chosen(df):
        return rows_of(subsample(df, AT, "2024-01-02", "2024-01-30", 30, ["event_id"]))

    one, many = chosen(sample.coalesce(1)), chosen(sample.repartition(13, "fare_amount"))
    assert one == many
    assert 0 < len(one) < sample.count()


def test_hash_percent_takes_nulls(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert all(0 <= row[0] < 100 for row in df.select(hash_percent(["a", "b"])).collect())


def test_prepare_trips(golden):
    names = {"fare_amount": "fare", "pickup_zip": "zip"}
    out = prepare_trips(golden, names, keep=["trip_distance"])
    assert out.columns == ["fare", "zip", "trip_distance"]


def test_validate_names_what_is_wrong(golden):
    assert validate(golden, TRIPS) is golden
    with pytest.raises(ValueError, match="pickup_zip is missing"):
        validate(golden.drop("pickup_zip"), TRIPS)
    with pytest.raises(ValueError, match="fare_amount is boolean"):
        validate(golden.withColumn("fare_amount", F.lit(True)), TRIPS)
