from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.operators.windows import dropoff_features, pickup_features
from faretide.schemas import DROPOFF_FEATURES, PICKUP_FEATURES

EPOCH = datetime(1970, 1, 1)
START, END = datetime(2024, 1, 5, 0, 20), datetime(2024, 1, 6, 3, 40)


def seconds(moment):
    return (moment - EPOCH) // timedelta(seconds=1)


def brute_pickup(trips, start=datetime.min, end=datetime.max):
    fares = defaultdict(list)
    for t in trips.collect():
        at = t["tpep_pickup_datetime"]
        if at is not None and start <= at < end:
            first = EPOCH + (at - EPOCH) // timedelta(minutes=15) * timedelta(minutes=15)
            for k in range(1, 5):
                fares[t["pickup_zip"], first + k * timedelta(minutes=15)].append(t["fare_amount"])
    return {
        (zip_, seconds(stop)): (stop.strftime("%Y-%m"), np.float32(np.mean(f)), len(f))
        for (zip_, stop), f in fares.items()
    }


def as_dict(features):
    return {(r[0], r[1]): tuple(r[2:]) for r in features.collect()}


def assert_same(got, expected):
    assert got.keys() == expected.keys()
    for key, (month, mean, count) in expected.items():
        assert got[key][0] == month and got[key][2] == count
        assert got[key][1] == pytest.approx(mean, rel=1e-6)


@pytest.mark.parametrize("panes", [True, False])
def test_golden_pickup_has_28_rows(golden, panes):
    features = pickup_features(
        golden, start="2019-01-01 00:00:00", end="2019-01-01 01:45:00", panes=panes
    )
    assert features.count() == 28
    first = features.filter("zip = 10000").orderBy("ts").collect()
    assert [r["ts"] - 1546300800 for r in first] == [900, 1800, 2700, 3600]
    assert {tuple(r[2:]) for r in first} == {("2019-01", 1.0, 1)}


@pytest.mark.parametrize("panes", [True, False])
def test_pickup_equals_brute_force(sample, panes):
    assert_same(as_dict(pickup_features(sample, panes=panes)), brute_pickup(sample))
    ranged = pickup_features(sample, start=START, end=END, panes=panes)
    assert_same(as_dict(ranged), brute_pickup(sample, START, END))


def test_every_trip_is_in_four_windows(sample):
    total = pickup_features(sample).agg(F.sum("count_trips_window_1h_pickup_zip")).first()[0]
    assert total == 4 * sample.count()


def test_whole_windows_lie_in_the_range(sample):
    start, end = seconds(START), seconds(END)
    partial = as_dict(pickup_features(sample, start=START, end=END))
    whole = as_dict(pickup_features(sample, start=START, end=END, edges="whole"))
    expected = {k: v for k, v in partial.items() if k[1] - 3600 >= start and k[1] <= end}
    assert whole == expected and len(whole) < len(partial)


def test_owned_windows_of_adjacent_ranges_make_up_the_whole(sample):
    middle = datetime(2024, 1, 5, 12, 10)
    parts = [
        as_dict(pickup_features(sample, start=a, end=b, edges="owned"))
        for a, b in [(START, middle), (middle, END)]
    ]
    assert not parts[0].keys() & parts[1].keys()
    complete = brute_pickup(sample)
    expected = {k: v for k, v in complete.items() if seconds(START) < k[1] <= seconds(END)}
    assert_same(parts[0] | parts[1], expected)


def test_bounds_may_be_columns_or_dates(sample):
    as_column = F.expr("timestamp_ntz'2024-01-05'"), F.expr("timestamp_ntz'2024-01-06'")
    for edges in ("partial", "whole", "owned"):
        bounds = {"start": "2024-01-05", "end": "2024-01-06"}
        expected = as_dict(pickup_features(sample, **bounds, edges=edges))
        for start, end in (as_column, (date(2024, 1, 5), date(2024, 1, 6))):
            got = pickup_features(sample, start=start, end=end, edges=edges)
            assert as_dict(got) == expected
    with pytest.raises(ValueError, match="unknown edges"):
        pickup_features(sample, edges="none")


def test_dropoff_counts_and_weekend(make_trips):
    def ending(*times):
        return [("2024-01-01 00:00:00", t, 1.0, 1.0, 1, 9) for t in times]

    # 05:00 UTC is midnight in New York in January.
    trips = make_trips(
        ending("2024-01-06 04:30:00", "2024-01-06 04:59:59", "2024-01-06 04:29:59",
               "2024-01-08 04:59:00", "2024-01-31 23:45:00")
    )
    got = {(r["ts"], *r[2:]) for r in dropoff_features(trips).collect()}
    assert got == {
        (seconds(datetime(2024, 1, 6, 4, 30)), "2024-01", 1, 0),
        # Friday's last half hour ends on Saturday.
        (seconds(datetime(2024, 1, 6, 5)), "2024-01", 2, 1),
        (seconds(datetime(2024, 1, 8, 5)), "2024-01", 1, 0),
        (seconds(datetime(2024, 2, 1)), "2024-02", 1, 0),
    }


def test_null_times_and_zips(make_trips):
    trips = make_trips(
        [
            ("2024-01-01 10:01:00", "2024-01-01 10:20:00", 1.0, 5.0, 1, 2),
            (None, None, 1.0, 7.0, 1, 2),
            ("2024-01-01 10:02:00", "2024-01-01 10:21:00", 1.0, None, None, None),
        ]
    )
    pickup = rows_of(pickup_features(trips).select("zip", F.expr("ts % 3600"), F.expr("*")))
    assert len(pickup) == 8
    assert {(r[0], r[5], r[6]) for r in pickup} == {(1, 5.0, 1), (None, None, 1)}
    dropoff = dropoff_features(trips).select("zip", "count_trips_window_30m_dropoff_zip")
    assert rows_of(dropoff) == [(2, 1), (None, 1)]


def test_schemas(sample):
    for features, schema in [
        (pickup_features(sample), PICKUP_FEATURES), (dropoff_features(sample), DROPOFF_FEATURES)
    ]:
        assert [(f.name, f.dataType) for f in features.schema] == [
            (f.name, f.dataType) for f in schema
        ]


@pytest.mark.parametrize("session_zone", ["Asia/Tokyo", "America/New_York"])
def test_other_sessions_give_the_same_features(sample, zone, session_zone):
    trips = sample.limit(300)
    expected = rows_of(pickup_features(trips)), rows_of(dropoff_features(trips))
    instants = trips.withColumns(
        {c: F.col(c).cast("timestamp") for c in trips.columns if c.startswith("tpep")}
    )
    assert (rows_of(pickup_features(instants)), rows_of(dropoff_features(instants))) == expected
    zone(session_zone)
    assert (rows_of(pickup_features(trips)), rows_of(dropoff_features(trips))) == expected


def test_no_python_and_few_columns_in_the_plan(sample):
    plan = pickup_features(sample, start=START, end=END)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Python" not in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert text.count("Exchange hashpartitioning") == 2
