from __future__ import annotations

import random

import numpy as np
import pytest

from faretide.operators.profile import (
    boxplot_dropoff,
    boxplot_stats,
    describe_features,
    null_keys,
    rides_by_weekend,
    shape_profile,
)
from faretide.operators.windows import dropoff_features, pickup_features


def test_describe_matches_sparks_own(sample):
    features = pickup_features(sample)
    own = {r[0]: r.asDict() for r in features.describe().collect()}
    for row in describe_features(features).collect():
        name = row["column_name"]
        assert row["value_count"] == int(own["count"][name])
        if name == "yyyy_mm":
            assert (row["min_text"], row["max_text"]) == (own["min"][name], own["max"][name])
            assert row["mean"] is None and row["min_value"] is None
        else:
            for key, column in [("mean", "mean"), ("stddev", "stddev"), ("min", "min_value"),
                                ("max", "max_value")]:
                assert row[column] == pytest.approx(float(own[key][name]), rel=1e-6)


def expected_box(values):
    values = np.sort(np.array(values, dtype=float))
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    reach = 1.5 * (q3 - q1)
    inside = values[(values >= q1 - reach) & (values <= q3 + reach)]
    return (q1, median, q3, len(values), inside.min(), inside.max(), len(values) - len(inside))


BOX = ["q1", "median", "q3", "row_count", "whisker_low", "whisker_high", "outliers"]


def test_boxplot_equals_brute_force_with_hot_group_and_value(spark):
    rng = random.Random(5)
    rows = [(0, rng.gauss(0, 10), 1.0) for _ in range(3000)]  # a group with most values
    rows += [(1, 4.25, rng.random()) for _ in range(1500)]  # a value with most rows
    rows += [(1, rng.uniform(-50, 50), 2.0) for _ in range(200)]
    rows += [(2, float(i), float(i % 3)) for i in range(7)] + [(3, -1.5, 0.0)]
    rows += [(4, None, 1.0), (None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(7)
    boxes = boxplot_stats(df, "g", ["a", "b"]).collect()
    got = {(r["measure"], r["group_value"]): r for r in boxes}
    expected = {}
    for index, measure in ((1, "a"), (2, "b")):
        for group in range(5):
            values = [r[index] for r in rows if r[0] == group and r[index] is not None]
            if values:
                expected[measure, float(group)] = expected_box(values)
    assert got.keys() == expected.keys()
    for key, numbers in expected.items():
        assert [got[key][c] for c in BOX] == pytest.approx(numbers, rel=1e-9)


def test_a_group_over_many_slices(spark, splitting):
    """Small shuffle partitions, so that one group's values span all slices."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        df = spark.range(10_001).selectExpr("1 AS g", "cast(id * 7919 % 10007 AS double) AS a")
        row = boxplot_stats(df, "g", ["a"]).first()
    finally:
        spark.conf.set(setting, before)
    values = [i * 7919 % 10007 for i in range(10_001)]
    assert [row[c] for c in BOX] == pytest.approx(expected_box(values))


def test_dropoff_boxes_have_both_flags(sample):
    boxes = boxplot_dropoff(dropoff_features(sample)).collect()
    groups = {(r["measure"], r["group_value"]) for r in boxes}
    names = ("count_trips_window_30m_dropoff_zip", "dropoff_is_weekend")
    assert groups == {(name, flag) for name in names for flag in (0.0, 1.0)}


def test_rides_by_weekend_leaves_out_null_flags(spark):
    df = spark.createDataFrame(
        [(3, 0), (4, 0), (5, 1), (9, None)],
        "count_trips_window_30m_dropoff_zip int, dropoff_is_weekend int",
    )
    assert {tuple(r) for r in rides_by_weekend(df).collect()} == {(7, 0), (5, 1)}


def test_shape_and_null_keys(make_trips, sample):
    assert tuple(shape_profile(sample, "trips").first()) == ("trips", sample.count(), 7)
    trips = make_trips(
        [(None, "2024-01-01", 1.0, 1.0, None, 2), ("2024-01-01", None, 1.0, 1.0, None, 2)]
    )
    assert tuple(null_keys(trips).first()) == (1, 1, 2, 0)


def test_profiles_use_one_aggregate(sample):
    plan = describe_features(dropoff_features(sample))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange SinglePartition") == 1
