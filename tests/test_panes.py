"""Streams kept from partial sums: windows, late trips, replays and what a batch reads."""

from __future__ import annotations

import os

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from faretide.functions.times import epoch_seconds
from faretide.operators import store
from faretide.operators.snapshots import read_snapshot
from faretide.operators.store import compact_features, create_feature_table, feature_table, read_features
from faretide.operators.windows import dropoff_features, pickup_features
from faretide.schemas import DROPOFF_FEATURES, PICKUP_FEATURES, TRIPS
from faretide.session import fresh_path
from faretide.sources.tables import stream_trips
from faretide.streaming.panes import (
    KINDS,
    backfill_late,
    compact_panes,
    fold_batch,
    late_count,
    late_trips,
    pane_sums,
    read_panes,
    seconds_of,
    stream_table,
    windows_of,
)

BATCH = {"pickup": (pickup_features, PICKUP_FEATURES), "dropoff": (dropoff_features, DROPOFF_FEATURES)}
HOUR = 3600


@pytest.fixture
def target(spark, table):
    def make(kind):
        name = table()
        create_feature_table(spark.createDataFrame([], BATCH[kind][1]), name)
        return name

    return make


def same(ours, expected, kind):
    """Equal rows, but for the last digits of means that are added up in another order."""
    ours = ours.select(*expected.columns)
    if kind == "pickup":
        mean = "mean_fare_window_1h_pickup_zip"
        ours, expected = (df.withColumn(mean, F.round(mean, 2)) for df in (ours, expected))
    assert rows_of(ours) == rows_of(expected)


@pytest.mark.parametrize("kind", ["pickup", "dropoff"])
def test_windows_of_panes_are_the_features(sample, kind):
    same(windows_of(pane_sums(sample, KINDS[kind]), KINDS[kind]), BATCH[kind][0](sample), kind)


@pytest.mark.parametrize("kind", ["pickup", "dropoff"])
def test_a_stream_in_time_order_gives_the_features(spark, sample, target, kind):
    name, source = target(kind), fresh_path(spark, "in")
    parts = sample.withColumn("p", F.ntile(3).over(Window.orderBy(KINDS[kind].ts_column)))
    for number in (1, 2, 3):
        parts.where(F.col("p") == number).select(*TRIPS.names).write.mode("append").parquet(source)
        stream_table(stream_trips(spark, source), name, kind).awaitTermination()
    same(read_features(spark, name), BATCH[kind][0](sample), kind)
    assert late_count(spark, name) == 0 and late_trips(spark, name) is None
    assert compact_panes(spark, name) and compact_features(spark, name)
    same(read_features(spark, name), BATCH[kind][0](sample), kind)


def split(sample):
    """Two batches in time order, and a third of early trips."""
    at = epoch_seconds(sample, "tpep_pickup_datetime")
    low, middle = sample.agg(F.min(at), F.percentile(at, 0.5).cast("long")).first()
    early = (at < low + 40 * HOUR) & (F.col("event_id") % 3 == 0)
    return [
        sample.where(~early & (at < middle)), sample.where(~early & (at >= middle)),
        sample.where(early),
    ], middle


def test_late_trips_go_to_the_side_table_and_come_back_by_backfill(spark, sample, target):
    name, (batches, _) = target("pickup"), split(sample)
    for number, batch in enumerate(batches):
        fold_batch(batch, number, name, KINDS["pickup"], HOUR)
    on_time = batches[0].unionByName(batches[1])
    same(read_features(spark, name), pickup_features(on_time), "pickup")
    late = batches[2].count()
    assert late_count(spark, name) == late > 0
    side = late_trips(spark, name)
    assert rows_of(side.select(*sample.columns)) == rows_of(batches[2])
    assert [tuple(r) for r in side.select("batch", "folded").distinct().collect()] == [(2, False)]

    hit = windows_of(pane_sums(batches[2], KINDS["pickup"]), KINDS["pickup"]).select("zip", "ts")
    report = backfill_late(spark, name, "pickup")
    assert report.rows == hit.distinct().count() < pickup_features(sample).count()
    same(read_features(spark, name), pickup_features(sample), "pickup")
    assert late_count(spark, name) == late
    assert late_trips(spark, name).where("not folded").count() == 0
    assert backfill_late(spark, name, "pickup").rows == 0
    same(read_features(spark, name), pickup_features(sample), "pickup")


def test_a_trip_is_late_when_all_its_windows_have_ended(spark, target, make_trips):
    """After 12:00 and a delay of an hour, the watermark is 11:00."""
    for kind, on_time, late in (
        ("pickup", "2024-01-05 10:15:00", "2024-01-05 10:14:59"),
        ("dropoff", "2024-01-05 11:00:00", "2024-01-05 10:59:59"),
    ):
        name = target(kind)
        trip = lambda at: make_trips([(at, at, 1.0, 4.0, 7, 7)])
        fold_batch(trip("2024-01-05 12:00:00"), 0, name, KINDS[kind], HOUR)
        for number, (at, count) in enumerate([(on_time, 0), (late, 1)], 1):
            fold_batch(trip(at), number, name, KINDS[kind], HOUR)
            assert late_count(spark, name) == count


def test_a_batch_that_is_run_again_changes_nothing(spark, sample, target, monkeypatch):
    name, (batches, _) = target("dropoff"), split(sample)
    fold = lambda number: fold_batch(batches[number], number, name, KINDS["dropoff"], None)
    fold(0)
    with monkeypatch.context() as patched:
        def lost(*_):
            raise RuntimeError("driver lost")

        patched.setattr(store, "_switch", lost)
        with pytest.raises(RuntimeError, match="lost"):
            fold(1)
    same(read_features(spark, name), dropoff_features(batches[0]), "dropoff")
    for number in (1, 1, 0, 2, 2):
        fold(number)
    same(read_features(spark, name), dropoff_features(sample), "dropoff")
    assert late_count(spark, name) == 0


def test_another_stream_is_refused(sample, target):
    name, (batches, _) = target("dropoff"), split(sample)
    fold_batch(batches[0], 0, name, KINDS["dropoff"], None, stream="a")
    with pytest.raises(ValueError, match="another stream"):
        fold_batch(batches[1], 1, name, KINDS["dropoff"], None, stream="b")


def test_a_batch_reads_the_panes_around_it(spark, sample, target):
    name, (batches, middle) = target("pickup"), split(sample)
    for number, batch in enumerate(batches[:2]):
        fold_batch(batch, number, name, KINDS["pickup"], None)
    info = feature_table(spark, name)
    panes = read_snapshot(spark, info.root).of("pane")
    end = max(s.high for s in panes)
    near = read_panes(spark, info, panes, end - HOUR, end)
    assert middle < end - HOUR
    assert len(near.inputFiles()) < len(read_panes(spark, info, panes, 0, end).inputFiles())
    assert near.agg(F.min("ts")).first()[0] >= end - HOUR


def test_many_batches_are_counted_exactly(spark, target, make_trips):
    """One trip an hour, and after every second one of two days before.

    ``BATCHES=101`` runs more batches than Spark remembers the progress of, in some minutes.
    """
    name, late, batches = target("dropoff"), 0, int(os.environ.get("BATCHES", "13"))
    for number in range(batches):
        day, hour = divmod(number, 24)
        at = f"2024-01-{4 + day:02} {hour:02}:10:00"
        old = f"2024-01-{2 + day:02} {hour:02}:10:00"
        rows = [(at, at, 1.0, 4.0, 7, 7)] + [(old, old, 1.0, 4.0, 7, number % 3)] * (number % 2)
        late += number % 2
        fold_batch(make_trips(rows), number, name, KINDS["dropoff"], HOUR)
        if number == batches // 2:
            compact_panes(spark, name)
            compact_features(spark, name)
    assert late_count(spark, name) == late == batches // 2
    assert read_features(spark, name).count() == batches


def test_trips_without_time_or_zip_are_in_no_window_and_not_late(spark, target, make_trips):
    name = target("pickup")
    fold_batch(make_trips([("2024-01-05 12:00:00", None, 1.0, None, 7, 7)]), 0, name, KINDS["pickup"], HOUR)
    odd = [(None, None, 1.0, 4.0, 7, 7), ("2024-01-05 09:00:00", None, 1.0, 4.0, None, 7)]
    fold_batch(make_trips(odd), 1, name, KINDS["pickup"], HOUR)
    fold_batch(make_trips(odd).limit(0), 2, name, KINDS["pickup"], HOUR)
    assert late_count(spark, name) == 0
    rows = read_features(spark, name).collect()
    assert len(rows) == 4 and all(r["mean_fare_window_1h_pickup_zip"] is None for r in rows)


def test_delays():
    assert [seconds_of(d) for d in ("1 hour", "90 minutes", "5 seconds", "2 days")] == [3600, 5400, 5, 172_800]
    with pytest.raises(ValueError, match="not a delay"):
        seconds_of("soon")
