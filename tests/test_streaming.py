from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.operators.store import create_feature_table, read_features, write_features
from faretide.operators.windows import dropoff_features, pickup_features
from faretide.schemas import DROPOFF_FEATURES, PICKUP_FEATURES
from faretide.session import fresh_path
from faretide.sources.tables import stream_trips
from faretide.streaming.features import late_rows, stream_features

KINDS = {
    "pickup": (pickup_features, PICKUP_FEATURES),
    "dropoff": (dropoff_features, DROPOFF_FEATURES),
}


def add_file(trips, folder):
    trips.coalesce(1).write.mode("append").parquet(folder)


def parts(sample, kind, count=3):
    """The sample as consecutive files in time order."""
    rows = sample.orderBy(f"tpep_{kind}_datetime").collect()
    size = -(-len(rows) // count)
    spark = sample.sparkSession
    return [
        spark.createDataFrame(rows[i : i + size], sample.schema).drop("event_id")
        for i in range(0, len(rows), size)
    ]


@pytest.fixture
def target(spark, table):
    def make(kind):
        name = table()
        create_feature_table(spark.createDataFrame([], KINDS[kind][1]), name)
        return name

    return make


def run(spark, folder, kind, name, checkpoint, **options):
    trips = stream_trips(spark, folder, maxFilesPerTrigger="1")
    query = write_features(
        stream_features(trips, kind, **options), name, checkpoint=checkpoint
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("kind", ["pickup", "dropoff"])
def test_final_state_equals_batch(spark, sample, target, kind):
    folder, checkpoint, name = fresh_path(spark, "in"), fresh_path(spark, "cp"), target(kind)
    for part in parts(sample, kind):
        add_file(part, folder)
        run(spark, folder, kind, name, checkpoint)
    expected = KINDS[kind][0](sample)
    got = read_features(spark, name).select(*expected.columns)
    assert rows_of(got.drop("mean_fare_window_1h_pickup_zip")) == rows_of(
        expected.drop("mean_fare_window_1h_pickup_zip")
    )
    if kind == "pickup":
        mean = "mean_fare_window_1h_pickup_zip"
        off = got.withColumnRenamed(mean, "m").join(expected, ["zip", "ts"])
        assert off.filter(F.abs(F.col("m") - F.col(mean)) > 1e-3).count() == 0


def test_late_trips_are_dropped_and_counted(spark, sample, target):
    folder, checkpoint, name = fresh_path(spark, "in"), fresh_path(spark, "cp"), target("pickup")
    first, second, third = parts(sample, "pickup")
    for part in (second, third):
        add_file(part, folder)
        query = run(spark, folder, "pickup", name, checkpoint)
        assert late_rows(query) == 0
    before = rows_of(read_features(spark, name))
    add_file(first.limit(5), folder)
    query = run(spark, folder, "pickup", name, checkpoint)
    assert late_rows(query) > 0
    assert rows_of(read_features(spark, name)) == before


def test_without_a_delay_nothing_is_late(spark, sample, target):
    folder, checkpoint, name = fresh_path(spark, "in"), fresh_path(spark, "cp"), target("dropoff")
    for part in reversed(parts(sample, "dropoff", 2)):
        add_file(part, folder)
        run(spark, folder, "dropoff", name, checkpoint, delay=None)
    expected = dropoff_features(sample)
    assert rows_of(read_features(spark, name).select(*expected.columns)) == rows_of(expected)


def test_replaying_everything_changes_nothing(spark, sample, target):
    folder, name = fresh_path(spark, "in"), target("dropoff")
    add_file(parts(sample, "dropoff", 1)[0], folder)
    run(spark, folder, "dropoff", name, fresh_path(spark, "cp"))
    before = rows_of(read_features(spark, name))
    run(spark, folder, "dropoff", name, fresh_path(spark, "cp"))
    assert rows_of(read_features(spark, name)) == before


def test_a_query_started_again_goes_on(spark, sample, target):
    folder, name = fresh_path(spark, "in"), target("dropoff")
    for part in parts(sample, "dropoff", 2):
        add_file(part, folder)
        query = run(spark, folder, "dropoff", name, None)
        assert query.lastProgress["batchId"] >= 0
    assert query.recentProgress[0]["numInputRows"] == part.count()
    assert rows_of(read_features(spark, name)) == rows_of(dropoff_features(sample).select(
        *read_features(spark, name).columns))


def test_other_sessions_give_the_same_windows(spark, sample, target, zone):
    folder, name = fresh_path(spark, "in"), target("dropoff")
    add_file(parts(sample, "dropoff", 1)[0], folder)
    expected = rows_of(dropoff_features(sample))
    zone("America/New_York")
    run(spark, folder, "dropoff", name, fresh_path(spark, "cp"))
    got = read_features(spark, name).select(*DROPOFF_FEATURES.names)
    assert rows_of(got) == expected


def test_streams_only_merge(spark, target):
    name = target("pickup")
    folder = fresh_path(spark, "in")
    spark.createDataFrame([], KINDS["pickup"][1]).write.parquet(folder)
    stream = spark.readStream.schema(PICKUP_FEATURES).parquet(folder)
    with pytest.raises(ValueError, match="only be merged"):
        write_features(stream, name, mode="overwrite")
