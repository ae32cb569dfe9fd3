from __future__ import annotations

import os
import sys
import uuid
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faretide.operators.store import create_database
from faretide.session import build_session, fresh_path

TRIP_TYPES = (
    "tpep_pickup_datetime {time}, tpep_dropoff_datetime {time}, trip_distance double, "
    "fare_amount {fare}, pickup_zip {zip}, dropoff_zip {zip}"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def zone(spark):
    """A function that sets the session's zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture
def splitting(spark):
    """Joins that shuffle, and take partitions of some 100 KB for skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def table(spark):
    """A function that gives names of tables that do not exist yet."""
    create_database(spark, "faretide_tests", fresh_path(spark, "database"))
    return lambda: f"faretide_tests.t{uuid.uuid4().hex}"


@pytest.fixture
def make_trips(spark):
    def make(rows):
        """Rows of (pickup, dropoff, distance, fare, pickup zip, dropoff zip)."""
        parsed = [
            tuple(datetime.fromisoformat(v) if isinstance(v, str) else v for v in row)
            for row in rows
        ]
        types = TRIP_TYPES.format(time="timestamp_ntz", fare="double", zip="int")
        return spark.createDataFrame(parsed, types)

    return make


@pytest.fixture
def golden(spark):
    """Twelve trips a quarter hour apart, with times as text."""
    first = datetime(2019, 1, 1)
    rows = []
    for i in range(12):
        pickup = first + timedelta(minutes=15 * i)
        dropoff = pickup + timedelta(hours=1)
        rows.append((str(pickup), str(dropoff), i + 1.0, i + 1, 10000 + 2 * i, 10001 + 2 * i))
    return spark.createDataFrame(rows, TRIP_TYPES.format(time="string", fare="long", zip="long"))


@pytest.fixture(scope="session")
def sample(spark):
    """The trips of the smallest driver tables."""
    from faretide.sources.events import read_events, trips_from_events

    return trips_from_events(read_events(spark, "/root/testdata/sf0.001"))


def rows_of(df) -> list[tuple]:
    """All rows in an order of their own."""
    return sorted((tuple(row) for row in df.collect()), key=str)
