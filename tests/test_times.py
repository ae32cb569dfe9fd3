from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from faretide.functions.times import (
    ceil_minutes,
    epoch_seconds,
    month_id,
    month_of_epoch,
    parse_date,
    weekend_flag,
)

ZONES = ["UTC", "Asia/Tokyo", "America/New_York"]
MOMENTS = [
    *[datetime(2024, 1, 1, 5, minute) for minute in (0, 15, 30)],
    *[datetime(2024, 1, 1, 5, minute, 0, 1) for minute in (0, 15, 30, 45)],
    datetime(2024, 1, 1, 5, 59, 59, 999_999),
    datetime(2023, 12, 31, 23, 59, 59, 999_999),
    datetime(1969, 12, 31, 23, 44, 59, 500_000),
    # Friday to Saturday and Sunday to Monday in New York, in winter and summer.
    *[datetime(2024, 1, 6, 5), datetime(2024, 1, 6, 4, 59, 59), datetime(2024, 1, 8, 5)],
    *[datetime(2024, 7, 6, 4), datetime(2024, 7, 6, 3, 59, 59), datetime(2024, 7, 8, 4)],
    # The clock changes of March and November.
    *[datetime(2024, 3, 10) + timedelta(minutes=30 * i) for i in range(60)],
    *[datetime(2024, 11, 3) + timedelta(minutes=30 * i) for i in range(60)],
]


def frame(spark, kind):
    """Moments as wall-clock times, instants or text, numbered."""
    rows = [(i, str(moment)) for i, moment in enumerate(MOMENTS)]
    df = spark.createDataFrame(rows, "i int, at string")
    if kind == "timestamp":
        return df.withColumn("at", F.concat("at", F.lit("Z")).cast("timestamp"))
    return df.withColumn("at", F.col("at").cast(kind))


def results(df, column):
    return [row[0] for row in df.select(column.alias("x"), "i").orderBy("i").select("x").collect()]


def micros(moment):
    return (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
@pytest.mark.parametrize("session_zone", ZONES)
class TestAnySessionAndType:
    def test_epoch_seconds(self, spark, zone, kind, session_zone):
        zone(session_zone)
        df = frame(spark, kind)
        expected = [micros(moment) // 1_000_000 for moment in MOMENTS]
        assert results(df, epoch_seconds(df, "at")) == expected

    @pytest.mark.parametrize("minutes", [7, 15, 30, 60, 120])
    def test_ceil_minutes(self, spark, zone, kind, session_zone, minutes):
        zone(session_zone)
        df = frame(spark, kind)
        step = minutes * 60_000_000
        expected = []
        for moment in MOMENTS:
            hour = micros(moment) // 3_600_000_000 * 3_600_000_000
            offset = micros(moment) - hour
            expected.append((hour + -(-offset // step) * step) // 1_000_000)
        assert results(df, ceil_minutes(df, "at", minutes)) == expected

    def test_weekend_flag(self, spark, zone, kind, session_zone):
        zone(session_zone)
        df = frame(spark, kind)
        for place in ("America/New_York", "Asia/Tokyo"):
            expected = [
                int(m.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(place)).weekday() >= 5)
                for m in MOMENTS
            ]
            assert results(df, weekend_flag(df, "at", place)) == expected

    def test_month_id(self, spark, zone, kind, session_zone):
        zone(session_zone)
        df = frame(spark, kind)
        expected = [moment.strftime("%Y-%m") for moment in MOMENTS]
        assert results(df, month_id(df, "at")) == expected
        assert results(df, month_of_epoch(epoch_seconds(df, "at"))) == expected


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_null_gives_null(spark, kind):
    df = spark.createDataFrame([(None,)], f"at {kind}")
    row = df.select(
        ceil_minutes(df, "at"), ceil_minutes(df, "at", 7), weekend_flag(df, "at"),
        month_id(df, "at"), epoch_seconds(df, "at"),
    ).first()
    assert set(row) == {None}


def test_time_beyond_int_gives_null(spark):
    df = spark.sql("SELECT timestamp_ntz'2039-01-01' AS at")
    assert df.select(ceil_minutes(df, "at")).first()[0] is None


def test_parse_date(spark):
    df = spark.createDataFrame([("2016-01-31",), ("2016-2-9",), (None,)], "d string")
    days = [row[0] for row in df.select(parse_date(F.col("d"))).collect()]
    assert days == [datetime(2016, 1, 31), datetime(2016, 2, 9), None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("31 Jan",)], "d string").select(parse_date(F.col("d"))).collect()
