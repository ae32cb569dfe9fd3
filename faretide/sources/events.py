"""Trips and logs derived from an ``events`` table.

``events`` has event_id, ts, user_id, event_type, value and props.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide.schemas import LOGS, TRIPS, schema_of, validate

EVENTS = schema_of(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def trips_from_events(events: DataFrame) -> DataFrame:
    trips = events.select(
        "event_id",
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("ts + (5 + cast(event_id % 40 AS int)) * INTERVAL '1' MINUTE").alias(
            "tpep_dropoff_datetime"
        ),
        F.expr("value / 4 + event_id % 7").alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        F.expr("cast(10000 + user_id % 20 AS int)").alias("pickup_zip"),
        F.expr("cast(10000 + (user_id * 7 + event_id) % 20 AS int)").alias("dropoff_zip"),
    )
    return validate(trips, TRIPS)


def logs_from_events(events: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "error", "exception")
        .when(F.col("event_type") == "purchase", "dependency")
        .otherwise("trace")
    )
    logs = events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("operation_id"),
        kind.alias("kind"),
        F.col("event_type").alias("role"),
        F.get_json_object("props", "$.k").alias("experiment_id"),
        F.expr("user_id % 5").alias("run_id"),
        F.col("value").alias("duration"),
    )
    return validate(logs, LOGS)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")
