"""A log table in files by day, for queries of recent rows that open recent days only.

Rows are stored under ``load=<id>/day=<day>``, sorted by time within a file. Each load writes its
own folder, so loads may run at once. A query of the last half hour reads one day (two around
midnight), and in it the parts of files around that time. A query of the newest rows of any age
opens days from the latest back until it has enough. Days are UTC; rows without a time have a
partition of their own, which comes last.

Dynamic dimensions may be stored as a variant: JSON that is parsed once, when it is written.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions.dimensions import parsed_dimensions
from faretide.functions.times import is_instant, moment_of, time_literal
from faretide.operators import logs as log_queries
from faretide.operators.snapshots import children
from faretide.schemas import LOGS, validate
from faretide.streaming.panes import seconds_of

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def write_logs(logs: DataFrame, path: str, dimensions: str | None = None) -> None:
    """Add rows to the table; ``dimensions`` names a column to store as a variant."""
    if dimensions:
        logs = logs.withColumn(dimensions, parsed_dimensions(logs, dimensions))
    if is_instant(logs, "ts"):
        days = F.floor(F.unix_seconds("ts") / 86_400).cast("int")
        day = F.date_add(F.lit("1970-01-01").cast("date"), days)
    else:
        day = F.col("ts").cast("timestamp_ntz").cast("date")
    rows = validate(logs, LOGS).withColumn("day", day.cast("string")).hint("rebalance", "day")
    rows = rows.sortWithinPartitions("day", "ts", "event_id")
    rows.write.partitionBy("day").parquet(f"{path}/load={uuid.uuid4().hex}")


def read_day_logs(
    spark: SparkSession,
    path: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    schema: T.StructType = LOGS,
) -> DataFrame:
    """The table, or the rows with a time in ``(start, end]``, from their days only."""
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType()),
                          T.StructField("day", T.StringType())])
    rows = spark.read.schema(whole).parquet(path)
    if start is not None:
        since = moment_of(start)
        rows = rows.where((F.col("day") >= str(since.date())) & (F.col("ts") > time_literal(rows, "ts", since)))
    if end is not None:
        until = moment_of(end)
        rows = rows.where((F.col("day") <= str(until.date())) & (F.col("ts") <= time_literal(rows, "ts", until)))
    return rows.drop("load", "day")


def recent_day_logs(
    spark: SparkSession,
    path: str,
    kind: str | None = log_queries.TRACE,
    experiment_id: str | None = None,
    run_id: object = None,
    now: datetime | str | None = None,
    window: str | timedelta = "30 minutes",
    limit: int | None = 1000,
    schema: T.StructType = LOGS,
) -> DataFrame:
    """:func:`faretide.operators.logs.recent_logs` of the table, which reads the window's days."""
    moment = datetime.now(timezone.utc) if now is None else now
    start = moment_of(moment) - timedelta(seconds=seconds_of(window))
    rows = read_day_logs(spark, path, start, schema=schema)
    return log_queries.recent_logs(rows, kind, experiment_id, run_id, window=None, limit=limit)


def days_of(spark: SparkSession, path: str) -> list[str]:
    """The table's days, the latest first, as folders name them."""
    loads = [name for name, _ in children(spark, path) if name.startswith("load=")]
    names = {day for load in loads for day, _ in children(spark, f"{path}/{load}")}
    days = sorted((n.removeprefix("day=") for n in names if n.startswith("day=")), reverse=True)
    # What has no time is older than everything.
    return [d for d in days if d != _NO_DAY] + [d for d in days if d == _NO_DAY]


def newest_day_logs(
    spark: SparkSession,
    path: str,
    kind: str | None = log_queries.TRACE,
    experiment_id: str | None = None,
    run_id: object = None,
    limit: int = 1000,
    schema: T.StructType = LOGS,
) -> DataFrame:
    """The newest ``limit`` rows of any age, from as few of the latest days as hold them.

    The days opened double until they hold enough rows, so a rare kind of row takes a number of
    counts that is logarithmic in the days.
    """
    days, opened = days_of(spark, path), 1
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType()),
                          T.StructField("day", T.StringType())])
    rows = spark.read.schema(whole).parquet(path) if days else spark.createDataFrame([], whole)

    def chosen(part: DataFrame, most: int | None) -> DataFrame:
        found = log_queries.recent_logs(part, kind, experiment_id, run_id, window=None, limit=most)
        return found.drop("load", "day")

    while opened < len(days):
        part = rows.where(F.col("day") >= days[opened - 1])
        if chosen(part, None).limit(limit).count() >= limit:
            return chosen(part, limit)
        opened *= 2
    return chosen(rows, limit)
