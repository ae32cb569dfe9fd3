"""Queries over the run logs: recent rows, stage durations, correlation.

The log is one table whose ``kind`` tells traces, exceptions and dependencies
apart; ``combine_logs`` makes it from three.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.functions.dimensions import dimension
from faretide.functions.times import is_instant, time_literal

TRACE, EXCEPTION, DEPENDENCY = "trace", "exception", "dependency"
KINDS = (TRACE, EXCEPTION, DEPENDENCY)


def combine_logs(traces: DataFrame, exceptions: DataFrame, dependencies: DataFrame) -> DataFrame:
    tables = zip(KINDS, (traces, exceptions, dependencies), strict=True)
    tagged = [table.withColumn("kind", F.lit(kind)) for kind, table in tables]
    return (
        tagged[0]
        .unionByName(tagged[1], allowMissingColumns=True)
        .unionByName(tagged[2], allowMissingColumns=True)
    )


def extend_dimensions(logs: DataFrame, column: str, **names: str) -> DataFrame:
    """Add dimensions as columns, ``new_name="dimension key"``."""
    return logs.withColumns(
        {new: dimension(logs, column, key) for new, key in names.items()}
    )


def _clock(logs: DataFrame) -> Column:
    """The current time as the column's type; wall-clock columns are UTC in any session."""
    if is_instant(logs, "ts"):
        return F.current_timestamp()
    seconds = (F.unix_micros(F.current_timestamp()) / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("timestamp_ntz'1970-01-01'") + F.make_dt_interval(zero, zero, zero, seconds)


def _recent(logs: DataFrame, now: datetime | str | Column | None, window: str | None) -> DataFrame:
    if window is None:
        return logs
    moment = _clock(logs) if now is None else time_literal(logs, "ts", now)
    return logs.filter(F.col("ts") > moment - F.expr(f"INTERVAL {window}"))


def _newest(logs: DataFrame, limit: int | None) -> DataFrame:
    """A row limit with a fixed choice of rows, unlike a bare limit; None for all rows."""
    if limit is None:
        return logs
    return logs.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(limit)


def recent_logs(
    logs: DataFrame,
    kind: str | None = TRACE,
    experiment_id: str | None = None,
    run_id: object = None,
    now: datetime | str | Column | None = None,
    window: str | None = "30 minutes",
    limit: int | None = 1000,
) -> DataFrame:
    """The newest rows of one kind, optionally of one experiment and run.

    ``now`` may be a scalar subquery; it defaults to the current time. No ``window`` or
    ``limit`` (None) takes rows of any age, or all of them.
    """
    rows = _recent(logs, now, window)
    if kind is not None:
        rows = rows.filter(F.col("kind") == kind)
    if experiment_id is not None:
        rows = rows.filter(F.col("experiment_id") == experiment_id)
    if run_id is not None:
        rows = rows.filter(F.col("run_id") == run_id)
    return _newest(rows, limit)


def recent_exceptions(logs: DataFrame, **options: object) -> DataFrame:
    return recent_logs(logs, kind=EXCEPTION, **options)


def stage_durations(
    logs: DataFrame,
    role: str,
    now: datetime | str | Column | None = None,
    window: str | None = "30 minutes",
    limit: int | None = 1000,
) -> DataFrame:
    """The newest dependency rows of one role, which hold its stages' durations."""
    return recent_logs(
        logs.filter(F.col("role") == role), DEPENDENCY, now=now, window=window, limit=limit
    )


def operation_logs(
    logs: DataFrame,
    operation_id: object,
    now: datetime | str | Column | None = None,
    window: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The rows of every kind that belong to one operation, all of them unless bounded."""
    rows = logs.filter(F.col("operation_id") == operation_id)
    return recent_logs(rows, None, now=now, window=window, limit=limit)


def correlate_logs(logs: DataFrame) -> DataFrame:
    """One row per operation that has traces, exceptions and dependencies.

    Joining the three kinds row by row would give traces x exceptions x
    dependencies rows per operation. Each kind is summed up instead, all in
    one aggregate whose partial sums take the size out of a hot operation.
    """

    def of(kind: str, value: Column | int = 1) -> Column:
        return F.when(F.col("kind") == kind, value)

    # Rows that belong to no operation are not one.
    totals = logs.filter(F.col("operation_id").isNotNull()).groupBy("operation_id").agg(
        F.count(of(TRACE)).alias("traces"),
        F.count(of(EXCEPTION)).alias("exceptions"),
        F.count(of(DEPENDENCY)).alias("dependencies"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.min(of(EXCEPTION, F.col("ts"))).alias("first_exception_ts"),
        F.sum(of(DEPENDENCY, F.col("duration"))).alias("dependency_duration"),
    )
    return totals.filter("traces > 0 AND exceptions > 0 AND dependencies > 0")


def correlated_rows(logs: DataFrame, salts: int = 8) -> DataFrame:
    """The log rows of the operations that ``correlate_logs`` reports.

    A semi join: rows are kept or not, never paired. A hot operation's rows
    are spread by a salt, and its one row on the right is repeated for each.
    The salt also makes the join shuffle its right side anew; on the
    aggregate's own partitioning, skewed partitions could not be split.
    """
    repeated = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    operations = correlate_logs(logs).select("operation_id", repeated.alias("_salt"))
    salted = logs.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int"))
    return salted.join(operations, ["operation_id", "_salt"], "left_semi").select(*logs.columns)
