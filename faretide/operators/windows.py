"""The two windowed feature tables, keyed by ``(zip, ts)``.

``ts`` is the end of the window in epoch seconds and ``yyyy_mm`` its month.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.functions.times import (
    NEW_YORK,
    as_time,
    epoch_seconds,
    moment_of,
    month_id,
    time_literal,
    weekend_flag,
)
from faretide.operators.rows import Bound, filter_by_time, given

PICKUP_WINDOW, PICKUP_SLIDE = "1 hour", "15 minutes"
DROPOFF_WINDOW = "30 minutes"
_LENGTHS = {PICKUP_WINDOW: timedelta(hours=1), DROPOFF_WINDOW: timedelta(minutes=30)}

# What becomes of windows that reach over an end of the time range:
#   partial  they are kept, computed from the trips inside the range;
#   whole    they are dropped;
#   owned    windows that end in (start, end] are kept and computed from all
#            their trips, so that adjacent ranges share no window.
Edges = Literal["partial", "whole", "owned"]


def _input_rows(
    df: DataFrame, ts_column: str, start: Bound, end: Bound, edges: Edges, length: str
) -> DataFrame:
    if edges == "owned" and given(start):
        length = _LENGTHS[length]
        start = start - F.lit(length) if isinstance(start, Column) else moment_of(start) - length
    return filter_by_time(df, ts_column, start, end)


def _output_windows(windows: DataFrame, start: Bound, end: Bound, edges: Edges) -> DataFrame:
    if edges not in ("partial", "whole", "owned"):
        raise ValueError(f"unknown edges: {edges}")
    if edges == "partial":
        return windows
    if given(start) and edges == "whole":
        low = time_literal(windows, "window.start", start)
        windows = windows.filter(F.col("window.start") >= low)
    elif given(start):
        low = time_literal(windows, "window.end", start)
        windows = windows.filter(F.col("window.end") > low)
    if given(end):
        high = time_literal(windows, "window.end", end)
        windows = windows.filter(F.col("window.end") <= high)
    return windows


def pickup_features(
    df: DataFrame,
    ts_column: str = "tpep_pickup_datetime",
    start: Bound = None,
    end: Bound = None,
    edges: Edges = "partial",
    panes: bool | None = None,
    with_sum: bool = False,
) -> DataFrame:
    """Mean fare and trip count per pickup zip, 1-hour windows every 15 minutes.

    A trip lies in four windows. With ``panes`` (the default for batch input)
    trips are first summed per zip and 15-minute pane, and only the panes are
    copied into their four windows: the raw rows meet one hash aggregate and
    no copy, and what is shuffled grows with zips and quarter hours, not with
    trips. Streams aggregate the windows directly, since the update output
    mode allows a single aggregate.

    ``with_sum`` adds ``sum_fare_window_1h_pickup_zip``, which
    ``exclude_self`` needs.
    """
    panes = not df.isStreaming if panes is None else panes
    df = _input_rows(df, ts_column, start, end, edges, PICKUP_WINDOW)
    rows = df.select(
        F.col("pickup_zip").alias("zip"),
        as_time(df, ts_column).alias("at"),
        F.col("fare_amount").cast("double").alias("fare"),
    )
    if panes:
        rows = (
            rows.groupBy("zip", F.window("at", PICKUP_SLIDE).alias("pane"))
            .agg(
                F.sum("fare").alias("fares"),
                F.count("fare").alias("known_fares"),
                F.count(F.lit(1)).alias("trips"),
            )
            .select("zip", F.col("pane.start").alias("at"), "fares", "known_fares", "trips")
        )
        measures = [
            F.sum("fares").alias("fares"),
            F.sum("known_fares").alias("known_fares"),
            F.sum("trips").alias("trips"),
        ]
    else:
        measures = [
            F.sum("fare").alias("fares"),
            F.count("fare").alias("known_fares"),
            F.count(F.lit(1)).alias("trips"),
        ]
    windows = rows.groupBy("zip", F.window("at", PICKUP_WINDOW, PICKUP_SLIDE)).agg(*measures)
    windows = _output_windows(windows, start, end, edges)
    mean = F.when(F.col("known_fares") > 0, F.col("fares") / F.col("known_fares"))
    columns = [
        F.col("zip"),
        epoch_seconds(windows, "window.end").try_cast("int").alias("ts"),
        month_id(windows, "window.end").alias("yyyy_mm"),
        mean.cast("float").alias("mean_fare_window_1h_pickup_zip"),
        F.col("trips").cast("int").alias("count_trips_window_1h_pickup_zip"),
    ]
    if with_sum:
        columns.append(F.col("fares").alias("sum_fare_window_1h_pickup_zip"))
    return windows.select(*columns)


def dropoff_features(
    df: DataFrame,
    ts_column: str = "tpep_dropoff_datetime",
    start: Bound = None,
    end: Bound = None,
    edges: Edges = "partial",
    zone: str = NEW_YORK,
) -> DataFrame:
    """Trip count per dropoff zip and half hour, and whether it ends on a weekend."""
    df = _input_rows(df, ts_column, start, end, edges, DROPOFF_WINDOW)
    rows = df.select(F.col("dropoff_zip").alias("zip"), as_time(df, ts_column).alias("at"))
    windows = rows.groupBy("zip", F.window("at", DROPOFF_WINDOW)).agg(
        F.count(F.lit(1)).alias("trips")
    )
    windows = _output_windows(windows, start, end, edges)
    return windows.select(
        "zip",
        epoch_seconds(windows, "window.end").try_cast("int").alias("ts"),
        month_id(windows, "window.end").alias("yyyy_mm"),
        F.col("trips").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        weekend_flag(windows, "window.end", zone).alias("dropoff_is_weekend"),
    )
