"""Row operators on trips: time filter, preparation, subsample, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.functions.times import as_time, ceil_minutes, time_literal

Bound = datetime | date | str | Column | None


def given(bound: Bound) -> bool:
    """Whether a bound was given: a column has no truth value to ask for."""
    return isinstance(bound, Column) or bool(bound)


def filter_by_time(
    df: DataFrame, ts_column: str | None, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Rows with ``start <= ts_column < end``; an empty argument drops its bound."""
    if not ts_column:
        return df
    if given(start):
        df = df.filter(as_time(df, ts_column) >= time_literal(df, ts_column, start))
    if given(end):
        df = df.filter(as_time(df, ts_column) < time_literal(df, ts_column, end))
    return df


def prepare_trips(
    df: DataFrame, rename: Mapping[str, str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Rename columns and drop the others.

    ``keep`` names further columns to carry over unchanged. Selecting here
    keeps dropped columns out of the file scan.
    """
    kept = [F.col(name) for name in keep or ()]
    return df.select(*[F.col(old).alias(new) for old, new in rename.items()], *kept)


def hash_percent(keys: Sequence[str]) -> Column:
    """A number in 0..99 fixed by the keys' values alone.

    It does not depend on row order, partitioning or task retries, which
    ``rand`` based sampling does.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def subsample(
    df: DataFrame,
    ts_column: str,
    start: Bound,
    end: Bound,
    percent: int,
    keys: Sequence[str],
) -> DataFrame:
    """About ``percent`` of the rows of a time range, chosen by key hash."""
    return filter_by_time(df, ts_column, start, end).filter(hash_percent(keys) < percent)


def rounded_trips(
    df: DataFrame,
    pickup_column: str = "tpep_pickup_datetime",
    dropoff_column: str = "tpep_dropoff_datetime",
    view: str | None = None,
) -> DataFrame:
    """Replace both trip times by the ends of the windows they look up.

    Pickup is rounded up to 15 minutes and dropoff to 30. ``view`` also
    registers the result as a temporary view.
    """
    out = df.withColumns(
        {
            "rounded_pickup_datetime": ceil_minutes(df, pickup_column, 15),
            "rounded_dropoff_datetime": ceil_minutes(df, dropoff_column, 30),
        }
    ).drop(pickup_column, dropoff_column)
    if view:
        out.createOrReplaceTempView(view)
    return out
