"""Time expressions, built only from native Spark functions.

Every function takes a DataFrame and a column name, because the right
expression depends on the column's type:

* ``timestamp_ntz`` and ``string`` hold UTC wall-clock times,
* ``timestamp`` holds instants.

None of the expressions reads the session time zone, so a job gives the same
features in any session. NULL times give NULL.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEW_YORK = "America/New_York"

# Seconds are counted from year 1 so that the truncating cast rounds down for
# times before 1970 as well; then the count is moved to the Unix epoch.
_YEAR_ONE = "timestamp_ntz'0001-01-01 00:00:00'"
_YEAR_ONE_TO_EPOCH = 62_135_596_800


def _type_of(df: DataFrame, name: str) -> T.DataType:
    """The type of a column or, as in ``window.end``, of a field of one."""
    kind: T.DataType = df.schema
    for part in name.split("."):
        kind = kind[part].dataType
    return kind


def is_instant(df: DataFrame, name: str) -> bool:
    return isinstance(_type_of(df, name), T.TimestampType)


def as_time(df: DataFrame, name: str) -> Column:
    """The column itself, or its parsed value when it is text."""
    if isinstance(_type_of(df, name), T.StringType):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name)


def moment_of(value: datetime | date | str) -> datetime:
    """The value as a naive UTC datetime."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def time_literal(df: DataFrame, name: str, value: datetime | date | str | Column) -> Column:
    """``value`` as a literal of the column's own type.

    Comparing a raw column with a literal of its type is what lets the
    comparison reach the file scan. Naive datetimes are UTC.
    """
    if isinstance(value, Column):
        return value
    text = moment_of(value).isoformat(sep=" ")
    if is_instant(df, name):
        return F.lit(f"{text}Z").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def _whole_seconds(wall_clock: Column) -> Column:
    since_year_one = (wall_clock - F.expr(_YEAR_ONE)).cast("interval second")
    return since_year_one.cast("bigint") - F.lit(_YEAR_ONE_TO_EPOCH)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since 1970 in UTC, rounded down, as bigint."""
    if is_instant(df, name):
        return F.unix_seconds(F.col(name))
    return _whole_seconds(as_time(df, name))


def _epoch_seconds_up(df: DataFrame, name: str) -> Column:
    if is_instant(df, name):
        micros = F.unix_micros(F.col(name))
        return F.unix_seconds(F.col(name)) + (F.pmod(micros, F.lit(1_000_000)) > 0).cast("int")
    return _whole_seconds(as_time(df, name) + F.expr("interval '0.999999' second"))


def ceil_minutes(df: DataFrame, name: str, minutes: int = 15) -> Column:
    """The time rounded up to ``minutes``, as epoch seconds in an int.

    The grid restarts every hour, so 7 minutes means :00, :07, ... :56, and
    :63 (three past the next hour) for what follows. A time on the grid stays.
    """
    step = minutes * 60
    seconds = _epoch_seconds_up(df, name)
    if 3600 % step == 0:
        rounded = seconds + F.pmod(-seconds, F.lit(step))
    else:
        # The second before tells the hour of a time rounded up to the hour.
        floor = epoch_seconds(df, name)
        hour = floor - F.pmod(floor, F.lit(3600))
        offset = seconds - hour
        rounded = hour + offset + F.pmod(-offset, F.lit(step))
    return rounded.try_cast("int")


def month_id(df: DataFrame, name: str) -> Column:
    """The UTC month as ``yyyy-MM``."""
    if is_instant(df, name):
        days = F.floor(F.unix_seconds(F.col(name)) / 86_400).cast("int")
        day = F.date_add(F.lit("1970-01-01").cast("date"), days)
    else:
        day = as_time(df, name).cast("date")
    return F.substring(day.cast("string"), 1, 7)


def month_of_epoch(seconds: Column) -> Column:
    """``month_id`` of a time given as epoch seconds."""
    days = F.floor(seconds / 86_400).cast("int")
    return F.substring(F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string"), 1, 7)


def weekend_flag(df: DataFrame, name: str, zone: str = NEW_YORK) -> Column:
    """1 when the time falls on Saturday or Sunday in ``zone``, else 0."""
    if is_instant(df, name):
        seconds = F.unix_seconds(F.col(name)).cast("decimal(18,6)")
        wall_clock = F.expr("timestamp_ntz'1970-01-01'") + F.make_dt_interval(secs=seconds)
    else:
        wall_clock = as_time(df, name)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall_clock)
    return (F.weekday(local) >= 5).cast("int")


def parse_date(text: Column) -> Column:
    """A ``yyyy-MM-dd`` string as midnight UTC; other text is an error."""
    return F.to_date(text, "yyyy-M-d").cast("timestamp_ntz")
