"""Declared table schemas and the check made where tables enter the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(columns: str) -> T.StructType:
    """``"name type, ..."`` as a schema; unlike Spark's parser, without a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TRIPS = schema_of(
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "trip_distance double, fare_amount double, pickup_zip int, dropoff_zip int"
)
PICKUP_FEATURES = schema_of(
    "zip int, ts int, yyyy_mm string, "
    "mean_fare_window_1h_pickup_zip float, count_trips_window_1h_pickup_zip int"
)
DROPOFF_FEATURES = schema_of(
    "zip int, ts int, yyyy_mm string, "
    "count_trips_window_30m_dropoff_zip int, dropoff_is_weekend int"
)
TRAINING = schema_of(
    "trip_distance double, pickup_zip int, dropoff_zip int, "
    "mean_fare_window_1h_pickup_zip double, count_trips_window_1h_pickup_zip int, "
    "count_trips_window_30m_dropoff_zip int, dropoff_is_weekend int, fare_amount double"
)
LOGS = schema_of(
    "event_id bigint, ts timestamp_ntz, operation_id bigint, kind string, role string, "
    "experiment_id string, run_id bigint, duration double"
)

_FAMILIES = (
    (T.IntegralType, T.FractionalType),
    (T.TimestampType, T.TimestampNTZType, T.StringType),
)


def _compatible(actual: T.DataType, declared: T.DataType) -> bool:
    if actual == declared:
        return True
    return any(
        isinstance(actual, family) and isinstance(declared, family) for family in _FAMILIES
    )


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` if it has every declared column with a compatible type.

    Numbers are interchangeable, and so are timestamps and timestamp strings;
    extra columns are allowed. Only the schema is looked at: no job runs.
    """
    actual = {field.name: field.dataType for field in df.schema}
    problems = []
    for field in schema:
        if field.name not in actual:
            problems.append(f"{field.name} is missing")
        elif not _compatible(actual[field.name], field.dataType):
            problems.append(
                f"{field.name} is {actual[field.name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    if problems:
        raise ValueError("; ".join(problems))
    return df
