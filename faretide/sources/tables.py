"""Readers of raw tables. Schemas are declared or stored, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faretide.schemas import LOGS, TRAINING, TRIPS, validate


def _read(
    spark: SparkSession, path: str | None, table: str | None, fmt: str
) -> DataFrame:
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    return spark.read.table(table) if table else spark.read.format(fmt).load(path)


def read_trips(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Raw trips from files or a catalog table.

    ``fmt="delta"`` needs that format's package on the cluster.
    """
    return validate(_read(spark, path, table, fmt), TRIPS)


def stream_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRIPS,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Raw trips from files as they arrive in a folder."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def read_training_csv(
    spark: SparkSession, path: str, schema: T.StructType = TRAINING
) -> DataFrame:
    """A training table with a header line, whose names are checked."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST")


def read_logs(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The log table (see ``operators.logs``)."""
    return validate(_read(spark, path, table, fmt), LOGS)
