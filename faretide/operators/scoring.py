"""Batch scoring, its output table and the record of a run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide.operators.lookups import DROPOFF_NAMES, PICKUP_NAMES, apply_lookups
from faretide.operators.models import predict
from faretide.operators.registry import PublishedModel, load_model

#: The published columns and their order.
SCORE_INPUT = (
    "fare_amount",
    "trip_distance",
    "pickup_zip",
    "dropoff_zip",
    "rounded_pickup_datetime",
    "rounded_dropoff_datetime",
)
SCORE_OUTPUT = (*SCORE_INPUT, *PICKUP_NAMES, *DROPOFF_NAMES)


def shape_predictions(df: DataFrame, prediction: str | Column = "prediction") -> DataFrame:
    """The published columns, with the prediction first and in cents."""
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    return df.select(F.round(value, 2).alias("predicted_fare_amount"), *SCORE_OUTPUT)


def predict_with(df: DataFrame, published: PublishedModel) -> DataFrame:
    """``df`` with a published model's features and its ``prediction``.

    Features come from the tables that the model was published with.
    """
    return predict(published.model, apply_lookups(df, published.lookups))


def predict_batch(
    df: DataFrame, root: str, name: str = "fares", version: int | str | None = None
) -> DataFrame:
    """``predict_with`` the model of that name and version, the latest if none is given."""
    return predict_with(df, load_model(df.sparkSession, root, name, version))


def score_with(trips: DataFrame, published: PublishedModel) -> DataFrame:
    """The predicted fares of rounded trips, in the published columns."""
    return shape_predictions(predict_with(trips.select(*SCORE_INPUT), published))


def score_batch(
    trips: DataFrame, root: str, name: str = "fares", version: int | str | None = None
) -> DataFrame:
    """``score_with`` the model of that name and version, the latest if none is given."""
    return score_with(trips, load_model(trips.sparkSession, root, name, version))


def write_predictions(
    predictions: DataFrame, path: str, run_id: str | None = None, fmt: str = "csv"
) -> None:
    """Write predictions with a header, one folder per run if ``run_id`` is given.

    Writing a run again replaces that run only.
    """
    if run_id is not None:
        predictions = predictions.withColumn("run_id", F.lit(run_id))
    writer = predictions.write.format(fmt).mode("overwrite").option("header", True)
    if run_id is not None:
        writer = writer.partitionBy("run_id").option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def log_run_metrics(
    spark: SparkSession, path: str, run_id: str, metrics: Mapping[str, object]
) -> None:
    """Append a run's parameters and metrics as (run_id, key, value, ts) rows."""
    rows = [(run_id, key, str(value)) for key, value in metrics.items()]
    table = spark.createDataFrame(rows, "run_id string, key string, value string")
    table = table.withColumn("ts", F.current_timestamp()).coalesce(1)
    # A folder of its own: writers of one folder remove each other's unfinished files.
    table.write.parquet(f"{path}/{uuid.uuid4().hex}")


def read_run_metrics(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    metrics = spark.read.schema("run_id string, key string, value string, ts timestamp")
    metrics = metrics.option("recursiveFileLookup", True).parquet(path)
    return metrics if run_id is None else metrics.filter(F.col("run_id") == run_id)
