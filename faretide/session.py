"""Session defaults and the shared folder for data that outlives one plan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window state of a long stream does not fit the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "faretide", **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` (dots as ``__``) wins."""
    builder = SparkSession.builder.appName(app_name)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, a folder of the warehouse.

    Both are shared by the driver and all executors, which folders for temporary files are not.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/faretide/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, with a writer's options, and read it back.

    Several actions can then share one computation, and losing an executor
    costs a re-read of files instead of a recomputation from the raw rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str = "numbered") -> tuple[DataFrame, str]:
    """``df``, written once with a unique number for each row, and that column's name."""
    taken, name = {c.lower() for c in df.columns}, "__row"
    while name in taken:
        name += "_"
    return stage(df.withColumn(name, F.monotonically_increasing_id()), label), name
