"""Published models: numbered Spark ML pipelines with their lookups.

A version number is claimed by a file that only one writer can create, so jobs
that publish at once get numbers of their own. It counts once its row is in the
``versions`` table, which is written after the model itself: a lost publish
leaves nothing that loads, and its number is not used again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretide.operators.lookups import FeatureLookup, TrainingSet
from faretide.operators.snapshots import children, write_once

_VERSIONS = (
    "model string, version int, path string, lookups string, label string, published_at timestamp"
)


@dataclass(frozen=True)
class PublishedModel:
    name: str
    version: int
    model: PipelineModel
    lookups: tuple[FeatureLookup, ...]
    label: str


def _versions(spark: SparkSession, root: str) -> DataFrame:
    """The versions table, which has no files before the first publish."""
    try:
        reader = spark.read.schema(_VERSIONS).option("recursiveFileLookup", True)
        return reader.parquet(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSIONS)


def latest_version(spark: SparkSession, root: str, name: str) -> int:
    """The highest version number; 1 when there is none."""
    newest = F.coalesce(F.max("version"), F.lit(1)).alias("newest")
    return _versions(spark, root).filter(F.col("model") == name).agg(newest).first()["newest"]


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next version number of a model, which no other caller gets."""
    known = _versions(spark, root).filter(F.col("model") == name)
    newest = known.agg(F.max("version").alias("newest")).first()["newest"] or 0
    claims = f"{root}/claims/{name}"
    taken = [int(claim) for claim, _ in children(spark, claims) if claim.isdigit()]
    number = max([newest, *taken]) + 1
    while not write_once(spark, claims, f"{number:09d}", ""):
        number += 1
    return number


def publish_model(
    model: PipelineModel, training_set: TrainingSet, root: str, name: str = "fares"
) -> int:
    """Store a model with its training set's lookups as the next version."""
    if model is None or training_set is None or not name:
        raise ValueError("a model, its training set and a name are needed")
    spark = training_set.trips.sparkSession
    version = claim_version(spark, root, name)
    path = f"{root}/models/{name}/version={version}/{uuid.uuid4().hex}"
    model.write().save(path)
    lookups = json.dumps([asdict(lookup) for lookup in training_set.lookups])
    row = spark.createDataFrame(
        [(name, version, path, lookups, training_set.label)],
        "model string, version int, path string, lookups string, label string",
    ).withColumn("published_at", F.current_timestamp())
    # A folder of its own: writers of one folder remove each other's unfinished files.
    row.coalesce(1).write.parquet(f"{root}/versions/{uuid.uuid4().hex}")
    return version


def load_model(
    spark: SparkSession, root: str, name: str, version: int | str | None = None
) -> PublishedModel:
    """A published model; an empty version means the latest."""
    number = latest_version(spark, root, name) if version in (None, "") else int(version)
    found = _versions(spark, root).filter((F.col("model") == name) & (F.col("version") == number))
    row = found.first()
    if row is None:
        raise LookupError(f"model {name} has no version {number}")
    lookups: Sequence[dict] = json.loads(row["lookups"])
    return PublishedModel(
        name,
        number,
        PipelineModel.load(row["path"]),
        tuple(FeatureLookup(**lookup) for lookup in lookups),
        row["label"],
    )
