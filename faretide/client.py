"""The engine behind one object, for code that works with a feature store client."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from faretide.operators import registry, scoring, store
from faretide.operators.lookups import FeatureLookup, TrainingSet, training_set


class FeatureClient:
    """Feature tables of the session's catalog and models under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def create_table(
        self,
        name: str,
        primary_keys: Sequence[str],
        df: DataFrame,
        partition_columns: str | None = None,
        description: str = "",
    ) -> store.WriteReport | None:
        return store.create_feature_table(df, name, primary_keys, partition_columns, description)

    def write_table(self, name: str, df: DataFrame, mode: str = "merge", **options: str):
        return store.write_features(df, name, mode, **options)

    def read_table(self, name: str) -> DataFrame:
        return store.read_features(self.spark, name)

    def create_training_set(
        self,
        df: DataFrame,
        feature_lookups: Sequence[FeatureLookup],
        label: str,
        exclude_columns: Sequence[str] = (),
    ) -> TrainingSet:
        return training_set(df, feature_lookups, label, exclude_columns)

    def log_model(
        self, model: PipelineModel, training_set: TrainingSet, registered_model_name: str
    ) -> int:
        return registry.publish_model(model, training_set, self.root, registered_model_name)

    def latest_version(self, name: str) -> int:
        return registry.latest_version(self.spark, self.root, name)

    def score_batch(self, model_uri: str, df: DataFrame) -> DataFrame:
        """Predict with ``models:/<name>`` or ``models:/<name>/<version>``."""
        scheme, _, address = model_uri.partition(":/")
        if scheme != "models" or not address:
            raise ValueError(f"not a model address: {model_uri}")
        name, _, version = address.partition("/")
        return scoring.predict_batch(df, self.root, name, version)
