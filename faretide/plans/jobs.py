"""The three jobs: features, training and batch scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from faretide.operators.lookups import (
    DROPOFF_TABLE,
    PICKUP_TABLE,
    TrainingSet,
    fare_lookups,
    training_set,
)
from faretide.operators.models import (
    DEFAULT_ROUNDS,
    LABEL,
    predict,
    regression_metrics,
    split_by_hash,
    train_fare_model,
)
from faretide.operators.profile import (
    boxplot_dropoff,
    boxplot_pickup,
    describe_features,
    null_keys,
    shape_profile,
)
from faretide.operators.registry import load_model, publish_model
from faretide.operators.rows import rounded_trips
from faretide.operators.scoring import log_run_metrics, score_with, write_predictions
from faretide.operators.store import create_feature_table, merge_features, put_features
from faretide.operators.windows import Edges, dropoff_features, pickup_features
from faretide.session import stage


@dataclass
class FeatureRun:
    """Both feature tables of a run, stored once, and their profiles."""

    pickup: DataFrame
    dropoff: DataFrame
    shapes: DataFrame
    profiles: dict[str, DataFrame] = field(default_factory=dict)

    def recorded(self) -> dict[str, object]:
        """Rows and columns of each table, as run metrics."""
        found = {}
        for row in self.shapes.collect():
            found[f"{row['table_name']}_rows"] = row["row_count"]
            found[f"{row['table_name']}_columns"] = row["column_count"]
        return found


def feature_job(
    trips: DataFrame,
    start: datetime | str | None,
    end: datetime | str | None,
    explain: bool = True,
    edges: Edges = "partial",
    tables: tuple[str, str] | None = None,
) -> FeatureRun:
    """Compute both feature tables of a time range, store them and profile them.

    Each table is computed and written once, into the tables named (created or merged into) or
    else for this run alone, and profiles read the rows as they were written. Stored rows have
    both keys; the others are left out.
    """
    pickup = pickup_features(trips, start=start, end=end, edges=edges)
    dropoff = dropoff_features(trips, start=start, end=end, edges=edges)
    if tables:
        pickup = put_features(pickup, tables[0], "Pickup features")
        dropoff = put_features(dropoff, tables[1], "Dropoff features")
    else:
        pickup, dropoff = stage(pickup, "pickup"), stage(dropoff, "dropoff")
    shapes = (
        shape_profile(trips, "trips")
        .unionByName(shape_profile(pickup, "pickup_features"))
        .unionByName(shape_profile(dropoff, "dropoff_features"))
    )
    run = FeatureRun(pickup, dropoff, shapes)
    if explain:
        run.profiles = {
            "null_keys": null_keys(trips),
            "describe_pickup": describe_features(pickup),
            "describe_dropoff": describe_features(dropoff),
            "boxplot_pickup": boxplot_pickup(pickup),
            "boxplot_dropoff": boxplot_dropoff(dropoff),
        }
    return run


def store_features(
    run: FeatureRun, pickup_table: str = PICKUP_TABLE, dropoff_table: str = DROPOFF_TABLE
) -> None:
    """Create the tables if need be, else merge into them.

    Rows that were just used to fill a new table need no merge.
    """
    tables = (
        (run.pickup, pickup_table, "Pickup features"),
        (run.dropoff, dropoff_table, "Dropoff features"),
    )
    for features, table, description in tables:
        created = create_feature_table(
            features, table, description=description, check_unique=False, staged=True
        )
        if created is None:
            merge_features(features, table, check_unique=False, staged=True)


@dataclass
class TrainingRun:
    model: PipelineModel
    training_set: TrainingSet
    metrics: dict[str, float]
    version: int | None = None
    features: FeatureRun | None = None


def fit_and_evaluate(
    described: TrainingSet,
    params: Mapping[str, object] | None = None,
    num_rounds: int = DEFAULT_ROUNDS,
    key_columns: Sequence[str] | None = None,
) -> TrainingRun:
    """Split a training set, fit a model and measure it on the test rows.

    ``key_columns`` identify a row for the split; they are no features.
    """
    rows = stage(described.load_df(), "training")
    train, test = split_by_hash(rows, key_columns)
    features = [name for name in rows.columns if name not in (key_columns or ())]
    model = train_fare_model(
        train.select(*features), params, num_rounds, label=described.label
    )
    scored = predict(model, test.select(*features))
    measured = regression_metrics(scored, label=described.label).first()
    metrics = {
        "mse": measured["mse"],
        "rmse": measured["rmse"],
        "training_data_rows": rows.count(),
        "training_data_columns": len(rows.columns),
    }
    return TrainingRun(model, described, metrics)


def train_job(
    trips: DataFrame,
    start: datetime | str | None,
    end: datetime | str | None,
    registry: str,
    name: str = "fares",
    params: Mapping[str, object] | None = None,
    num_rounds: int = DEFAULT_ROUNDS,
    key_columns: Sequence[str] | None = None,
    pickup_table: str = PICKUP_TABLE,
    dropoff_table: str = DROPOFF_TABLE,
    refresh_features: bool = True,
    run_id: str | None = None,
    explain: bool = True,
) -> TrainingRun:
    """Refresh the features of the range, train on all trips and publish.

    Trips outside the range are trained on with NULL features, as the left
    lookups leave them.
    """
    features = None
    if refresh_features:
        features = feature_job(trips, start, end, explain, tables=(pickup_table, dropoff_table))
    described = training_set(rounded_trips(trips), fare_lookups(pickup_table, dropoff_table), LABEL)
    run = fit_and_evaluate(described, params, num_rounds, key_columns)
    run.version = publish_model(run.model, described, registry, name)
    run.features = features
    if run_id is not None:
        shapes = features.recorded() if features else {}
        recorded = shapes | run.metrics | {"model_name": name, "model_version": run.version}
        log_run_metrics(trips.sparkSession, f"{registry}/run_metrics", run_id, recorded)
    return run


def score_job(
    trips: DataFrame,
    start: datetime | str | None,
    end: datetime | str | None,
    registry: str,
    output: str | None = None,
    name: str = "fares",
    version: int | str | None = None,
    pickup_table: str = PICKUP_TABLE,
    dropoff_table: str = DROPOFF_TABLE,
    refresh_features: bool = True,
    run_id: str | None = None,
    explain: bool = True,
) -> DataFrame:
    """Refresh the features of the range and score all trips.

    With ``output`` the predictions are written there, under the run's id,
    by one distributed write.
    """
    features = None
    if refresh_features:
        features = feature_job(trips, start, end, explain, tables=(pickup_table, dropoff_table))
    published = load_model(trips.sparkSession, registry, name, version)
    predictions = score_with(rounded_trips(trips), published)
    if output is not None:
        write_predictions(predictions, output, run_id)
    if run_id is not None:
        spark = trips.sparkSession
        shapes = features.recorded() if features else {}
        recorded = shapes | {"scored_model_name": name, "scored_model_version": published.version}
        log_run_metrics(spark, f"{registry}/run_metrics", run_id, recorded)
    return predictions
