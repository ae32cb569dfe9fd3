"""Every operator as a query over the driver's tables, with its SQL oracle.

``trips`` and ``log`` are views over ``events`` (see ``faretide.sources.events``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions.dimensions import dimension_map, merge_dimensions
from faretide.functions.times import ceil_minutes, month_id, parse_date, weekend_flag
from faretide.operators import day_logs
from faretide.operators import logs as log_queries
from faretide.operators.lookups import (
    DROPOFF_KEY,
    DROPOFF_NAMES,
    PICKUP_KEY,
    PICKUP_NAMES,
    exclude_self,
    fare_lookups,
    lookup_features,
    training_set,
)
from faretide.operators.models import predict, regression_metrics, split_by_hash, train_fare_model
from faretide.operators.profile import (
    DROPOFF_PLOT,
    PICKUP_PLOT,
    boxplot_dropoff,
    boxplot_pickup,
    describe_features,
    null_keys,
    rides_by_weekend,
)
from faretide.operators.registry import publish_model
from faretide.operators.rows import filter_by_time, prepare_trips, rounded_trips, subsample
from faretide.operators.scoring import (
    log_run_metrics,
    read_run_metrics,
    score_batch,
    shape_predictions,
    write_predictions,
)
from faretide.operators.store import (
    bucket_features,
    compact_features,
    create_database,
    create_feature_table,
    merge_features,
    overwrite_features,
    put_features,
    read_features,
    write_features,
)
from faretide.operators.summaries import refresh_summaries, stored_boxplot, stored_statistics
from faretide.operators.windows import dropoff_features, pickup_features
from faretide.plans.jobs import feature_job, score_job, train_job
from faretide.schemas import DROPOFF_FEATURES, LOGS, PICKUP_FEATURES
from faretide.session import fresh_path, stage
from faretide.sources.events import logs_from_events, read_events, trips_from_events
from faretide.sources.tables import read_logs, read_training_csv, read_trips, stream_trips
from faretide.streaming.features import stream_features
from faretide.streaming.panes import backfill_late, late_trips, stream_table

try:
    import corpus_pipeline
    from faretide.llm.queries import ORACLES as LLM_ORACLES
    from faretide.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as error:
    # Only if the text operators are not there; a library that they miss is an error.
    if error.name not in ("corpus_pipeline", "faretide.llm", "faretide.llm.queries"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {"pipeline": corpus_pipeline.run, **LLM_QUERIES}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = {"pipeline": corpus_pipeline.ORACLE_SQL, **LLM_ORACLES}

DATABASE = "faretide_queries"
LOGS_WITH_PROPS = T.StructType([*LOGS.fields, T.StructField("props", T.VariantType())])
START, END = "2024-01-05", "2024-01-20"
FIRST_HALF, SECOND_HALF = ("2024-01-01", "2024-01-16"), ("2024-01-15", "2024-02-01")


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_from_events(read_events(spark, folder))


def _logs(spark: SparkSession, folder: str) -> DataFrame:
    return logs_from_events(read_events(spark, folder))


def _latest(logs: DataFrame):
    """The newest log time as a scalar subquery, in place of the clock."""
    return logs.select(F.max("ts")).scalar()


def _new_table(spark: SparkSession, label: str) -> str:
    create_database(spark, DATABASE, fresh_path(spark, "database"))
    return f"{DATABASE}.{label}_{uuid.uuid4().hex}"


def _stored_pair(spark: SparkSession, folder: str, start=None, end=None) -> tuple[str, str]:
    """Both feature tables of a time range, in the store."""
    pickup, dropoff = _new_table(spark, "pickup"), _new_table(spark, "dropoff")
    feature_job(_trips(spark, folder), start, end, explain=False, tables=(pickup, dropoff))
    return pickup, dropoff


# --- rows and scalar functions ---------------------------------------------------------


def q_filter_by_time(spark, folder):
    return filter_by_time(_trips(spark, folder), "tpep_pickup_datetime", START, END)


def q_read_trips(spark, folder):
    path = fresh_path(spark, "trips")
    _trips(spark, folder).write.parquet(path)
    return read_trips(spark, path)


def q_read_trips_by_name(spark, folder):
    name = _new_table(spark, "trips")
    _trips(spark, folder).write.saveAsTable(name)
    return read_trips(spark, table=name)


def q_weekend_flag(spark, folder):
    trips = _trips(spark, folder)
    return trips.select("event_id", weekend_flag(trips, "tpep_dropoff_datetime").alias("flag"))


def q_month_id(spark, folder):
    trips = _trips(spark, folder)
    return trips.select("event_id", month_id(trips, "tpep_dropoff_datetime").alias("yyyy_mm"))


def q_ceil_minutes(spark, folder):
    trips = _trips(spark, folder)
    return trips.select(
        "event_id",
        *[
            ceil_minutes(trips, "tpep_pickup_datetime", n).alias(f"up_{n}")
            for n in (7, 15, 30, 120)
        ],
    )


def q_parse_dates(spark, folder):
    events = read_events(spark, folder)
    text = F.col("ts").cast("date").cast("string")
    return events.select("event_id", parse_date(text).alias("day"))


def q_rounded_trips(spark, folder):
    rounded_trips(_trips(spark, folder), view="rounded_trips")
    return spark.table("rounded_trips")


def q_prepare_trips(spark, folder):
    names = {"ts": "tpep_pickup_datetime", "value": "fare_amount", "user_id": "rider"}
    return prepare_trips(read_events(spark, folder), names, keep=["event_id"])


def q_subsample(spark, folder):
    trips = _trips(spark, folder)
    return subsample(trips, "tpep_pickup_datetime", START, END, 20, ["event_id"])


# --- feature tables --------------------------------------------------------------------


def q_pickup_features(spark, folder):
    return pickup_features(_trips(spark, folder))


def q_pickup_features_direct(spark, folder):
    return pickup_features(_trips(spark, folder), panes=False)


def q_pickup_features_range(spark, folder):
    return pickup_features(_trips(spark, folder), start=START, end=END)


def q_pickup_features_whole(spark, folder):
    return pickup_features(_trips(spark, folder), start=START, end=END, edges="whole")


def q_pickup_features_owned(spark, folder):
    return pickup_features(_trips(spark, folder), start=START, end=END, edges="owned")


def q_dropoff_features(spark, folder):
    return dropoff_features(_trips(spark, folder))


def q_dropoff_features_range(spark, folder):
    return dropoff_features(_trips(spark, folder), start=START, end=END)


def q_create_feature_table(spark, folder):
    table = _new_table(spark, "created")
    features = stage(dropoff_features(_trips(spark, folder)))
    for _ in range(2):
        create_feature_table(features, table, description="Dropoff features")
    return read_features(spark, table)


def q_read_features(spark, folder):
    pickup, _ = _stored_pair(spark, folder)
    return read_features(spark, pickup, "2024-01-10 06:00:00", END)


def _halves(spark, folder, write):
    table = _new_table(spark, "halves")
    first, second = (
        pickup_features(_trips(spark, folder), start=start, end=end)
        for start, end in (FIRST_HALF, SECOND_HALF)
    )
    create_feature_table(first, table)
    write(second, table)
    return read_features(spark, table)


def q_merge_features(spark, folder):
    return _halves(spark, folder, merge_features)


def q_overwrite_features(spark, folder):
    return _halves(spark, folder, overwrite_features)


#: Parts of the trips that arrive one after another, by time.
ARRIVALS = (None, "2024-01-08 06:10:00", "2024-01-16", "2024-01-24 17:50:00", None)


def _streamed(spark, folder, kind, schema):
    """Four starts of one stream, each after more trips came; state and progress are carried over."""
    table, source = _new_table(spark, f"stream_{kind}"), fresh_path(spark, "arrivals")
    create_feature_table(spark.createDataFrame([], schema), table)
    trips, at = _trips(spark, folder), f"tpep_{kind}_datetime"
    for start, end in zip(ARRIVALS, ARRIVALS[1:], strict=False):
        arrived = filter_by_time(trips, at, start, end).drop("event_id")
        arrived.write.mode("append").parquet(source)
        query = write_features(stream_features(stream_trips(spark, source), kind), table, "merge")
        query.awaitTermination()
    return read_features(spark, table)


def q_stream_pickup(spark, folder):
    return _streamed(spark, folder, "pickup", PICKUP_FEATURES)


def q_stream_dropoff(spark, folder):
    return _streamed(spark, folder, "dropoff", DROPOFF_FEATURES)


#: Of each quarter's trips, those that come two quarters later than their time.
DELAYED = "event_id % 11 = 0"


def _with_late(spark, folder, kind, schema, delay="1 hour"):
    """Four batches by time, of which the third and fourth hold trips of earlier ones."""
    table, source = _new_table(spark, f"late_{kind}"), fresh_path(spark, "arrivals")
    create_feature_table(spark.createDataFrame([], schema), table)
    trips, at = _trips(spark, folder), F.col(f"tpep_{kind}_datetime")
    quarter = sum((at >= F.lit(bound).cast("timestamp_ntz")).cast("int") for bound in ARRIVALS[1:-1])
    arrival = F.least(quarter + F.when(F.expr(DELAYED), 2).otherwise(0), F.lit(3))
    arriving = stage(trips.withColumn("arrival", arrival), "arriving")
    for number in range(4):
        part = arriving.where(F.col("arrival") == number).drop("arrival")
        part.write.mode("append").parquet(source)
        stream = stream_trips(spark, source, trips.schema)
        stream_table(stream, table, kind, delay=delay).awaitTermination()
    return table


def q_stream_late(spark, folder):
    return read_features(spark, _with_late(spark, folder, "pickup", PICKUP_FEATURES))


def q_stream_late_trips(spark, folder):
    table = _with_late(spark, folder, "dropoff", DROPOFF_FEATURES)
    return late_trips(spark, table).select("event_id", "batch", "folded")


def q_stream_backfilled(spark, folder):
    table = _with_late(spark, folder, "dropoff", DROPOFF_FEATURES)
    backfill_late(spark, table, "dropoff")
    compact_features(spark, table)
    return read_features(spark, table)


# --- lookups ---------------------------------------------------------------------------


def _nullable(df: DataFrame) -> DataFrame:
    """Looked-up ints as doubles: pandas has no plain int column with NULLs."""
    counts = (PICKUP_NAMES[1], *DROPOFF_NAMES)
    return df.withColumns({c: F.col(c).cast("double") for c in counts if c in df.columns})


def q_pickup_lookup(spark, folder):
    trips = _trips(spark, folder)
    features = pickup_features(trips, start=START, end=END)
    return _nullable(
        lookup_features(rounded_trips(trips), features, PICKUP_KEY, PICKUP_NAMES)
    )


def q_dropoff_lookup(spark, folder):
    trips = _trips(spark, folder)
    features = dropoff_features(trips, start=START, end=END)
    return _nullable(
        lookup_features(rounded_trips(trips), features, DROPOFF_KEY, DROPOFF_NAMES)
    )


def _training(spark, folder) -> DataFrame:
    lookups = fare_lookups(*_stored_pair(spark, folder, START, END))
    return training_set(rounded_trips(_trips(spark, folder)), lookups).load_df()


def q_training_set(spark, folder):
    return _nullable(_training(spark, folder))


def q_bucketed_training_set(spark, folder):
    """The training set by lookups in bucketed copies, as of tables too large to broadcast."""
    tables = _stored_pair(spark, folder, START, END)
    for table in tables:
        bucket_features(spark, table)
    rounded = rounded_trips(_trips(spark, folder))
    return _nullable(training_set(rounded, fare_lookups(*tables), max_broadcast_bytes=0).load_df())


def q_training_csv(spark, folder):
    training, path = _training(spark, folder), fresh_path(spark, "csv")
    training.write.option("header", True).csv(path)
    return _nullable(read_training_csv(spark, path, training.schema))


def q_exclude_self(spark, folder):
    trips = _trips(spark, folder)
    features = pickup_features(trips, start=START, end=END, with_sum=True)
    names = (*PICKUP_NAMES, "sum_fare_window_1h_pickup_zip")
    at = "tpep_pickup_datetime"
    timed = trips.withColumn("rounded_pickup_datetime", ceil_minutes(trips, at, 15))
    joined = lookup_features(timed, features, PICKUP_KEY, names)
    others = exclude_self(joined, at, START, END)
    return _nullable(others.select("event_id", "fare_amount", *PICKUP_NAMES))


# --- profiles --------------------------------------------------------------------------


def _rounded_numbers(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Doubles as they agree between engines that add up in another order."""
    return df.withColumns({name: F.round(name, digits) for name in names})


def _significant(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    """Doubles of any size to so many digits, as text."""
    text = lambda name: F.format_string(f"%.{digits - 1}e", name)
    return df.withColumns({name: F.when(F.col(name).isNotNull(), text(name)) for name in names})


def q_rides_by_weekend(spark, folder):
    return rides_by_weekend(dropoff_features(_trips(spark, folder)))


def q_shape_profile(spark, folder):
    return feature_job(_trips(spark, folder), START, END, explain=False).shapes


def q_null_keys(spark, folder):
    return null_keys(_trips(spark, folder))


def q_describe_pickup(spark, folder):
    described = describe_features(pickup_features(_trips(spark, folder)))
    return _significant(described, "mean", "stddev", "min_value", "max_value")


def q_describe_dropoff(spark, folder):
    described = describe_features(dropoff_features(_trips(spark, folder)))
    return _significant(described, "mean", "stddev", "min_value", "max_value")


def q_boxplot_pickup(spark, folder):
    boxes = boxplot_pickup(pickup_features(_trips(spark, folder)))
    return _rounded_numbers(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def q_boxplot_dropoff(spark, folder):
    boxes = boxplot_dropoff(dropoff_features(_trips(spark, folder)))
    return _rounded_numbers(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def _summarised(spark, folder, plot):
    """Features of the first half, summarised, then merged with the second and summarised again."""
    table = _new_table(spark, "summarised")
    write = pickup_features if plot is PICKUP_PLOT else dropoff_features
    for start, end in (FIRST_HALF, SECOND_HALF):
        put_features(write(_trips(spark, folder), start=start, end=end), table)
        refresh_summaries(spark, table, [plot])
    return table


def q_describe_merged(spark, folder):
    described = stored_statistics(spark, _summarised(spark, folder, PICKUP_PLOT))
    return _significant(described, "mean", "stddev", "min_value", "max_value")


def q_boxplot_merged(spark, folder):
    boxes = stored_boxplot(spark, _summarised(spark, folder, DROPOFF_PLOT), DROPOFF_PLOT)
    return _rounded_numbers(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


# --- logs ------------------------------------------------------------------------------


def q_read_logs(spark, folder):
    path = fresh_path(spark, "logs")
    _logs(spark, folder).write.parquet(path)
    return read_logs(spark, path)


def q_recent_logs(spark, folder):
    logs = _logs(spark, folder)
    return log_queries.recent_logs(
        logs, experiment_id="42", now=_latest(logs), window="20 DAYS"
    )


def q_recent_logs_run(spark, folder):
    logs = _logs(spark, folder)
    return log_queries.recent_logs(
        logs, experiment_id="42", run_id=3, now=_latest(logs), window="20 DAYS"
    )


def q_recent_exceptions(spark, folder):
    logs = _logs(spark, folder)
    return log_queries.recent_exceptions(logs, now=_latest(logs), window="3 DAYS")


def q_stage_durations(spark, folder):
    logs = _logs(spark, folder)
    return log_queries.stage_durations(logs, "purchase", now=_latest(logs), window="3 DAYS")


def q_operation_logs(spark, folder):
    logs = _logs(spark, folder)
    return log_queries.operation_logs(logs, 7, now=_latest(logs), window="20 DAYS")


def q_correlate_logs(spark, folder):
    logs = _logs(spark, folder)
    return _rounded_numbers(log_queries.correlate_logs(logs), "dependency_duration")


def q_correlate_three_logs(spark, folder):
    logs = _logs(spark, folder)
    kinds = [logs.filter(F.col("kind") == kind).drop("kind") for kind in log_queries.KINDS]
    correlated = log_queries.correlate_logs(log_queries.combine_logs(*kinds))
    return _rounded_numbers(correlated, "dependency_duration")


def q_correlated_rows(spark, folder):
    return log_queries.correlated_rows(_logs(spark, folder))


def q_correlate_unnamed(spark, folder):
    """Rows without an operation are not one."""
    unnamed = F.when(F.col("event_id") % 3 != 0, F.col("operation_id"))
    logs = _logs(spark, folder).withColumn("operation_id", unnamed)
    return _rounded_numbers(log_queries.correlate_logs(logs), "dependency_duration")


def q_all_traces(spark, folder):
    """More rows than the default limit, which is lifted."""
    return log_queries.recent_logs(_logs(spark, folder), window=None, limit=None)


def q_newest_traces(spark, folder):
    """The default limit, where there are more rows."""
    return log_queries.recent_logs(_logs(spark, folder), window=None)


def _day_logs(spark, folder):
    """The log table by day, written in two loads, and its newest time."""
    path, logs = fresh_path(spark, "day_logs"), _logs(spark, folder)
    for part in (0, 1):
        day_logs.write_logs(logs.where(F.col("event_id") % 2 == part), path)
    return path, logs.agg(F.max("ts")).first()[0]


def q_recent_day_logs(spark, folder):
    path, now = _day_logs(spark, folder)
    return day_logs.recent_day_logs(spark, path, experiment_id="42", now=now, window="20 days")


def q_recent_day_exceptions(spark, folder):
    path, now = _day_logs(spark, folder)
    return day_logs.recent_day_logs(spark, path, log_queries.EXCEPTION, now=now, window="3 days")


def q_newest_day_logs(spark, folder):
    path, _ = _day_logs(spark, folder)
    return day_logs.newest_day_logs(spark, path)


def q_variant_dimensions(spark, folder):
    """Dimensions parsed once, when the log is written."""
    path, events = fresh_path(spark, "day_logs"), read_events(spark, folder)
    logs = _logs(spark, folder).join(events.select("event_id", "props"), "event_id")
    day_logs.write_logs(logs, path, dimensions="props")
    stored = day_logs.read_day_logs(spark, path, schema=LOGS_WITH_PROPS).select("event_id", "props")
    return log_queries.extend_dimensions(stored, "props", experiment="k", absent="nothing").drop(
        "props"
    )


def q_log_dimensions(spark, folder):
    events = read_events(spark, folder)
    return log_queries.extend_dimensions(
        events.select("event_id", "props"), "props", experiment="k", absent="nothing"
    ).drop("props")


def q_merge_dimensions(spark, folder):
    events = read_events(spark, folder)
    defaults = F.create_map(F.lit("k"), F.lit("none"), F.lit("component"), F.col("event_type"))
    record = F.when(F.col("event_id") % 3 != 0, dimension_map(events, "props"))
    merged = events.select("event_id", merge_dimensions(defaults, record).alias("d"))
    return merged.select(
        "event_id",
        F.col("d")["k"].alias("k"),
        F.col("d")["component"].alias("component"),
        F.size("d").alias("dimensions"),
    )


# --- models ----------------------------------------------------------------------------


def q_split_by_hash(spark, folder):
    trips = _trips(spark, folder).select("event_id", "fare_amount")
    train, test = split_by_hash(trips, ["event_id"])
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def q_regression_metrics(spark, folder):
    trips = _trips(spark, folder)
    looked_up = lookup_features(
        rounded_trips(trips), pickup_features(trips), PICKUP_KEY, PICKUP_NAMES
    )
    return _rounded_numbers(regression_metrics(looked_up, PICKUP_NAMES[0]), "mse", "rmse")


def _looked_up(spark, folder) -> DataFrame:
    trips = _trips(spark, folder)
    looked_up = rounded_trips(trips)
    for features, key, names in (
        (pickup_features(trips, start=START, end=END), PICKUP_KEY, PICKUP_NAMES),
        (dropoff_features(trips, start=START, end=END), DROPOFF_KEY, DROPOFF_NAMES),
    ):
        looked_up = lookup_features(looked_up, features, key, names)
    return looked_up


def _mean_as_prediction():
    return F.col(PICKUP_NAMES[0]).cast("double")


def q_prediction_shape(spark, folder):
    return _nullable(shape_predictions(_looked_up(spark, folder), _mean_as_prediction()))


def q_write_predictions(spark, folder):
    path = fresh_path(spark, "predictions")
    predictions = shape_predictions(_looked_up(spark, folder), _mean_as_prediction())
    for _ in range(2):
        write_predictions(predictions, path, run_id="run-1")
    written = spark.read.schema(predictions.schema).csv(f"{path}/run_id=run-1", header=True)
    return _nullable(written)


def q_run_metrics(spark, folder):
    path = fresh_path(spark, "run_metrics")
    trips = _trips(spark, folder)
    metrics = {"data_raw_rows": trips.count(), "data_raw_cols": len(trips.columns)}
    log_run_metrics(spark, path, "run-1", metrics)
    return read_run_metrics(spark, path, "run-1").drop("ts")


#: A boosted model on one feature with few values gives each value's mean label.
ONE_FEATURE = "dropoff_is_weekend"


def q_train_fare_model(spark, folder):
    lookups = fare_lookups(*_stored_pair(spark, folder))
    rows = training_set(rounded_trips(_trips(spark, folder)), lookups).load_df()
    rows = stage(rows.select("event_id", ONE_FEATURE, "fare_amount"))
    train, test = split_by_hash(rows, ["event_id"])
    model = train_fare_model(train.drop("event_id"))
    predicted = predict(model, test)
    return predicted.select("event_id", F.round("prediction", 6).alias("prediction"))


def q_fare_model_quality(spark, folder):
    """All features and rounds: no prediction missing, and better than the mean."""
    lookups = fare_lookups(*_stored_pair(spark, folder))
    rows = stage(training_set(rounded_trips(_trips(spark, folder)), lookups).load_df())
    train, test = split_by_hash(rows, ["event_id"])
    predicted = predict(train_fare_model(train.drop("event_id")), test)
    error = F.col("prediction") - F.col("fare_amount")
    return predicted.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("prediction").isNull()).alias("missing"),
        (F.avg(error * error) < F.var_pop("fare_amount")).alias("better_than_mean"),
    )


def q_score_batch(spark, folder):
    trips = rounded_trips(_trips(spark, folder))
    lookups = fare_lookups(*_stored_pair(spark, folder))
    others = {*trips.columns, *PICKUP_NAMES, *DROPOFF_NAMES} - {ONE_FEATURE, "fare_amount"}
    described = training_set(trips, lookups, exclude_columns=sorted(others))
    model = train_fare_model(stage(described.load_df()))
    registry = fresh_path(spark, "registry")
    publish_model(model, described, registry)
    return _nullable(score_batch(trips, registry))


def _jobs(spark, folder):
    """The training job of one range and the scoring job of the next, both recorded."""
    trips, registry = _trips(spark, folder), fresh_path(spark, "registry")
    tables = {
        "pickup_table": _new_table(spark, "pickup"), "dropoff_table": _new_table(spark, "dropoff"),
        "explain": False,
    }
    train_job(trips, *FIRST_HALF, registry, num_rounds=5, key_columns=["event_id"],
              run_id="train", **tables)
    scores = score_job(trips, *SECOND_HALF, registry, run_id="score", **tables)
    return registry, scores


def q_job_record(spark, folder):
    """What both jobs recorded, but for what depends on the fitted model."""
    registry, _ = _jobs(spark, folder)
    record = read_run_metrics(spark, f"{registry}/run_metrics").drop("ts")
    return record.where(~F.col("key").isin("mse", "rmse"))


def q_score_job(spark, folder):
    """All trips with the features of both ranges, and whether they have a prediction in cents."""
    _, scores = _jobs(spark, folder)
    cents = F.col("predicted_fare_amount") * 100
    given = F.coalesce(F.abs(cents - F.round(cents)) < 1e-6, F.lit(False))
    return _nullable(scores.withColumn("predicted_fare_amount", given))


def entry(spark: SparkSession) -> DataFrame:
    """Pickup features of the smallest tables."""
    return q_pickup_features(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All ``q_`` functions of this module by name, and the text operators if they are there."""
    own = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return own | LLM_QUERIES


# --- oracles ---------------------------------------------------------------------------

_TRIPS = """
trips AS (
  SELECT event_id, ts AS tpep_pickup_datetime,
         ts + to_minutes(5 + event_id % 40) AS tpep_dropoff_datetime,
         value / 4 + event_id % 7 AS trip_distance, value AS fare_amount,
         (10000 + user_id % 20)::INT AS pickup_zip,
         (10000 + (user_id * 7 + event_id) % 20)::INT AS dropoff_zip
  FROM events)"""

_LOG = """
log AS (
  SELECT event_id, ts, user_id AS operation_id,
         CASE event_type WHEN 'error' THEN 'exception' WHEN 'purchase' THEN 'dependency'
              ELSE 'trace' END AS kind,
         event_type AS role, json_extract_string(props, '$.k') AS experiment_id,
         user_id % 5 AS run_id, value AS duration
  FROM events)"""

_ROUNDED = """
rounded AS (
  SELECT event_id, trip_distance, fare_amount, pickup_zip, dropoff_zip,
         (ceil(epoch_us(tpep_pickup_datetime) / 900000000) * 900)::INT
           AS rounded_pickup_datetime,
         (ceil(epoch_us(tpep_dropoff_datetime) / 1800000000) * 1800)::INT
           AS rounded_dropoff_datetime
  FROM trips)"""


def _within(column: str, start: str | None, end: str | None) -> str:
    low = f"{column} >= TIMESTAMP '{start}'" if start else "true"
    high = f"{column} < TIMESTAMP '{end}'" if end else "true"
    return f"{low} AND {high}"


def _pickup(name: str, start=None, end=None, having="true", extra="") -> str:
    inside = _within("tpep_pickup_datetime", start, end)
    return f"""
{name} AS (
  SELECT pickup_zip AS zip, epoch(e)::INT AS ts, strftime(e, '%Y-%m') AS yyyy_mm,
         avg(fare_amount)::FLOAT AS mean_fare_window_1h_pickup_zip,
         count(*)::INT AS count_trips_window_1h_pickup_zip{extra}
  FROM (SELECT pickup_zip, fare_amount,
               time_bucket(INTERVAL 15 minutes, tpep_pickup_datetime, TIMESTAMP '1970-01-01')
               + to_minutes(15 * k) AS e
        FROM trips, range(1, 5) r(k) WHERE {inside})
  GROUP BY pickup_zip, e HAVING {having})"""


def _dropoff(name: str, start=None, end=None) -> str:
    inside = _within("tpep_dropoff_datetime", start, end)
    return f"""
{name} AS (
  SELECT dropoff_zip AS zip, epoch(e)::INT AS ts, strftime(e, '%Y-%m') AS yyyy_mm,
         count(*)::INT AS count_trips_window_30m_dropoff_zip,
         (isodow(timezone('America/New_York', timezone('UTC', e))) >= 6)::INT
           AS dropoff_is_weekend
  FROM (SELECT dropoff_zip,
               time_bucket(INTERVAL 30 minutes, tpep_dropoff_datetime, TIMESTAMP '1970-01-01')
               + INTERVAL 30 minutes AS e
        FROM trips WHERE {inside})
  GROUP BY dropoff_zip, e)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_PICKUP_JOIN = """LEFT JOIN pickup p
  ON r.pickup_zip = p.zip AND r.rounded_pickup_datetime = p.ts"""
_DROPOFF_JOIN = """LEFT JOIN dropoff d
  ON r.dropoff_zip = d.zip AND r.rounded_dropoff_datetime = d.ts"""
_P = """p.mean_fare_window_1h_pickup_zip,
       p.count_trips_window_1h_pickup_zip::DOUBLE AS count_trips_window_1h_pickup_zip"""
_D = """d.count_trips_window_30m_dropoff_zip::DOUBLE AS count_trips_window_30m_dropoff_zip,
       d.dropoff_is_weekend::DOUBLE AS dropoff_is_weekend"""

_RANGED = (_TRIPS, _ROUNDED, _pickup("pickup", START, END), _dropoff("dropoff", START, END))


def _describe(table: str, numbers: list[str]) -> str:
    text = "format('{{:.8e}}', {}::DOUBLE)".format
    rows = [
        f"""SELECT '{c}' AS column_name, count({c}) AS value_count,
       {text(f"avg({c}::DOUBLE)")} AS mean, {text(f"stddev_samp({c}::DOUBLE)")} AS stddev,
       {text(f"min({c})")} AS min_value, {text(f"max({c})")} AS max_value,
       NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM {table}"""
        for c in numbers
    ]
    rows.append(
        f"""SELECT 'yyyy_mm', count(yyyy_mm), NULL, NULL, NULL, NULL,
       min(yyyy_mm), max(yyyy_mm) FROM {table}"""
    )
    return "\nUNION ALL\n".join(rows)


def _boxplot(table: str, group: str, measures: list[str]) -> str:
    values = "\n  UNION ALL\n  ".join(
        f"SELECT '{m}' AS measure, {group}::DOUBLE AS group_value, {m}::DOUBLE AS value "
        f"FROM {table} WHERE {group} IS NOT NULL AND {m} IS NOT NULL"
        for m in measures
    )
    return f"""vals AS ({values}),
box AS (
  SELECT measure, group_value, quantile_cont(value, 0.25) AS q1,
         quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM vals GROUP BY ALL)
SELECT measure, group_value, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       count(*) AS row_count,
       round(min(value) FILTER (i), 6) AS whisker_low,
       round(max(value) FILTER (i), 6) AS whisker_high,
       count(*) FILTER (NOT i) AS outliers
FROM (SELECT v.*, q1, median, q3,
             value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS i
      FROM vals v JOIN box USING (measure, group_value))
GROUP BY measure, group_value"""


def _recent(where: str, days: int) -> str:
    return (
        _with(_LOG)
        + f"""SELECT * FROM log
WHERE ts > (SELECT max(ts) FROM log) - to_days({days}) AND {where}
ORDER BY ts DESC, event_id DESC LIMIT 1000"""
    )


_CORRELATED = """
SELECT operation_id,
       count(*) FILTER (kind = 'trace') AS traces,
       count(*) FILTER (kind = 'exception') AS exceptions,
       count(*) FILTER (kind = 'dependency') AS dependencies,
       min(ts) AS first_ts, max(ts) AS last_ts,
       min(ts) FILTER (kind = 'exception') AS first_exception_ts,
       round(sum(duration) FILTER (kind = 'dependency'), 6) AS dependency_duration
FROM log GROUP BY operation_id
HAVING count(DISTINCT kind) = 3"""

_PREDICTIONS = (
    _with(*_RANGED)
    + f"""SELECT round(p.mean_fare_window_1h_pickup_zip::DOUBLE, 2) AS predicted_fare_amount,
       r.fare_amount, r.trip_distance, r.pickup_zip, r.dropoff_zip,
       r.rounded_pickup_datetime, r.rounded_dropoff_datetime, {_P}, {_D}
FROM rounded r {_PICKUP_JOIN} {_DROPOFF_JOIN}"""
)

_TRAINING = (
    _with(*_RANGED)
    + f"""SELECT r.event_id, r.trip_distance, r.pickup_zip, r.dropoff_zip, {_P}, {_D},
       r.fare_amount
FROM rounded r {_PICKUP_JOIN} {_DROPOFF_JOIN}"""
)

_PICKUP_NUMBERS = [
    "zip", "ts", "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip",
]
_DROPOFF_NUMBERS = ["zip", "ts", "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"]
_ALL_PICKUP = _with(_TRIPS, _pickup("pickup")) + "SELECT * FROM pickup"
_ALL_DROPOFF = _with(_TRIPS, _dropoff("dropoff")) + "SELECT * FROM dropoff"
_RANGE_PICKUP = _with(_TRIPS, _pickup("pickup", START, END)) + "SELECT * FROM pickup"
_RANGE_DROPOFF = _with(_TRIPS, _dropoff("dropoff", START, END)) + "SELECT * FROM dropoff"
_HASH = "('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 100"


def _merged(kind: str, part: Callable[..., str]) -> str:
    """Features of the second half over those of the first."""
    return _with(
        _TRIPS,
        part("old", *FIRST_HALF),
        part("new", *SECOND_HALF),
        """
merged AS (
  SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS
    (SELECT 1 FROM new n WHERE n.zip = o.zip AND n.ts = o.ts))""",
    )


def _late(kind: str, pane: int, window: int) -> str:
    """Trips by batch, and which of them the stream's watermark leaves on time."""
    at = f"tpep_{kind}_datetime"
    quarter = " + ".join(f"({at} >= TIMESTAMP '{bound}')::INT" for bound in ARRIVALS[1:-1])
    return f"""
arriving AS (
  SELECT *, floor(epoch({at}))::BIGINT AS second,
         least(3, {quarter} + CASE WHEN {DELAYED} THEN 2 ELSE 0 END) AS batch FROM trips),
marks AS (
  SELECT batch, max(max(second)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING) - 3600 AS watermark
  FROM arriving GROUP BY batch),
told AS (
  SELECT a.*, coalesce(second - second % {pane} + {window} <= watermark, false) AS late
  FROM arriving a JOIN marks USING (batch)),
ontime AS (SELECT * FROM told WHERE NOT late)"""


def oracle_sql() -> dict[str, str]:
    return _own_oracles() | LLM_ORACLES


def _own_oracles() -> dict[str, str]:
    return {
        "filter_by_time": _with(_TRIPS)
        + f"SELECT * FROM trips WHERE {_within('tpep_pickup_datetime', START, END)}",
        "read_trips": _with(_TRIPS) + "SELECT * FROM trips",
        "read_trips_by_name": _with(_TRIPS) + "SELECT * FROM trips",
        "weekend_flag": _with(_TRIPS)
        + """SELECT event_id, (isodow(timezone('America/New_York',
            timezone('UTC', tpep_dropoff_datetime))) >= 6)::INT AS flag FROM trips""",
        "month_id": _with(_TRIPS)
        + "SELECT event_id, strftime(tpep_dropoff_datetime, '%Y-%m') AS yyyy_mm FROM trips",
        "ceil_minutes": """
WITH t AS (
  SELECT event_id, epoch(date_trunc('hour', ts))::BIGINT AS h,
         epoch_us(ts) - epoch_us(date_trunc('hour', ts)) AS o FROM events)
SELECT event_id, (h + ceil(o / 420000000) * 420)::INT AS up_7,
       (h + ceil(o / 900000000) * 900)::INT AS up_15,
       (h + ceil(o / 1800000000) * 1800)::INT AS up_30,
       (h + ceil(o / 7200000000) * 7200)::INT AS up_120 FROM t""",
        "parse_dates": """SELECT event_id,
       strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS day FROM events""",
        "rounded_trips": _with(_TRIPS, _ROUNDED) + "SELECT * FROM rounded",
        "prepare_trips": """SELECT ts AS tpep_pickup_datetime, value AS fare_amount,
       user_id AS rider, event_id FROM events""",
        "subsample": _with(_TRIPS)
        + f"""SELECT * FROM trips
WHERE {_within('tpep_pickup_datetime', START, END)} AND {_HASH} < 20""",
        "pickup_features": _ALL_PICKUP,
        "pickup_features_direct": _ALL_PICKUP,
        "pickup_features_range": _RANGE_PICKUP,
        "pickup_features_whole": _with(
            _TRIPS,
            _pickup(
                "pickup",
                START,
                END,
                f"e - INTERVAL 1 hour >= TIMESTAMP '{START}' AND e <= TIMESTAMP '{END}'",
            ),
        )
        + "SELECT * FROM pickup",
        "pickup_features_owned": _with(
            _TRIPS,
            _pickup("pickup", having=f"e > TIMESTAMP '{START}' AND e <= TIMESTAMP '{END}'"),
        )
        + "SELECT * FROM pickup",
        "dropoff_features": _ALL_DROPOFF,
        "dropoff_features_range": _RANGE_DROPOFF,
        "create_feature_table": _ALL_DROPOFF,
        "read_features": _with(_TRIPS, _pickup("pickup"))
        + f"""SELECT * FROM pickup WHERE ts >= epoch(TIMESTAMP '2024-01-10 06:00:00')
  AND ts < epoch(TIMESTAMP '{END}')""",
        "merge_features": _with(
            _TRIPS, _pickup("old", *FIRST_HALF), _pickup("new", *SECOND_HALF)
        )
        + """SELECT * FROM new UNION ALL
SELECT * FROM old WHERE NOT EXISTS
  (SELECT 1 FROM new WHERE new.zip = old.zip AND new.ts = old.ts)""",
        "overwrite_features": _with(_TRIPS, _pickup("new", *SECOND_HALF)) + "SELECT * FROM new",
        "stream_pickup": _ALL_PICKUP,
        "stream_dropoff": _ALL_DROPOFF,
        "stream_late": _with(
            _TRIPS,
            _late("pickup", 900, 3600),
            _pickup("pickup").replace("FROM trips", "FROM ontime"),
        )
        + "SELECT * FROM pickup",
        "stream_late_trips": _with(_TRIPS, _late("dropoff", 1800, 1800))
        + "SELECT event_id, batch, false AS folded FROM told WHERE late",
        "stream_backfilled": _ALL_DROPOFF,
        "pickup_lookup": _with(*_RANGED) + f"SELECT r.*, {_P} FROM rounded r {_PICKUP_JOIN}",
        "dropoff_lookup": _with(*_RANGED) + f"SELECT r.*, {_D} FROM rounded r {_DROPOFF_JOIN}",
        "training_set": _TRAINING,
        "bucketed_training_set": _TRAINING,
        "training_csv": _TRAINING,
        "exclude_self": _with(
            _TRIPS,
            _ROUNDED,
            _pickup("pickup", START, END, extra=", sum(fare_amount) AS fares"),
        )
        + f"""SELECT r.event_id, r.fare_amount,
       CASE WHEN epoch_us(t.tpep_pickup_datetime) < r.rounded_pickup_datetime::BIGINT * 1000000
                 AND {_within('t.tpep_pickup_datetime', START, END)}
            THEN CASE WHEN p.count_trips_window_1h_pickup_zip > 1
                      THEN ((p.fares - r.fare_amount)
                            / (p.count_trips_window_1h_pickup_zip - 1))::FLOAT END
            ELSE p.mean_fare_window_1h_pickup_zip END AS mean_fare_window_1h_pickup_zip,
       p.count_trips_window_1h_pickup_zip::DOUBLE AS count_trips_window_1h_pickup_zip
FROM rounded r JOIN trips t USING (event_id) {_PICKUP_JOIN}""",
        "rides_by_weekend": _with(_TRIPS, _dropoff("dropoff"))
        + """SELECT sum(count_trips_window_30m_dropoff_zip)::BIGINT AS num_rides,
       dropoff_is_weekend
FROM dropoff WHERE dropoff_is_weekend IS NOT NULL GROUP BY dropoff_is_weekend""",
        "shape_profile": _with(*_RANGED)
        + """SELECT 'trips' AS table_name, count(*) AS row_count, 7 AS column_count FROM trips
UNION ALL SELECT 'pickup_features', count(*), 5 FROM pickup
UNION ALL SELECT 'dropoff_features', count(*), 5 FROM dropoff""",
        "null_keys": _with(_TRIPS)
        + """SELECT count(*) FILTER (tpep_pickup_datetime IS NULL) AS tpep_pickup_datetime,
       count(*) FILTER (tpep_dropoff_datetime IS NULL) AS tpep_dropoff_datetime,
       count(*) FILTER (pickup_zip IS NULL) AS pickup_zip,
       count(*) FILTER (dropoff_zip IS NULL) AS dropoff_zip FROM trips""",
        "describe_pickup": _with(_TRIPS, _pickup("pickup")) + _describe("pickup", _PICKUP_NUMBERS),
        "describe_dropoff": _with(_TRIPS, _dropoff("dropoff"))
        + _describe("dropoff", _DROPOFF_NUMBERS),
        "boxplot_pickup": _with(_TRIPS, _pickup("pickup")).rstrip()
        + ",\n"
        + _boxplot(
            "pickup",
            "count_trips_window_1h_pickup_zip",
            ["mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"],
        ),
        "boxplot_dropoff": _with(_TRIPS, _dropoff("dropoff")).rstrip()
        + ",\n"
        + _boxplot(
            "dropoff",
            "dropoff_is_weekend",
            ["count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"],
        ),
        "describe_merged": _merged("pickup", _pickup) + _describe("merged", _PICKUP_NUMBERS),
        "boxplot_merged": _merged("dropoff", _dropoff).rstrip()
        + ",\n"
        + _boxplot(
            "merged",
            "dropoff_is_weekend",
            ["count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"],
        ),
        "read_logs": _with(_LOG) + "SELECT * FROM log",
        "recent_logs": _recent("kind = 'trace' AND experiment_id = '42'", 20),
        "recent_logs_run": _recent("kind = 'trace' AND experiment_id = '42' AND run_id = 3", 20),
        "recent_exceptions": _recent("kind = 'exception'", 3),
        "stage_durations": _recent("kind = 'dependency' AND role = 'purchase'", 3),
        "operation_logs": _recent("operation_id = 7", 20),
        "correlate_logs": _with(_LOG) + _CORRELATED,
        "correlate_three_logs": _with(_LOG) + _CORRELATED,
        "correlated_rows": _with(_LOG)
        + """SELECT * FROM log WHERE operation_id IN (
  SELECT operation_id FROM log GROUP BY operation_id HAVING count(DISTINCT kind) = 3)""",
        "correlate_unnamed": _with(_LOG)
        + _CORRELATED.replace("FROM log", "FROM log WHERE event_id % 3 <> 0"),
        "all_traces": _with(_LOG) + "SELECT * FROM log WHERE kind = 'trace'",
        "newest_traces": _with(_LOG)
        + """SELECT * FROM log WHERE kind = 'trace'
ORDER BY ts DESC, event_id DESC LIMIT 1000""",
        "recent_day_logs": _recent("kind = 'trace' AND experiment_id = '42'", 20),
        "recent_day_exceptions": _recent("kind = 'exception'", 3),
        "newest_day_logs": _with(_LOG)
        + """SELECT * FROM log WHERE kind = 'trace'
ORDER BY ts DESC, event_id DESC LIMIT 1000""",
        "variant_dimensions": """SELECT event_id,
       json_extract_string(props, '$.k') AS experiment,
       json_extract_string(props, '$.nothing') AS absent FROM events""",
        "log_dimensions": """SELECT event_id,
       json_extract_string(props, '$.k') AS experiment,
       json_extract_string(props, '$.nothing') AS absent FROM events""",
        "merge_dimensions": """
WITH m AS (
  SELECT event_id, json_merge_patch(
           json_object('k', 'none', 'component', event_type),
           CASE WHEN event_id % 3 <> 0 THEN props::JSON ELSE '{}'::JSON END) AS d
  FROM events)
SELECT event_id, json_extract_string(d, '$.k') AS k,
       json_extract_string(d, '$.component') AS component,
       len(json_keys(d))::INT AS dimensions FROM m""",
        "split_by_hash": f"""SELECT event_id, value AS fare_amount,
       CASE WHEN {_HASH} < 75 THEN 'train' ELSE 'test' END AS part FROM events""",
        "regression_metrics": _with(_TRIPS, _ROUNDED, _pickup("pickup"))
        + f"""SELECT round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
       count(e) AS row_count
FROM (SELECT p.mean_fare_window_1h_pickup_zip::DOUBLE - r.fare_amount AS e
      FROM rounded r {_PICKUP_JOIN})""",
        "prediction_shape": _PREDICTIONS,
        "write_predictions": _PREDICTIONS,
        "train_fare_model": _with(_TRIPS, _ROUNDED, _dropoff("dropoff"))
        + f""", j AS (SELECT r.event_id, r.fare_amount, d.dropoff_is_weekend AS flag,
       {_HASH} < 75 AS train FROM rounded r {_DROPOFF_JOIN}),
m AS (SELECT flag, avg(fare_amount) AS fare FROM j WHERE train GROUP BY flag)
SELECT event_id, round(fare, 6) AS prediction
FROM j JOIN m ON j.flag IS NOT DISTINCT FROM m.flag WHERE NOT train""",
        "fare_model_quality": f"""SELECT count(*) AS row_count, 0::BIGINT AS missing,
       true AS better_than_mean FROM events WHERE {_HASH} >= 75""",
        "score_batch": _with(_TRIPS, _ROUNDED, _pickup("pickup"), _dropoff("dropoff"))
        + f"""SELECT round(avg(r.fare_amount) OVER (PARTITION BY d.dropoff_is_weekend), 2)
         AS predicted_fare_amount,
       r.fare_amount, r.trip_distance, r.pickup_zip, r.dropoff_zip,
       r.rounded_pickup_datetime, r.rounded_dropoff_datetime, {_P}, {_D}
FROM rounded r {_PICKUP_JOIN} {_DROPOFF_JOIN}""",
        "run_metrics": """SELECT 'run-1' AS run_id, 'data_raw_rows' AS key,
       count(*)::VARCHAR AS value FROM events
UNION ALL SELECT 'run-1', 'data_raw_cols', '7'""",
        "job_record": _with(
            _TRIPS,
            *[
                part(f"{kind}_{run}", *bounds)
                for run, bounds in (("train", FIRST_HALF), ("score", SECOND_HALF))
                for kind, part in (("pickup", _pickup), ("dropoff", _dropoff))
            ],
        )
        + """SELECT run_id, key, value::VARCHAR AS value FROM (
SELECT unnest(['train', 'score']) AS run_id, 'trips_rows' AS key,
       (SELECT count(*) FROM trips)::VARCHAR AS value
UNION ALL SELECT unnest(['train', 'score']), 'trips_columns', '7'
UNION ALL SELECT unnest(['train', 'score']), 'pickup_features_columns', '5'
UNION ALL SELECT unnest(['train', 'score']), 'dropoff_features_columns', '5'
UNION ALL SELECT 'train', 'pickup_features_rows', count(*)::VARCHAR FROM pickup_train
UNION ALL SELECT 'train', 'dropoff_features_rows', count(*)::VARCHAR FROM dropoff_train
UNION ALL SELECT 'score', 'pickup_features_rows', count(*)::VARCHAR FROM pickup_score
UNION ALL SELECT 'score', 'dropoff_features_rows', count(*)::VARCHAR FROM dropoff_score
UNION ALL SELECT 'train', 'training_data_rows', count(*)::VARCHAR FROM trips
UNION ALL SELECT 'train', 'training_data_columns', '9'
UNION ALL SELECT 'train', 'model_name', 'fares' UNION ALL SELECT 'train', 'model_version', '1'
UNION ALL SELECT 'score', 'scored_model_name', 'fares'
UNION ALL SELECT 'score', 'scored_model_version', '1')""",
        "score_job": _with(
            _TRIPS,
            _ROUNDED,
            *[
                part(f"{kind}_{age}", *bounds)
                for age, bounds in (("old", FIRST_HALF), ("new", SECOND_HALF))
                for kind, part in (("pickup", _pickup), ("dropoff", _dropoff))
            ],
            *[
                f"""
{kind} AS (
  SELECT * FROM {kind}_new UNION ALL
  SELECT * FROM {kind}_old o WHERE NOT EXISTS
    (SELECT 1 FROM {kind}_new n WHERE n.zip = o.zip AND n.ts = o.ts))"""
                for kind in ("pickup", "dropoff")
            ],
        )
        + f"""SELECT true AS predicted_fare_amount,
       r.fare_amount, r.trip_distance, r.pickup_zip, r.dropoff_zip,
       r.rounded_pickup_datetime, r.rounded_dropoff_datetime, {_P}, {_D}
FROM rounded r {_PICKUP_JOIN} {_DROPOFF_JOIN}""",
    }
