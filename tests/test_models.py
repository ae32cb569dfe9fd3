from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.client import FeatureClient
from faretide.operators import models
from faretide.operators.lookups import fare_lookups
from faretide.operators.models import (
    missing_sentinel,
    predict,
    regression_metrics,
    split_by_hash,
    train_fare_model,
    tree_settings,
)
from faretide.operators.registry import claim_version, latest_version, load_model, publish_model
from faretide.operators.rows import rounded_trips
from faretide.operators.scoring import (
    log_run_metrics,
    read_run_metrics,
    score_batch,
    score_with,
    write_predictions,
)
from faretide.operators.snapshots import children, read_snapshot
from faretide.operators.store import feature_table, read_features
from faretide.operators.windows import dropoff_features
from faretide.plans import jobs
from faretide.plans.jobs import feature_job, score_job, store_features, train_job
from faretide.schemas import TRAINING
from faretide.session import fresh_path
from faretide.sources.events import read_events, trips_from_events
from faretide.sources.tables import read_training_csv


@pytest.fixture(scope="module")
def larger(spark):
    return trips_from_events(read_events(spark, "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def trained(spark, larger):
    """A small published model, its run and its tables."""
    from uuid import uuid4

    from faretide.operators.store import create_database

    create_database(spark, "faretide_models", fresh_path(spark, "database"))
    pickup, dropoff = (f"faretide_models.t{uuid4().hex}" for _ in range(2))
    registry = fresh_path(spark, "registry")
    run = train_job(
        larger, "2024-01-05", "2024-01-20", registry, num_rounds=8, key_columns=["event_id"],
        pickup_table=pickup, dropoff_table=dropoff, run_id="r1",
    )
    return run, registry, pickup, dropoff


def test_split_is_disjoint_complete_and_stable(larger):
    for keys in (["event_id"], None):
        train, test = split_by_hash(larger, keys)
        again = split_by_hash(larger.repartition(11, "pickup_zip"), keys)[0]
        train_ids, test_ids = (
            {r[0] for r in part.select("event_id").collect()} for part in (train, test)
        )
        assert not train_ids & test_ids
        assert len(train_ids | test_ids) == larger.count()
        assert abs(len(train_ids) / larger.count() - 0.75) < 0.02
        assert train_ids == {r[0] for r in again.select("event_id").collect()}


def test_metrics(spark):
    rows = [(1.0, 3.0), (2.0, 2.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "prediction double, fare_amount double")
    assert tuple(regression_metrics(df).first()) == (2.0, 2.0**0.5, 2)


def test_sentinel_is_below_all_values(spark):
    df = spark.createDataFrame([(1.0, None), (-3.5, None)], "a double, b int")
    assert missing_sentinel(df, ["a", "b"]) == -5.0
    assert missing_sentinel(df.filter("a > 0"), ["a", "b"]) == -1.0


def test_small_csv_trains(spark):
    path = fresh_path(spark, "csv")
    rows = [(i / 2, 10003 + i, 10282 - i, 3.5 + i, 1 + i % 2, 1 + i % 2, i % 2, 4.0 + i)
            for i in range(9)]
    rows.append((1.0, 10003, 10004, None, None, None, None, 5.5))
    spark.createDataFrame(rows, TRAINING).coalesce(1).write.option("header", True).csv(path)
    df = read_training_csv(spark, path)
    assert rows_of(df) == rows_of(spark.createDataFrame(rows, TRAINING))
    model = train_fare_model(df, {"num_leaves": 4}, num_rounds=2)
    assert predict(model, df).filter("prediction IS NULL").count() == 0
    with pytest.raises(ValueError, match="objective"):
        train_fare_model(df, {"objective": "binary"})


def test_csv_with_other_names_is_refused(spark):
    path = fresh_path(spark, "csv")
    spark.range(3).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_training_csv(spark, path).collect()


def test_model_beats_the_mean(trained, larger):
    run = trained[0]
    variance = larger.agg(F.var_pop("fare_amount")).first()[0]
    assert run.metrics["mse"] < variance / 2
    assert run.metrics["training_data_rows"] == larger.count()


def test_model_without_leaks_still_beats_the_mean(larger):
    """Without the distance, which this data derives from the fare, and without features."""
    plain = rounded_trips(larger).select("event_id", "pickup_zip", "dropoff_zip", "fare_amount")
    train, test = split_by_hash(plain, ["event_id"])
    model = train_fare_model(train.drop("event_id"), {"num_leaves": 4}, num_rounds=2)
    measured = regression_metrics(predict(model, test)).first()
    variance = test.agg(F.var_pop("fare_amount")).first()[0]
    assert measured["mse"] < variance * 1.1


def test_arguments_set_depth_and_rounds(trained, sample):
    trees = trained[0].model.stages[-1]
    assert trees.getMaxIter() == 8 and trees.getMaxDepth() == 5
    small = train_fare_model(
        sample.select("trip_distance", "pickup_zip", "fare_amount"), {"num_leaves": 8}, 1
    )
    assert small.stages[-1].getMaxDepth() == 3 and small.stages[-1].getNumTrees == 1


def test_rounds_scan_few_rows_in_many_tasks(spark, sample, monkeypatch):
    """From one file with each trip thirty times, boosting takes each kind of row once."""
    path, taken = fresh_path(spark, "copies"), []
    copies = sample.select("trip_distance", "pickup_zip", "fare_amount").crossJoin(spark.range(30))
    copies.drop("id").coalesce(1).write.parquet(path)
    fit = models.GBTRegressor.fit
    monkeypatch.setattr(
        models.GBTRegressor, "fit", lambda self, df: taken.append(df) or fit(self, df)
    )
    train_fare_model(spark.read.parquet(path), {"num_leaves": 4}, num_rounds=1)
    # A batch of its own for each partition that has rows.
    assert taken[0].select(F.spark_partition_id()).distinct().count() > 2
    assert taken[0].count() <= sample.count()


def test_weighed_rows_give_the_model_of_all_rows(spark, larger, monkeypatch):
    """In bins alone, and with NULL, each kind of row has the prediction it has unweighed."""
    rows = rounded_trips(larger).selectExpr(
        "round(trip_distance) AS distance", "nullif(pickup_zip, 10003) AS zip", "fare_amount"
    )
    weighed = train_fare_model(rows, {"num_leaves": 8}, num_rounds=5)
    monkeypatch.setattr(
        models, "weighed_rows", lambda df, *_: df.withColumn(models._WEIGHT, F.lit(1.0))
    )
    plain = train_fare_model(rows, {"num_leaves": 8}, num_rounds=5)
    both = predict(plain, predict(weighed, rows).withColumnRenamed("prediction", "ours"))
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("ours")))).first()[0] < 1e-6
    assert both.select("ours").distinct().count() > 8


def test_bin_edges(spark):
    rows = [(float(i % 5), i / 7, -1.0 if i == 3 else float(i), 2.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    a, b, c, d = models.bin_edges(df, df.columns, 8, -1.0)
    assert a[1:-1] == [0.5, 1.5, 2.5, 3.5]
    counts = [df.filter((df.b >= low) & (df.b < high)).count() for low, high in zip(b, b[1:])]
    assert 7 <= len(counts) <= 8 and max(counts) <= 150
    # The missing value has a bin of its own, however few rows have it.
    assert len(c) <= 9 and c[1] == 0.0
    assert len(d) == 3


def test_scores(spark, trained, larger):
    run, registry, _, _ = trained
    scored = score_batch(rounded_trips(larger), registry)
    assert scored.columns == [
        "predicted_fare_amount", "fare_amount", "trip_distance", "pickup_zip", "dropoff_zip",
        "rounded_pickup_datetime", "rounded_dropoff_datetime",
        "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip",
        "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend",
    ]
    assert scored.count() == larger.count()
    predicted = F.col("predicted_fare_amount")
    assert scored.filter(predicted.isNull() | (predicted != F.round(predicted, 2))).count() == 0


def test_versions(spark, trained, larger):
    run, registry, _, _ = trained
    assert run.version == 1
    assert latest_version(spark, registry, "fares") == 1
    assert latest_version(spark, fresh_path(spark, "none"), "fares") == 1
    with pytest.raises(LookupError):
        load_model(spark, fresh_path(spark, "none"), "fares")
    for expected in (1, 2):
        assert publish_model(run.model, run.training_set, registry, "other") == expected
    assert load_model(spark, registry, "other").version == 2
    assert load_model(spark, registry, "other", "").version == 2
    assert load_model(spark, registry, "other", "1").version == 1
    assert load_model(spark, registry, "other").lookups == run.training_set.lookups
    with pytest.raises(LookupError, match="no version 11"):
        load_model(spark, registry, "other", 11)
    # Numbers, not text: 10 comes after 9.
    root = fresh_path(spark, "registry")
    spark.createDataFrame([("m", 9), ("m", 10)], "model string, version int").write.parquet(
        f"{root}/versions"
    )
    assert latest_version(spark, root, "m") == 10
    for bad in [(None, run.training_set), (run.model, None)]:
        with pytest.raises(ValueError):
            publish_model(*bad, registry)


def test_client(spark, trained, sample, table):
    run, registry, pickup, dropoff = trained
    client = FeatureClient(spark, registry)
    features, name = dropoff_features(sample), table()
    for _ in range(2):
        client.create_table(
            name=name, primary_keys=["zip", "ts"], df=features, partition_columns="yyyy_mm",
            description="Dropoff features",
        )
    client.write_table(name=name, df=features, mode="merge")
    assert client.read_table(name).count() == features.count()
    described = client.create_training_set(
        rounded_trips(sample),
        feature_lookups=fare_lookups(pickup, name),
        label="fare_amount",
        exclude_columns=["rounded_pickup_datetime", "rounded_dropoff_datetime"],
    )
    assert described.load_df().count() == sample.count()
    version = client.log_model(run.model, described, registered_model_name="by_client")
    assert client.latest_version("by_client") == version == 1
    for address in ("models:/by_client", "models:/by_client/1"):
        scored = client.score_batch(address, rounded_trips(sample))
        assert scored.columns[-1] == "prediction" and "event_id" in scored.columns
        assert scored.count() == sample.count()
    with pytest.raises(ValueError, match="not a model address"):
        client.score_batch("runs:/x", sample)


def test_run_metrics(spark, trained):
    _, registry, _, _ = trained
    log_run_metrics(spark, f"{registry}/run_metrics", "r2", {"x": 1})
    recorded = {r["key"]: r["value"] for r in read_run_metrics(
        spark, f"{registry}/run_metrics", "r1").collect()}
    assert recorded["model_version"] == "1" and float(recorded["mse"]) > 0
    assert read_run_metrics(spark, f"{registry}/run_metrics").count() == len(recorded) + 1


def test_score_job_writes_each_run_once(spark, trained, larger):
    _, registry, pickup, dropoff = trained
    output = fresh_path(spark, "scores")
    for run_id in ("a", "b", "a"):
        scored = score_job(
            larger, "2024-01-20", "2024-01-25", registry, output, version="1",
            pickup_table=pickup, dropoff_table=dropoff, run_id=run_id,
        )
    for run_id in ("a", "b"):
        written = spark.read.schema(scored.schema).csv(f"{output}/run_id={run_id}", header=True)
        assert written.count() == larger.count()
    assert rows_of(written) == rows_of(scored)
    # The merge kept the training range and added the scoring range.
    assert spark.table(pickup).filter("ts < 1705276800").count() > 0
    assert spark.table(pickup).filter("ts > 1705881600").count() > 0


def test_write_without_run_id(spark, sample):
    path = fresh_path(spark, "scores")
    write_predictions(sample.select("fare_amount"), path, fmt="parquet")
    assert spark.read.parquet(path).count() == sample.count()


def test_feature_job_profiles(spark, sample, table):
    run = feature_job(sample, "2024-01-05", "2024-01-20")
    shapes = {r["table_name"]: r["row_count"] for r in run.shapes.collect()}
    assert shapes["trips"] == sample.count() and shapes["pickup_features"] == run.pickup.count()
    assert set(run.profiles) == {
        "null_keys", "describe_pickup", "describe_dropoff", "boxplot_pickup", "boxplot_dropoff"
    }
    assert all(profile.count() for profile in run.profiles.values())
    names = table(), table()
    for _ in range(2):
        store_features(run, *names)
        assert rows_of(spark.table(names[0]).select(run.pickup.columns)) == rows_of(run.pickup)
        assert rows_of(spark.table(names[1]).select(run.dropoff.columns)) == rows_of(run.dropoff)


def test_publishers_at_once_get_versions_of_their_own(spark, trained):
    run, registry, _, _ = trained
    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: claim_version(spark, registry, "claims"), range(8)))
    assert sorted(claimed) == list(range(1, 9))
    publish = lambda _: publish_model(run.model, run.training_set, registry, "at_once")
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(publish, range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    assert [load_model(spark, registry, "at_once", v).version for v in versions] == versions


def test_the_recorded_version_is_the_one_that_scored(spark, trained, sample, monkeypatch):
    run, registry, pickup, dropoff = trained
    assert publish_model(run.model, run.training_set, registry, "raced") == 1

    def publish_meanwhile(*args):
        publish_model(run.model, run.training_set, registry, "raced")
        return score_with(*args)

    monkeypatch.setattr(jobs, "score_with", publish_meanwhile)
    score_job(sample, None, None, registry, name="raced", pickup_table=pickup, dropoff_table=dropoff,
              refresh_features=False, run_id="raced")
    record = {r["key"]: r["value"] for r in read_run_metrics(
        spark, f"{registry}/run_metrics", "raced").collect()}
    assert record["scored_model_version"] == "1" and latest_version(spark, registry, "raced") == 2


def test_a_new_table_is_written_once(spark, sample, table):
    names = table(), table()
    run = feature_job(sample, None, None, explain=False, tables=names)
    for name, rows in zip(names, (run.pickup, run.dropoff), strict=True):
        info = feature_table(spark, name)
        (segment, *_) = read_snapshot(spark, info.root).segments
        versions = [n for n, _ in children(spark, info.root) if n.startswith("version=")]
        assert versions == [segment.folder.split("/")[0]]
        assert rows_of(read_features(spark, name).select(rows.columns)) == rows_of(rows)
    again = feature_job(sample, "2024-01-05", "2024-01-20", explain=False, tables=names)
    expected = dropoff_features(sample, start="2024-01-05", end="2024-01-20")
    assert rows_of(again.dropoff) == rows_of(expected.select(again.dropoff.columns))


def test_parameters_are_honoured_or_refused():
    found = tree_settings({"num_leaves": 31, "learning_rate": 0.3, "max_bin": 16, "seed": 7})
    assert found["maxDepth"] == 5 and found["stepSize"] == 0.3
    assert found["maxBins"] == 16 and found["seed"] == 7
    for wrong in ({"nonsense": 5}, {"objective": "binary"}, {"metric": "mae"}, {"num_leaves": 1}):
        with pytest.raises(ValueError):
            tree_settings(wrong)
