from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from faretide.operators import store
from faretide.operators.store import (
    create_feature_table,
    expire_features,
    merge_features,
    overwrite_features,
    primary_keys,
    read_features,
    write_features,
)
from faretide.operators.windows import pickup_features
from faretide.schemas import DROPOFF_FEATURES
from faretide.session import fresh_path

JANUARY, FEBRUARY, MARCH = 1704070800, 1706749200, 1709254800
MONTHS = {JANUARY: "2024-01", FEBRUARY: "2024-02", MARCH: "2024-03"}


@pytest.fixture
def features(spark):
    def make(*rows):
        """Rows of (zip, ts, trips)."""
        full = [(zip_, ts, MONTHS.get(ts), trips, 0) for zip_, ts, trips in rows]
        return spark.createDataFrame(full, DROPOFF_FEATURES)

    return make


def content(spark, table):
    columns = ["zip", "ts", "count_trips_window_30m_dropoff_zip"]
    return rows_of(spark.table(table).select(*columns))


def test_create_is_idempotent(spark, table, features):
    name = table()
    report = create_feature_table(
        features((1, JANUARY, 5), (1, FEBRUARY, 6)), name, description="It's a table"
    )
    assert (report.rows, report.null_keys, report.months) == (2, 0, ("2024-01", "2024-02"))
    assert create_feature_table(features((9, JANUARY, 9)), name) is None
    assert content(spark, name) == [(1, JANUARY, 5), (1, FEBRUARY, 6)]
    assert primary_keys(spark, name) == ["zip", "ts"]
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Comment"] == "It's a table"
    assert spark.table(name).columns[-1] == "yyyy_mm"


def test_create_fills_a_table_left_empty(spark, table, features):
    name = table()
    create_feature_table(features(), name)
    create_feature_table(features((1, JANUARY, 5)), name)
    assert content(spark, name) == [(1, JANUARY, 5)]


def test_create_checks_columns(table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5)), name)
    with pytest.raises(ValueError, match="has columns"):
        create_feature_table(features((1, JANUARY, 5)).withColumn("x", F.lit(1)), name)


def test_create_at_a_location(spark, table, features):
    name, path = table(), fresh_path(spark, "external")
    create_feature_table(features((1, JANUARY, 5)), name, location=path)
    merge_features(features((2, JANUARY, 6)), name)
    assert content(spark, name) == [(1, JANUARY, 5), (2, JANUARY, 6)]
    # Replaced folders stay for readers that began on them, until they are removed by age.
    expire_features(spark, name, older_than=0)
    assert spark.read.parquet(path).count() == 2


def test_merge_inserts_and_replaces(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (2, JANUARY, 6), (1, FEBRUARY, 7)), name)
    new = features((2, JANUARY, 60), (3, JANUARY, 8), (1, MARCH, 9))
    expected = [
        (1, JANUARY, 5), (1, FEBRUARY, 7), (1, MARCH, 9), (2, JANUARY, 60), (3, JANUARY, 8),
    ]
    for _ in range(2):
        report = merge_features(new, name)
        assert content(spark, name) == sorted(expected, key=str)
    assert report.months == ("2024-01", "2024-03")


def test_merge_leaves_other_months_alone(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)

    def february():
        kept = spark.table(name).filter("yyyy_mm = '2024-02'")
        return rows_of(kept.select(F.input_file_name()))

    before = february()
    merge_features(features((1, JANUARY, 6)), name)
    assert february() == before


def test_null_keys_are_counted_and_dropped(spark, table, features):
    name = table()
    report = create_feature_table(features((1, JANUARY, 5), (None, JANUARY, 7)), name)
    assert (report.rows, report.null_keys) == (1, 1)
    report = merge_features(features((None, FEBRUARY, 7), (4, None, 7)), name)
    assert (report.rows, report.null_keys, report.months) == (0, 2, ())
    assert content(spark, name) == [(1, JANUARY, 5)]


def test_duplicate_keys_are_refused(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5)), name)
    with pytest.raises(ValueError, match="more than once"):
        merge_features(features((2, JANUARY, 5), (2, JANUARY, 6)), name)
    assert content(spark, name) == [(1, JANUARY, 5)]


def test_overwrite_replaces_all_months(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)
    write_features(features((1, FEBRUARY, 8), (1, MARCH, 9)), name, mode="overwrite")
    assert content(spark, name) == [(1, FEBRUARY, 8), (1, MARCH, 9)]


def test_failing_overwrite_keeps_the_rows(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5)), name)
    failing = features((1, JANUARY, 8)).withColumn("zip", F.expr("cast(1 / (zip - 1) AS int)"))
    with pytest.raises(Exception, match="(?i)divide"):
        overwrite_features(failing, name)
    assert content(spark, name) == [(1, JANUARY, 5)]


def test_a_table_can_be_rewritten_from_itself(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)
    trips = "count_trips_window_30m_dropoff_zip"
    overwrite_features(spark.table(name).withColumn(trips, F.col(trips) + 1), name)
    assert content(spark, name) == [(1, JANUARY, 6), (1, FEBRUARY, 8)]


def test_tables_without_partitions(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (2, JANUARY, 6)), name, partition_column=None)
    merge_features(features((2, JANUARY, 60), (3, MARCH, 7)), name)
    assert content(spark, name) == [(1, JANUARY, 5), (2, JANUARY, 60), (3, MARCH, 7)]
    overwrite_features(features((4, JANUARY, 1)), name)
    assert content(spark, name) == [(4, JANUARY, 1)]


def test_read_prunes_months(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7), (1, MARCH, 9)), name)
    read = read_features(spark, name, "2024-02-01", "2024-03-01")
    assert [r["ts"] for r in read.collect()] == [FEBRUARY]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy_mm" in plan


def test_files_are_in_time_order(spark, table, features):
    name = table()
    create_feature_table(features(*[(z, JANUARY + 900 * t, 1) for t in range(9) for z in (2, 1)])
                         .fillna("2024-01", ["yyyy_mm"]), name)
    merge_features(features((3, JANUARY, 1)), name)
    for path in spark.table(name).inputFiles():
        rows = spark.read.parquet(path).select("ts", "zip").collect()
        assert rows == sorted(rows)


def test_the_session_setting_is_restored(spark, table, features):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    create_feature_table(features((1, JANUARY, 5)), table())
    assert spark.conf.get(setting) == before


def test_unknown_modes_and_tables(spark, table, features):
    with pytest.raises(ValueError, match="unknown mode"):
        write_features(features((1, JANUARY, 5)), table(), mode="append")
    name = table()
    features((1, JANUARY, 5)).write.saveAsTable(name)
    with pytest.raises(ValueError, match="not created as a feature table"):
        merge_features(features((1, JANUARY, 5)), name)


def test_large_months_are_split_over_files(spark, table):
    name = table()
    rows = spark.range(400_000).selectExpr(
        "cast(id AS int) AS zip", f"{JANUARY} AS ts", "'2024-01' AS yyyy_mm",
        "1 AS count_trips_window_30m_dropoff_zip", "0 AS dropoff_is_weekend",
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "500KB")
    try:
        create_feature_table(rows, name)
    finally:
        spark.conf.set(setting, before)
    assert spark.table(name).count() == 400_000
    assert len(spark.table(name).inputFiles()) > 3


@pytest.mark.parametrize("partition", ["yyyy_mm", None])
def test_a_lost_merge_keeps_the_old_rows(spark, table, features, monkeypatch, partition):
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name,
                         partition_column=partition)
    new = features((1, JANUARY, 6), (2, FEBRUARY, 8))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(store, "_switch", lost)
        for write in (merge_features, overwrite_features):
            with pytest.raises(RuntimeError, match="lost"):
                write(new, name)
            assert content(spark, name) == [(1, JANUARY, 5), (1, FEBRUARY, 7)]
    merge_features(new, name)
    assert content(spark, name) == [(1, JANUARY, 6), (1, FEBRUARY, 7), (2, FEBRUARY, 8)]


def test_two_threads_write_two_tables(spark, table, features):
    names = [table(), table()]
    for name in names:
        create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)

    def write(task):
        kind, name = task
        for trips in range(3):
            kind(features((1, JANUARY, trips)), name)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, zip((merge_features, overwrite_features), names, strict=True)))
    assert content(spark, names[0]) == [(1, JANUARY, 2), (1, FEBRUARY, 7)]
    assert content(spark, names[1]) == [(1, JANUARY, 2)]


def test_rows_outside_their_month_are_refused(spark, table, features):
    name = table()
    create_feature_table(features((1, JANUARY, 5)), name)
    with pytest.raises(ValueError, match="not in the month"):
        merge_features(features((1, JANUARY, 5)).withColumn("yyyy_mm", F.lit("2024-02")), name)
    with pytest.raises(ValueError, match="partitioned by"):
        create_feature_table(features((1, JANUARY, 5)), table(), partition_column="zip")
    with pytest.raises(ValueError, match="partitioned by"):
        create_feature_table(features((1, JANUARY, 5)), table(), primary_keys=["zip"])


def test_times_an_int_cannot_hold_fail_the_write(spark, table, make_trips):
    name = table()
    trips = make_trips([("2040-05-01 10:00:00", "2040-05-01 10:20:00", 1.0, 5.0, 7, 8)])
    with pytest.raises(ValueError, match="4 rows end after January 2038"):
        create_feature_table(pickup_features(trips), name)
