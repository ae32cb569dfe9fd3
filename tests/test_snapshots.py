"""Commits of feature tables: what readers see while others write, and what stays on disk."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from test_store import FEBRUARY, JANUARY, MARCH, features  # noqa: F401

from faretide.operators import snapshots, store
from faretide.operators.snapshots import Conflict, read_snapshot, write_once
from faretide.operators.store import (
    compact_features,
    create_feature_table,
    expire_features,
    feature_table,
    merge_features,
    overwrite_features,
    read_features,
    repair_catalog,
    stored_rows,
)
from faretide.schemas import DROPOFF_FEATURES
from faretide.session import fresh_path

TRIPS = "count_trips_window_30m_dropoff_zip"


def content(spark, table, **options):
    return rows_of(read_features(spark, table, **options).select("zip", "ts", TRIPS))


def latest(spark, table):
    return read_snapshot(spark, feature_table(spark, table).root)


def test_a_reader_that_began_before_finishes(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)
    before = read_features(spark, name)
    merge_features(features((1, JANUARY, 6), (2, FEBRUARY, 8)), name)
    between = read_features(spark, name)
    overwrite_features(features((9, MARCH, 1)), name)
    compact_features(spark, name)
    seen = [rows_of(df.select("zip", "ts", TRIPS)) for df in (before, between)]
    assert seen[0] == [(1, JANUARY, 5), (1, FEBRUARY, 7)]
    assert seen[1] == [(1, JANUARY, 6), (1, FEBRUARY, 7), (2, FEBRUARY, 8)]
    assert content(spark, name) == [(9, MARCH, 1)]
    assert content(spark, name, snapshot=1) == seen[0]
    with pytest.raises(LookupError, match="no snapshot 9"):
        read_features(spark, name, snapshot=9)


@pytest.mark.parametrize("write", [merge_features, overwrite_features])
def test_a_write_of_two_months_is_seen_whole_or_not(spark, table, features, monkeypatch, write):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 5), (1, FEBRUARY, 7)), name)
    new = features((1, JANUARY, 6), (1, FEBRUARY, 8))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "write_once", lost)
        with pytest.raises(RuntimeError, match="lost"):
            write(new, name)
    assert content(spark, name) == [(1, JANUARY, 5), (1, FEBRUARY, 7)]
    with monkeypatch.context() as patched:
        patched.setattr(store, "_point", lost)
        with pytest.raises(RuntimeError, match="lost"):
            write(new, name)
    after = [(1, JANUARY, 6), (1, FEBRUARY, 8)]
    assert content(spark, name) == after
    repair_catalog(spark, name)
    assert rows_of(spark.table(name).select("zip", "ts", TRIPS)) == after


def test_logs_replace_by_key_in_their_order(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 1), (2, JANUARY, 1), (1, MARCH, 1)), name)
    for trips in (2, 3):
        merge_features(features((1, JANUARY, trips), (3, FEBRUARY, trips)), name, compact=False)
    expected = [(1, JANUARY, 3), (1, MARCH, 1), (2, JANUARY, 1), (3, FEBRUARY, 3)]
    assert content(spark, name) == sorted(expected, key=str)
    assert [s.month for s in latest(spark, name).of("log")] == ["2024-01", "2024-02"] * 2
    assert content(spark, name, start="2024-02-01") == [(1, MARCH, 1), (3, FEBRUARY, 3)]
    assert stored_rows(spark, name) == 7
    assert compact_features(spark, name, least_logs=3) == ()
    assert compact_features(spark, name, months=["2024-01"]) == ("2024-01",)
    assert compact_features(spark, name) == ("2024-02",)
    assert content(spark, name) == sorted(expected, key=str)
    assert rows_of(spark.table(name).select("zip", "ts", TRIPS)) == sorted(expected, key=str)
    assert not latest(spark, name).of("log") and stored_rows(spark, name) == 4


def test_merging_over_logs_keeps_the_newest(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 1), (2, JANUARY, 1)), name)
    merge_features(features((1, JANUARY, 2), (3, JANUARY, 2)), name, compact=False)
    merge_features(features((3, JANUARY, 4), (4, JANUARY, 4)), name)
    assert content(spark, name) == [(1, JANUARY, 2), (2, JANUARY, 1), (3, JANUARY, 4), (4, JANUARY, 4)]
    assert len(latest(spark, name).segments) == 1


@pytest.mark.parametrize("rows", [10, 20_000])
def test_what_a_batch_writes_does_not_grow_with_the_month(spark, table, features, rows):  # noqa: F811
    name = table()
    month = spark.range(rows).selectExpr(
        "cast(id AS int) AS zip", f"{JANUARY} AS ts", "'2024-01' AS yyyy_mm", f"1 AS {TRIPS}",
        "0 AS dropoff_is_weekend",
    )
    create_feature_table(month, name)
    old = {s.folder for s in latest(spark, name).segments}
    merge_features(features((1, JANUARY, 2)), name, compact=False)
    snapshot = latest(spark, name)
    assert old <= {s.folder for s in snapshot.segments}
    (new,) = (s for s in snapshot.segments if s.folder not in old)
    files = spark.read.parquet(f"{feature_table(spark, name).root}/{new.folder}").inputFiles()
    assert (new.rows, len(files)) == (1, 1)
    assert read_features(spark, name).count() == rows


def test_a_log_added_during_compaction_stays_on_top(spark, table, features, monkeypatch):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 1)), name)
    merge_features(features((1, JANUARY, 2), (2, JANUARY, 2)), name, compact=False)
    rewrite = store._rewrite

    def meanwhile(*args):
        out = rewrite(*args)
        merge_features(features((2, JANUARY, 9)), name, compact=False)
        return out

    with monkeypatch.context() as patched:
        patched.setattr(store, "_rewrite", meanwhile)
        assert compact_features(spark, name) == ("2024-01",)
    assert content(spark, name) == [(1, JANUARY, 2), (2, JANUARY, 9)]
    assert [s.kind for s in latest(spark, name).segments].count("log") == 1


def test_writers_at_once_lose_nothing(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features((0, JANUARY, 0)), name)
    tasks = [(zip_, zip_ % 2 == 0) for zip_ in range(1, 9)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: merge_features(features((t[0], JANUARY, t[0])), name, compact=t[1]), tasks))
    assert content(spark, name) == sorted(((k, JANUARY, k) for k in range(9)), key=str)


def test_two_compactions_of_a_month_conflict(spark, table, features, monkeypatch):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 1)), name)
    merge_features(features((1, JANUARY, 2)), name, compact=False)
    rewrite = store._rewrite

    def meanwhile(*args):
        out = rewrite(*args)
        monkeypatch.setattr(store, "_rewrite", rewrite)
        compact_features(spark, name)
        return out

    monkeypatch.setattr(store, "_rewrite", meanwhile)
    with pytest.raises(Conflict):
        compact_features(spark, name)
    assert content(spark, name) == [(1, JANUARY, 2)]


def test_old_folders_go_by_age(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features((1, JANUARY, 1)), name)
    for trips in (2, 3):
        merge_features(features((1, JANUARY, trips)), name)
    merge_features(features((2, FEBRUARY, 1)), name, compact=False)
    assert expire_features(spark, name) == 0
    assert content(spark, name, snapshot=1) == [(1, JANUARY, 1)]
    assert expire_features(spark, name, older_than=0) == 2
    assert content(spark, name) == [(1, JANUARY, 3), (2, FEBRUARY, 1)]
    with pytest.raises(LookupError):
        read_features(spark, name, snapshot=1)


def test_a_name_is_taken_once(spark):
    folder = fresh_path(spark, "names")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: write_once(spark, folder, "0001.json", str(k)), range(8)))
    assert sum(won) == 1
    assert [name for name, _ in snapshots.children(spark, folder)] == ["0001.json"]
    assert snapshots._text(spark, folder, "0001.json") == str(won.index(True))


def test_empty_tables_read_as_empty(spark, table):
    name = table()
    create_feature_table(spark.createDataFrame([], DROPOFF_FEATURES), name)
    assert read_features(spark, name).collect() == []
    assert read_features(spark, name).columns == spark.table(name).columns
    assert stored_rows(spark, name) == 0
