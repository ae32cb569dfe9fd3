"""Profiles from monthly summaries, after writes of all kinds."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_store import FEBRUARY, JANUARY, MARCH, features  # noqa: F401

from faretide.operators.profile import DROPOFF_PLOT, boxplot_dropoff, describe_features
from faretide.operators.snapshots import read_snapshot
from faretide.operators.store import (
    compact_features,
    create_feature_table,
    feature_table,
    merge_features,
    overwrite_features,
    read_features,
)
from faretide.operators.summaries import refresh_summaries, stored_boxplot, stored_statistics


def rounded(df):
    names = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return rows_of(df.select(*[F.round(c, 6).alias(c) if c in names else c for c in sorted(df.columns)]))


def check(spark, name):
    rows = read_features(spark, name)
    assert rounded(stored_statistics(spark, name)) == rounded(describe_features(rows))
    assert rounded(stored_boxplot(spark, name, DROPOFF_PLOT)) == rounded(boxplot_dropoff(rows))


def test_profiles_follow_writes_and_read_touched_months_only(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(
        features(*[(z, t, z * 7 % 5) for z in range(30) for t in (JANUARY, FEBRUARY, MARCH)]), name
    )
    refresh = lambda: refresh_summaries(spark, name, [DROPOFF_PLOT])
    with pytest.raises(RuntimeError, match="without a summary"):
        stored_statistics(spark, name)
    assert refresh() == ("2024-01", "2024-02", "2024-03")
    check(spark, name)
    assert refresh() == ()
    merge_features(features((3, FEBRUARY, 40), (99, FEBRUARY, 41)), name)
    with pytest.raises(RuntimeError, match="2024-02"):
        stored_boxplot(spark, name, DROPOFF_PLOT)
    kept = {s.folder for s in read_snapshot(spark, feature_table(spark, name).root).of("summary") if s.month != "2024-02"}
    assert refresh() == ("2024-02",)
    check(spark, name)
    now = {s.folder for s in read_snapshot(spark, feature_table(spark, name).root).of("summary")}
    assert kept < now and len(now) == 3
    merge_features(features((3, MARCH, 400)), name, compact=False)
    assert refresh() == ("2024-03",)
    check(spark, name)
    compact_features(spark, name)
    assert refresh() == ("2024-03",)
    overwrite_features(features((1, JANUARY, 8), (2, JANUARY, None)), name)
    assert refresh() == ("2024-01",)
    check(spark, name)


def test_a_table_without_rows_has_an_empty_profile(spark, table, features):  # noqa: F811
    name = table()
    create_feature_table(features(), name)
    assert refresh_summaries(spark, name, [DROPOFF_PLOT]) == ()
    assert stored_statistics(spark, name).collect() == []
    assert stored_boxplot(spark, name, DROPOFF_PLOT).collect() == []
