"""Profiles of a stored feature table that follow its writes.

Each month has a summary beside its rows: counts, means, squared deviations and bounds of every
column, and how often each value of a box plot occurs. Summaries of months add up to those of the
table, so after a write only the months it touched are read again, and the profile of the table
comes from the summaries. A month's summary is younger than its rows, or it is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.operators import snapshots
from faretide.operators.profile import boxplot_of, value_counts
from faretide.operators.snapshots import Segment, Snapshot
from faretide.operators.store import FeatureTable, feature_table, snapshot_rows

#: A box plot: the column that groups, and the measures.
Plot = tuple[str, Sequence[str]]

_MOMENTS = (
    "column_name string, value_count long, mean double, squares double, min_value double, "
    "max_value double, min_text string, max_text string, position int"
)
_VALUES = "plot string, measure int, group_value double, value double, n long"


def _number(segment: Segment) -> int:
    return int(segment.version.split("-")[0])


def stale_months(snapshot: Snapshot) -> list[str]:
    """Months whose rows are as young as their summary, or that have none."""
    rows: dict[str, int] = {}
    for segment in snapshot.of("base", "log"):
        rows[segment.month] = max(rows.get(segment.month, 0), _number(segment))
    made = {s.month: _number(s) for s in snapshot.of("summary")}
    return sorted(m for m, number in rows.items() if made.get(m, -1) <= number)


def _moments(rows: DataFrame, month: str) -> DataFrame:
    """A row a month and column, from one aggregate."""
    measures = []
    for position, field in enumerate(rows.schema):
        value, is_number = F.col(field.name), isinstance(field.dataType, T.NumericType)
        if not is_number and not isinstance(field.dataType, T.StringType):
            continue
        number = value.cast("double") if is_number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if is_number else value
        measures.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(value).alias("value_count"),
                F.avg(number).alias("mean"),
                (F.var_pop(number) * F.count(number)).alias("squares"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
                F.min(text).alias("min_text"),
                F.max(text).alias("max_text"),
                F.lit(position if is_number else 1000 + position).alias("position"),
            )
        )
    by_month = rows.withColumn("_month", F.col(month)).groupBy("_month")
    found = by_month.agg(F.array(*measures).alias("columns"))
    return found.select(F.col("_month").alias(month), F.inline("columns"))


def refresh_summaries(spark: SparkSession, table: str, plots: Sequence[Plot] = ()) -> tuple[str, ...]:
    """Summarise the months that were written since; returns them, and reads no others."""
    info = feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    months = stale_months(snapshot)
    if not months:
        return ()
    rows = snapshot_rows(spark, info, snapshot, months)
    version = snapshots.new_version(snapshot)
    found = {"_summaries": _moments(rows, info.partition)}
    for group, measures in plots:
        counted = value_counts(rows, group, measures, info.partition).withColumn("plot", F.lit(group))
        part = found.get("_values")
        found["_values"] = counted if part is None else part.unionByName(counted)
    added = []
    for folder, kind in (("_summaries", "summary"), ("_values", "values")):
        if folder in found:
            where = f"{folder}/version={version}"
            found[folder].write.partitionBy(info.partition).parquet(f"{info.root}/{where}")
            added += [Segment(kind, m, f"{where}/{info.partition}={m}", version, 0) for m in months]
    old = snapshot.of("summary", "values", months=months)
    snapshots.commit(spark, info.root, snapshot, added, old)
    return tuple(months)


def _read(spark: SparkSession, info: FeatureTable, kind: str, schema: str) -> DataFrame:
    latest = snapshots.read_snapshot(spark, info.root)
    if stale := stale_months(latest):
        raise RuntimeError(f"{info.name} has months without a summary: {stale}")
    live = {s.month for s in latest.of("base", "log")}
    folders = [f"{info.root}/{s.folder}" for s in latest.of(kind) if s.month in live]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def stored_statistics(spark: SparkSession, table: str) -> DataFrame:
    """``describe_features`` of the whole table, from its months' summaries."""
    parts = _read(spark, feature_table(spark, table), "summary", _MOMENTS)
    total = parts.groupBy("column_name").agg(
        (F.sum(F.col("mean") * F.col("value_count")) / F.sum("value_count")).alias("center")
    )
    # Squares around the table's mean: those around each month's, and the months' own distance.
    apart = F.col("squares") + F.col("value_count") * F.pow(F.col("mean") - F.col("center"), 2)
    count = F.sum("value_count")
    return (
        parts.join(total, "column_name")
        .groupBy("column_name", "position")
        .agg(
            count.alias("value_count"),
            F.first("center").alias("mean"),
            F.when(count > 1, F.sqrt(F.sum(apart) / (count - 1))).alias("stddev"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.min("min_text").alias("min_text"),
            F.max("max_text").alias("max_text"),
        )
        .orderBy("position")
        .drop("position")
    )


def stored_boxplot(spark: SparkSession, table: str, plot: Plot) -> DataFrame:
    """``boxplot_stats`` of the whole table, from its months' counted values."""
    group, measures = plot
    values = _read(spark, feature_table(spark, table), "values", _VALUES)
    counted = values.where(F.col("plot") == group).groupBy("measure", "group_value", "value")
    return boxplot_of(counted.agg(F.sum("n").alias("n")), measures)
