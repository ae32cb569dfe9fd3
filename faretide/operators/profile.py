"""Profiles of a feature table as tables: shape, statistics, box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.session import stage

_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def shape_profile(df: DataFrame, name: str) -> DataFrame:
    """One row: the table's name, row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def null_keys(trips: DataFrame) -> DataFrame:
    """One row: trips that windows or lookups leave out, by missing column."""
    columns = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_zip", "dropoff_zip")
    return trips.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def describe_features(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of each column.

    One row per numeric or string column, from a single aggregate over the
    table. Text minima and maxima have columns of their own, so that the
    numbers stay numbers.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    measures = []
    for name in numeric + text:
        value = F.col(name)
        is_number = name in numeric
        number = value.cast("double") if is_number else F.lit(None).cast("double")
        string = F.lit(None).cast("string") if is_number else value
        measures.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(value).alias("value_count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
                F.min(string).alias("min_text"),
                F.max(string).alias("max_text"),
            )
        )
    return df.agg(F.array(*measures).alias("columns")).select(F.inline("columns"))


def value_counts(df: DataFrame, group: str, measures: Sequence[str], *by: str) -> DataFrame:
    """How often each value occurs, per measure and group (and the columns ``by``).

    Measures are numbered from 1, which shuffles less than their names.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(number).alias("measure"), F.col(name).cast("double").alias("value"))
            for number, name in enumerate(measures, start=1)
        ]
    )
    return (
        df.select(*by, F.col(group).cast("double").alias("group_value"), F.inline(pairs))
        .dropna(subset=["group_value", "value"])
        .groupBy(*by, "measure", "group_value", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _sliced(counted: DataFrame) -> DataFrame:
    """Counted values in value order.

    ``slice`` numbers the range partitions. Sampling for the ranges sees
    (measure, group, value) rows, so a group with many values is spread over
    many slices, while a value that occurs often is a single row.
    """
    sliced = counted.repartitionByRange("measure", "group_value", "value").withColumn(
        "slice", F.spark_partition_id()
    )
    # Slice numbers must be the same for every later reader.
    return stage(sliced, "frequencies")


def _quartiles(values: DataFrame, held: DataFrame) -> DataFrame:
    """Exact interpolated quartiles per measure and group.

    ``held``, the number of rows per slice, tells which slices hold the wanted ranks; only
    those, at most six per group, are read again and ranked. No task sees
    more than one slice of a group.
    """
    group = ["measure", "group_value"]
    whole = Window.partitionBy(*group)
    slices = held.withColumn("total", F.sum("held").over(whole)).withColumn(
        "upto", F.sum("held").over(whole.orderBy("slice"))
    )
    position = {name: (F.col("total") - 1) * share for name, share in _QUARTILES.items()}
    ranks = F.array(
        *[
            F.struct(
                F.lit(f"{name}_{side}").alias("wanted"), rounded(at).cast("bigint").alias("rank")
            )
            for name, at in position.items()
            for side, rounded in (("low", F.floor), ("high", F.ceil))
        ]
    )
    # rank counts from 0; a slice holds the ranks [upto - held, upto).
    here = F.filter(
        ranks, lambda r: (r["rank"] >= F.col("upto") - F.col("held")) & (r["rank"] < F.col("upto"))
    )
    needed = slices.select(
        *group, "slice", "total", (F.col("upto") - F.col("held")).alias("before"),
        here.alias("ranks"),
    ).filter(F.size("ranks") > 0)
    running = Window.partitionBy(*group, "slice").orderBy("value")
    found = (
        values.join(needed, [*group, "slice"])
        .withColumn("last", F.col("before") + F.sum("n").over(running) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
        .select(*group, "total", "value", "first", "last", F.inline("ranks"))
        .filter(F.col("rank").between(F.col("first"), F.col("last")))
    )

    def wanted(name: str):
        return F.max(F.when(F.col("wanted") == name, F.col("value")))

    quartiles = []
    for name, share in _QUARTILES.items():
        at = (F.max("total") - 1) * share
        low, high = wanted(f"{name}_low"), wanted(f"{name}_high")
        quartiles.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return found.groupBy(*group).agg(*quartiles)


def boxplot_stats(df: DataFrame, group: str, measures: Sequence[str]) -> DataFrame:
    """The numbers of a box plot of each measure against ``group``.

    Quartiles are exact and interpolated; whiskers are the outermost values
    within 1.5 interquartile ranges of the box; values beyond them are
    counted as outliers. NULLs are left out.
    """
    return boxplot_of(value_counts(df, group, measures), measures)


def boxplot_of(counted: DataFrame, measures: Sequence[str]) -> DataFrame:
    """:func:`boxplot_stats` of values that are counted already."""
    keys = ["measure", "group_value"]
    values = _sliced(counted)
    held = values.groupBy(*keys, "slice").agg(F.sum("n").alias("held"))
    # Each slice gets its group's box: joining by slice, no task takes the
    # values of a whole group.
    boxes = held.select(*keys, "slice").join(_quartiles(values, held), keys)
    boxed = values.join(boxes, [*keys, "slice"])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    stats = boxed.groupBy(*keys, "q1", "median", "q3").agg(
        F.sum("n").alias("row_count"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
    )
    names = F.array(*[F.lit(name) for name in measures])
    return stats.withColumn("measure", F.element_at(names, F.col("measure")))


#: Of each box plot the group and the measures: mean fare and trip count against trip count, and
#: trip count and weekend flag against weekend flag.
PICKUP_PLOT = (
    "count_trips_window_1h_pickup_zip",
    ("mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"),
)
DROPOFF_PLOT = (
    "dropoff_is_weekend",
    ("count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"),
)


def boxplot_pickup(features: DataFrame) -> DataFrame:
    return boxplot_stats(features, *PICKUP_PLOT)


def boxplot_dropoff(features: DataFrame) -> DataFrame:
    return boxplot_stats(features, *DROPOFF_PLOT)


def rides_by_weekend(features: DataFrame) -> DataFrame:
    """Trips per weekend flag, windows without a flag left out."""
    return (
        features.filter(F.col("dropoff_is_weekend").isNotNull())
        .groupBy("dropoff_is_weekend")
        .agg(F.sum("count_trips_window_30m_dropoff_zip").alias("num_rides"))
        .select("num_rides", "dropoff_is_weekend")
    )
