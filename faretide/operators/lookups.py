"""Feature lookups: left joins of trips to keyed feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions.times import as_time, epoch_seconds, month_of_epoch, time_literal
from faretide.operators.rows import Bound, given
from faretide.operators.store import bucketed_rows, primary_keys, read_features

# Most bytes a feature table may take, as counted rows of known width, to be
# sent to every executor. Beyond it the join shuffles both sides, or the trips' side alone if the
# table has a copy bucketed by its keys.
MAX_BROADCAST_BYTES = 128 << 20
# Rows of one key beyond which a bucketed lookup treats the key by itself.
HOT_ROWS = 20_000_000


@dataclass(frozen=True)
class FeatureLookup:
    """Features of one table and the columns that hold its primary keys.

    ``lookup_key`` is matched to the table's primary keys by position.
    """

    table_name: str
    feature_names: tuple[str, ...]
    lookup_key: tuple[str, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "feature_names", tuple(self.feature_names))
        object.__setattr__(self, "lookup_key", tuple(self.lookup_key))


PICKUP_TABLE = "fares.pickup_features"
DROPOFF_TABLE = "fares.dropoff_features"
# The column names that stored features and models go by.
PICKUP_NAMES = ("mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip")
DROPOFF_NAMES = ("count_trips_window_30m_dropoff_zip", "dropoff_is_weekend")
PICKUP_KEY = ("pickup_zip", "rounded_pickup_datetime")
DROPOFF_KEY = ("dropoff_zip", "rounded_dropoff_datetime")


def fare_lookups(
    pickup_table: str = PICKUP_TABLE, dropoff_table: str = DROPOFF_TABLE
) -> list[FeatureLookup]:
    """The two lookups of the fare model."""
    return [
        FeatureLookup(pickup_table, PICKUP_NAMES, PICKUP_KEY),
        FeatureLookup(dropoff_table, DROPOFF_NAMES, DROPOFF_KEY),
    ]


def fits_broadcast(features: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a stored table is proven small enough to broadcast.

    The proof is its row count, which Parquet answers from file footers,
    times a row width that must be fixed by the schema. Call it on stored
    tables only: on anything else the count runs the whole plan.
    """
    fixed_width = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not all(isinstance(field.dataType, fixed_width) for field in features.schema):
        return False
    # Twice the values' own width, for the row header and the hash table.
    row_bytes = 16 * (1 + len(features.columns))
    return features.count() * row_bytes <= max_bytes


def lookup_features(
    df: DataFrame,
    features: DataFrame,
    lookup_key: Sequence[str],
    feature_names: Sequence[str],
    keys: Sequence[str] = ("zip", "ts"),
    broadcast: bool = False,
    month_column: str | None = None,
) -> DataFrame:
    """``df`` with the named features added; NULL where there is no feature row.

    The features' keys are unique, so every row of ``df`` comes out once.
    Unless ``broadcast`` is asked for, Spark chooses the join when it runs
    and splits the tasks of hot keys (the ``df`` side of a left join can be
    split), NULL keys among them. For that, ``features`` must not come from
    an aggregate by the lookup's own keys; stored tables never do.

    ``month_column`` names the features' partition column, to be joined on
    as well: then a filter on ``df`` also prunes the months read. It costs
    a string key per row, so it is for selective inputs only.
    """
    right = features.select(
        *[F.col(key).alias(f"_key_{i}") for i, key in enumerate(keys)],
        *([F.col(month_column).alias("_key_month")] if month_column else []),
        *feature_names,
    )
    matches = [df[column] == right[f"_key_{i}"] for i, column in enumerate(lookup_key)]
    if month_column:
        # The last key is the window end, of which the month is a function.
        matches.append(month_of_epoch(df[lookup_key[-1]]) == right["_key_month"])
    dropped = [name for name in right.columns if name.startswith("_key_")]
    if broadcast:
        right = F.broadcast(right)
    return df.join(right, matches, "left").drop(*dropped)


def lookup_bucketed(
    df: DataFrame,
    features: DataFrame,
    lookup_key: Sequence[str],
    feature_names: Sequence[str],
    keys: Sequence[str] = ("zip", "ts"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``lookup_features`` in features that are bucketed by ``keys``, which stay where they are.

    A bucket is one task, which adaptive execution cannot split, so what would make one large is
    taken out: rows without a key get NULL features and join with nothing, and keys of more than
    ``hot_rows`` rows, which are ``rows / hot_rows`` at most, are counted first and joined to
    their features by broadcast.
    """
    columns = df.columns
    keyed = df.dropna(subset=list(lookup_key))
    types = dict(features.dtypes)
    missing = [F.lit(None).cast(types[name]).alias(name) for name in feature_names]
    no_key = F.lit(False)
    for column in lookup_key:
        no_key = no_key | F.col(column).isNull()
    out = df.where(no_key).select(*columns, *missing)
    hot = keyed.groupBy(*lookup_key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = hot.where(F.col("_rows") > hot_rows).select(*lookup_key).collect()
    if hot:
        spark = df.sparkSession
        kinds = ", ".join(f"`{k}` {types[k]}" for k in keys)
        few = F.broadcast(spark.createDataFrame([tuple(r) for r in hot], kinds))
        matches = [keyed[c] == few[k] for c, k in zip(lookup_key, keys, strict=True)]
        theirs = features.join(few, list(keys), "left_semi")
        part = keyed.join(few, matches, "left_semi")
        part = lookup_features(part, theirs, lookup_key, feature_names, keys, broadcast=True)
        out = out.unionByName(part.select(*columns, *feature_names))
        keyed = keyed.join(few, matches, "left_anti")
    # Spark would shuffle keys of another type, or the features if they were the smaller side.
    cast = {c: keyed[c].cast(types[k]) for c, k in zip(lookup_key, keys, strict=True)}
    keyed = keyed.withColumns({f"_look_{i}": c for i, c in enumerate(cast.values())})
    names = [f"_look_{i}" for i in range(len(cast))]
    joined = lookup_features(keyed, features, names, feature_names, keys)
    return out.unionByName(joined.select(*columns, *feature_names))


def apply_lookups(
    df: DataFrame,
    lookups: Sequence[FeatureLookup],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    prune_months: bool = False,
) -> DataFrame:
    """All lookups one after the other, each from its stored table."""
    spark = df.sparkSession
    for lookup in lookups:
        features = read_features(spark, lookup.table_name)
        keys = primary_keys(spark, lookup.table_name)
        needed = features.select(*keys, *lookup.feature_names)
        month = "yyyy_mm" if prune_months and "yyyy_mm" in features.columns else None
        small = not month and fits_broadcast(needed, max_broadcast_bytes)
        copy = None if small or month else bucketed_rows(spark, lookup.table_name)
        if copy is not None:
            copy = copy.select(*keys, *lookup.feature_names)
            df = lookup_bucketed(df, copy, lookup.lookup_key, lookup.feature_names, keys)
            continue
        df = lookup_features(
            df,
            features if month else needed,
            lookup.lookup_key,
            lookup.feature_names,
            keys,
            broadcast=small,
            month_column=month,
        )
    return df


@dataclass(frozen=True)
class TrainingSet:
    """Trips with the lookups, label and columns to leave out; lazy."""

    trips: DataFrame
    lookups: tuple[FeatureLookup, ...]
    label: str
    exclude_columns: tuple[str, ...] = ()
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES
    prune_months: bool = False

    def load_df(self) -> DataFrame:
        """The remaining trip columns, then the features, then the label."""
        joined = apply_lookups(
            self.trips, self.lookups, self.max_broadcast_bytes, self.prune_months
        )
        left_out = {self.label, *self.exclude_columns}
        columns = [name for name in joined.columns if name not in left_out]
        return joined.select(*columns, self.label)


def training_set(
    trips: DataFrame,
    lookups: Sequence[FeatureLookup],
    label: str = "fare_amount",
    exclude_columns: Sequence[str] = ("rounded_pickup_datetime", "rounded_dropoff_datetime"),
    **options: object,
) -> TrainingSet:
    """Describe a training set of rounded trips.

    The rounded times are left out by default because a model would overfit
    them. An off-boundary trip looks up a window it lies in, so its own fare
    is part of its mean fare; ``exclude_self`` takes it out again.
    """
    return TrainingSet(trips, tuple(lookups), label, tuple(exclude_columns), **options)


def exclude_self(
    df: DataFrame,
    ts_column: str = "tpep_pickup_datetime",
    start: Bound = None,
    end: Bound = None,
) -> DataFrame:
    """Take each trip's own fare out of its looked-up mean fare.

    ``df`` must hold the trip's pickup time and rounded time, its fare, and
    the looked-up mean, count and ``sum_fare_window_1h_pickup_zip`` columns.
    ``start`` and ``end`` are the range the features were computed from: a
    trip outside it is not part of any window. The mean becomes NULL for a
    trip that was alone. Trips are taken to have a fare.
    """
    # A trip on the quarter hour looks up the window that ends before it.
    inside = F.col("rounded_pickup_datetime") > epoch_seconds(df, ts_column)
    at = as_time(df, ts_column)
    if given(start):
        inside = inside & (at >= time_literal(df, ts_column, start))
    if given(end):
        inside = inside & (at < time_literal(df, ts_column, end))
    mean, trips = "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"
    others = (F.col("sum_fare_window_1h_pickup_zip") - F.col("fare_amount")) / (F.col(trips) - 1)
    without_self = F.when(F.col(trips) > 1, others).cast("float")
    return df.withColumn(mean, F.when(inside, without_self).otherwise(F.col(mean)))
