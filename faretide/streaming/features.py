"""Feature tables kept up to date by a stream of trips."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from faretide.functions.times import as_time, is_instant
from faretide.operators.store import merge_features, table_folder
from faretide.operators.windows import dropoff_features, pickup_features


def _with_event_time(trips: DataFrame, ts_column: str, delay: str | None) -> DataFrame:
    """Make the column an instant, which watermarks require, and mark it."""
    if not is_instant(trips, ts_column):
        # Read as UTC whatever the session's zone: microseconds since 1970.
        since = as_time(trips, ts_column) - F.expr("timestamp_ntz'1970-01-01'")
        seconds = since.cast("interval second").cast("decimal(18,6)")
        trips = trips.withColumn(ts_column, F.timestamp_seconds(seconds))
    return trips.withWatermark(ts_column, delay) if delay else trips


def stream_features(
    trips: DataFrame,
    kind: Literal["pickup", "dropoff"],
    ts_column: str | None = None,
    delay: str | None = "1 hour",
) -> DataFrame:
    """The windowed features of a stream of trips, in update mode.

    Trips later than ``delay`` are dropped (see ``late_rows``). Without a
    delay nothing is late, and the state of every window is kept for good.
    """
    ts_column = ts_column or f"tpep_{kind}_datetime"
    build = {"pickup": pickup_features, "dropoff": dropoff_features}[kind]
    return build(_with_event_time(trips, ts_column, delay), ts_column)


def merge_stream(
    features: DataFrame,
    table: str,
    checkpoint: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start merging streaming features into a feature table.

    Update mode emits each changed window whole, so merging by key gives the
    same table when a batch is replayed after a failure. A batch adds its rows
    to the logs of its months, so what it writes does not grow with what they
    hold (``compact_features`` folds logs into months and may run meanwhile);
    ``every`` sets the trigger interval. Without it, what has arrived is
    processed and the query stops. Progress is kept with the table unless
    ``checkpoint`` names a folder, so that a query started again goes on where
    the last one stopped.
    """
    folder = table_folder(features.sparkSession, table)
    checkpoint = checkpoint or f"{folder}/_stream"

    def merge(batch: DataFrame, _: int) -> None:
        merge_features(batch, table, check_unique=False, compact=False)

    writer = features.writeStream.outputMode("update").foreachBatch(merge)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as late in the query's recent batches.

    Counted after partial aggregation: late trips of one zip and window in
    one task count once.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
