"""Feature tables kept by a stream from partial sums, with an account of every late row.

Each batch's trips are summed per zip and pane (a quarter hour for pickups, half an hour for
dropoffs), and the sums are added to the table's pane log. The windows that these panes lie in are
then recomputed from the log, of which only the part around the batch's times is read, and added
to the table's feature log. A batch is one commit: its panes, windows, late rows, watermark and
number become visible together, and a batch that is run again after a failure finds its number and
changes nothing. So the sums are state in the table itself, a row a zip and pane and batch instead
of one for each of a pickup's four windows, and what a batch writes and reads depends on the batch,
not on what the table holds. ``compact_panes`` and ``compact_features`` fold the logs by month.

The watermark is the latest trip of the earlier batches less ``delay``. A trip all of whose
windows had ended by then is late: it goes to the table's side table, with its batch, and does not
touch a window. ``backfill_late`` adds late trips to the sums and recomputes the windows they hit,
and those alone; afterwards the table is what a batch run over all trips gives.

Trips without a time or zip are in no window, and neither are they late.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from faretide.functions.times import epoch_seconds, month_of_epoch, weekend_flag
from faretide.operators import snapshots, store
from faretide.operators.snapshots import Segment, Snapshot
from faretide.operators.store import FeatureTable, WriteReport
from faretide.schemas import schema_of

_PANES = schema_of(
    "zip int, ts int, fares double, known_fares bigint, trips bigint, last bigint, yyyy_mm string"
)
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


@dataclass(frozen=True)
class Kind:
    """Which trips make a table: their zip and time, and seconds of a pane and of a window."""

    name: str
    zip_column: str
    ts_column: str
    pane: int
    window: int


KINDS = {
    "pickup": Kind("pickup", "pickup_zip", "tpep_pickup_datetime", 900, 3600),
    "dropoff": Kind("dropoff", "dropoff_zip", "tpep_dropoff_datetime", 1800, 1800),
}


def seconds_of(delay: str | timedelta) -> int:
    """``"90 minutes"`` in seconds."""
    if isinstance(delay, timedelta):
        return int(delay.total_seconds())
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", delay)
    if not found:
        raise ValueError(f"not a delay: {delay}")
    return int(found[1]) * _UNITS[found[2]]


def pane_sums(trips: DataFrame, kind: Kind, ts_column: str | None = None) -> DataFrame:
    """Trips summed per zip and pane; ``ts`` is the pane's start, ``last`` its latest trip."""
    at = epoch_seconds(trips, ts_column or kind.ts_column)
    rows = trips.select(
        F.col(kind.zip_column).cast("int").alias("zip"),
        at.alias("at"),
        F.col("fare_amount").cast("double").alias("fare"),
    )
    start = (F.col("at") - F.pmod("at", F.lit(kind.pane))).try_cast("int").alias("ts")
    return (
        rows.groupBy("zip", start)
        .agg(
            F.sum("fare").alias("fares"),
            F.count("fare").alias("known_fares"),
            F.count(F.lit(1)).alias("trips"),
            F.max("at").alias("last"),
        )
        .withColumn("yyyy_mm", month_of_epoch(F.col("ts")))
    )


def _ends(kind: Kind) -> Column:
    """The ends of the windows that a pane lies in."""
    ts = F.col("ts")
    return F.explode(F.sequence(ts + kind.pane, ts + kind.window, F.lit(kind.pane)))


def windows_of(panes: DataFrame, kind: Kind, only: DataFrame | None = None) -> DataFrame:
    """Features of the windows over pane sums, or of the ``(zip, ts)`` in ``only``."""
    parts = panes.withColumn("ts", _ends(kind))
    if only is not None:
        parts = parts.join(only, ["zip", "ts"], "left_semi")
    windows = parts.groupBy("zip", "ts").agg(
        F.sum("fares").alias("fares"),
        F.sum("known_fares").alias("known"),
        F.sum("trips").cast("int").alias("trips"),
    )
    windows = windows.withColumn("yyyy_mm", month_of_epoch(F.col("ts")))
    if kind.name == "pickup":
        mean = F.when(F.col("known") > 0, F.col("fares") / F.col("known")).cast("float")
        return windows.select(
            "zip", "ts", "yyyy_mm", mean.alias("mean_fare_window_1h_pickup_zip"),
            F.col("trips").alias("count_trips_window_1h_pickup_zip"),
        )
    windows = windows.withColumn("end", F.timestamp_seconds("ts"))
    return windows.select(
        "zip", "ts", "yyyy_mm", F.col("trips").alias("count_trips_window_30m_dropoff_zip"),
        weekend_flag(windows, "end").alias("dropoff_is_weekend"),
    )


# --- the table's companions ------------------------------------------------------------


def _panes_of(info: FeatureTable) -> FeatureTable:
    return replace(
        info, name=f"{info.name} panes", root=f"{info.root}/_panes", keys=("zip", "ts"),
        partition="yyyy_mm", schema=_PANES,
    )


def _inside(segments: Sequence[Segment]) -> list[Segment]:
    """Segments of panes, named from the table's folder or, the other way, from the panes' own."""
    named = all(s.folder.startswith("_panes/") for s in segments)
    name = (lambda f: f.removeprefix("_panes/")) if named else (lambda f: f"_panes/{f}")
    return [replace(s, folder=name(s.folder)) for s in segments]


def read_panes(
    spark: SparkSession, info: FeatureTable, segments: Sequence[Segment], low: int, high: int
) -> DataFrame:
    """Sums of panes that start in ``[low, high]``; other segments are not opened."""
    near = [s for s in segments if s.low <= high and s.high >= low]
    rows = store.read_segments(spark, _panes_of(info), _inside(near))
    return rows.where(F.col("ts").between(low, high)).drop(store._VERSION)


def _fold(
    spark: SparkSession,
    info: FeatureTable,
    kind: Kind,
    trips: DataFrame,
    snapshot: Snapshot,
    version: str,
    ts_column: str | None,
) -> tuple[list[Segment], WriteReport, int | None]:
    """Write the panes of some trips and the windows they change; also their latest time."""
    panes = _panes_of(info)
    sums = pane_sums(trips, kind, ts_column).select(*_PANES.names)
    written, report = store._write_new(sums, panes, version, "pane", check_unique=False)
    if not written:
        return [], report, None
    new = store.read_segments(spark, panes, written)
    last = new.agg(F.max("last")).first()[0]
    segments = [*snapshot.of("pane"), *_inside(written)]
    low, high = min(s.low for s in written), max(s.high for s in written)
    touched = new.select("zip", _ends(kind).alias("ts")).distinct()
    around = read_panes(spark, info, segments, low - kind.window, high + kind.window)
    changed = windows_of(around, kind, touched).select(*info.columns)
    windows, _ = store._write_new(changed, info, version, "log", check_unique=False)
    return [*_inside(written), *windows], report, last


# --- batches ---------------------------------------------------------------------------


def fold_batch(
    batch: DataFrame,
    number: int,
    table: str,
    kind: Kind,
    delay: int | None,
    ts_column: str | None = None,
    stream: str = "",
) -> Snapshot:
    """Add one batch of trips to the table, in one commit."""
    spark = batch.sparkSession
    info = store.feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    mine = f"batch:{stream}"
    if others := [m for m in snapshot.marks if m.startswith("batch:") and m != mine]:
        raise ValueError(f"{table} is kept by another stream: {others[0]}")
    if snapshot.marks.get(mine, -1) >= number:
        return snapshot
    version, watermark = snapshots.new_version(snapshot), snapshot.marks.get("watermark")
    at = epoch_seconds(batch, ts_column or kind.ts_column)
    added, on_time = [], batch
    if watermark is not None:
        ended = at - F.pmod(at, F.lit(kind.pane)) + kind.window <= watermark
        late = F.coalesce(ended & F.col(kind.zip_column).isNotNull(), F.lit(False))
        added = _write_late(batch.where(late), info, number, version)
        on_time = batch.where(~late) if added else batch
    segments, _, last = _fold(spark, info, kind, on_time, snapshot, version, ts_column)
    marks = {mine: number}
    if delay is not None and last is not None:
        marks["watermark"] = max(last - delay, watermark if watermark is not None else last - delay)
    return store._switch(spark, info, snapshot, [*added, *segments], (), marks)


def _write_late(late: DataFrame, info: FeatureTable, number: int, version: str) -> list[Segment]:
    spark, folder = late.sparkSession, f"_late/{store._VERSION}={version}"
    late.withColumn("batch", F.lit(number)).write.parquet(f"{info.root}/{folder}")
    rows = spark.read.parquet(f"{info.root}/{folder}").count()
    if rows:
        return [Segment("late", None, folder, version, rows)]
    snapshots.delete(spark, f"{info.root}/{folder}")
    return []


def stream_table(
    trips: DataFrame,
    table: str,
    kind: str,
    ts_column: str | None = None,
    delay: str | timedelta | None = "1 hour",
    checkpoint: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start keeping a feature table from a stream of trips.

    Without ``every`` what has arrived is processed and the query stops. Progress is kept with the
    table unless ``checkpoint`` names a folder. Sums are added, so a table takes batches from one
    checkpoint only. Without a ``delay`` nothing is late.
    """
    spark = trips.sparkSession
    folder = checkpoint or f"{store.table_folder(spark, table)}/_panes_stream"
    wait = None if delay is None else seconds_of(delay)

    def fold(batch: DataFrame, number: int) -> None:
        fold_batch(batch, number, table, KINDS[kind], wait, ts_column, folder)

    writer = trips.writeStream.foreachBatch(fold).option("checkpointLocation", folder)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


# --- late rows -------------------------------------------------------------------------


def late_trips(spark: SparkSession, table: str) -> DataFrame | None:
    """Late trips with their batch, and whether they were added since; None if there is none."""
    info = store.feature_table(spark, table)
    latest, out = snapshots.read_snapshot(spark, info.root), None
    for kind in ("late", "folded"):
        if found := latest.of(kind):
            rows = spark.read.parquet(*[f"{info.root}/{s.folder}" for s in found])
            rows = rows.withColumn("folded", F.lit(kind == "folded"))
            out = rows if out is None else out.unionByName(rows)
    return out


def late_count(spark: SparkSession, table: str) -> int:
    """How many trips came too late for the stream, from the commit alone."""
    info = store.feature_table(spark, table)
    return sum(s.rows for s in snapshots.read_snapshot(spark, info.root).of("late", "folded"))


def backfill_late(
    spark: SparkSession, table: str, kind: str, ts_column: str | None = None
) -> WriteReport:
    """Add the late trips to the table; only windows they lie in are computed again."""
    info = store.feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    late = snapshot.of("late")
    if not late:
        return WriteReport(0, 0, ())
    trips = spark.read.parquet(*[f"{info.root}/{s.folder}" for s in late])
    version = snapshots.new_version(snapshot)
    added, _, _ = _fold(spark, info, KINDS[kind], trips, snapshot, version, ts_column)
    folded = [replace(s, kind="folded") for s in late]
    # A stream that went on meanwhile read panes without these; its windows are not to win.
    panes = {s.folder for s in snapshot.of("pane")}
    busy = lambda latest: any(s.folder not in panes for s in latest.of("pane"))
    snapshots.commit(spark, info.root, snapshot, [*added, *folded], late, None, busy)
    windows = [s for s in added if s.kind == "log"]
    return WriteReport(sum(s.rows for s in windows), 0, tuple(s.month for s in windows))


def compact_panes(
    spark: SparkSession, table: str, months: Sequence[str] | None = None, least: int = 2
) -> tuple[str, ...]:
    """Add up the panes of months that have ``least`` segments of them."""
    info = store.feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    found = snapshot.of("pane", months=months)
    counts = {m: sum(s.month == m for s in found) for m in {s.month for s in found}}
    chosen = sorted(m for m, n in counts.items() if n >= least)
    if not chosen:
        return ()
    old, panes = snapshot.of("pane", months=chosen), _panes_of(info)
    sums = store.read_segments(spark, panes, _inside(old)).groupBy("zip", "ts", "yyyy_mm").agg(
        *[F.sum(name).alias(name) for name in ("fares", "known_fares", "trips")],
        F.max("last").alias("last"),
    )
    version = snapshots.new_version(snapshot)
    written, _ = store._write_new(sums.select(*_PANES.names), panes, version, "pane", False)
    snapshots.commit(spark, info.root, snapshot, _inside(written), old)
    return tuple(chosen)
