"""Keyed feature tables: snapshots of folders of rows, partitioned by month.

A write puts its rows into new folders and then makes one commit that names all folders of all
months (see ``faretide.operators.snapshots``). ``read_features`` reads one commit, so it sees a
write whole or not at all, and what it reads stays until ``expire_features`` removes it by age.

A merge replaces rows by key. It rewrites the months it touches, or, with ``compact=False``, only
adds its rows to the months' logs, whatever the months hold: reads then take the newest row of
each key, and ``compact_features`` folds a log into its month when that suits. Streams write so.

Tables are plain Parquet unless another format is named, and are registered in the session's
catalog. After a commit the catalog's partitions are pointed at the new folders, a month at a
time, for readers of ``FROM table``; these do not see logs, nor several months at once. Where the
table's format has ``MERGE INTO``, merging uses that (no such format is installed here, so that
branch has not been run).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.functions.times import moment_of, month_of_epoch
from faretide.operators import snapshots
from faretide.operators.snapshots import Conflict, Segment, Snapshot
from faretide.session import stage

_MERGING_FORMATS = ("delta", "iceberg")
_MONTH, _VERSION = "yyyy_mm", "version"
#: The months of rows that are not stored: without a key, and ending after January 2038.
_NO_KEY, _BEYOND = "none", "beyond"
#: How often a write that another one got ahead of is made again.
_ATTEMPTS = 4
WEEK = 7 * 86_400


@dataclass(frozen=True)
class WriteReport:
    """What a write did: rows stored, rows without a key, months touched."""

    rows: int
    null_keys: int
    months: tuple[str, ...]


@dataclass(frozen=True)
class FeatureTable:
    """A table as the catalog has it."""

    name: str
    root: str
    provider: str
    keys: tuple[str, ...]
    partition: str | None
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def merges(self) -> bool:
        return self.provider in _MERGING_FORMATS


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def feature_table(spark: SparkSession, table: str) -> FeatureTable:
    """What the catalog says of a feature table, from one statement."""
    found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)} AS JSON").first()[0])
    keys = found.get("table_properties", {}).get("primary_keys")
    if keys is None:
        raise ValueError(f"{table} was not created as a feature table")
    partitions = found.get("partition_columns") or [None]
    return FeatureTable(
        table,
        found["location"].split(f"/{_VERSION}=")[0],
        found["provider"].lower(),
        tuple(json.loads(keys)),
        partitions[0],
        spark.table(table).schema,
    )


def table_folder(spark: SparkSession, table: str) -> str:
    """The folder under which all versions of the table's rows are kept."""
    return feature_table(spark, table).root


def primary_keys(spark: SparkSession, table: str) -> list[str]:
    """The keys the table was created with."""
    return list(feature_table(spark, table).keys)


# --- reading ---------------------------------------------------------------------------


def read_segments(spark: SparkSession, info: FeatureTable, segments: Sequence[Segment]) -> DataFrame:
    """Rows of some segments, with the version of each."""
    schema = T.StructType([*info.schema.fields, T.StructField(_VERSION, T.StringType())])
    if not segments:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", info.root).format(info.provider)
    return reader.load([f"{info.root}/{s.folder}" for s in segments])


def _newest(info: FeatureTable, logs: DataFrame) -> DataFrame:
    others = [c for c in info.columns if c not in info.keys]
    last = F.max_by(F.struct(*others), _VERSION).alias("last")
    return logs.groupBy(*info.keys).agg(last).select(*info.keys, "last.*").select(*info.columns)


def snapshot_rows(
    spark: SparkSession, info: FeatureTable, snapshot: Snapshot, months: Sequence[str | None] | None = None
) -> DataFrame:
    """The rows of a snapshot, each key once.

    Months without a log are read as they are. Of the others, the logs' newest rows are found, and
    rows of the month that they replace are left out; Spark sends the logs' keys to the month's
    tasks if they are few, and shuffles both otherwise.
    """
    base, logs = snapshot.of("base", months=months), snapshot.of("log", months=months)
    layered = {s.month for s in logs}
    plain = [s for s in base if s.month not in layered]
    rows = read_segments(spark, info, plain).select(*info.columns)
    if not logs:
        return rows
    newest = _newest(info, read_segments(spark, info, logs))
    under = read_segments(spark, info, [s for s in base if s.month in layered]).select(*info.columns)
    kept = under.join(newest.select(*info.keys), list(info.keys), "left_anti").select(*info.columns)
    layers = kept.unionByName(newest)
    return rows.unionByName(layers) if plain else layers


def read_features(
    spark: SparkSession,
    table: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    snapshot: int | None = None,
) -> DataFrame:
    """The table, or only the windows ending in ``[start, end)``.

    The rows are those of the latest commit, or of ``snapshot``, whatever is written until they
    are read. A bound prunes the months read as well as filtering on ``ts``.
    """
    info = feature_table(spark, table)
    if info.merges:
        spark.catalog.refreshTable(table)
        df = spark.table(table)
    else:
        df = snapshot_rows(spark, info, snapshots.read_snapshot(spark, info.root, snapshot))
    for bound, is_start in ((start, True), (end, False)):
        if not bound:
            continue
        moment = moment_of(bound).replace(tzinfo=timezone.utc)
        seconds, month = moment.timestamp(), moment.strftime("%Y-%m")
        if is_start:
            df = df.filter((F.col("yyyy_mm") >= month) & (F.col("ts") >= seconds))
        else:
            df = df.filter((F.col("yyyy_mm") <= month) & (F.col("ts") < seconds))
    return df


def stored_rows(spark: SparkSession, table: str) -> int | None:
    """At most how many rows a read gives, from the commit alone; None if it does not say."""
    info = feature_table(spark, table)
    if info.merges:
        return None
    latest = snapshots.read_snapshot(spark, info.root)
    return sum(s.rows for s in latest.of("base", "log"))


# --- writing ---------------------------------------------------------------------------


def _has_keys(info: FeatureTable) -> Column:
    has_keys = F.lit(True)
    for key in info.keys:
        has_keys = has_keys & F.col(key).isNotNull()
    return has_keys


def _check_schema(df: DataFrame, info: FeatureTable) -> None:
    stored = {f.name: f.dataType for f in info.schema}
    offered = {f.name: f.dataType for f in df.schema}
    if stored != offered:
        raise ValueError(f"{info.name} has columns {stored}, not {offered}")


def _save(df: DataFrame, info: FeatureTable, version: str) -> None:
    """Write rows to a folder of their own, which no other writer touches, by month."""
    order = [*([info.partition] if info.partition else []), *reversed(info.keys)]
    if info.partition:
        # Files of about the advisory size: large months are split over many
        # tasks and small ones share a task.
        df = df.hint("rebalance", info.partition)
    # A partitioned write sorts by partition anyway. With the last key, the
    # time, next, reads of a time range can skip parts of files.
    df = df.sortWithinPartitions(*order)
    writer = df.write.format(info.provider)
    if info.partition:
        writer = writer.partitionBy(info.partition)
    writer.save(f"{info.root}/{_VERSION}={version}")


def _folder(info: FeatureTable, month: str | None, version: str) -> str:
    own = f"{_VERSION}={version}"
    return f"{own}/{info.partition}={month}" if info.partition else own


def _measured(spark: SparkSession, info: FeatureTable, version: str, kind: str, months) -> list[Segment]:
    """Segments of what was written, with their rows and times as counted in the files."""
    found = [Segment(kind, m, _folder(info, m, version), version, 0) for m in months]
    if not found:
        return []
    rows = read_segments(spark, info, found)
    timed = "ts" in info.columns
    month = F.col(info.partition) if info.partition else F.lit(None).cast("string")
    counted = rows.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        *([F.min("ts").alias("low"), F.max("ts").alias("high")] if timed else []),
    )
    seen = {row["month"]: row.asDict() for row in counted.collect()}
    return [
        Segment(kind, s.month, s.folder, version, r["rows"], r.get("low"), r.get("high"))
        for s in found
        if (r := seen.get(s.month))
    ]


def _written(spark: SparkSession, info: FeatureTable, version: str) -> DataFrame:
    """All rows of a version, in whatever months; no other version's files are listed."""
    reader = spark.read.schema(info.schema).option("basePath", info.root).format(info.provider)
    return reader.load(f"{info.root}/{_VERSION}={version}")


def _write_new(
    df: DataFrame, info: FeatureTable, version: str, kind: str, check_unique: bool
) -> tuple[list[Segment], WriteReport]:
    """Write new rows once, as segments that no commit names yet, and check them as written.

    Rows without a key go to a folder of their own that is never named. Rows with a month but no
    time ended after January 2038, which an int of seconds cannot hold; they fail the write, as do
    rows in another month than their time's.
    """
    spark = df.sparkSession
    if not info.partition:
        stored = stage(df, "features")
        keyed = stored.filter(_has_keys(info))
        _save(keyed, info, version)
        segments, nulls = _measured(spark, info, version, kind, [None]), stored.filter(~_has_keys(info)).count()
        report = WriteReport(sum(s.rows for s in segments), nulls, ())
    else:
        beyond = F.col("ts").isNull() & F.col(info.partition).isNotNull()
        month = F.when(_has_keys(info), F.coalesce(info.partition, F.lit("")))
        month = F.coalesce(month, F.when(beyond, F.lit(_BEYOND)), F.lit(_NO_KEY))
        _save(df.withColumn(info.partition, month), info, version)
        placed = F.col(info.partition).isin(_BEYOND, _NO_KEY) | (
            F.col(info.partition) == month_of_epoch(F.col("ts"))
        )
        counted = _written(spark, info, version).groupBy(info.partition).agg(
            F.count(F.lit(1)).alias("rows"), F.min("ts").alias("low"), F.max("ts").alias("high"),
            F.count_if(~placed).alias("astray"),
        ).orderBy(F.desc("astray"), info.partition).limit(100_000).collect()
        by_month = {row[info.partition]: row for row in counted}
        none, late = by_month.pop(_NO_KEY, None), by_month.pop(_BEYOND, None)
        problem = None
        if late:
            problem = f"{late['rows']} rows end after January 2038"
        elif astray := sum(row["astray"] for row in by_month.values()):
            problem = f"{astray} rows are not in the month of their time"
        segments = [
            Segment(kind, m, _folder(info, m, version), version, r["rows"], r["low"], r["high"])
            for m, r in sorted(by_month.items())
        ]
        if problem or not segments:
            snapshots.delete(spark, f"{info.root}/{_VERSION}={version}")
        elif none:
            snapshots.delete(spark, f"{info.root}/{_folder(info, _NO_KEY, version)}")
        if problem:
            raise ValueError(problem)
        months = tuple(s.month for s in segments)
        report = WriteReport(sum(s.rows for s in segments), none["rows"] if none else 0, months)
    if check_unique and segments:
        rows = read_segments(spark, info, segments)
        twice = rows.groupBy(*info.keys).count().filter("count > 1").limit(1).collect()
        if twice:
            _drop_folders(spark, info, segments)
            raise ValueError(f"key appears more than once: {twice[0].asDict()}")
    return segments, report


def _drop_folders(spark: SparkSession, info: FeatureTable, segments: Sequence[Segment]) -> None:
    for version in {s.version for s in segments}:
        snapshots.delete(spark, f"{info.root}/{_VERSION}={version}")


def _switch(spark, info, read, added, removed, marks=None, replaced=()) -> Snapshot:
    """Make the commit: from here on the table is what it says.

    Months in ``replaced`` are made from what ``read`` has of them, so another writer's new base
    of one of them is a conflict; another's log stays on top.
    """
    bases = {s.folder for s in read.of("base")}

    def changed(latest: Snapshot) -> bool:
        now = latest.of("base", months=replaced) if replaced else []
        return any(s.folder not in bases for s in now)

    return snapshots.commit(spark, info.root, read, added, removed, marks, changed)


def _point(spark: SparkSession, info: FeatureTable, snapshot: Snapshot, months) -> None:
    """Point the catalog's partitions, or the table, at the bases of a snapshot."""
    table = _quoted(info.name)
    bases = {s.month: s for s in snapshot.of("base", months=months)}
    if not info.partition:
        for segment in bases.values():
            where = _text(f"{info.root}/{segment.folder}")
            spark.sql(f"ALTER TABLE {table} SET LOCATION {where}")
        spark.catalog.refreshTable(info.name)
        return
    stored = {
        row["partition"].split("=")[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }
    part = lambda month: f" PARTITION (`{info.partition}` = {_text(month)})"
    where = lambda month: f" LOCATION {_text(f'{info.root}/{bases[month].folder}')}"
    new = [month for month in sorted(bases) if month not in stored]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS" + "".join(part(m) + where(m) for m in new))
    for month in sorted(set(bases) & stored):
        spark.sql(f"ALTER TABLE {table}{part(month)} SET{where(month)}")
    for month in sorted(stored & set(months) - set(bases)):
        # Dropping a partition removes its folder, which readers of older commits may still need.
        spark.sql(f"ALTER TABLE {table}{part(month)} SET LOCATION {_text(f'{info.root}/_dropped')}")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS{part(month)}")
    spark.catalog.refreshTable(info.name)


def repair_catalog(spark: SparkSession, table: str) -> None:
    """Point the catalog at the latest commit, which a driver lost right after it did not."""
    info = feature_table(spark, table)
    latest = snapshots.read_snapshot(spark, info.root)
    stored = {None}
    if info.partition:
        rows = spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()
        stored = {row["partition"].split("=")[1] for row in rows}
    _point(spark, info, latest, stored | {s.month for s in latest.of("base")})


def create_feature_table(
    df: DataFrame,
    table: str,
    primary_keys: Sequence[str] = ("zip", "ts"),
    partition_column: str | None = "yyyy_mm",
    description: str = "",
    fmt: str = "parquet",
    location: str | None = None,
    check_unique: bool = True,
    staged: bool = False,
) -> WriteReport | None:
    """Create the table and fill it; do nothing when it exists and has rows.

    An existing table must have the same columns. One that was created but
    never filled, because its job was lost, is filled now. Rows are written once and checked as
    written, so ``staged`` input is read once like any other. Partitions are the months of ``ts``,
    which must be a key then: a key thereby lies in one of them.
    """
    spark = df.sparkSession
    info, exists = _ensure(
        df, table, primary_keys, partition_column, description, fmt, location
    )
    if info.merges:
        if exists and not spark.table(table).isEmpty():
            return None
        return _merge_into(df, info, check_unique)
    snapshot = snapshots.read_snapshot(spark, info.root)
    if snapshot.of("base", "log"):
        return None
    segments, report = _write_new(df, info, snapshots.new_version(snapshot), "base", check_unique)
    try:
        latest = _switch(spark, info, snapshot, segments, (), None, report.months or (None,))
    except Conflict:
        # Another job has filled it meanwhile.
        _drop_folders(spark, info, segments)
        return None
    _point(spark, info, latest, report.months or (None,))
    return report


def _ensure(
    df: DataFrame, table: str, keys: Sequence[str] = ("zip", "ts"),
    partition: str | None = _MONTH, description: str = "", fmt: str = "parquet",
    location: str | None = None,
) -> tuple[FeatureTable, bool]:
    """The table, registered for ``df``'s columns if it is not there, and whether it was."""
    spark = df.sparkSession
    if partition not in (None, _MONTH) or (partition and "ts" not in keys):
        raise ValueError(f"tables are partitioned by {_MONTH}, the month of the key ts, or not")
    if "." in table:
        create_database(spark, table.rsplit(".", 1)[0])
    exists = spark.catalog.tableExists(table)
    if not exists:
        columns = [f for f in df.schema if f.name != partition]
        columns += [f for f in df.schema if f.name == partition]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(
            f"CREATE TABLE {_quoted(table)} ({ddl}) USING {fmt}"
            + (f" PARTITIONED BY (`{partition}`)" if partition else "")
            + (f" LOCATION {_text(location)}" if location else "")
            + f" COMMENT {_text(description)}"
            + f" TBLPROPERTIES ('primary_keys' = {_text(json.dumps(list(keys)))})"
        )
    info = feature_table(spark, table)
    _check_schema(df, info)
    return info, exists


def put_features(df: DataFrame, table: str, description: str = "") -> DataFrame:
    """Create the table or merge into it, and return the new rows as they are stored.

    Rows are written once. A table that has none takes them as its months' rows, and another one
    as logs, which are folded into the months they touch.
    """
    spark = df.sparkSession
    info, _ = _ensure(df, table, description=description)
    if info.merges:
        rows = stage(df, "features")
        _merge_into(rows, info, check_unique=False)
        return rows
    snapshot = snapshots.read_snapshot(spark, info.root)
    kind = "log" if snapshot.of("base", "log") else "base"
    segments, report = _write_new(df, info, snapshots.new_version(snapshot), kind, False)
    if kind == "base":
        try:
            latest = _switch(spark, info, snapshot, segments, (), None, report.months)
            _point(spark, info, latest, report.months)
            return read_segments(spark, info, segments).select(*info.columns)
        except Conflict:
            # Another job has filled it meanwhile, and these rows go on top.
            segments = [replace(s, kind="log") for s in segments]
    if segments:
        _switch(spark, info, snapshots.read_snapshot(spark, info.root), segments, ())
        compact_features(spark, table, months=report.months)
    return read_segments(spark, info, segments).select(*info.columns)


def merge_features(
    df: DataFrame,
    table: str,
    check_unique: bool = True,
    staged: bool = False,
    compact: bool = True,
    marks: dict[str, int] | None = None,
) -> WriteReport:
    """Insert new keys and replace the rows of known ones.

    Only the months of the new rows are read and rewritten; a row's month
    follows from its key, so no other month can hold the key. With ``compact=False`` nothing is
    read or rewritten: the new rows are added to their months' logs. ``marks`` are numbers to
    remember in the commit, which then is made even if there are no rows.
    """
    spark = df.sparkSession
    info = feature_table(spark, table)
    _check_schema(df, info)
    if info.merges:
        return _merge_into(df, info, check_unique)
    snapshot = snapshots.read_snapshot(spark, info.root)
    logs, report = _write_new(df, info, snapshots.new_version(snapshot), "log", check_unique)
    if not logs and not marks:
        return report
    if not compact or not logs:
        _switch(spark, info, snapshot, logs, (), marks)
        return report
    months = [s.month for s in logs]
    for attempt in range(_ATTEMPTS):
        snapshot = snapshots.read_snapshot(spark, info.root)
        version = snapshots.new_version(snapshot)
        with_new = Snapshot(snapshot.number, (*snapshot.segments, *_on_top(logs, version)))
        added = _rewrite(spark, info, with_new, months, version)
        try:
            latest = _switch(spark, info, snapshot, added, snapshot.of("base", "log", months=months),
                             marks, months)
        except Conflict:
            _drop_folders(spark, info, added)
            if attempt + 1 == _ATTEMPTS:
                raise
            continue
        _drop_folders(spark, info, logs)
        _point(spark, info, latest, months)
        return report
    raise AssertionError


def _on_top(logs: Sequence[Segment], version: str) -> list[Segment]:
    return [Segment("newest", s.month, s.folder, version, s.rows, s.low, s.high) for s in logs]


def _rewrite(spark, info, snapshot: Snapshot, months, version: str) -> list[Segment]:
    """Write what a snapshot has of some months, with rows "newest" on top, as new bases."""
    rows = snapshot_rows(spark, info, snapshot, months)
    if newest := snapshot.of("newest"):
        new = read_segments(spark, info, newest).select(*info.columns)
        kept = rows.join(new.select(*info.keys), list(info.keys), "left_anti")
        rows = kept.select(*info.columns).unionByName(new)
    _save(rows, info, version)
    return _measured(spark, info, version, "base", months)


def compact_features(
    spark: SparkSession, table: str, least_logs: int = 1, months: Sequence[str] | None = None
) -> tuple[str, ...]:
    """Fold the logs of months that have ``least_logs`` of them into their rows.

    Runs beside writers: logs added meanwhile stay on top. Returns the months rewritten.
    """
    info = feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    logs = snapshot.of("log", months=months)
    counts = {m: sum(s.month == m for s in logs) for m in {s.month for s in logs}}
    chosen = sorted((m for m, n in counts.items() if n >= least_logs), key=str)
    if not chosen:
        return ()
    added = _rewrite(spark, info, snapshot, chosen, snapshots.new_version(snapshot))
    removed = snapshot.of("base", "log", months=chosen)
    latest = _switch(spark, info, snapshot, added, removed, None, chosen)
    _point(spark, info, latest, chosen)
    return tuple(str(m) for m in chosen)


def expire_features(spark: SparkSession, table: str, older_than: float = WEEK) -> int:
    """Remove folders that no commit of the last ``older_than`` seconds names.

    Reads that began on an older commit must have ended. Returns how many folders were removed.
    """
    info = feature_table(spark, table)
    copies = [f"_by_key/{name}" for name, _ in snapshots.children(spark, f"{info.root}/_by_key")]
    return snapshots.expire(spark, info.root, older_than, ("", "_panes", "_late", "_summaries", "_values", *copies))


def bucket_features(spark: SparkSession, table: str, buckets: int | None = None) -> int:
    """Store the rows a second time, bucketed and sorted by key, for lookups that shuffle.

    A lookup in a table too large to broadcast then moves its own rows only. The copy serves until
    the table changes. ``buckets`` is by default one for each 4 million rows, and at least Spark's
    number of shuffle partitions, so that joins keep the copy's partitions. Returns their number.
    """
    info = feature_table(spark, table)
    snapshot = snapshots.read_snapshot(spark, info.root)
    rows = snapshot_rows(spark, info, snapshot)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = sum(s.rows for s in snapshot.of("base", "log"))
    buckets = buckets or min(max(least, -(-count // 4_000_000)), 100_000)
    version = snapshots.new_version(snapshot)
    folder = f"_by_key/buckets={buckets}/{_VERSION}={version}"
    # A write by buckets goes through the catalog. Bucketing first leaves a file a bucket.
    name = f"{info.name}_{version.split('-')[1]}"
    (
        rows.repartition(buckets, *info.keys)
        .write.bucketBy(buckets, *info.keys).sortBy(*info.keys)
        .format(info.provider).option("path", f"{info.root}/{folder}").saveAsTable(_quoted(name))
    )
    spark.sql(f"DROP TABLE {_quoted(name)}")
    copy = Segment("by_key", None, folder, version, count)
    snapshots.commit(spark, info.root, snapshot, [copy], snapshot.of("by_key"))
    return buckets


def bucketed_rows(spark: SparkSession, table: str) -> DataFrame | None:
    """The bucketed copy, if there is one of the table's rows as they are now."""
    info = feature_table(spark, table)
    latest = snapshots.read_snapshot(spark, info.root)
    copies = latest.of("by_key")
    # A copy's number is above those of all rows that it was made from.
    number = lambda s: int(s.version.split("-")[0])
    if not copies or any(number(s) >= number(copies[0]) for s in latest.of("base", "log")):
        return None
    buckets = copies[0].folder.split("/")[1].split("=")[1]
    name = f"{info.name}_{snapshots.new_version(latest).split('-')[1]}"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in info.schema)
    keys = ", ".join(f"`{key}`" for key in info.keys)
    spark.sql(
        f"CREATE TABLE {_quoted(name)} ({ddl}) USING {info.provider} CLUSTERED BY ({keys}) "
        f"SORTED BY ({keys}) INTO {buckets} BUCKETS "
        f"LOCATION {_text(f'{info.root}/{copies[0].folder}')}"
    )
    rows = spark.table(name)
    # The name served to tell Spark of the buckets; the files belong to the commit.
    spark.sql(f"DROP TABLE {_quoted(name)}")
    return rows


def overwrite_features(df: DataFrame, table: str, check_unique: bool = True) -> WriteReport:
    """Replace all rows of the table.

    A failing computation leaves the old rows in place.
    """
    spark = df.sparkSession
    info = feature_table(spark, table)
    _check_schema(df, info)
    if info.merges:
        df.select(*info.columns).write.insertInto(info.name, overwrite=True)
        return WriteReport(df.count(), 0, ())
    snapshot = snapshots.read_snapshot(spark, info.root)
    segments, report = _write_new(df, info, snapshots.new_version(snapshot), "base", check_unique)
    for attempt in range(_ATTEMPTS):
        removed = snapshot.of("base", "log")
        months = {s.month for s in (*removed, *segments)}
        try:
            latest = _switch(spark, info, snapshot, segments, removed, None, tuple(months))
        except Conflict:
            if attempt + 1 == _ATTEMPTS:
                raise
            snapshot = snapshots.read_snapshot(spark, info.root)
            continue
        _point(spark, info, latest, months)
        return report
    raise AssertionError


def _merge_into(df: DataFrame, info: FeatureTable, check_unique: bool) -> WriteReport:
    """The merge of a format that has one."""
    spark, stored = df.sparkSession, stage(df, "features")
    clean = stored.filter(_has_keys(info))
    if check_unique:
        twice = clean.groupBy(*info.keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"key appears more than once: {twice[0].asDict()}")
    same = " AND ".join(f"t.`{key}` = s.`{key}`" for key in info.keys)
    months = ()
    if info.partition:
        months = tuple(sorted(r[0] for r in clean.select(info.partition).distinct().collect()))
        listed = ", ".join(_text(month) for month in months)
        same += f" AND t.`{info.partition}` = s.`{info.partition}`"
        same += f" AND t.`{info.partition}` IN ({listed})" if months else ""
    spark.sql(
        f"MERGE INTO {_quoted(info.name)} t USING {{new}} s ON {same} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
        new=clean,
    )
    rows = clean.count()
    return WriteReport(rows, stored.count() - rows, months)


def write_features(df: DataFrame, table: str, mode: str = "merge", **stream_options: str):
    """Write batch or streaming features; a stream can only be merged."""
    if df.isStreaming:
        from faretide.streaming.features import merge_stream

        if mode != "merge":
            raise ValueError("a stream can only be merged")
        return merge_stream(df, table, **stream_options)
    if mode == "merge":
        return merge_features(df, table)
    if mode == "overwrite":
        return overwrite_features(df, table)
    raise ValueError(f"unknown mode: {mode}")
