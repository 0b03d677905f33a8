"""The wifi feed as a stream: ingest, new users, attendance and presence refresh.

Every batch is written with insert-if-absent or by replacing whole date partitions, so a
batch that is run again after a failure leaves the same tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall import schemas
from rollcall.functions import clock
from rollcall.operators.joins import only_new
from rollcall.plans import loads, presence
from rollcall.session import stored
from rollcall.sources.sinks import append, drop_partitions, exists, replace_partitions

WIFI_KEY = ["DateKey", "TimeKey", "UserKey"]
LECTURE = ["LectureID", "SubgroupKey"]
LEDGER = "File string, Modified timestamp, FirstTime timestamp_ntz, Batch string"


@dataclass(frozen=True)
class FeedTables:
    """Folders of the tables the feed keeps; all below one shared root."""

    root: str

    @property
    def users(self) -> str:
        return f"{self.root}/dim_user"

    @property
    def wifi(self) -> str:
        return f"{self.root}/fact_wifi"

    @property
    def attendance(self) -> str:
        return f"{self.root}/attendance"

    @property
    def presence(self) -> str:
        return f"{self.root}/presence"

    @property
    def open_lectures(self) -> str:
        return f"{self.root}/open_lectures"

    @property
    def loaded_files(self) -> str:
        return f"{self.root}/loaded_files"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A parquet table; empty while nothing has been written."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def read_feed(
    spark: SparkSession, path: str, ddl: str = schemas.WIFI_FEED, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of landed feed files."""
    reader = spark.readStream.schema(ddl)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def touched_dates(rows: DataFrame) -> list[int]:
    """Dates in a batch: at most one value per calendar day comes to the driver."""
    return sorted(r[0] for r in rows.select("DateKey").distinct().collect())


def ingest(batch: DataFrame, tables: FeedTables) -> list[int]:
    """Add the users and connections of one batch that the tables lack; returns its dates.

    History is read for the dates of the batch only.
    """
    spark = batch.sparkSession
    rows = batch.select("UserName", "DateKey", "TimeKey").distinct().persist()
    try:
        users = read_table(spark, tables.users, schemas.DIM_USER)
        append(loads.new_users(rows, users), tables.users)
        users = read_table(spark, tables.users, schemas.DIM_USER)
        dates = touched_dates(rows)
        history = read_table(spark, tables.wifi, schemas.FACT_WIFI).where(F.col("DateKey").isin(dates))
        append(only_new(loads.wifi_fact(rows, users), history, WIFI_KEY), tables.wifi, ["DateKey"])
        return dates
    finally:
        rows.unpersist()


def open_schema(lectures: DataFrame) -> str:
    kind = lambda c: f"{c} {lectures.schema[c].dataType.simpleString()}"
    return ", ".join(kind(c) for c in [*LECTURE, "UntilTimeKey", "DateKey"])


def register_lectures(tables: FeedTables, lectures: DataFrame) -> None:
    """Put the lectures that have no final count yet on the list of open ones.

    Call it when a timetable is loaded; the first refresh does it by itself.  Only here are all
    counted lectures read.  Registering a lecture again changes nothing.
    """
    spark = lectures.sparkSession
    kind = open_schema(lectures)
    counted = read_table(spark, tables.attendance, f"{kind}, UserCount bigint").where("UserCount IS NOT NULL")
    listed = read_table(spark, tables.open_lectures, kind)
    fresh = lectures.select(*LECTURE, "UntilTimeKey", "DateKey").distinct()
    append(only_new(only_new(fresh, counted, LECTURE), listed, LECTURE), tables.open_lectures, ["DateKey"])


def due_dates(tables: FeedTables, lectures: DataFrame, now: Column) -> list[int]:
    """Dates with a finished lecture on the list of open ones: lectures without a final count.

    The list holds what is still to come and little else, whatever the history, and is pruned to the dates
    up to now.
    """
    listed = read_table(lectures.sparkSession, tables.open_lectures, open_schema(lectures))
    return touched_dates(listed.where(clock.finished("DateKey", "UntilTimeKey", now)))


def close_lectures(tables: FeedTables, lectures: DataFrame, dates: list[int], now: Column) -> None:
    """Take the lectures of these dates that are over off the list; they have their final count.

    Run again after a failure it does the same; if it fails before, its dates are due again.
    """
    spark = lectures.sparkSession
    listed = read_table(spark, tables.open_lectures, open_schema(lectures)).where(F.col("DateKey").isin(dates))
    # a date at a time is small: the rows are written before their partitions are replaced
    left = stored(listed.where(~clock.finished("DateKey", "UntilTimeKey", now)), "open")
    stay = touched_dates(left)
    replace_partitions(left, tables.open_lectures, ["DateKey"])
    drop_partitions(spark, tables.open_lectures, "DateKey", [d for d in dates if d not in stay])


def refresh_attendance(
    tables: FeedTables,
    lectures: DataFrame,
    bridge: DataFrame,
    subgroups: DataFrame,
    dates: list[int],
    now: Column,
    grace_minutes: int = 15,
    rooms: DataFrame | None = None,
) -> None:
    """Recompute the lectures of the given dates and all that are due.

    Counts are null until a lecture is over.  A finished lecture without a count, on whatever
    date and with or without connections, is recomputed too, so a batch after its end makes it
    final.  Those are kept in a list of open lectures (``register_lectures``), so a batch reads the list and
    the dates that it changes, not the history.  ``now`` is the time of this batch.  With ``rooms`` the
    occupancy follows.
    """
    spark = lectures.sparkSession
    if not exists(spark, tables.open_lectures):
        register_lectures(tables, lectures)
    dates = sorted({*dates, *due_dates(tables, lectures, now)})
    wifi = read_table(spark, tables.wifi, schemas.FACT_WIFI).where(F.col("DateKey").isin(dates))
    users = read_table(spark, tables.users, schemas.DIM_USER)
    due = lectures.where(F.col("DateKey").isin(dates))
    filled = presence.refresh_attendance(due, wifi, bridge, users, subgroups, now, grace_minutes)
    if rooms is not None:
        filled = presence.refresh_occupancy(filled, rooms)
    replace_partitions(filled, tables.attendance, ["DateKey"])
    close_lectures(tables, lectures, dates, now)


def refresh_presence(tables: FeedTables, bridge: DataFrame, subgroups: DataFrame, dates: list[int]) -> None:
    """Distinct users per time step and subgroup for the given dates."""
    spark = bridge.sparkSession
    wifi = read_table(spark, tables.wifi, schemas.FACT_WIFI).where(F.col("DateKey").isin(dates))
    replace_partitions(presence.presence_by_minute(wifi, bridge, subgroups), tables.presence, ["DateKey"])


def start_feed(
    feed: DataFrame,
    tables: FeedTables,
    step_seconds: int = 300,
    source_timezone: str | None = "UTC",
    after_batch=None,
    late_after: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the feed into the tables.

    ``after_batch(dates)`` is called with the dates of each batch, also where a batch brings none;
    take the time of a refresh inside it, since it runs once for each batch.  Duplicates are removed
    per batch and against the history, which keeps every late row.  ``late_after`` adds a
    state store that removes duplicates earlier, and drops rows later than that.
    """
    points = loads.wifi_points(feed, step_seconds=step_seconds, source_timezone=source_timezone)
    if late_after:
        at = F.col("timestamp").cast("timestamp")
        points = (
            loads.wifi_points(feed.withColumn("_at", at), step_seconds=step_seconds, source_timezone=source_timezone, keep=["_at"])
            .withWatermark("_at", late_after)
            .dropDuplicatesWithinWatermark(["UserName", "DateKey", "TimeKey"])
            .drop("_at")
        )

    def run(batch: DataFrame, _epoch: int) -> None:
        dates = ingest(batch, tables)
        if after_batch:
            after_batch(dates)

    writer = points.writeStream.foreachBatch(run).option("checkpointLocation", tables.checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "15 minutes"})).start()


def backfill(feed: DataFrame, tables: FeedTables, **options) -> list[int]:
    """Load a folder of old files into the same tables; running it twice adds nothing."""
    return ingest(loads.wifi_points(feed, **options), tables)


def pending_files(spark: SparkSession, path: str, tables: FeedTables, ddl: str = schemas.WIFI_FEED, glob: str = "*.parquet") -> DataFrame:
    """``File, Modified, FirstTime`` of the files that the ledger lacks, or has with an older time of change."""
    files = spark.read.schema(ddl).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(path)
    found = files.groupBy(F.col("_metadata.file_path").alias("File"), F.col("_metadata.file_modification_time").alias("Modified")).agg(
        F.min(F.col("timestamp").cast("timestamp_ntz")).alias("FirstTime"))
    return only_new(found, read_table(spark, tables.loaded_files, LEDGER), ["File", "Modified"])


def backfill_folder(
    spark: SparkSession, path: str, tables: FeedTables, ddl: str = schemas.WIFI_FEED, files_per_batch: int = 100, after_batch=None, **options
) -> list[int]:
    """Load a folder of old files in batches of neighbouring dates; returns the dates of the batches run.

    A ledger names the loaded files.  Each batch adds its rows and then its lines of the ledger: a run that
    ends in between is taken up at the batch that it didn't finish, whose rows are added only where they
    are absent, and files of finished batches aren't read again.  Files are taken in the order of their first
    connection, so the history that a batch is compared with is that of its few dates.  The names of pending
    files come to the driver, which lists the folder anyway.  ``after_batch(dates)`` follows each batch, before its ledger lines.
    """
    pending = [r.File for r in pending_files(spark, path, tables, ddl).orderBy("FirstTime", "File").select("File").collect()]
    seen: set[int] = set()
    for start in range(0, len(pending), files_per_batch):
        names = pending[start:start + files_per_batch]
        rows = spark.read.schema(ddl).parquet(*names)
        # taken before the rows are read: a file that changes meanwhile is loaded again
        listed = stored(rows.groupBy(F.col("_metadata.file_path").alias("File"), F.col("_metadata.file_modification_time").alias("Modified")).agg(
            F.min(F.col("timestamp").cast("timestamp_ntz")).alias("FirstTime")).withColumn("Batch", F.lit(uuid.uuid4().hex)), "ledger")
        dates = ingest(loads.wifi_points(rows, **options), tables)
        if after_batch:
            after_batch(dates)
        append(listed.coalesce(1), tables.loaded_files)
        seen.update(dates)
    return sorted(seen)
