"""The feed as a stream, run to completion over landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.attendance_queries import DOM_03_SQL, OVER
from rollcall.catalogue.registry import query
from rollcall.catalogue.views import CTES, r9
from rollcall.functions import clock
from rollcall.plans import loads
from rollcall.session import scratch_path
from rollcall.sources.sinks import append
from rollcall.streaming import feed as stream

CTES.setdefault("feed_keys", """
SELECT DISTINCT username AS UserName, CAST(strftime(t, '%Y%m%d') AS INTEGER) AS DateKey, CAST(strftime(t, '%H%M%S') AS INTEGER) AS TimeKey
FROM (SELECT username, make_timestamp(CAST(round_even(epoch_us(timezone('Europe/Brussels', timezone('UTC', timestamp))) / 300000000.0, 0) AS BIGINT) * 300000000) AS t FROM wifi_feed WHERE ssid = 'eduroam')""")
_KEYS = "SELECT UserName, DateKey, TimeKey FROM feed_keys"


def _landed(v, copies: int = 1, rows=None) -> str:
    path = scratch_path(v.spark, "landed")
    for _ in range(copies):
        (v.wifi_feed if rows is None else rows).write.mode("append").parquet(path)
    return path


def _tables(v, users=None) -> stream.FeedTables:
    tables = stream.FeedTables(scratch_path(v.spark, "feed"))
    if users is not None:
        append(users, tables.users)
    return tables


def _run(v, tables, copies: int = 1, files_per_batch: int = 2, rows=None, **options) -> None:
    landed = stream.read_feed(v.spark, _landed(v, copies, rows), files_per_batch=files_per_batch)
    stream.start_feed(landed, tables, trigger={"availableNow": True}, **options).awaitTermination()


def _named(v, tables):
    wifi, users = v.spark.read.parquet(tables.wifi), v.spark.read.parquet(tables.users)
    return wifi.join(users, "UserKey").select("UserName", "DateKey", "TimeKey")


@query("str_01_feed_ingest", _KEYS)
def str_01(v):
    tables = _tables(v)
    _run(v, tables)
    return _named(v, tables)


@query("str_02_feed_without_duplicates", _KEYS)
def str_02(v):
    tables = _tables(v)
    _run(v, tables, copies=2)
    return _named(v, tables)


@query("str_02_feed_with_state", _KEYS)
def str_02_state(v):
    tables = _tables(v)
    _run(v, tables, copies=2, late_after="60 days")
    return _named(v, tables)


@query("str_03_new_users", """
SELECT count(*) AS Users, count(DISTINCT UserKey) AS Keys, max(UserKey) - (SELECT max(UserKey) FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!') AS Added
FROM (SELECT UserKey FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!' UNION ALL
      SELECT row_number() OVER () + (SELECT max(UserKey) FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!')
      FROM (SELECT DISTINCT UserName FROM feed_keys WHERE UserName NOT IN (SELECT UserName FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!')))""")
def str_03(v):
    old = v.users.where(F.col("UserName").startswith("u_"))
    tables = _tables(v, old)
    _run(v, tables)
    last = old.agg(F.max("UserKey").alias("m")).select("m").scalar()
    return v.spark.read.parquet(tables.users).agg(
        F.count(F.lit(1)).alias("Users"), F.count_distinct("UserKey").alias("Keys"), F.max("UserKey").alias("_max")
    ).select("Users", "Keys", (F.col("_max") - last).alias("Added"))


# every fifth date has no connections: its lectures become due and are final without any
_FEED_DAYS = DOM_03_SQL.replace("c.DateKey = l.DateKey", "c.DateKey = l.DateKey AND c.DateKey % 5 <> 0")


@query("str_04_attendance_refresh", f"""
SELECT x.*, {r9("CASE WHEN Capacity > 0 THEN CAST(UserCount AS DOUBLE) / Capacity END")} AS OccupancyRate
FROM ({_FEED_DAYS} WHERE f.DateKey % 5 <> 0 OR f.DateKey IN (SELECT f.DateKey FROM fact_base f WHERE {OVER})) x LEFT JOIN dim_room r ON r.RoomKey = x.RoomKey""")
def str_04(v):
    tables = _tables(v, v.users)
    day, _ = clock.rounded_keys("timestamp", 60)

    def refresh(dates):
        stream.refresh_attendance(tables, v.fact_base, v.bridge, v.subgroups, dates, v.now, rooms=v.rooms)

    _run(v, tables, rows=v.wifi_feed.where(day % 5 != 0), step_seconds=60, source_timezone=None, after_batch=refresh)
    return v.spark.read.parquet(tables.attendance)


@query("str_05_presence_buckets", """
SELECT k.DateKey, k.TimeKey, b.SubgroupKey, s.SubgroupCode, count(DISTINCT u.UserKey) AS PresentStudents FROM feed_keys k JOIN dim_user u ON u.UserName = k.UserName
JOIN bridge b ON b.UserKey = u.UserKey LEFT JOIN dim_subgroup s ON s.SubgroupKey = b.SubgroupKey GROUP BY ALL""")
def str_05(v):
    tables = _tables(v, v.users)
    refresh = lambda dates: stream.refresh_presence(tables, v.bridge, v.subgroups, dates)
    _run(v, tables, after_batch=refresh)
    return v.spark.read.parquet(tables.presence)


@query("str_06_backfill", _KEYS)
def str_06(v):
    """Half of the files come as a stream, all are loaded from the folder in batches, and once more."""
    tables, path = _tables(v), _landed(v, copies=2)
    _run(v, tables, rows=v.wifi_feed.where(F.dayofmonth("timestamp") < 15))
    for _ in range(2):
        stream.backfill_folder(v.spark, path, tables, files_per_batch=1, step_seconds=300, source_timezone="UTC")
    return _named(v, tables)
