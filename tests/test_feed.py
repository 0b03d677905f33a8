"""The feed over several small batches."""

from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.plans import presence
from rollcall.streaming import feed
from tests.conftest import rows


def land(spark, path, data):
    df = spark.createDataFrame(data, "username string, t string, ssid string")
    df.select("username", F.col("t").cast("timestamp_ntz").alias("timestamp"), "ssid").coalesce(1).write.mode("append").parquet(path)


def run(spark, path, tables, **options):
    stream = feed.read_feed(spark, path, files_per_batch=1)
    feed.start_feed(stream, tables, trigger={"availableNow": True}, **options).awaitTermination()


def seen(spark, tables):
    wifi, users = spark.read.parquet(tables.wifi), spark.read.parquet(tables.users)
    return rows(wifi.join(users, "UserKey").select("UserName", "DateKey", "TimeKey"))


def test_feed_ingests_once(spark, tmp_path):
    path, tables = str(tmp_path / "landed"), feed.FeedTables(str(tmp_path / "tables"))
    land(spark, path, [("enc_a", "2025-10-26 00:30:00", "eduroam"), ("enc_a", "2025-10-26 01:30:00", "eduroam"), ("enc_z", "2025-10-26 00:30:00", "gast")])
    run(spark, path, tables)
    # both are 02:30 on the local clock, the guest network does not count
    assert seen(spark, tables) == [(20251026, 23000, "enc_a")]
    land(spark, path, [("enc_b", "2025-11-24 22:58:00", "eduroam"), ("enc_a", "2025-10-26 00:31:00", "eduroam"), (None, "2025-10-26 00:31:00", "eduroam")])
    run(spark, path, tables)
    run(spark, path, tables)
    assert seen(spark, tables) == [(20251026, 23000, "enc_a"), (20251125, 0, "enc_b")]
    assert rows(spark.read.parquet(tables.users)) == [(1, "enc_a"), (2, "enc_b")]


def test_a_batch_run_twice_changes_nothing(spark, tmp_path):
    tables = feed.FeedTables(str(tmp_path))
    batch = spark.createDataFrame([("enc_a", 20251124, 90000), ("enc_b", 20251124, 90000)], "UserName string, DateKey int, TimeKey int")
    assert feed.ingest(batch, tables) == [20251124]
    before = seen(spark, tables)
    feed.ingest(batch, tables)
    assert seen(spark, tables) == before


def test_attendance_follows_the_feed(spark, tmp_path):
    tables = feed.FeedTables(str(tmp_path))
    bridge = spark.createDataFrame([(1, 1), (2, 1)], schemas.BRIDGE)
    subgroups = spark.createDataFrame([(1, "A", "P")], schemas.DIM_SUBGROUP)
    lectures = spark.createDataFrame([(1, 20251124, 81500, 101500, 1), (2, 20251125, 81500, 101500, 1)], "LectureID bigint, DateKey int, FromTimeKey int, UntilTimeKey int, SubgroupKey bigint")

    def step(name, day, now):
        batch = spark.createDataFrame([(name, day, 90000)], "UserName string, DateKey int, TimeKey int")
        dates = feed.ingest(batch, tables)
        feed.refresh_attendance(tables, lectures, bridge, subgroups, dates, F.lit(now).cast("timestamp_ntz"))
        feed.refresh_presence(tables, bridge, subgroups, dates)
        return {r.LectureID: r.UserCount for r in spark.read.parquet(tables.attendance).collect()}

    assert step("enc_a", 20251124, "2025-11-24 09:30:00") == {1: None}
    assert step("enc_b", 20251124, "2025-11-24 10:15:00") == {1: 2}
    assert step("enc_a", 20251125, "2025-11-25 12:00:00") == {1: 2, 2: 1}
    assert spark.read.parquet(tables.presence).count() == 2


def test_due_lectures_become_final_without_connections(spark, tmp_path):
    tables = feed.FeedTables(str(tmp_path))
    bridge = spark.createDataFrame([(1, 1)], schemas.BRIDGE)
    subgroups = spark.createDataFrame([(1, "A", "P")], schemas.DIM_SUBGROUP)
    rooms = spark.createDataFrame([(7, 4)], "RoomKey bigint, Capacity int")
    kind = "LectureID bigint, DateKey int, FromTimeKey int, UntilTimeKey int, SubgroupKey bigint, RoomKey bigint"
    lectures = spark.createDataFrame([(1, 20251124, 81500, 101500, 1, 7), (2, 20251125, 81500, 101500, 1, 7), (3, 20251128, 81500, 101500, 1, 7)], kind)

    def step(name, day, now):
        batch = spark.createDataFrame([(name, day, 90000)] if name else [], "UserName string, DateKey int, TimeKey int")
        dates = feed.ingest(batch, tables)
        feed.refresh_attendance(tables, lectures, bridge, subgroups, dates, F.lit(now).cast("timestamp_ntz"), rooms=rooms)
        return {r.LectureID: (r.UserCount, r.OccupancyRate) for r in spark.read.parquet(tables.attendance).collect()}

    # running in the first batch, final in the next one, which has no rows of that date
    assert step("enc_a", 20251124, "2025-11-24 09:30:00") == {1: (None, None)}
    assert step(None, None, "2025-11-24 11:00:00") == {1: (1, 0.25)}
    # a date without any connection ends at 0
    assert step("enc_a", 20251126, "2025-11-26 09:30:00") == {1: (1, 0.25), 2: (0, 0.0)}


def test_cohorts_cover_every_user(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 2), (3, 1)], schemas.BRIDGE)
    pairs, sizes = presence.cohorts(bridge)
    assert rows(sizes) == [("1", 1), ("1,2", 2)]
    assert pairs.count() == 3
