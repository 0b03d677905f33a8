"""Head counts from words of members, the list of open lectures and the resumable backfill."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.functions import clock
from rollcall.plans import heads, presence
from rollcall.sources import sinks
from rollcall.streaming import feed
from tests.conftest import rows
from tests.test_feed import land, seen

KIND = "LectureID bigint, DateKey int, FromTimeKey int, UntilTimeKey int, SubgroupKey bigint"


def second(t):
    return t // 10000 * 3600 + t // 100 % 100 * 60 + t % 100


def test_counts_equal_users_counted_one_by_one(spark):
    """One subgroup has most of the members and windows begin and end at any second."""
    r = random.Random(3)
    members = sorted({(r.choice([1, 1, 1, 2, 3]), 10_000_019 * u) for u in range(400)} | {(2, 5), (None, 6), (3, None)}, key=str)
    wifi = [(20240101 + r.randrange(3), r.randrange(8, 19) * 10000 + r.randrange(60) * 100 + r.randrange(60), 10_000_019 * r.randrange(450)) for _ in range(4000)]
    windows = sorted({(r.choice([1, 2, 3, 9]), 20240101 + r.randrange(4), a, a + r.randrange(-100, 9000)) for a in r.choices(range(28000, 66000), k=150)})
    spans = spark.createDataFrame(windows, "SubgroupKey bigint, DateKey int, _from bigint, _until bigint").withColumns({"a": F.col("_from"), "b": F.col("_until")})
    bridge = spark.createDataFrame([(u, s) for s, u in members], schemas.BRIDGE)
    numbered = heads.numbered_members(bridge, "SubgroupKey")
    keys = ["SubgroupKey", "DateKey", "a", "b"]
    got = heads.heads_in_spans(spans, keys, spark.createDataFrame(wifi + wifi[:50], "DateKey int, TimeKey int, UserKey bigint"), numbered, "SubgroupKey", "n")
    own = {}
    for s, u in members:
        own.setdefault(s, set()).add(u)
    expected = {}
    for s, d, a, b in windows:
        users = {u for day, t, u in wifi if day == d and a <= second(t) <= b} & own.get(s, set())
        if users:
            expected[s, d, a, b] = len(users)
    assert {tuple(x[k] for k in keys): x.n for x in got.collect()} == expected


def test_members_are_numbered_densely(spark):
    bridge = spark.createDataFrame([(u * 977, u % 2) for u in range(200)] * 2, schemas.BRIDGE)
    numbered = heads.numbered_members(bridge, "SubgroupKey")
    words = numbered.groupBy("SubgroupKey", "_word").agg(F.count(F.lit(1)).alias("n"), F.bit_count(F.bit_or("_bit")).alias("bits"))
    assert rows(words.select("SubgroupKey", "_word", "n", "bits")) == [(0, 0, 64, 64), (1, 0, 64, 64), (0, 1, 36, 36), (1, 1, 36, 36)] or \
        sorted((x.SubgroupKey, x._word, x.n, x.bits) for x in words.collect()) == [(0, 0, 64, 64), (0, 1, 36, 36), (1, 0, 64, 64), (1, 1, 36, 36)]


def test_large_groups_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(heads, "PART", 256)
    bridge = spark.createDataFrame([(u * 31, 1 if u % 5 else 2) for u in range(3000)], schemas.BRIDGE)
    numbered = heads.numbered_members(bridge, "SubgroupKey")
    places = numbered.groupBy("SubgroupKey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_word", "_bit").alias("places"), F.count_distinct("_word").alias("words"))
    assert sorted((x.SubgroupKey, x.n, x.places) for x in places.collect()) == [(1, 2400, 2400), (2, 600, 600)]
    # each part of a group has one word that isn't full at most
    assert all(x.words <= x.n / 64 + 2 + x.n / 256 for x in places.collect())


def test_presence_counts_users_once(spark):
    wifi = spark.createDataFrame([(20240101, 90000, 1), (20240101, 90000, 1), (20240101, 90000, 2), (20240101, 90500, 2)], "DateKey int, TimeKey int, UserKey bigint")
    bridge = spark.createDataFrame([(1, 7), (2, 7), (2, 7), (2, 8)], schemas.BRIDGE)
    subgroups = spark.createDataFrame([(7, "A", "P")], schemas.DIM_SUBGROUP)
    out = presence.presence_by_minute(wifi, bridge, subgroups)
    assert sorted((x.TimeKey, x.SubgroupKey, x.SubgroupCode, x.PresentStudents) for x in out.collect()) == [
        (90000, 7, "A", 2), (90000, 8, None, 1), (90500, 7, "A", 1), (90500, 8, None, 1)]


# --- open lectures ---------------------------------------------------------------------


@pytest.fixture
def term(spark, tmp_path):
    lectures = spark.createDataFrame([(i, 20251101 + i, 81500, 101500, 1) for i in range(1, 25)], KIND)
    return feed.FeedTables(str(tmp_path)), lectures, spark.createDataFrame([(1, 1)], schemas.BRIDGE), spark.createDataFrame([(1, "A", "P")], schemas.DIM_SUBGROUP)


def refresh(spark, term, day, now, name="enc_a"):
    tables, lectures, bridge, subgroups = term
    dates = feed.ingest(spark.createDataFrame([(name, day, 90000)] if name else [], "UserName string, DateKey int, TimeKey int"), tables)
    feed.refresh_attendance(tables, lectures, bridge, subgroups, dates, F.lit(now).cast("timestamp_ntz"))


def open_ids(spark, tables):
    # no partition is left where all lectures are final
    return sorted(r.LectureID for r in feed.read_table(spark, tables.open_lectures, KIND).collect())


def test_the_list_of_open_lectures_shrinks(spark, term):
    """What is listed are lectures still to come; a batch reads those and its dates, however many are final."""
    tables = term[0]
    refresh(spark, term, 20251110, "2025-11-10 09:30:00")
    assert open_ids(spark, tables) == list(range(9, 25))
    refresh(spark, term, 20251110, "2025-11-10 10:15:00", None)
    assert open_ids(spark, tables) == list(range(10, 25))
    counted = {r.LectureID: r.UserCount for r in spark.read.parquet(tables.attendance).collect()}
    assert counted == {i: 0 for i in range(1, 9)} | {9: 1}
    before = feed.due_dates(tables, term[1], F.lit("2025-11-11 00:00:00").cast("timestamp_ntz"))
    assert before == []
    plan = spark.read.parquet(tables.open_lectures).where(clock.finished("DateKey", "UntilTimeKey", F.lit("2025-11-11 00:00:00").cast("timestamp_ntz")))
    assert "PartitionFilters: [" in plan._jdf.queryExecution().executedPlan().toString()


def test_new_lectures_are_registered(spark, term):
    tables, lectures, bridge, subgroups = term
    refresh(spark, term, 20251103, "2025-11-30 00:00:00")
    assert open_ids(spark, tables) == []
    more = lectures.unionByName(spark.createDataFrame([(77, 20251105, 81500, 101500, 1), (78, 20251220, 81500, 101500, 1)], KIND))
    feed.register_lectures(tables, more)
    feed.register_lectures(tables, more)
    assert open_ids(spark, tables) == [77, 78]
    refresh(spark, (tables, more, bridge, subgroups), 20251103, "2025-11-30 00:15:00", None)
    assert open_ids(spark, tables) == [78]
    assert spark.read.parquet(tables.attendance).where("LectureID = 77").first().UserCount == 0


def test_a_batch_that_failed_before_closing_is_due_again(spark, term, monkeypatch):
    tables = term[0]
    monkeypatch.setattr(feed, "close_lectures", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        refresh(spark, term, 20251103, "2025-11-04 00:00:00")
    monkeypatch.undo()
    assert open_ids(spark, tables) == list(range(1, 25))
    refresh(spark, term, 20251103, "2025-11-04 00:00:00")
    assert open_ids(spark, tables) == list(range(3, 25))
    assert {r.LectureID: r.UserCount for r in spark.read.parquet(tables.attendance).collect()} == {1: 0, 2: 1}


# --- backfill --------------------------------------------------------------------------


def land_days(spark, path, days):
    for d in days:
        land(spark, path, [(f"enc_{u}", f"2025-11-{d:02d} {8 + u:02d}:00:00", "eduroam") for u in range(3)])


def test_a_killed_backfill_goes_on(spark, tmp_path):
    """Killed after the rows of a batch are written and before its ledger lines, then started again: the same tables as in one go."""
    path = str(tmp_path / "landed")
    land_days(spark, path, [5, 3, 4, 1, 2])
    whole, resumed = feed.FeedTables(str(tmp_path / "whole")), feed.FeedTables(str(tmp_path / "resumed"))
    options = {"source_timezone": None, "files_per_batch": 2}
    assert feed.backfill_folder(spark, path, whole, **options) == [20251101 + i for i in range(5)]
    batches = []

    def die(dates):
        batches.append(dates)
        if len(batches) == 2:
            raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        feed.backfill_folder(spark, path, resumed, after_batch=die, **options)
    assert batches == [[20251101, 20251102], [20251103, 20251104]]
    assert spark.read.parquet(resumed.loaded_files).count() == 2
    assert feed.backfill_folder(spark, path, resumed, after_batch=batches.append, **options) == [20251103, 20251104, 20251105]
    assert batches[2:] == [[20251103, 20251104], [20251105]]
    assert seen(spark, resumed) == seen(spark, whole)
    # nothing is left to load, until a file comes in
    assert feed.backfill_folder(spark, path, resumed, **options) == []
    land_days(spark, path, [9])
    assert feed.backfill_folder(spark, path, resumed, **options) == [20251109]


def test_partitions_are_dropped_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1, 1), (2, 2)], "a int, DateKey int"), path, ["DateKey"])
    sinks.drop_partitions(spark, path, "DateKey", [2, 3])
    sinks.drop_partitions(spark, path, "DateKey", [2])
    assert rows(spark.read.parquet(path)) == [(1, 1)]
    assert sinks.exists(spark, path) and not sinks.exists(spark, path + "x")
