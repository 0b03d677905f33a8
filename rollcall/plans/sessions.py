"""From timetable blocks to sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions import clock
from rollcall.operators.aggregates import distinct_list, distinct_texts
from rollcall.operators.windows import bounded_sessions, island_sessions

MAX_BREAK_MINUTES = 30
MIN_SESSION_MINUTES = 210
MAX_SESSION_MINUTES = 300


def with_times(schedule: DataFrame) -> DataFrame:
    """Date and start / end second of the day from the integer keys."""
    return schedule.withColumns({
        "FullDate": clock.key_date("DateKey"),
        "StartSecond": clock.key_seconds("FromTimeKey"),
        "EndSecond": clock.key_seconds("UntilTimeKey"),
    })


def time_blocks(schedule: DataFrame, keys: list[str]) -> DataFrame:
    return schedule.select(*keys, "StartSecond", "EndSecond").distinct()


def _shape(sessions: DataFrame) -> DataFrame:
    """Duration, wall-clock bounds, weekly slot and ISO week of each session."""
    return sessions.withColumns({
        "SessionDurationMinutes": clock.minutes_between("SessionStartSecond", "SessionEndSecond"),
        "SessionStart": clock.at_second("FullDate", "SessionStartSecond"),
        "SessionEnd": clock.at_second("FullDate", "SessionEndSecond"),
        "WeekdayNumber": clock.weekday_number("FullDate"),
        "WeekdayName": clock.weekday_name("FullDate"),
        "SessionStartTime": clock.hhmm("SessionStartSecond"),
        "SessionEndTime": clock.hhmm("SessionEndSecond"),
        "YearWeek": clock.iso_year_week("FullDate"),
    }).withColumn(
        "SessionSlot",
        F.concat("WeekdayName", F.lit(" "), "SessionStartTime", F.lit("-"), "SessionEndTime"),
    )


def bounded_blocks(
    schedule: DataFrame,
    keys: list[str] | None = None,
    max_break: int = MAX_BREAK_MINUTES,
    max_length: int = MAX_SESSION_MINUTES,
) -> DataFrame:
    """Distinct blocks with the id of the bounded session they belong to."""
    keys = keys or ["FullDate"]
    numbered = bounded_sessions(
        time_blocks(schedule, keys), keys, "StartSecond", "EndSecond", max_break * 60, max_length * 60
    )
    lead = [F.col(k).cast("string") for k in keys if k != "FullDate"]
    return numbered.withColumn(
        "SessionID",
        F.concat_ws("_", *lead, F.date_format("FullDate", "yyyyMMdd"), F.col("SessionNumber").cast("string")),
    )


def bounded_schedule(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per bounded session, flagged when it looks like a four-hour session."""
    keys = keys or ["FullDate"]
    sessions = blocks.groupBy(*keys, "SessionID").agg(
        F.min("StartSecond").alias("SessionStartSecond"),
        F.max("EndSecond").alias("SessionEndSecond"),
        F.count(F.lit(1)).alias("NumberOfTimeBlocks"),
    )
    return _shape(sessions).withColumn(
        "LooksLikeFourHourSession",
        F.col("SessionDurationMinutes").between(MIN_SESSION_MINUTES, MAX_SESSION_MINUTES),
    )


def course_blocks(schedule: DataFrame, max_break: int = MAX_BREAK_MINUTES) -> DataFrame:
    """Distinct blocks per class and day with their unbounded session."""
    keys = ["ClassName", "NormalizedClassName", "LessonType", "FullDate"]
    blocks = time_blocks(schedule, keys)
    numbered = island_sessions(blocks, ["ClassName", "FullDate"], "StartSecond", "EndSecond", max_break * 60)
    return numbered.withColumn(
        "SessionID",
        F.concat_ws(
            "_", "NormalizedClassName", F.date_format("FullDate", "yyyyMMdd"), F.col("SessionNumber").cast("string")
        ),
    )


def course_sessions(blocks: DataFrame, min_minutes: int = 1) -> DataFrame:
    sessions = blocks.groupBy("ClassName", "NormalizedClassName", "LessonType", "FullDate", "SessionID").agg(
        F.min("StartSecond").alias("SessionStartSecond"),
        F.max("EndSecond").alias("SessionEndSecond"),
        F.count_distinct("StartSecond").alias("NumberOfTimeBlocks"),
    )
    return _shape(sessions).where(F.col("SessionDurationMinutes") >= min_minutes)


def course_session_sets(schedule: DataFrame, max_break: int = MAX_BREAK_MINUTES, min_minutes: int = 1) -> DataFrame:
    """Sessions per class and day, each with the sorted set of its subgroups.

    A block carries its subgroups as one set while sessions are numbered, so the window
    holds one row per distinct block, and blocks are not joined back to the timetable.
    """
    keys = ["ClassName", "NormalizedClassName", "LessonType", "FullDate"]
    blocks = schedule.groupBy(*keys, "StartSecond", "EndSecond").agg(F.collect_set("SubgroupKey").alias("_subgroups"))
    numbered = island_sessions(blocks, ["ClassName", "FullDate"], "StartSecond", "EndSecond", max_break * 60)
    sessions = numbered.groupBy(*keys, "SessionNumber").agg(
        F.min("StartSecond").alias("SessionStartSecond"),
        F.max("EndSecond").alias("SessionEndSecond"),
        F.size(F.collect_set("StartSecond")).alias("NumberOfTimeBlocks"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_subgroups")))).alias("_set"),
    )
    named = sessions.withColumn(
        "SessionID",
        F.concat_ws(
            "_", "NormalizedClassName", F.date_format("FullDate", "yyyyMMdd"), F.col("SessionNumber").cast("string")
        ),
    ).drop("SessionNumber")
    return _shape(named).where(F.col("SessionDurationMinutes") >= min_minutes)


def session_rows(schedule: DataFrame, blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Schedule rows with the session of their block."""
    keys = keys or ["FullDate"]
    return schedule.join(
        blocks.select(*keys, "StartSecond", "EndSecond", "SessionID"), [*keys, "StartSecond", "EndSecond"]
    )


def session_subgroups(rows: DataFrame) -> DataFrame:
    """Per session and subgroup: the highest head count over its half blocks."""
    return rows.groupBy("FullDate", "SessionID", "SubgroupCode").agg(
        F.max("UserCount").alias("EstimatedUniquePresent"),
        F.max("TotalStudents").alias("AdministrativeStudents"),
        F.count(F.lit(1)).alias("NumberOfRows"),
        F.count_distinct("LectureID").alias("NumberOfLectureIDs"),
        F.count_distinct("StartSecond").alias("NumberOfBlocks"),
        F.count_distinct("RoomCode").alias("NumberOfRooms"),
        distinct_list("RoomCode").alias("Rooms"),
        F.min("UserCount").alias("MinBlockCount"),
        F.max("UserCount").alias("MaxBlockCount"),
    )


def session_attendance(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Present and administrative students per session, without user ids.

    Two steps: the highest count per subgroup over the blocks, then the sum over
    subgroups, so a student of two half blocks counts once.  Rooms are a relation of (session, room) rows,
    counted and joined to texts range by range (``distinct_texts``).
    """
    key = ["FullDate", "SessionID"]
    per_subgroup = rows.groupBy(*key, "SubgroupCode").agg(F.max("UserCount").alias("_present"), F.max("TotalStudents").alias("_students"))
    per_session = per_subgroup.groupBy(*key).agg(
        F.sum("_present").alias("EstimatedPresentStudents"),
        F.sum("_students").alias("AdministrativeExpectedStudents"),
        F.count(F.lit(1)).alias("NumberOfSubgroups"),
    )
    rooms = distinct_texts(rows, key, "RoomCode", "NumberOfDistinctRooms", "Rooms")
    named = per_session.join(rooms, key, "left").withColumns({
        "NumberOfDistinctRooms": F.coalesce("NumberOfDistinctRooms", F.lit(0)).cast("int"), "Rooms": F.coalesce("Rooms", F.lit("")),
    })
    return named.join(schedule, key, "left")
