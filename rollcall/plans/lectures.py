"""Timetable exports to lecture facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import schemas
from rollcall.functions import clock, text
from rollcall.operators.aggregates import labelled_counts
from rollcall.operators.columns import drop_existing, patch, require, to_number, typed_nulls
from rollcall.operators.dedupe import keep_one
from rollcall.operators.joins import first_filled_lookup, lookup, only_known
from rollcall.operators.tables import upsert

FACT_KEYS = ["LectureID", "SubgroupKey"]
REQUIRED_KEYS = ["LectureID", "SubgroupKey", "DateKey", "FromTimeKey", "UntilTimeKey"]
LECTURE_COLUMNS = [
    "LectureId", "DateKey", "FromTimeKey", "UntilTimeKey", "ClassKey", "SubgroupKey", "RoomKey", "ActivityKey",
    "UserCount", "TotalStudents", "AttendanceRate",
]


def not_cancelled(status: str = "Status") -> Column:
    """True for every status but cancelled; an unknown status stays."""
    return ~F.lower(F.col(status)).eqNullSafe(F.lit("cancelled"))


def clean_schedule(exports: DataFrame, drop_cancelled: bool = True, patches: list[tuple] | None = None) -> DataFrame:
    """Typed keys per reservation.  ``patches`` are (id, column, value) corrections."""
    require(exports, schemas.SCHEDULE_REQUIRED, "timetable export")
    rows = exports.where(not_cancelled()) if drop_cancelled and "Status" in exports.columns else exports
    rows = drop_existing(rows, schemas.SCHEDULE_DROP_COLUMNS).withColumnRenamed("Id", "LectureId")
    rows = rows.withColumns({c: text.strip(c) for c in ["LectureId", "OlodPointers", "Rooms", "Classgroups"]})
    rows = rows.withColumns({"ParsedStart": clock.parse_datetime("Start"), "ParsedEnd": clock.parse_datetime("End")})
    rows = rows.withColumns({
        "DateKey": clock.date_key("ParsedStart"),
        "FromTimeKey": clock.time_key("ParsedStart"),
        "UntilTimeKey": clock.time_key("ParsedEnd"),
    })
    for lecture, column, value in patches or []:
        rows = patch(rows, "LectureId", lecture, column, value)
    return rows


def format_lectures(
    exports: DataFrame,
    classes: DataFrame,
    rooms: DataFrame,
    activities: DataFrame,
    drop_cancelled: bool = True,
    patches: list[tuple] | None = None,
) -> DataFrame:
    """One distinct row per reservation and subgroup with all keys looked up."""
    rows = clean_schedule(exports, drop_cancelled, patches)
    missing = [c for c in schemas.ACTIVITY_COLUMNS if c not in rows.columns]
    rows = typed_nulls(rows, {c: "string" for c in missing})
    # lookups run on reservations, before subgroups multiply the rows
    rows = rows.withColumns({
        "_code": text.first_item("OlodPointers").try_cast("bigint"), "_room": text.first_item("Rooms"),
    })
    rows = lookup(rows, classes, {"_code": "ClassCode"}, ["ClassKey"], ["ClassKey"])
    rows = lookup(
        rows, rooms.withColumn("Code", text.strip("Code")), {"_room": "Code"}, ["RoomKey"], ["RoomKey"]
    )
    default = activities.where("SourceValue = ''").select(F.min("ActivityKey")).scalar()
    rows = first_filled_lookup(rows, activities, schemas.ACTIVITY_COLUMNS, "ActivityKey", default, "ActivityKey")
    rows = text.explode_items(rows, "Classgroups", "SubgroupKey", keep_empty=True)
    rows = typed_nulls(rows, {"UserCount": "bigint", "TotalStudents": "bigint", "AttendanceRate": "double"})
    return rows.select(*LECTURE_COLUMNS).distinct()


def split_by_keys(lectures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with room and class, rows that miss one)."""
    complete = F.col("RoomKey").isNotNull() & F.col("ClassKey").isNotNull()
    return lectures.where(complete), lectures.where(~complete)


def format_summary(lectures: DataFrame) -> DataFrame:
    no_class, no_room = F.col("ClassKey").isNull(), F.col("RoomKey").isNull()
    return labelled_counts(lectures, {
        "Rows": F.lit(True),
        "ValidRows": ~(no_class | no_room),
        "InvalidRows": no_class | no_room,
        "MissingClassKeys": no_class,
        "MissingRoomKeys": no_room,
        "MissingBothKeys": no_class & no_room,
        "MissingActivityKeys": F.col("ActivityKey").isNull(),
        "InvalidDates": F.col("DateKey").isNull() | F.col("UntilTimeKey").isNull(),
    })


def fact_rows(formatted: DataFrame, subgroups: DataFrame, order: list[str]) -> DataFrame:
    """Typed fact rows: required keys present, one row per key (the last by ``order``),
    known subgroups only."""
    require(formatted, [c for c in LECTURE_COLUMNS if c != "AttendanceRate"], "formatted lectures")
    rows = formatted.withColumnRenamed("LectureId", "LectureID")
    rows = to_number(rows, ["LectureID", "ClassKey", "SubgroupKey", "RoomKey", "UserCount", "TotalStudents"])
    rows = to_number(rows, ["DateKey", "FromTimeKey", "UntilTimeKey", "ActivityKey"], "int")
    rows = rows.dropna(subset=REQUIRED_KEYS)
    rows = keep_one(rows, FACT_KEYS, [*order], last=True)
    rows = only_known(rows, subgroups, ["SubgroupKey"])
    return rows.select(
        "LectureID", "DateKey", "FromTimeKey", "UntilTimeKey", "ClassKey", "SubgroupKey", "RoomKey", "ActivityKey",
        "UserCount", "TotalStudents",
    )


def load_fact(target: DataFrame, formatted: DataFrame, subgroups: DataFrame, order: list[str]) -> DataFrame:
    """Upsert by lecture and subgroup.  A reload sets the counts to null until the next
    attendance refresh, because every measure of a matched row is replaced."""
    rows = fact_rows(formatted, subgroups, order)
    return upsert(target.select(*rows.columns), rows, FACT_KEYS)


def clean_reservations(exports: DataFrame) -> DataFrame:
    """Older path: listed columns, cancelled rows removed, dates parsed."""
    kept = exports.select(*[c for c in schemas.RESERVATION_COLUMNS if c in exports.columns])
    rows = kept.where(not_cancelled())
    dates = [c for c in ["Start", "End", "Updated"] if c in rows.columns]
    return rows.withColumns({c: clock.parse_datetime(c) for c in dates})
