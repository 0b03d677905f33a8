"""Attendance of group-project courses against regular courses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions import clock, maths
from rollcall.functions.text import normalise_title, with_normalised
from rollcall.operators import aggregates
from rollcall.operators.joins import interval_join, unique_on
from rollcall.operators.windows import rolling_mean_by_week
from rollcall.plans import presence, sessions as build
from rollcall.session import stored

# --- fixed values: labels of the reports -------------------------------------------
GROUP, REGULAR, UNMATCHED = "Groepswerk", "Gewoon vak", "Niet gekoppeld"
CONTRAST_METRICS = {
    "Gewogen aanwezigheidsgraad": "WeightedAttendanceRate",
    "Gemiddelde aanwezigheidsgraad": "MeanAttendanceRate",
    "Mediaan aanwezigheidsgraad": "MedianAttendanceRate",
    "Standaardafwijking": "StandardDeviation",
    "Variantie": "Variance",
    "Eerste kwartiel": "Quartile1",
    "Derde kwartiel": "Quartile3",
    "Interkwartielafstand": "InterquartileRange",
    "Aantal sessies": "SessionCount",
}
CONTRAST_NAMES = ("Groepswerk", "GewoonVak", "VerschilGroepswerkMinGewoon")
# -------------------------------------------------------------------------------------


def title_set(titles: DataFrame, column: str) -> DataFrame:
    names = titles.where(F.col(column).isNotNull()).select(F.col(column).alias("_t")).distinct()
    return names.select(normalise_title("_t").alias("NormalizedClassName")).distinct()


def check_disjoint(group_titles: DataFrame, regular_titles: DataFrame) -> DataFrame:
    """The group titles; the query fails when a title is in both sets."""
    both = regular_titles.select("NormalizedClassName", F.lit(True).alias("_both"))
    return group_titles.join(both, "NormalizedClassName", "left").where(
        F.when(F.col("_both"), F.raise_error(F.concat(F.lit("title in both sets: "), "NormalizedClassName")).cast("boolean"))
        .otherwise(F.lit(True))
    ).drop("_both")


def with_lesson_type(schedule: DataFrame, group_titles: DataFrame, regular_titles: DataFrame) -> DataFrame:
    """Lesson type by normalised class name; names in neither set are kept and marked."""
    named = with_normalised(schedule, "ClassName", "NormalizedClassName")
    kinds = check_disjoint(group_titles, regular_titles).withColumn("_kind", F.lit(GROUP)).unionByName(
        regular_titles.withColumn("_kind", F.lit(REGULAR))
    )
    return named.join(kinds, "NormalizedClassName", "left").withColumn(
        "LessonType", F.coalesce("_kind", F.lit(UNMATCHED))
    ).drop("_kind")


def unmatched_titles(schedule: DataFrame) -> DataFrame:
    return schedule.where(F.col("LessonType") == UNMATCHED).select("ClassName", "NormalizedClassName").distinct()


def classified(schedule: DataFrame) -> DataFrame:
    return schedule.where(F.col("LessonType").isin(GROUP, REGULAR))


def present_users(sessions: DataFrame, wifi: DataFrame, bridge: DataFrame) -> DataFrame:
    """Distinct (session, user): expected users with a connection inside the session.

    A user is seen once per distinct span and counts at the first of their subgroups in a session's set, so the
    join of sessions and users by span and subgroup gives every pair once: the pairs, by far the most
    rows, are neither shuffled nor compared, and a session is dealt out for each of its subgroups, not for each cohort.
    """
    span = ["DateKey", "SessionStartSecond", "SessionEndSecond"]
    signed = unique_on(sessions.withColumn("DateKey", clock.date_key("FullDate")).select("SessionID", *span, "_set"), ["SessionID"], "sessions")
    points = wifi.select("UserKey", "DateKey", clock.key_seconds("TimeKey").alias("_second"))
    seen = interval_join(points, sessions.select(clock.date_key("FullDate").alias("DateKey"), *span[1:]).distinct(), ["DateKey"], "_second", "SessionStartSecond", "SessionEndSecond")
    users = seen.select(*span, "UserKey").distinct().join(presence.user_places(bridge), "UserKey")
    asked = signed.withColumn("SubgroupKey", F.explode("_set"))
    met = asked.join(users, [*span, "SubgroupKey"]).where(~F.arrays_overlap("_set", "_earlier"))
    return met.select("SessionID", "UserKey")


def rate_sessions(sessions: DataFrame, wifi: DataFrame, bridge: DataFrame) -> DataFrame:
    """Expected and present students and the rate of sessions from ``course_session_sets``.

    The query fails when two sessions have one SessionID, as titles do that differ only in what normalising
    removes.  The sessions are read three times: hand in a stored table when they are costly.  Counts are summed
    per SessionID, so whole sessions are dealt out once, by the check of their ids.
    """
    signed = sessions.withColumns({
        "DateKey": clock.date_key("FullDate"), "StartSecond": F.col("SessionStartSecond"), "EndSecond": F.col("SessionEndSecond"),
    })
    expected = presence.summed_over_sets(signed, ["SessionID"], presence.expected_counts(bridge), [], "_expected")
    present = presence.summed_over_sets(signed, ["SessionID"], presence.present_counts(signed, wifi, bridge), presence.SPAN, "_present")
    known = unique_on(sessions.drop("_set"), ["SessionID"], "sessions")
    joined = known.join(expected, "SessionID", "left").join(present, "SessionID", "left").withColumns({
        "ExpectedStudents": F.coalesce("_expected", F.lit(0)),
        "PresentStudents": F.coalesce("_present", F.lit(0)),
    }).drop("_expected", "_present")
    rated = joined.withColumn("AttendanceRate", maths.ratio("PresentStudents", "ExpectedStudents"))
    return rated.withColumn("AttendancePercentage", F.col("AttendanceRate") * 100)


def session_results(schedule: DataFrame, wifi: DataFrame, bridge: DataFrame, min_minutes: int = 1) -> DataFrame:
    """One row per session of the classified timetable."""
    return rate_sessions(build.course_session_sets(classified(schedule), min_minutes=min_minutes), wifi, bridge)


def valid(results: DataFrame) -> DataFrame:
    return results.where("ExpectedStudents > 0")


def contrast(metrics: DataFrame) -> DataFrame:
    return aggregates.contrast(metrics, "LessonType", GROUP, REGULAR, CONTRAST_METRICS, CONTRAST_NAMES)


def extremes(results: DataFrame, n: int = 30, lowest: bool = True) -> DataFrame:
    """Sessions with the lowest or highest rate; equal rates by session id."""
    columns = [
        "FullDate", "SessionID", "ClassName", "LessonType", "SessionStart", "SessionEnd",
        "ExpectedStudents", "PresentStudents", "AttendanceRate",
    ]
    rate = F.col("AttendanceRate")
    return results.select(*columns).orderBy(rate.asc() if lowest else rate.desc(), "SessionID").limit(n)


def weekly_trend(results: DataFrame) -> DataFrame:
    """Weighted percentage per week (from Monday) and lesson type."""
    weekly = results.groupBy(clock.week_monday("FullDate").alias("WeekStart"), "LessonType").agg(
        F.sum("ExpectedStudents").alias("ExpectedStudents"),
        F.sum("PresentStudents").alias("PresentStudents"),
        F.count(F.lit(1)).alias("SessionCount"),
    )
    return weekly.withColumn("AttendancePercentage", maths.ratio("PresentStudents", "ExpectedStudents") * 100)


def weekly_pivot(trend: DataFrame) -> DataFrame:
    """A row per week, a column per lesson type; a type without sessions is null."""
    return trend.groupBy("WeekStart").agg(
        F.max(F.when(F.col("LessonType") == GROUP, F.col("AttendancePercentage"))).alias("Groepswerk"),
        F.max(F.when(F.col("LessonType") == REGULAR, F.col("AttendancePercentage"))).alias("GewoonVak"),
    )


def rolling_trend(trend: DataFrame, weeks: int = 4) -> DataFrame:
    """Mean over four weeks of the grid; weeks without sessions of a type are skipped."""
    grid = weekly_pivot(trend).select(
        "WeekStart",
        F.inline(F.array(
            F.struct(F.lit(GROUP).alias("LessonType"), F.col("Groepswerk").alias("_p")),
            F.struct(F.lit(REGULAR).alias("LessonType"), F.col("GewoonVak").alias("_p")),
        )),
    )
    return rolling_mean_by_week(grid, ["LessonType"], "WeekStart", "_p", weeks, "RollingPercentage").drop("_p")


def quality_summary(schedule: DataFrame, results: DataFrame) -> DataFrame:
    """One labelled count per check."""
    rows = schedule.agg(
        F.count(F.lit(1)).alias("Roosterfactrijen"),
        F.count_if(F.col("LessonType").isin(GROUP, REGULAR)).alias("Geclassificeerde roosterfactrijen"),
        F.count_distinct(F.when(F.col("LessonType") == UNMATCHED, F.col("ClassName"))).alias(
            "Niet-gekoppelde unieke vaknamen"
        ),
    )
    usable = F.col("ExpectedStudents") > 0
    built = results.agg(
        F.count(F.lit(1)).alias("Afgeleide sessies"),
        F.count_if(usable).alias("Sessies met verwachte studenten"),
        F.count_if(F.col("ExpectedStudents") == 0).alias("Sessies zonder verwachte studenten"),
        F.count_if(usable & (F.col("PresentStudents") == 0)).alias("Sessies zonder aanwezige wifi-gebruikers"),
        F.count_if(usable & (F.col("AttendanceRate") > 1)).alias("Sessies boven 100 procent aanwezigheid"),
    )
    return aggregates.unpivot_row(rows, rows.columns, "Check", "Rows").unionByName(
        aggregates.unpivot_row(built, built.columns, "Check", "Rows")
    )


# --- lecture grain -------------------------------------------------------------------


def lecture_results(schedule: DataFrame, wifi: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per lecture: distinct expected and present users over its subgroups.

    No sessions and no grace: a connection between start and end counts.  A lecture has one time,
    that of its first subgroup by code.  The lectures are read four times, so they are stored first.
    """
    first = F.struct("SubgroupCode", "DateKey", "FullDate", "StartSecond", "EndSecond", "ClassName", "NormalizedClassName",
                     "LessonType", "ProgramName")
    lectures = schedule.groupBy("LectureID").agg(
        F.min(first).alias("_first"),
        aggregates.distinct_list("SubgroupCode").alias("SubgroupCodes"),
        F.array_sort(F.collect_set("SubgroupKey")).alias("_set"),
    )
    named = lectures.select(
        "LectureID", *[f"_first.{c}" for c in (*presence.SPAN, "FullDate", "ClassName", "NormalizedClassName", "LessonType", "ProgramName")],
        "SubgroupCodes", "_set",
    )
    named = stored(named, "lectures")
    expected = presence.summed_over_sets(named, ["LectureID"], presence.expected_counts(bridge), [], "_total")
    present = presence.summed_over_sets(named, ["LectureID"], presence.present_counts(named, wifi, bridge), presence.SPAN, "_present")
    named = named.drop("_set").withColumns({
        "LectureStart": clock.at_second("FullDate", "StartSecond"),
        "LectureEnd": clock.at_second("FullDate", "EndSecond"),
    })
    joined = named.join(expected, "LectureID", "left").join(present, "LectureID", "left").withColumns({
        "TotalStudents": F.coalesce("_total", F.lit(0)), "UserCount": F.coalesce("_present", F.lit(0)),
    }).drop("_total", "_present", *presence.SPAN)
    return joined.withColumn("AttendanceRate", maths.ratio("UserCount", "TotalStudents"))


def valid_observations(lectures: DataFrame) -> DataFrame:
    return lectures.where(
        F.col("LessonType").isin(GROUP, REGULAR) & (F.col("TotalStudents") > 0) & (F.col("AttendanceRate") >= 0)
    )
