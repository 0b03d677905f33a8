"""Weekly slots: expected group size, assignment of users, corrected attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rollcall.functions import clock, maths
from rollcall.operators.aggregates import quantile, with_percentiles
from rollcall.operators.dedupe import keep_one
from rollcall.operators.joins import interval_join

SLOT = ["WeekdayNumber", "WeekdayName", "SessionStartTime", "SessionEndTime", "SessionSlot"]
UNASSIGNED = "Unassigned"
MIN_SESSIONS_PER_USER = 2


# --- without user ids --------------------------------------------------------------


def slot_expectation(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(*SLOT).agg(
        F.max("EstimatedPresentStudents").alias("ExpectedStudentsForSlot"),
        quantile("EstimatedPresentStudents", 0.95).alias("P95StudentsForSlot"),
        F.count_distinct("SessionID").alias("NumberOfObservedSessions"),
    )


def slot_maximum(sessions: DataFrame) -> DataFrame:
    """The session with the highest count per slot; the earliest on equal counts.

    The slot is decided on numbers and keys; its room list is only read for the session chosen.
    """
    ordered = sessions.select("SessionSlot", "FullDate", "SessionID", (-F.col("EstimatedPresentStudents")).alias("_down"))
    best = keep_one(ordered.where("_down is not null"), ["SessionSlot"], ["_down", "FullDate", "SessionID"])
    chosen = sessions.join(best.select("SessionSlot", "FullDate", "SessionID"), ["SessionSlot", "FullDate", "SessionID"], "left_semi")
    return chosen.select(
        "SessionSlot", F.col("FullDate").alias("DateOfMaximum"), "SessionID", "SessionStart", "SessionEnd",
        F.col("EstimatedPresentStudents").alias("MaximumObservedStudents"), "Rooms",
    )


def corrected_sessions(sessions: DataFrame) -> DataFrame:
    """Rates against the highest count of the slot and against the administration.

    Sessions are one row each and a weekly slot has as many as there are weeks, so the
    slot values come from a window over the slot and the sessions are built once.
    """
    slot = Window.partitionBy("SessionSlot")
    present = F.col("EstimatedPresentStudents")
    return sessions.withColumns({
        "ExpectedStudentsForSlot": F.max(present).over(slot),
        "P95StudentsForSlot": quantile(present, 0.95).over(slot),
        "NumberOfObservedSessions": F.count("SessionID").over(slot),
    }).withColumns({
        "CorrectedAttendanceRate": maths.ratio("EstimatedPresentStudents", "ExpectedStudentsForSlot"),
        "AdministrativeAttendanceRate": maths.ratio("EstimatedPresentStudents", "AdministrativeExpectedStudents"),
    }).withColumn("CorrectedAttendanceRateCapped", maths.cap_at_one("CorrectedAttendanceRate"))


def slot_summary(corrected: DataFrame) -> DataFrame:
    return corrected.groupBy(*SLOT).agg(
        F.count_distinct("SessionID").alias("NumberOfSessions"),
        F.max("ExpectedStudentsForSlot").alias("ExpectedStudents"),
        F.avg("EstimatedPresentStudents").alias("MeanPresentStudents"),
        quantile("EstimatedPresentStudents", 0.5).alias("MedianPresentStudents"),
        F.min("EstimatedPresentStudents").alias("MinPresentStudents"),
        F.max("EstimatedPresentStudents").alias("MaxPresentStudents"),
        F.avg("CorrectedAttendanceRate").alias("MeanAttendanceRate"),
        quantile("CorrectedAttendanceRate", 0.5).alias("MedianAttendanceRate"),
    )


def slot_comparison(corrected: DataFrame) -> DataFrame:
    return corrected.groupBy("SessionSlot").agg(
        F.avg("AdministrativeAttendanceRate").alias("MeanAdministrativeAttendance"),
        F.avg("CorrectedAttendanceRate").alias("MeanCorrectedAttendance"),
        quantile("AdministrativeAttendanceRate", 0.5).alias("MedianAdministrativeAttendance"),
        quantile("CorrectedAttendanceRate", 0.5).alias("MedianCorrectedAttendance"),
        F.max("ExpectedStudentsForSlot").alias("ExpectedStudentsForSlot"),
    )


def first_week_sensitivity(sessions: DataFrame) -> DataFrame:
    """Slot maximum with and without the first week the slot was seen in."""
    first = F.min("YearWeek").over(Window.partitionBy("SessionSlot"))
    later = F.when(F.col("YearWeek") != F.col("FirstObservedWeek"), F.col("EstimatedPresentStudents"))
    return sessions.withColumn("FirstObservedWeek", first).groupBy("SessionSlot", "FirstObservedWeek").agg(
        F.max("EstimatedPresentStudents").alias("MaximumIncludingFirstWeek"),
        F.max(later).alias("MaximumWithoutFirstWeek"),
    )


# --- with user ids -----------------------------------------------------------------


def session_presence(sessions: DataFrame, wifi: DataFrame) -> DataFrame:
    """Distinct (user, session): a connection between start and end, both included.

    Sessions do not cross midnight, so the date is an equality key of the join.
    """
    points = wifi.select(
        "UserKey", clock.key_date("DateKey").alias("FullDate"), clock.key_seconds("TimeKey").alias("_second")
    )
    hits = interval_join(
        points,
        sessions.select("FullDate", "SessionID", "SessionSlot", "YearWeek", "SessionStartSecond", "SessionEndSecond"),
        ["FullDate"], "_second", "SessionStartSecond", "SessionEndSecond",
    )
    return hits.select("UserKey", "SessionID", "FullDate", "SessionSlot", "YearWeek").distinct()


def course_wifi(wifi: DataFrame, bridge: DataFrame, schedule: DataFrame) -> DataFrame:
    """Connections of users that belong to a scheduled subgroup."""
    members = bridge.join(schedule.select("SubgroupKey"), "SubgroupKey", "left_semi")
    return wifi.join(members.select("UserKey"), "UserKey", "left_semi")


def user_slot_counts(presence: DataFrame, sessions: DataFrame, skip_first_week: bool = True) -> DataFrame:
    """Sessions per user and slot, the first observed week left out on request."""
    if skip_first_week:
        first = sessions.agg(F.min("YearWeek").alias("w")).select("w").scalar()
        presence = presence.withColumn("_first", first).where("YearWeek <> _first").drop("_first")
    return presence.groupBy("UserKey", "SessionSlot").agg(
        F.count(F.lit(1)).alias("SessionsObserved"),
        F.min("FullDate").alias("FirstSeen"),
        F.max("FullDate").alias("LastSeen"),
    )


def assign_slots(counts: DataFrame, min_sessions: int = MIN_SESSIONS_PER_USER, tie: str = "unassigned") -> DataFrame:
    """Slot with a unique highest count per user.

    With ``tie='latest'`` the tied slot seen last wins (by name on the same day).
    """
    if tie not in ("unassigned", "latest"):
        raise ValueError("tie is 'unassigned' or 'latest'")
    rank = F.struct("SessionsObserved", "LastSeen", "SessionSlot")
    ranked = counts.groupBy("UserKey").agg(
        F.sum("SessionsObserved").alias("TotalObservedSessions"),
        # a user has at most one entry per weekly slot
        F.sort_array(F.collect_list(rank), asc=False).alias("_slots"),
    )
    best = F.get("_slots", F.lit(0))
    second = F.coalesce(F.get("_slots", F.lit(1))["SessionsObserved"], F.lit(0))
    few = F.col("TotalObservedSessions") < min_sessions
    unique = best["SessionsObserved"] > second
    tied = ("Tie resolved by latest", best["SessionSlot"]) if tie == "latest" else ("Tie", F.lit(UNASSIGNED))
    return ranked.select(
        "UserKey",
        F.when(few, UNASSIGNED).when(unique, best["SessionSlot"]).otherwise(tied[1]).alias("AssignedSessionSlot"),
        F.when(few, "Too few observations").when(unique, "Unique maximum").otherwise(tied[0]).alias("AssignmentReason"),
        "TotalObservedSessions",
        best["SessionsObserved"].alias("BestSlotObservations"),
        second.alias("SecondBestSlotObservations"),
        ((best["SessionsObserved"] - second) / best["SessionsObserved"]).alias("AssignmentConfidence"),
    )


def group_sizes(assignments: DataFrame) -> DataFrame:
    assigned = assignments.where(F.col("AssignedSessionSlot") != UNASSIGNED)
    sizes = assigned.groupBy("AssignedSessionSlot").agg(
        F.count(F.lit(1)).alias("ExpectedStudents"),
        F.avg("AssignmentConfidence").alias("MeanAssignmentConfidence"),
        F.avg("BestSlotObservations").alias("MeanBestSlotObservations"),
    )
    return with_percentiles(sizes, assigned, ["AssignedSessionSlot"], {"MedianAssignmentConfidence": ("AssignmentConfidence", 0.5)})


def corrected_attendance(sessions: DataFrame, presence: DataFrame, assignments: DataFrame) -> DataFrame:
    """Assigned users present in their own slot over all users assigned to the slot."""
    assigned = assignments.where(F.col("AssignedSessionSlot") != UNASSIGNED).select(
        "UserKey", F.col("AssignedSessionSlot").alias("SessionSlot")
    )
    expected = assigned.groupBy("SessionSlot").agg(F.count(F.lit(1)).alias("_expected"))
    present = presence.join(assigned, ["UserKey", "SessionSlot"]).groupBy("SessionID").agg(
        F.count(F.lit(1)).alias("_present")
    )
    columns = ["SessionID", "FullDate", "SessionSlot", "SessionStart", "SessionEnd", "YearWeek"]
    return (
        sessions.select(*columns)
        .join(expected, "SessionSlot", "left")
        .join(present, "SessionID", "left")
        .select(
            *columns,
            F.coalesce("_expected", F.lit(0)).alias("ExpectedStudents"),
            F.coalesce("_present", F.lit(0)).alias("PresentAssignedStudents"),
        )
        .withColumn("AttendanceRate", maths.ratio("PresentAssignedStudents", "ExpectedStudents"))
    )


def assigned_slot_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("SessionSlot").agg(
        F.max("ExpectedStudents").alias("ExpectedStudents"),
        F.count(F.lit(1)).alias("NumberOfSessions"),
        F.avg("PresentAssignedStudents").alias("MeanPresent"),
        quantile("PresentAssignedStudents", 0.5).alias("MedianPresent"),
        F.min("PresentAssignedStudents").alias("MinPresent"),
        F.max("PresentAssignedStudents").alias("MaxPresent"),
        F.avg("AttendanceRate").alias("MeanAttendanceRate"),
        quantile("AttendanceRate", 0.5).alias("MedianAttendanceRate"),
    )


def first_week_switchers(sessions: DataFrame, presence: DataFrame, assignments: DataFrame) -> DataFrame:
    """Users seen in the first week in another slot than the one assigned later."""
    first = sessions.agg(F.min("YearWeek").alias("w")).select("w").scalar()
    early = presence.withColumn("_first", first).where("YearWeek = _first")
    assigned = assignments.where(F.col("AssignedSessionSlot") != UNASSIGNED).select("UserKey", "AssignedSessionSlot")
    return (
        early.join(assigned, "UserKey")
        .where(F.col("SessionSlot") != F.col("AssignedSessionSlot"))
        .select("UserKey", "FullDate", "SessionSlot", "AssignedSessionSlot")
        .distinct()
    )
