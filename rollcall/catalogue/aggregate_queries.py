"""Aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.registry import query
from rollcall.catalogue.views import r9
from rollcall.functions import clock, maths
from rollcall.operators import aggregates, dedupe, windows
from rollcall.operators.columns import tag_source_file
from rollcall.operators.joins import lookup
from rollcall.session import stored
from rollcall.plans import attendance_model, course_types, lectures, loads, presence, programs, sanity, sessions, slots

_D = lambda c: f"CAST({c} AS DOUBLE)"
_r9 = r9


def _q(c: str, p: float) -> str:
    return r9(f"quantile_cont(CAST({c} AS DOUBLE), {p})")


def metric_sql(source: str, keys: str, rounded: bool = True) -> str:
    """The metric block per group of sessions."""
    r9 = _r9 if rounded else lambda e: e
    _q = lambda c, p: r9(f"quantile_cont(CAST({c} AS DOUBLE), {p})")
    r = "AttendanceRate"
    return f"""SELECT {keys}, count(SessionID) AS SessionCount, count({r}) AS ValidAttendanceRates,
        sum(ExpectedStudents)::BIGINT AS ExpectedStudentsSum, sum(PresentStudents)::BIGINT AS PresentStudentsSum,
        {r9("CASE WHEN sum(ExpectedStudents) > 0 THEN sum(PresentStudents)::DOUBLE / sum(ExpectedStudents)::DOUBLE END")} AS WeightedAttendanceRate,
        {r9(f"avg({r})")} AS MeanAttendanceRate, {_q(r, 0.5)} AS MedianAttendanceRate, {r9(f"stddev_samp({r})")} AS StandardDeviation,
        {r9(f"var_samp({r})")} AS Variance, {r9(f"min({r})")} AS Minimum, {_q(r, 0.1)} AS Percentile10, {_q(r, 0.25)} AS Quartile1,
        {_q(r, 0.75)} AS Quartile3, {_q(r, 0.9)} AS Percentile90, {r9(f"max({r})")} AS Maximum,
        {r9(f"quantile_cont({r}, 0.75) - quantile_cont({r}, 0.25)")} AS InterquartileRange,
        {r9(f"CASE WHEN count({r}) > 1 AND avg({r}) <> 0 THEN stddev_samp({r}) / avg({r}) END")} AS CoefficientOfVariation,
        {r9("avg(ExpectedStudents)")} AS MeanExpectedStudents, {_q("ExpectedStudents", 0.5)} AS MedianExpectedStudents,
        {r9("avg(PresentStudents)")} AS MeanPresentStudents, {_q("PresentStudents", 0.5)} AS MedianPresentStudents
        FROM {source} GROUP BY {keys}"""


def lesson_sql(source: str, keys: str) -> str:
    r = "AttendanceRate"
    return f"""SELECT {keys}, count(*) AS LessonCount, count({r}) AS ValidAttendanceRates,
        sum(TotalStudents)::BIGINT AS TotalStudentsSum, sum(UserCount)::BIGINT AS UserCountSum,
        {r9("CASE WHEN sum(TotalStudents) > 0 THEN sum(UserCount)::DOUBLE / sum(TotalStudents)::DOUBLE END")} AS WeightedAttendanceRate,
        {r9(f"avg({r})")} AS MeanAttendanceRate, {_q(r, 0.5)} AS MedianAttendanceRate, {r9(f"stddev_samp({r})")} AS StandardDeviation,
        {r9(f"var_samp({r})")} AS Variance, {r9(f"min({r})")} AS Minimum, {_q(r, 0.1)} AS Percentile10, {_q(r, 0.25)} AS Quartile1,
        {_q(r, 0.75)} AS Quartile3, {_q(r, 0.9)} AS Percentile90, {r9(f"max({r})")} AS Maximum,
        {r9(f"quantile_cont({r}, 0.75) - quantile_cont({r}, 0.25)")} AS InterquartileRange,
        {r9(f"CASE WHEN count({r}) > 1 AND avg({r}) <> 0 THEN stddev_samp({r}) / avg({r}) END")} AS CoefficientOfVariation,
        {r9("avg(TotalStudents)")} AS MeanStudents, {r9("avg(UserCount)")} AS MeanPresent
        FROM {source} GROUP BY {keys}"""


@query("ag_01_exact_distinct", "SELECT SubgroupKey, count(DISTINCT LectureID) AS Lectures, count(DISTINCT RoomKey) AS Rooms FROM fact_base GROUP BY 1")
def ag_01(v):
    return v.fact_base.groupBy("SubgroupKey").agg(
        F.count_distinct("LectureID").alias("Lectures"), F.count_distinct("RoomKey").alias("Rooms")
    )


@query("ag_02_grouped_statistics", f"""
SELECT SubgroupKey, count(*) AS Rows, min(UserCount) AS MinUsers, max(UserCount) AS MaxUsers, sum(UserCount)::BIGINT AS SumUsers,
       {r9('avg(UserCount)')} AS MeanUsers, {_q('UserCount', 0.5)} AS MedianUsers, arg_min(RoomKey, LectureID) AS FirstRoom FROM fact_lecture GROUP BY 1""")
def ag_02(v):
    return v.fact.groupBy("SubgroupKey").agg(
        F.count(F.lit(1)).alias("Rows"), F.min("UserCount").alias("MinUsers"), F.max("UserCount").alias("MaxUsers"),
        F.sum("UserCount").alias("SumUsers"), F.avg("UserCount").alias("MeanUsers"),
        aggregates.quantile("UserCount", 0.5).alias("MedianUsers"), F.min_by("RoomKey", "LectureID").alias("FirstRoom"),
    )


@query("ag_03_describe", f"""
SELECT count(TotalStudents) AS count, {r9('avg(TotalStudents)')} AS mean, {r9('stddev_samp(TotalStudents)')} AS std, {_D('min(TotalStudents)')} AS min,
       {_q('TotalStudents', 0.01)} AS p1, {_q('TotalStudents', 0.05)} AS p5, {_q('TotalStudents', 0.25)} AS p25, {_q('TotalStudents', 0.5)} AS p50,
       {_q('TotalStudents', 0.75)} AS p75, {_q('TotalStudents', 0.95)} AS p95, {_q('TotalStudents', 0.99)} AS p99, {_D('max(TotalStudents)')} AS max FROM fact_lecture""")
def ag_03(v):
    return aggregates.describe(v.fact, "TotalStudents", [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])


@query("ag_04_percentiles", f"""
SELECT SubgroupKey, {_q('AttendanceRate', 0.1)} AS p10, {_q('AttendanceRate', 0.25)} AS q1, {_q('AttendanceRate', 0.9)} AS p90 FROM fact_lecture WHERE AttendanceRate IS NOT NULL GROUP BY 1""")
def ag_04(v):
    rate = "AttendanceRate"
    return v.fact.where("AttendanceRate IS NOT NULL").groupBy("SubgroupKey").agg(
        aggregates.quantile(rate, 0.1).alias("p10"), aggregates.quantile(rate, 0.25).alias("q1"), aggregates.quantile(rate, 0.9).alias("p90")
    )


@query("ag_05_sample_deviation", f"SELECT ActivityKey, {r9('stddev_samp(AttendanceRate)')} AS std, {r9('var_samp(AttendanceRate)')} AS var FROM fact_lecture GROUP BY 1")
def ag_05(v):
    return v.fact.groupBy("ActivityKey").agg(
        F.stddev_samp("AttendanceRate").alias("std"), F.var_samp("AttendanceRate").alias("var")
    )


@query("ag_06_session_metrics", metric_sql("course_valid", "LessonType, ClassName"))
def ag_06(v):
    return aggregates.session_metrics(v.course_valid, ["LessonType", "ClassName"])


@query("ag_07_lesson_metrics", lesson_sql("fact_lecture", "ActivityKey"))
def ag_07(v):
    return aggregates.lesson_metrics(v.fact, ["ActivityKey"])


@query("ag_08_value_counts", "SELECT Status, count(*) AS Rows FROM schedule_export GROUP BY 1")
def ag_08(v):
    return aggregates.value_counts(v.schedule_export, ["Status"])


@query("ag_09_distinct_list", "SELECT ClassName, string_agg(DISTINCT SubgroupCode, ', ' ORDER BY SubgroupCode) AS Subgroups FROM schedule GROUP BY 1")
def ag_09(v):
    return v.schedule.groupBy("ClassName").agg(aggregates.distinct_list("SubgroupCode").alias("Subgroups"))


@query("ag_10_share_of_rows", f"SELECT SubgroupKey, {r9('avg(CASE WHEN AttendanceRate < 0.2 THEN 1.0 ELSE 0.0 END)')} AS ShareBelow20 FROM fact_lecture WHERE AttendanceRate IS NOT NULL GROUP BY 1")
def ag_10(v):
    return v.fact.where("AttendanceRate IS NOT NULL").groupBy("SubgroupKey").agg(
        aggregates.share(F.col("AttendanceRate") < 0.2).alias("ShareBelow20")
    )


@query("ag_11_null_counts", """
SELECT unnest(['Id', 'Status', 'WorkFormCourse', 'WorkFormExam', 'EducationActivity', 'Classgroups']) AS "Column",
       unnest([count(*) FILTER (Id IS NULL), count(*) FILTER (Status IS NULL), count(*) FILTER (WorkFormCourse IS NULL), count(*) FILTER (WorkFormExam IS NULL),
               count(*) FILTER (EducationActivity IS NULL), count(*) FILTER (Classgroups IS NULL)]) AS Nulls FROM schedule_export""")
def ag_11(v):
    return aggregates.null_counts(
        v.schedule_export, ["Id", "Status", "WorkFormCourse", "WorkFormExam", "EducationActivity", "Classgroups"]
    )


@query("ag_12_group_without_aggregate", "SELECT UserKey FROM fact_wifi WHERE DateKey = 20240110 AND TimeKey BETWEEN 93000 AND 123000 GROUP BY UserKey")
def ag_12(v):
    return v.wifi.where("DateKey = 20240110 AND TimeKey BETWEEN 93000 AND 123000").select("UserKey").distinct()


@query("ag_13_counts_in_order", "SELECT ClassName, count(*) AS LectureCount FROM schedule GROUP BY 1")
def ag_13(v):
    return aggregates.value_counts(v.schedule, ["ClassName"], out="LectureCount").orderBy(F.desc("LectureCount"), "ClassName")


@query("ag_14_row_of_group_maximum", """
SELECT SessionSlot, FullDate::VARCHAR AS DateOfMaximum, SessionID, EstimatedPresentStudents AS MaximumObservedStudents, Rooms
FROM (SELECT *, row_number() OVER (PARTITION BY SessionSlot ORDER BY EstimatedPresentStudents DESC, FullDate, SessionID) AS rn FROM lab_attendance WHERE EstimatedPresentStudents IS NOT NULL) WHERE rn = 1""")
def ag_14(v):
    return slots.slot_maximum(v.lab_attendance).drop("SessionStart", "SessionEnd")


@query("ag_15_pivot", """
SELECT UserKey, count(*) FILTER (weekday = 1) AS Mon, count(*) FILTER (weekday = 2) AS Tue, count(*) FILTER (weekday = 3) AS Wed, count(*) FILTER (weekday = 4) AS Thu, count(*) FILTER (weekday = 5) AS Fri
FROM (SELECT UserKey, isodow(strptime(CAST(DateKey AS VARCHAR), '%Y%m%d')) AS weekday FROM fact_wifi) GROUP BY 1""")
def ag_15(v):
    day = F.date_format(clock.key_date("DateKey"), "E")
    return v.wifi.withColumn("_day", day).groupBy("UserKey").pivot("_day", ["Mon", "Tue", "Wed", "Thu", "Fri"]).count().fillna(0)


@query("ag_16_keys_per_user", "SELECT u.UserName, string_agg(CAST(SubgroupKey AS VARCHAR), ',' ORDER BY SubgroupKey) AS Subgroups FROM bridge b JOIN dim_user u ON u.UserKey = b.UserKey GROUP BY 1")
def ag_16(v):
    links = v.bridge.join(v.users, "UserKey").select("UserName", "SubgroupKey")
    return loads.subgroups_per_user(links).select("UserName", F.concat_ws(",", F.transform("Subgroups", lambda s: s.cast("string"))).alias("Subgroups"))


@query("ag_17_weekly_mean", f"""
SELECT strftime(w, '%Y-%m-%d') AS WeekEnd, {r9('avg(AttendanceRate)')} AS Mean
FROM (SELECT unnest(generate_series(min(e), max(e), INTERVAL 7 DAY))::DATE AS w FROM (SELECT FullDate + CAST(7 - isodow(FullDate) AS INTEGER) AS e FROM facts_wide))
LEFT JOIN (SELECT FullDate + CAST(7 - isodow(FullDate) AS INTEGER) AS e, AttendanceRate FROM facts_wide) ON e = w GROUP BY 1""")
def ag_17(v):
    return aggregates.weekly_mean(v.facts_wide, "FullDate", "AttendanceRate")


_TREND = f"""SELECT strftime(date_trunc('week', FullDate), '%Y-%m-%d') AS WeekStart, LessonType, sum(ExpectedStudents)::BIGINT AS ExpectedStudents,
    sum(PresentStudents)::BIGINT AS PresentStudents, count(*) AS SessionCount, {r9("100 * sum(PresentStudents)::DOUBLE / sum(ExpectedStudents)::DOUBLE")} AS AttendancePercentage
    FROM course_valid GROUP BY ALL"""


@query("ag_18_weekly_weighted_rate", _TREND)
def ag_18(v):
    return course_types.weekly_trend(v.course_valid)


@query("ag_19_two_level", "SELECT FullDate::VARCHAR AS FullDate, SessionID, EstimatedPresentStudents, AdministrativeExpectedStudents, NumberOfSubgroups FROM day_attendance")
def ag_19(v):
    return v.day_attendance.select(
        "FullDate", "SessionID", "EstimatedPresentStudents", "AdministrativeExpectedStudents", "NumberOfSubgroups"
    )


@query("ag_20_bands", """
SELECT CASE WHEN AttendanceRate <= 0.05 THEN '<= 5%' WHEN AttendanceRate <= 0.2 THEN '5–20%' WHEN AttendanceRate <= 0.5 THEN '20–50%' WHEN AttendanceRate <= 0.9 THEN '50–90%' WHEN AttendanceRate > 0.9 THEN '> 90%' END AS Band, count(*) AS Rows FROM fact_lecture GROUP BY 1""")
def ag_20(v):
    return aggregates.value_counts(v.fact.select(maths.attendance_band("AttendanceRate").alias("Band")), ["Band"])


@query("ag_21_histogram", f"""
SELECT CAST(least(CASE WHEN hi > lo THEN floor((AttendanceRate - lo) / ((hi - lo) / 30)) ELSE 0 END, 29) AS INTEGER) AS Bin, count(*) AS Rows,
       {r9("min(lo + CAST(least(CASE WHEN hi > lo THEN floor((AttendanceRate - lo) / ((hi - lo) / 30)) ELSE 0 END, 29) AS INTEGER) * ((hi - lo) / 30))")} AS LowerEdge
FROM fact_lecture, (SELECT min(AttendanceRate) AS lo, max(AttendanceRate) AS hi FROM fact_lecture) WHERE AttendanceRate IS NOT NULL GROUP BY 1""")
def ag_21(v):
    return aggregates.histogram(v.fact, "AttendanceRate", 30)


@query("ag_22_box_plot", f"""
SELECT f.SubgroupKey, count(*) AS Rows, {r9('avg(AttendanceRate)')} AS Mean, {r9('q1')} AS Quartile1, {r9('q2')} AS Median, {r9('q3')} AS Quartile3,
       {r9('min(AttendanceRate) FILTER (AttendanceRate BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS WhiskerLow,
       {r9('max(AttendanceRate) FILTER (AttendanceRate BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS WhiskerHigh,
       count(*) FILTER (AttendanceRate NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS Outliers
FROM fact_lecture f JOIN (SELECT SubgroupKey, quantile_cont(AttendanceRate, 0.25) AS q1, quantile_cont(AttendanceRate, 0.5) AS q2, quantile_cont(AttendanceRate, 0.75) AS q3
  FROM fact_lecture WHERE AttendanceRate IS NOT NULL GROUP BY 1) q ON q.SubgroupKey = f.SubgroupKey WHERE AttendanceRate IS NOT NULL GROUP BY f.SubgroupKey, q1, q2, q3""")
def ag_22(v):
    return aggregates.box_plot(v.fact, "AttendanceRate", ["SubgroupKey"])


@query("ag_23_labelled_counts", """
SELECT 'no users' AS "Check", count(*) FILTER (UserCount = 0) AS Rows FROM fact_lecture UNION ALL
SELECT 'not over', count(*) FILTER (UserCount IS NULL) FROM fact_lecture UNION ALL
SELECT 'full room', count(*) FILTER (OccupancyRate >= 1) FROM fact_lecture""")
def ag_23(v):
    return aggregates.labelled_counts(v.fact, {
        "no users": F.col("UserCount") == 0, "not over": F.col("UserCount").isNull(), "full room": F.col("OccupancyRate") >= 1,
    })


@query("ag_24_group_with_dates", """
SELECT ProgramName, CAST(month(FullDate) AS INTEGER) AS Month, count(*) AS FactRows, count(DISTINCT LectureID) AS UniqueLectures, min(FullDate)::VARCHAR AS FirstDate, max(FullDate)::VARCHAR AS LastDate FROM schedule GROUP BY ALL""")
def ag_24(v):
    return v.schedule.groupBy("ProgramName", F.month("FullDate").alias("Month")).agg(
        F.count(F.lit(1)).alias("FactRows"), F.count_distinct("LectureID").alias("UniqueLectures"),
        F.min("FullDate").alias("FirstDate"), F.max("FullDate").alias("LastDate"),
    )


def _profile_sql(column: str) -> str:
    return f"""SELECT {column}, {r9('avg(AttendanceRate)')} AS mean, {_q('AttendanceRate', 0.5)} AS median, {r9('stddev_samp(AttendanceRate)')} AS std,
        count(AttendanceRate) AS count FROM facts_wide GROUP BY 1"""


for _column in ("NameDayDutch", "FromHour", "ClassProgramStage", "ActivityDomain", "NumberSemester"):
    query(f"ag_25_profile_{_column.lower()}", _profile_sql(_column))(
        lambda v, c=_column: aggregates.profile(v.facts_wide, c)
    )


@query("ag_26_contrast", f"""
WITH m AS ({metric_sql('course_valid', 'LessonType', rounded=False)})
SELECT label AS Metric, {r9('g')} AS Groepswerk, {r9('r')} AS GewoonVak, {r9('g - r')} AS VerschilGroepswerkMinGewoon FROM (
""" + " UNION ALL ".join(
    f"SELECT '{label}' AS label, max(CASE WHEN LessonType = 'Groepswerk' THEN CAST({c} AS DOUBLE) END) AS g, max(CASE WHEN LessonType = 'Gewoon vak' THEN CAST({c} AS DOUBLE) END) AS r FROM m"
    for label, c in course_types.CONTRAST_METRICS.items()
) + ")")
def ag_26(v):
    return course_types.contrast(aggregates.session_metrics(v.course_valid, ["LessonType"]))


# --- windows -----------------------------------------------------------------------------


def _lag_sql(group: str, n: int) -> str:
    return f"avg(AttendanceRate) OVER (PARTITION BY {group} ORDER BY ClassKey, DateKey, FromTimeKey, LectureID, SubgroupKey ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


@query("wn_01_lagged_rolling_mean", f"""
SELECT LectureID, SubgroupKey, {r9(_lag_sql('ClassKey', 5))} AS avg_attendance_class_5, {r9(_lag_sql('SubgroupKey', 5))} AS avg_attendance_subgroup_5,
       {r9(_lag_sql('Weekday', 10))} AS avg_attendance_weekday FROM facts_wide WHERE AttendanceRate <> 0""")
def wn_01(v):
    columns = ["LectureID", "SubgroupKey", "ClassKey", "DateKey", "FromTimeKey", "Weekday", "AttendanceRate"]
    rows = v.facts_wide.where("AttendanceRate <> 0").select(*columns)
    return attendance_model.lagged_features(rows).select(
        "LectureID", "SubgroupKey", "avg_attendance_class_5", "avg_attendance_subgroup_5", "avg_attendance_weekday"
    )


@query("wn_02_rolling_four_weeks", f"""
WITH t AS ({_TREND}), g AS (SELECT w.WeekStart, k.LessonType, t.AttendancePercentage FROM (SELECT DISTINCT WeekStart FROM t) w
  CROSS JOIN (VALUES ('Groepswerk'), ('Gewoon vak')) k(LessonType) LEFT JOIN t ON t.WeekStart = w.WeekStart AND t.LessonType = k.LessonType)
SELECT WeekStart, LessonType, {r9("avg(AttendancePercentage) OVER (PARTITION BY LessonType ORDER BY WeekStart ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")} AS RollingPercentage FROM g""")
def wn_02(v):
    return course_types.rolling_trend(course_types.weekly_trend(v.course_valid))


@query("wn_03_keep_first_or_last", """
SELECT ClassName, arg_min(ClassKey, ClassKey) AS FirstKey, arg_max(ClassKey, ClassKey) AS LastKey FROM dim_class GROUP BY 1""")
def wn_03(v):
    names = v.classes.select("ClassName", "ClassKey")
    first = dedupe.keep_one(names, ["ClassName"], ["ClassKey"]).withColumnRenamed("ClassKey", "FirstKey")
    last = dedupe.keep_one(names, ["ClassName"], ["ClassKey"], last=True).withColumnRenamed("ClassKey", "LastKey")
    return first.join(last, "ClassName")


_VOTES = "SELECT ClassName, SubgroupCode, count(*) AS EvidenceCount FROM schedule GROUP BY ALL"


@query("wn_04_best_candidate", f"""
SELECT ClassName, SubgroupCode, EvidenceCount, TopCandidateCount FROM (SELECT *, count(*) FILTER (EvidenceCount = top) OVER (PARTITION BY ClassName) AS TopCandidateCount,
  row_number() OVER (PARTITION BY ClassName ORDER BY EvidenceCount DESC, SubgroupCode) AS rn
  FROM (SELECT *, max(EvidenceCount) OVER (PARTITION BY ClassName) AS top FROM ({_VOTES}))) WHERE rn = 1""")
def wn_04(v):
    counts = aggregates.value_counts(v.schedule, ["ClassName", "SubgroupCode"], out="EvidenceCount")
    return windows.best_candidate(counts, ["ClassName"], "SubgroupCode", "EvidenceCount")


@query("wn_05_share_of_total", f"""
SELECT *, sum(EvidenceCount) OVER (PARTITION BY ClassName)::BIGINT AS TotalEvidence, {r9("EvidenceCount / CAST(sum(EvidenceCount) OVER (PARTITION BY ClassName) AS DOUBLE)")} AS Confidence FROM ({_VOTES})""")
def wn_05(v):
    counts = aggregates.value_counts(v.schedule, ["ClassName", "SubgroupCode"], out="EvidenceCount")
    return windows.with_share(counts, ["ClassName"], "EvidenceCount")


@query("wn_06_island_sessions", "SELECT ClassName, FullDate::VARCHAR AS FullDate, StartSecond, EndSecond, SessionNumber, SessionID FROM course_blocks")
def wn_06(v):
    return sessions.course_blocks(course_types.classified(v.typed_schedule)).select(
        "ClassName", "FullDate", "StartSecond", "EndSecond", "SessionNumber", "SessionID"
    )


@query("wn_07_bounded_sessions", "SELECT FullDate::VARCHAR AS FullDate, StartSecond, EndSecond, SessionNumber, SessionID FROM day_blocks")
def wn_07(v):
    return v.day_blocks


@query("wn_08_best_and_second", f"""
SELECT UserKey, max(n) AS Best, coalesce(max(n) FILTER (rn = 2), 0) AS SecondBest, {r9("(max(n) - coalesce(max(n) FILTER (rn = 2), 0)) / CAST(max(n) AS DOUBLE)")} AS Confidence
FROM (SELECT UserKey, DateKey, n, row_number() OVER (PARTITION BY UserKey ORDER BY n DESC) AS rn FROM (SELECT UserKey, DateKey, count(*) AS n FROM fact_wifi GROUP BY ALL)) GROUP BY 1""")
def wn_08(v):
    return windows.best_two(aggregates.value_counts(v.wifi, ["UserKey", "DateKey"], out="n"), ["UserKey"], "n")


@query("wn_09_surrogate_keys", """
SELECT UserName, row_number() OVER (ORDER BY UserName) + (SELECT max(UserKey) FROM dim_user) AS UserKey FROM dim_user""")
def wn_09(v):
    last = v.users.agg(F.max("UserKey")).first()[0]
    return windows.number_rows(v.users.select("UserName"), "UserName", "UserKey", start=last + 1)


@query("wn_10_first_by_order", "SELECT SessionSlot, min(YearWeek) AS FirstWeek, (SELECT min(YearWeek) FROM lab_sessions) AS FirstWeekOverall FROM lab_sessions GROUP BY 1")
def wn_10(v):
    overall = v.lab_sessions.agg(F.min("YearWeek").alias("w")).select("w").scalar()
    return v.lab_sessions.groupBy("SessionSlot").agg(F.min("YearWeek").alias("FirstWeek")).withColumn("FirstWeekOverall", overall)


@query("wn_11_rows_per_lecture", "SELECT LectureID, SubgroupKey, count(*) OVER (PARTITION BY LectureID) AS FactRows FROM fact_base")
def wn_11(v):
    return dedupe.with_group_size(v.fact_base.select("LectureID", "SubgroupKey"), ["LectureID"], "FactRows")


@query("wn_12_members_of_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def wn_12(v):
    lines = v.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dedupe.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])
