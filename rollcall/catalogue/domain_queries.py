"""The questions users ask: lectures, sessions, slots, programmes, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.aggregate_queries import _TREND, _q, lesson_sql, metric_sql
from rollcall.catalogue.registry import query
from rollcall.catalogue.scalar_queries import evaluated_courses
from rollcall.catalogue.source_queries import _STUDENTS, _students, course_list
from rollcall.catalogue.views import CTES, r9, secs
from rollcall.functions import clock, maths
from rollcall.operators import aggregates, tables
from rollcall.operators.joins import only_new
from rollcall.plans import course_types, courses, lectures, loads, presence, programs, sanity, sessions, slots

# --- lectures --------------------------------------------------------------------------------

CTES.setdefault("formatted_all", """
SELECT x.Id AS LectureId, CAST(20240101 + CAST(Id AS BIGINT) % 30 AS INTEGER) AS DateKey,
    CAST(replace(substr("Start", 12), ':', '') AS INTEGER) AS FromTimeKey, CAST(replace(substr("End", 12), ':', '') AS INTEGER) AS UntilTimeKey,
    c.ClassKey, unnest(CASE WHEN Classgroups IS NULL THEN [NULL] ELSE string_split(Classgroups, '|') END) AS SubgroupKey, r.RoomKey,
    CASE WHEN WorkFormCourse = 'Practicum' THEN 9 WHEN WorkFormExam = 'Schriftelijk examen' THEN 18 WHEN EducationActivity = 'Feedback' THEN 29 ELSE 1 END AS ActivityKey
FROM schedule_export x
LEFT JOIN (SELECT * FROM dim_class WHERE ClassProgramStage <> 2) c ON CAST(c.ClassCode AS VARCHAR) = split_part(x.OlodPointers, '|', 1)
LEFT JOIN (SELECT * FROM dim_room WHERE Capacity > 0) r ON CAST(r.RoomKey AS VARCHAR) = split_part(x.Rooms, '|', 1)
WHERE Status IS DISTINCT FROM 'Cancelled'""")
CTES.setdefault("formatted", "SELECT DISTINCT * FROM formatted_all")


def formatted(v):
    classes = v.classes.where("ClassProgramStage <> 2")
    rooms = v.rooms.where("Capacity > 0").withColumn("Code", F.col("RoomKey").cast("string"))
    return lectures.format_lectures(v.schedule_export, classes, rooms, v.activities)


@query("dom_01_format_lectures", "SELECT *, CAST(NULL AS BIGINT) AS UserCount, CAST(NULL AS BIGINT) AS TotalStudents, CAST(NULL AS DOUBLE) AS AttendanceRate FROM formatted")
def dom_01(v):
    return formatted(v)


@query("dom_01_missing_keys", "SELECT LectureId, SubgroupKey, ClassKey, RoomKey FROM formatted WHERE ClassKey IS NULL OR RoomKey IS NULL")
def dom_01_missing(v):
    return lectures.split_by_keys(formatted(v))[1].select("LectureId", "SubgroupKey", "ClassKey", "RoomKey")


@query("ag_27_run_summary", """
SELECT unnest(['Rows', 'ValidRows', 'InvalidRows', 'MissingClassKeys', 'MissingRoomKeys', 'MissingBothKeys', 'MissingActivityKeys', 'InvalidDates']) AS "Check",
  unnest([count(*), count(*) FILTER (ClassKey IS NOT NULL AND RoomKey IS NOT NULL), count(*) FILTER (ClassKey IS NULL OR RoomKey IS NULL), count(*) FILTER (ClassKey IS NULL),
    count(*) FILTER (RoomKey IS NULL), count(*) FILTER (ClassKey IS NULL AND RoomKey IS NULL), 0, 0]) AS Rows FROM formatted""")
def ag_27(v):
    return lectures.format_summary(formatted(v))


@query("dom_02_fact_load", """
WITH s AS (SELECT CAST(LectureId AS BIGINT) AS LectureID, CAST(SubgroupKey AS BIGINT) AS SubgroupKey, DateKey, FromTimeKey, UntilTimeKey, ClassKey, RoomKey, ActivityKey,
             CAST(NULL AS BIGINT) AS UserCount FROM formatted WHERE SubgroupKey IS NOT NULL AND CAST(SubgroupKey AS BIGINT) IN (SELECT SubgroupKey FROM dim_subgroup WHERE ProgramName <> 'ASIA'))
SELECT * FROM s UNION ALL SELECT LectureID, SubgroupKey, DateKey, FromTimeKey, UntilTimeKey, ClassKey, RoomKey, ActivityKey, UserCount FROM fact_lecture f
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.LectureID = f.LectureID AND s.SubgroupKey = f.SubgroupKey)""")
def dom_02(v):
    known = v.subgroups.where("ProgramName <> 'ASIA'")
    return lectures.load_fact(v.fact, formatted(v), known, ["DateKey", "FromTimeKey"]).drop("TotalStudents")


# --- programmes --------------------------------------------------------------------------------

CTES.setdefault("program_links", """
SELECT DISTINCT Id, g % 25 AS code FROM (
  SELECT o_orderkey AS Id, o_custkey AS g FROM orders UNION ALL SELECT o_orderkey, o_custkey + 5 FROM orders
  UNION ALL SELECT o_orderkey, min(l_suppkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1)""")
CTES.setdefault("program_known", """
SELECT SubgroupKey AS code, ProgramName || CASE WHEN SubgroupKey < 5 THEN '/1A' ELSE '/2A' END AS name, ProgramName AS family FROM dim_subgroup WHERE SubgroupKey < 15""")


def _votes_sql(column: str) -> str:
    return f"""SELECT m.code, k.{column} AS candidate, count(DISTINCT m.Id) AS n FROM program_links m JOIN program_links o ON o.Id = m.Id JOIN program_known k ON k.code = o.code
        WHERE m.code NOT IN (SELECT code FROM program_known) GROUP BY ALL"""


def _shares_sql(column: str) -> str:
    return f"""SELECT code, candidate, n, sum(n) OVER (PARTITION BY code) AS total, max(n) OVER (PARTITION BY code) AS top,
        row_number() OVER (PARTITION BY code ORDER BY n DESC, candidate) AS rn FROM ({_votes_sql(column)})"""


def _accepted_sql(column: str) -> str:
    return f"""SELECT code, min(candidate) FILTER (rn = 1) AS candidate, max(n) AS n, max(n) / CAST(max(total) AS DOUBLE) AS share FROM ({_shares_sql(column)})
        GROUP BY 1 HAVING max(n) >= 3 AND max(n) / CAST(max(total) AS DOUBLE) >= 0.8 AND count(*) FILTER (n = top) = 1"""


def program_inputs(v):
    """Subgroups of which two in five lack a programme, and a timetable whose lectures
    mostly hold subgroups of one programme."""
    known = F.col("SubgroupKey") < 15
    stage = F.when(F.col("SubgroupKey") < 5, "/1A").otherwise("/2A")
    groups = v.subgroups.select(
        "SubgroupKey", F.concat(F.col("SubgroupKey").cast("string"), F.lit(".0")).alias("SubgroupCode"),
        F.when(known, F.concat("ProgramName", stage)).otherwise("nan").alias("ProgramName"),
    )
    o, l = v.raw("orders"), v.raw("lineitem")
    stray = l.groupBy("l_orderkey").agg((F.min("l_suppkey") % 25).cast("string").alias("_s"))
    c = F.col("o_custkey")
    rows = o.join(stray, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("_s"))
    cell = F.concat_ws("|", (c % 25).cast("string"), F.concat(((c + 5) % 25).cast("string"), F.lit(" ")), urgent)
    return groups, rows.select(F.col("o_orderkey").cast("string").alias("Id"), cell.alias("Classgroups"))


@query("dom_06_program_inference", f"""
SELECT s.SubgroupKey, CAST(s.SubgroupKey AS VARCHAR) AS SubgroupCode, coalesce(k.name, e.candidate) AS ProgramName,
       coalesce(k.family, split_part(e.candidate, '/', 1), f.candidate) AS ProgramFamily,
       CASE WHEN k.name IS NOT NULL THEN 'students' WHEN e.candidate IS NOT NULL THEN 'lecture_subgroup_cooccurrence' END AS ProgramNameSource,
       CASE WHEN k.name IS NOT NULL THEN 'students' WHEN coalesce(e.candidate, f.candidate) IS NOT NULL THEN 'lecture_subgroup_cooccurrence' END AS ProgramFamilySource,
       {r9('CASE WHEN k.name IS NULL THEN coalesce(e.share, f.share) END')} AS InferenceConfidence, CASE WHEN k.name IS NULL THEN coalesce(e.n, f.n) END AS InferenceEvidenceCount
FROM dim_subgroup s LEFT JOIN program_known k ON k.code = s.SubgroupKey
LEFT JOIN ({_accepted_sql('name')}) e ON e.code = s.SubgroupKey LEFT JOIN ({_accepted_sql('family')}) f ON f.code = s.SubgroupKey""")
def dom_06(v):
    return programs.infer_programs(*program_inputs(v))


@query("dom_06_evidence", f"""
SELECT CAST(code AS VARCHAR) AS SubgroupCode, candidate AS ProgramName, n AS EvidenceCount, CAST(total AS BIGINT) AS TotalEvidence, {r9('n / CAST(total AS DOUBLE)')} AS Confidence, 'ExactProgramName' AS InferenceType FROM ({_shares_sql('name')})
UNION ALL SELECT CAST(code AS VARCHAR), candidate, n, CAST(total AS BIGINT), {r9('n / CAST(total AS DOUBLE)')}, 'ProgramFamily' FROM ({_shares_sql('family')})""")
def dom_06_evidence(v):
    return programs.evidence_table(*programs.evidence(*program_inputs(v)))


@query("dom_06_summary", f"""
WITH r AS (SELECT k.name, e.candidate AS e, f.candidate AS f FROM dim_subgroup s LEFT JOIN program_known k ON k.code = s.SubgroupKey
  LEFT JOIN ({_accepted_sql('name')}) e ON e.code = s.SubgroupKey LEFT JOIN ({_accepted_sql('family')}) f ON f.code = s.SubgroupKey)
SELECT unnest(['Subgroups', 'KnownFromStudents', 'InferredExactly', 'InferredFamilyOnly', 'WithoutProgramName', 'WithoutAnything']) AS "Check",
  unnest([count(*), count(name), count(*) FILTER (name IS NULL AND e IS NOT NULL), count(*) FILTER (name IS NULL AND e IS NULL AND f IS NOT NULL),
    count(*) FILTER (name IS NULL AND e IS NULL), count(*) FILTER (name IS NULL AND e IS NULL AND f IS NULL)]) AS Rows FROM r""")
def dom_06_summary(v):
    return programs.inference_summary(programs.infer_programs(*program_inputs(v)))


@query("dom_07_group_projects", """
SELECT code, title, reason AS classification_reason, reason IN ('Project in titel', 'Observatie van functioneren van de student') AS is_group_project FROM (
  SELECT code, title, CASE WHEN evaluation_methods LIKE '[%' AND f = 'Schriftelijk examen' THEN 'Schriftelijk examen' WHEN evaluation_methods LIKE '{%' THEN 'Mondeling examen'
    WHEN title LIKE '% project' THEN 'Project in titel' WHEN evaluation_methods IS NOT NULL AND f LIKE 'Observatie%' THEN 'Observatie van functioneren van de student'
    ELSE 'Geen sterk signaal voor verplicht groepswerk' END AS reason FROM evaluated_courses)""")
def dom_07(v):
    return courses.classify_courses(evaluated_courses(v)).select("code", "title", "classification_reason", "is_group_project")


_PROGRAM_CODES = """SELECT c_custkey AS SubgroupKey, CASE c_mktsegment WHEN 'BUILDING' THEN 'PBA-TIN/1A' WHEN 'AUTOMOBILE' THEN 'PBA-SO/LOBR/2A' WHEN 'MACHINERY' THEN 'ic it' WHEN 'HOUSEHOLD' THEN NULL ELSE NULL END AS name,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PBA-VPK' END AS family FROM customer"""


@query("dom_08_program_attributes", f"""
SELECT SubgroupKey, CAST(SubgroupKey AS VARCHAR) AS SubgroupCode, name AS ProgramName, coalesce(family, upper(split_part(name, '/', 1))) AS ProgramFamily,
  CASE WHEN name LIKE 'PBA-TIN%' OR name = 'ic it' THEN 'Toegepaste Informatica' WHEN name LIKE 'PBA-SO%' THEN 'Sociaal Werk' WHEN family IS NOT NULL THEN 'Verpleegkunde' END AS StudyProgram,
  coalesce(name LIKE 'PBA-TIN%' OR name = 'ic it', false) AS IsIT, CASE WHEN name IS NOT NULL THEN 'ExactProgramName' WHEN family IS NOT NULL THEN 'ProgramFamilyOnly' ELSE 'Unknown' END AS ProgramInformationLevel
FROM ({_PROGRAM_CODES})""")
def dom_08(v):
    return programs.program_attributes(_program_codes(v))


def _program_codes(v):
    m = F.col("c_mktsegment")
    name = (
        F.when(m == "BUILDING", "PBA-TIN/1A").when(m == "AUTOMOBILE", " PBA-SO/LOBR/2A").when(m == "MACHINERY", "ic it").otherwise("NaN")
    )
    k = F.col("c_custkey")
    return v.raw("customer").select(
        k.alias("SubgroupKey"), F.concat(k.cast("string"), F.lit(".0")).alias("SubgroupCode"), name.alias("ProgramName"),
        F.when(m == "HOUSEHOLD", "pba-vpk").alias("ProgramFamily"),
    )


@query("dom_08_unknown_programs", f"SELECT SubgroupKey FROM ({_PROGRAM_CODES}) WHERE name IS NULL AND family IS NULL")
def dom_08_unknown(v):
    return programs.unknown_programs(programs.program_attributes(_program_codes(v))).select("SubgroupKey")


CTES.setdefault("program_compare", """
SELECT coalesce(g.code, r.code) AS SubgroupCode, g.name AS ProgramName, r.name AS ReferenceProgramName,
  CASE WHEN g.code IS NULL THEN 'only_reference' WHEN r.code IS NULL THEN 'only_generated' WHEN g.name IS NULL THEN 'can_fill' WHEN upper(g.name) = upper(r.name) THEN 'match' ELSE 'conflict' END AS Status
FROM (SELECT CAST(c_custkey AS VARCHAR) AS code, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS name FROM customer) g
FULL JOIN (SELECT CAST(c_custkey AS VARCHAR) AS code, CASE WHEN c_nationkey < 5 THEN 'OTHER NAME' ELSE lower(c_mktsegment) END AS name FROM customer WHERE c_acctbal > 0
           UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier) r ON r.code = g.code""")


def compared(v):
    c = v.raw("customer")
    k, m = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    generated = c.select(
        F.concat(F.lit(" "), k, F.lit(".0")).alias("SubgroupCode"), F.when(m == "BUILDING", "None").otherwise(m).alias("ProgramName"),
        F.lit("students").alias("ProgramNameSource"), F.lit(None).cast("double").alias("InferenceConfidence"),
        F.lit(None).cast("bigint").alias("InferenceEvidenceCount"),
    )
    name = F.when(F.col("c_nationkey") < 5, " OTHER   NAME").otherwise(F.lower(m))
    reference = c.where("c_acctbal > 0").select(k.alias("SUBGROEPID"), name.alias("SUBGROEPCODE")).unionByName(
        v.raw("supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("SUBGROEPID"), F.col("s_name").alias("SUBGROEPCODE"))
    )
    return programs.reconcile(generated, reference)


@query("dom_09_reconciliation", "SELECT * FROM program_compare")
def dom_09(v):
    return compared(v).select("SubgroupCode", "ProgramName", "ReferenceProgramName", "Status")


@query("dom_09_filled", """
SELECT SubgroupCode, CASE WHEN Status IN ('can_fill', 'conflict') THEN ReferenceProgramName ELSE ProgramName END AS ProgramName,
  CASE Status WHEN 'can_fill' THEN 'cleaned_unique_subgroups' WHEN 'conflict' THEN 'cleaned_unique_subgroups_override' ELSE 'students' END AS ProgramNameSource,
  CASE WHEN Status IN ('can_fill', 'conflict') THEN CAST(1 AS DOUBLE) END AS InferenceConfidence FROM program_compare WHERE Status <> 'only_reference'""")
def dom_09_filled(v):
    return programs.fill_from_reference(compared(v), overwrite_conflicts=True).drop("InferenceEvidenceCount")


@query("dom_09_coverage", f"""
SELECT g AS Generated, m AS match, f AS can_fill, c AS conflict, r AS only_reference, o AS only_generated, x AS MissingBefore, {r9('k * 100.0 / g')} AS CoverageBefore, {r9('(k + f) * 100.0 / g')} AS CoverageAfter
FROM (SELECT count(*) FILTER (Status <> 'only_reference') AS g, count(*) FILTER (Status = 'match') AS m, count(*) FILTER (Status = 'can_fill') AS f, count(*) FILTER (Status = 'conflict') AS c,
  count(*) FILTER (Status = 'only_reference') AS r, count(*) FILTER (Status = 'only_generated') AS o, count(*) FILTER (Status <> 'only_reference' AND ProgramName IS NULL) AS x,
  count(*) FILTER (Status <> 'only_reference' AND ProgramName IS NOT NULL) AS k FROM program_compare)""")
def dom_09_coverage(v):
    return programs.coverage(compared(v))


# --- sessions and slots ----------------------------------------------------------------------------

_SESSION = "SessionID, FullDate::VARCHAR AS FullDate, SessionSlot, strftime(SessionStart, '%Y-%m-%d %H:%M:%S') AS SessionStart, strftime(SessionEnd, '%Y-%m-%d %H:%M:%S') AS SessionEnd"


@query("dom_10_bounded_sessions", f"SELECT {_SESSION}, NumberOfTimeBlocks, {r9('SessionDurationMinutes')} AS SessionDurationMinutes, LooksLikeFourHourSession FROM day_sessions")
def dom_10(v):
    return v.day_sessions.select(
        "SessionID", "FullDate", "SessionSlot", "SessionStart", "SessionEnd", "NumberOfTimeBlocks", "SessionDurationMinutes", "LooksLikeFourHourSession"
    )


@query("dom_11_course_sessions", f"SELECT {_SESSION}, ClassName, LessonType, NumberOfTimeBlocks, {r9('SessionDurationMinutes')} AS SessionDurationMinutes FROM course_sessions")
def dom_11(v):
    blocks = sessions.course_blocks(course_types.classified(v.typed_schedule))
    return sessions.course_sessions(blocks).select(
        "SessionID", "FullDate", "SessionSlot", "SessionStart", "SessionEnd", "ClassName", "LessonType", "NumberOfTimeBlocks", "SessionDurationMinutes"
    )


@query("dom_12_session_attendance", """
SELECT SessionID, EstimatedPresentStudents, AdministrativeExpectedStudents, NumberOfSubgroups, NumberOfDistinctRooms, Rooms, NumberOfTimeBlocks FROM day_attendance""")
def dom_12(v):
    return v.day_attendance.select(
        "SessionID", "EstimatedPresentStudents", "AdministrativeExpectedStudents", "NumberOfSubgroups", "NumberOfDistinctRooms", "Rooms", "NumberOfTimeBlocks"
    )


@query("dom_12_session_subgroups", """
SELECT SessionID, SubgroupCode, max(UserCount) AS EstimatedUniquePresent, max(TotalStudents) AS AdministrativeStudents, count(*) AS NumberOfRows, count(DISTINCT LectureID) AS NumberOfLectureIDs,
  count(DISTINCT StartSecond) AS NumberOfBlocks, count(DISTINCT RoomCode) AS NumberOfRooms, min(UserCount) AS MinBlockCount, max(UserCount) AS MaxBlockCount FROM day_rows GROUP BY 1, 2""")
def dom_12_subgroups(v):
    return sessions.session_subgroups(sessions.session_rows(v.day_rows, v.day_blocks)).drop("FullDate", "Rooms")


@query("dom_13_slot_expectation", """
SELECT SessionSlot, min(WeekdayNumber) AS WeekdayNumber, min(WeekdayName) AS WeekdayName, min(SessionStartTime) AS SessionStartTime, min(SessionEndTime) AS SessionEndTime,
  max(EstimatedPresentStudents) AS ExpectedStudentsForSlot, round(quantile_cont(CAST(EstimatedPresentStudents AS DOUBLE), 0.95), 9) AS P95StudentsForSlot, count(DISTINCT SessionID) AS NumberOfObservedSessions
FROM lab_attendance GROUP BY 1""")
def dom_13(v):
    return slots.slot_expectation(v.lab_attendance)


@query("dom_13_corrected_sessions", f"""
SELECT SessionID, EstimatedPresentStudents, ExpectedStudentsForSlot, NumberOfObservedSessions, {r9('P95StudentsForSlot')} AS P95StudentsForSlot, {r9('CorrectedAttendanceRate')} AS CorrectedAttendanceRate,
  {r9('CASE WHEN CorrectedAttendanceRate > 1 THEN 1.0 ELSE CorrectedAttendanceRate END')} AS CorrectedAttendanceRateCapped, {r9('AdministrativeAttendanceRate')} AS AdministrativeAttendanceRate FROM lab_corrected""")
def dom_13_corrected(v):
    return slots.corrected_sessions(v.lab_attendance).select(
        "SessionID", "EstimatedPresentStudents", "ExpectedStudentsForSlot", "NumberOfObservedSessions", "P95StudentsForSlot",
        "CorrectedAttendanceRate", "CorrectedAttendanceRateCapped", "AdministrativeAttendanceRate",
    )


@query("dom_13_slot_summary", f"""
SELECT SessionSlot, count(DISTINCT SessionID) AS NumberOfSessions, max(ExpectedStudentsForSlot) AS ExpectedStudents, {r9('avg(EstimatedPresentStudents)')} AS MeanPresentStudents,
  {_q('EstimatedPresentStudents', 0.5)} AS MedianPresentStudents, min(EstimatedPresentStudents) AS MinPresentStudents, max(EstimatedPresentStudents) AS MaxPresentStudents,
  {r9('avg(CorrectedAttendanceRate)')} AS MeanAttendanceRate, {_q('CorrectedAttendanceRate', 0.5)} AS MedianAttendanceRate FROM lab_corrected GROUP BY 1""")
def dom_13_summary(v):
    return slots.slot_summary(slots.corrected_sessions(v.lab_attendance)).drop("WeekdayNumber", "WeekdayName", "SessionStartTime", "SessionEndTime")


@query("dom_13_slot_comparison", f"""
SELECT SessionSlot, {r9('avg(AdministrativeAttendanceRate)')} AS MeanAdministrativeAttendance, {r9('avg(CorrectedAttendanceRate)')} AS MeanCorrectedAttendance,
  {_q('AdministrativeAttendanceRate', 0.5)} AS MedianAdministrativeAttendance, {_q('CorrectedAttendanceRate', 0.5)} AS MedianCorrectedAttendance, max(ExpectedStudentsForSlot) AS ExpectedStudentsForSlot FROM lab_corrected GROUP BY 1""")
def dom_13_comparison(v):
    return slots.slot_comparison(slots.corrected_sessions(v.lab_attendance))


@query("dom_14_first_week_sensitivity", """
SELECT SessionSlot, FirstObservedWeek, max(EstimatedPresentStudents) AS MaximumIncludingFirstWeek, max(EstimatedPresentStudents) FILTER (YearWeek <> FirstObservedWeek) AS MaximumWithoutFirstWeek
FROM (SELECT *, min(YearWeek) OVER (PARTITION BY SessionSlot) AS FirstObservedWeek FROM lab_attendance) GROUP BY 1, 2""")
def dom_14(v):
    return slots.first_week_sensitivity(v.lab_attendance)


@query("dom_15_slot_assignment", f"SELECT * REPLACE ({r9('AssignmentConfidence')} AS AssignmentConfidence) FROM lab_assigned")
def dom_15(v):
    return v.lab_assigned


@query("dom_15_latest_on_tie", """
WITH c AS (SELECT *, max(SessionsObserved) OVER (PARTITION BY UserKey) AS m, sum(SessionsObserved) OVER (PARTITION BY UserKey) AS total FROM lab_counts)
SELECT UserKey, CASE WHEN max(total) < 2 THEN 'Unassigned' ELSE arg_max(SessionSlot, strftime(LastSeen, '%Y%m%d') || SessionSlot) FILTER (SessionsObserved = m) END AS AssignedSessionSlot,
  CASE WHEN max(total) < 2 THEN 'Too few observations' WHEN count(*) FILTER (SessionsObserved = m) = 1 THEN 'Unique maximum' ELSE 'Tie resolved by latest' END AS AssignmentReason FROM c GROUP BY 1""")
def dom_15_latest(v):
    counts = slots.user_slot_counts(v.lab_presence, v.lab_sessions)
    return slots.assign_slots(counts, tie="latest").select("UserKey", "AssignedSessionSlot", "AssignmentReason")


@query("dom_16_group_sizes", f"""
SELECT AssignedSessionSlot, count(*) AS ExpectedStudents, {r9('avg(AssignmentConfidence)')} AS MeanAssignmentConfidence, {_q('AssignmentConfidence', 0.5)} AS MedianAssignmentConfidence,
  {r9('avg(BestSlotObservations)')} AS MeanBestSlotObservations FROM lab_assigned WHERE AssignedSessionSlot <> 'Unassigned' GROUP BY 1""")
def dom_16(v):
    return slots.group_sizes(v.lab_assigned)


@query("dom_16_assignment_quality", """
SELECT AssignmentReason, AssignedSessionSlot <> 'Unassigned' AS Assigned, count(*) AS Users FROM lab_assigned GROUP BY ALL""")
def dom_16_quality(v):
    return v.lab_assigned.groupBy(
        "AssignmentReason", (F.col("AssignedSessionSlot") != slots.UNASSIGNED).alias("Assigned")
    ).agg(F.count(F.lit(1)).alias("Users"))


@query("dom_17_corrected_attendance", f"SELECT {_SESSION}, YearWeek, ExpectedStudents, PresentAssignedStudents, {r9('AttendanceRate')} AS AttendanceRate FROM lab_results")
def dom_17(v):
    return slots.corrected_attendance(v.lab_sessions, v.lab_presence, v.lab_assigned)


@query("dom_17_slot_summary", f"""
SELECT SessionSlot, max(ExpectedStudents) AS ExpectedStudents, count(*) AS NumberOfSessions, {r9('avg(PresentAssignedStudents)')} AS MeanPresent, {_q('PresentAssignedStudents', 0.5)} AS MedianPresent,
  min(PresentAssignedStudents) AS MinPresent, max(PresentAssignedStudents) AS MaxPresent, {r9('avg(AttendanceRate)')} AS MeanAttendanceRate, {_q('AttendanceRate', 0.5)} AS MedianAttendanceRate FROM lab_results GROUP BY 1""")
def dom_17_summary(v):
    return slots.assigned_slot_summary(slots.corrected_attendance(v.lab_sessions, v.lab_presence, v.lab_assigned))


@query("dom_18_first_week_switchers", """
SELECT DISTINCT p.UserKey, p.FullDate::VARCHAR AS FullDate, p.SessionSlot, a.AssignedSessionSlot FROM lab_presence p JOIN lab_assigned a ON a.UserKey = p.UserKey
WHERE p.YearWeek = (SELECT min(YearWeek) FROM lab_sessions) AND a.AssignedSessionSlot <> 'Unassigned' AND a.AssignedSessionSlot <> p.SessionSlot""")
def dom_18(v):
    return slots.first_week_switchers(v.lab_sessions, v.lab_presence, v.lab_assigned)


# --- course types --------------------------------------------------------------------------------------


@query("dom_19_session_results", f"SELECT {_SESSION}, ClassName, LessonType, ExpectedStudents, PresentStudents, {r9('AttendanceRate')} AS AttendanceRate FROM course_results")
def dom_19(v):
    return v.course_results.select(
        "SessionID", "FullDate", "SessionSlot", "SessionStart", "SessionEnd", "ClassName", "LessonType", "ExpectedStudents", "PresentStudents", "AttendanceRate"
    )


@query("dom_19_metrics_by_type", metric_sql("course_valid", "LessonType"))
def dom_19_type(v):
    return aggregates.session_metrics(v.course_valid, ["LessonType"])


@query("dom_19_unmatched_titles", "SELECT DISTINCT ClassName, NormalizedClassName FROM typed_schedule WHERE LessonType = 'Niet gekoppeld'")
def dom_19_unmatched(v):
    return course_types.unmatched_titles(v.typed_schedule)


@query("dom_19_lowest_sessions", f"SELECT SessionID, ClassName, ExpectedStudents, PresentStudents, {r9('AttendanceRate')} AS AttendanceRate FROM course_valid ORDER BY course_valid.AttendanceRate, SessionID LIMIT 30")
def dom_19_lowest(v):
    return course_types.extremes(v.course_valid).select("SessionID", "ClassName", "ExpectedStudents", "PresentStudents", "AttendanceRate")


@query("dom_19_quality_summary", """
SELECT 'Roosterfactrijen' AS "Check", count(*) AS Rows FROM typed_schedule UNION ALL SELECT 'Geclassificeerde roosterfactrijen', count(*) FROM typed_schedule WHERE LessonType <> 'Niet gekoppeld'
UNION ALL SELECT 'Niet-gekoppelde unieke vaknamen', count(DISTINCT ClassName) FROM typed_schedule WHERE LessonType = 'Niet gekoppeld' UNION ALL SELECT 'Afgeleide sessies', count(*) FROM course_results
UNION ALL SELECT 'Sessies met verwachte studenten', count(*) FROM course_valid UNION ALL SELECT 'Sessies zonder verwachte studenten', count(*) FROM course_results WHERE ExpectedStudents = 0
UNION ALL SELECT 'Sessies zonder aanwezige wifi-gebruikers', count(*) FROM course_valid WHERE PresentStudents = 0 UNION ALL SELECT 'Sessies boven 100 procent aanwezigheid', count(*) FROM course_valid WHERE AttendanceRate > 1""")
def dom_19_quality(v):
    return course_types.quality_summary(v.typed_schedule, v.course_results)


CTES.setdefault("lecture_results", """
SELECT l.*, coalesce(e.n, 0) AS TotalStudents, coalesce(p.n, 0) AS UserCount, CASE WHEN coalesce(e.n, 0) > 0 THEN coalesce(p.n, 0) / CAST(e.n AS DOUBLE) END AS AttendanceRate
FROM (SELECT LectureID, min(FullDate) AS FullDate, min(ClassName) AS ClassName, min(LessonType) AS LessonType, string_agg(DISTINCT SubgroupCode, ', ' ORDER BY SubgroupCode) AS SubgroupCodes FROM typed_schedule GROUP BY 1) l
LEFT JOIN (SELECT LectureID, CAST(sum(n) AS BIGINT) AS n FROM lecture_cohort GROUP BY 1) e ON e.LectureID = l.LectureID
LEFT JOIN (SELECT t.LectureID, CAST(sum(k.n) AS BIGINT) AS n FROM lecture_cohort t JOIN (SELECT DISTINCT LectureID, DateKey, StartSecond, EndSecond FROM typed_schedule) s ON s.LectureID = t.LectureID
           JOIN lecture_users k ON k.DateKey = s.DateKey AND k.StartSecond = s.StartSecond AND k.EndSecond = s.EndSecond AND k.Cohort = t.Cohort GROUP BY 1) p ON p.LectureID = l.LectureID""")
CTES.setdefault("lecture_cohort", "SELECT DISTINCT LectureID, Cohort, n FROM typed_schedule JOIN cohort_member USING (SubgroupKey)")
CTES.setdefault("lecture_users", f"""
SELECT DateKey, StartSecond, EndSecond, Cohort, count(DISTINCT UserKey) AS n FROM (SELECT DISTINCT DateKey, StartSecond, EndSecond FROM typed_schedule) s
JOIN fact_wifi w USING (DateKey) JOIN user_cohort USING (UserKey) WHERE {secs('w.TimeKey')} BETWEEN StartSecond AND EndSecond GROUP BY ALL""")


@query("dom_20_lecture_results", f"SELECT LectureID, FullDate::VARCHAR AS FullDate, ClassName, LessonType, SubgroupCodes, TotalStudents, UserCount, {r9('AttendanceRate')} AS AttendanceRate FROM lecture_results")
def dom_20(v):
    return course_types.lecture_results(v.typed_schedule, v.wifi, v.bridge).select(
        "LectureID", "FullDate", "ClassName", "LessonType", "SubgroupCodes", "TotalStudents", "UserCount", "AttendanceRate"
    )


@query("dom_20_lesson_metrics", lesson_sql("(SELECT * FROM lecture_results WHERE LessonType <> 'Niet gekoppeld' AND TotalStudents > 0 AND AttendanceRate >= 0)", "LessonType"))
def dom_20_metrics(v):
    rows = course_types.valid_observations(course_types.lecture_results(v.typed_schedule, v.wifi, v.bridge))
    return aggregates.lesson_metrics(rows, ["LessonType"])


@query("dom_21_weekly_pivot", f"""
WITH t AS ({_TREND}) SELECT WeekStart, max(AttendancePercentage) FILTER (LessonType = 'Groepswerk') AS Groepswerk, max(AttendancePercentage) FILTER (LessonType = 'Gewoon vak') AS GewoonVak FROM t GROUP BY 1""")
def dom_21(v):
    return course_types.weekly_pivot(course_types.weekly_trend(v.course_valid))


# --- sanity checks and exploration ---------------------------------------------------------------------------


@query("dom_22_grain_summary", f"""
SELECT sum(n)::BIGINT AS FactRows, count(*) AS UniqueLectures, count(*) FILTER (n = 1) AS LecturesWithOneRow, count(*) FILTER (n > 1) AS LecturesWithMoreRows, max(n) AS MaxRowsPerLecture, {r9('avg(n)')} AS MeanRowsPerLecture
FROM (SELECT LectureID, count(*) AS n FROM facts_wide GROUP BY 1)""")
def dom_22_grain(v):
    return sanity.grain_summary(v.facts_wide)


@query("dom_22_consistency", """
SELECT unnest(['TotalStudents NULL', 'TotalStudents <= 0', 'UserCount NULL', 'UserCount < 0', 'AttendanceRate < 0', 'AttendanceRate > 1', 'Afwijking opgeslagen/herberekend > 0.0001']) AS "Check",
  unnest([count(*) FILTER (TotalStudents IS NULL), count(*) FILTER (coalesce(TotalStudents, 0) <= 0), count(*) FILTER (UserCount IS NULL), count(*) FILTER (coalesce(UserCount, 0) < 0),
    count(*) FILTER (AttendanceRate < 0), count(*) FILTER (AttendanceRate > 1), 0]) AS Rows FROM facts_wide""")
def dom_22_consistency(v):
    return sanity.consistency(v.facts_wide)


# facts with known faults: exact copies, repeated keys, a wrong rate, a negative count, no students
_EXACT, _REPEAT, _RATE, _NEGATIVE, _NOBODY = 97, 89, 83, 79, 73
CTES.setdefault("faulty_facts", f"""
SELECT * REPLACE (CASE WHEN LectureID % {_NOBODY} = 0 THEN NULL ELSE TotalStudents END AS TotalStudents,
  CASE WHEN LectureID % {_NEGATIVE} = 0 THEN -1 ELSE UserCount END AS UserCount,
  CASE WHEN LectureID % {_RATE} = 0 THEN AttendanceRate + 0.5 ELSE AttendanceRate END AS AttendanceRate) FROM facts_wide
UNION ALL SELECT * FROM facts_wide WHERE LectureID % {_EXACT} = 0
UNION ALL SELECT * REPLACE (UserCount + 1 AS UserCount) FROM facts_wide WHERE LectureID % {_REPEAT} = 0""")
_DIFFERS = "abs(AttendanceRate - CASE WHEN TotalStudents > 0 THEN UserCount / CAST(TotalStudents AS DOUBLE) END) > 1e-4"


def faulty_facts(v):
    f, k = v.facts_wide, F.col("LectureID")
    marred = f.withColumns({
        "TotalStudents": F.when(k % _NOBODY != 0, F.col("TotalStudents")),
        "UserCount": F.when(k % _NEGATIVE == 0, F.lit(-1)).otherwise(F.col("UserCount")),
        "AttendanceRate": F.when(k % _RATE == 0, F.col("AttendanceRate") + 0.5).otherwise(F.col("AttendanceRate")),
    })
    copies = f.where(k % _EXACT == 0)
    again = f.where(k % _REPEAT == 0).withColumn("UserCount", F.col("UserCount") + 1)
    return marred.unionByName(copies).unionByName(again)


@query("dom_22_consistency_of_faulty_facts", f"""
SELECT unnest(['TotalStudents NULL', 'TotalStudents <= 0', 'UserCount NULL', 'UserCount < 0', 'AttendanceRate < 0', 'AttendanceRate > 1', 'Afwijking opgeslagen/herberekend > 0.0001']) AS "Check",
  unnest([count(*) FILTER (TotalStudents IS NULL), count(*) FILTER (coalesce(TotalStudents, 0) <= 0), count(*) FILTER (UserCount IS NULL), count(*) FILTER (coalesce(UserCount, 0) < 0),
    count(*) FILTER (AttendanceRate < 0), count(*) FILTER (AttendanceRate > 1), count(*) FILTER ({_DIFFERS})]) AS Rows FROM faulty_facts""")
def dom_22_consistency_faulty(v):
    return sanity.consistency(faulty_facts(v))


@query("dom_22_status_of_faulty_facts", f"""
WITH l AS (SELECT LectureID, count(*) AS n, min(UserCount) AS low, max(UserCount) AS high, sum(TotalStudents) AS students, arg_min(RoomCapacity, SubgroupKey) AS room FROM faulty_facts GROUP BY 1),
c AS (SELECT '{sanity.CHECK_EXACT}' AS Controle, (SELECT coalesce(sum(n), 0) FROM (SELECT *, count(*) AS n FROM faulty_facts GROUP BY ALL HAVING count(*) > 1))::BIGINT AS n, 'NAKIJKEN' AS bad, 'OK' AS good
  UNION ALL SELECT '{sanity.CHECK_KEY}', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM faulty_facts GROUP BY LectureID, SubgroupKey HAVING count(*) > 1))::BIGINT, 'NAKIJKEN', 'OK'
  UNION ALL SELECT '{sanity.CHECK_RATE}', (SELECT count(*) FROM faulty_facts WHERE {_DIFFERS}), 'NAKIJKEN', 'OK'
  UNION ALL SELECT '{sanity.CHECK_REPEATED}', (SELECT count(*) FROM l WHERE n > 1 AND low = high), 'INTERPRETEREN', 'INTERPRETEREN'
  UNION ALL SELECT '{sanity.CHECK_CAPACITY}', (SELECT count(*) FROM l WHERE students > room OR high > room), 'INTERPRETEREN', 'OK'
  UNION ALL SELECT '{sanity.CHECK_OVER}', (SELECT count(*) FROM faulty_facts WHERE AttendanceRate > 1), 'INTERPRETEREN', 'OK')
SELECT Controle, n AS VerdachteRecords, CASE WHEN n = 0 THEN good ELSE bad END AS Status FROM c""")
def dom_22_status_faulty(v):
    return sanity.status_table(faulty_facts(v))


@query("dom_22_repeated_counts", f"""
SELECT count(*) AS LecturesWithMoreRows, count(*) FILTER (same) AS WithSameUserCount, {r9('avg(CASE WHEN same THEN 1.0 ELSE 0.0 END)')} AS ShareSameUserCount
FROM (SELECT LectureID, count(DISTINCT UserCount) = 1 AS same FROM facts_wide GROUP BY 1 HAVING count(*) > 1)""")
def dom_22_repeated(v):
    return sanity.repeated_counts(sanity.lecture_structure(v.facts_wide))


@query("dom_22_scenarios", f"""
WITH l AS (SELECT max(UserCount) / CAST(nullif(sum(TotalStudents), 0) AS DOUBLE) AS a, sum(UserCount) / CAST(nullif(sum(TotalStudents), 0) AS DOUBLE) AS b FROM facts_wide GROUP BY LectureID)
SELECT '{sanity.SCENARIO_FACT}' AS Methode, {r9('avg(AttendanceRate)')} AS Gemiddelde, {_q('AttendanceRate', 0.5)} AS Mediaan FROM facts_wide
UNION ALL SELECT '{sanity.SCENARIO_MAX}', {r9('avg(a)')}, {_q('a', 0.5)} FROM l UNION ALL SELECT '{sanity.SCENARIO_SUM}', {r9('avg(b)')}, {_q('b', 0.5)} FROM l""")
def dom_22_scenarios(v):
    return sanity.scenarios(v.facts_wide)


CTES.setdefault("lecture_capacity", """
SELECT LectureID, arg_min(RoomCode, SubgroupKey) AS RoomCode, arg_min(RoomCapacity, SubgroupKey) AS RoomCapacity, string_agg(DISTINCT SubgroupCode, ', ' ORDER BY SubgroupCode) AS Subgroups,
  count(*) AS FactRows, max(UserCount) AS UserCount, sum(TotalStudents)::BIGINT AS SumTotalStudents FROM facts_wide GROUP BY 1""")


@query("dom_22_suspicious_capacity", "SELECT * FROM lecture_capacity WHERE SumTotalStudents > RoomCapacity OR UserCount > RoomCapacity")
def dom_22_capacity(v):
    return sanity.suspicious_capacity(sanity.lecture_capacity(v.facts_wide)).drop("FullDate", "ClassName")


@query("dom_22_capacity_checks", """
SELECT 'Rijen met onbekende lokaalcapaciteit' AS "Check", count(*) FILTER (RoomCapacity IS NULL) AS Rows FROM facts_wide UNION ALL SELECT 'TotalStudents > RoomCapacity', count(*) FILTER (TotalStudents > RoomCapacity) FROM facts_wide
UNION ALL SELECT 'UserCount > RoomCapacity', count(*) FILTER (UserCount > RoomCapacity) FROM facts_wide UNION ALL SELECT 'Som TotalStudents per les > RoomCapacity', count(*) FILTER (SumTotalStudents > RoomCapacity) FROM lecture_capacity""")
def dom_22_capacity_checks(v):
    return sanity.capacity_checks(v.facts_wide)


@query("dom_22_subgroup_stability", f"""
SELECT SubgroupCode, count(DISTINCT LectureID) AS Lessons, min(TotalStudents) AS MinStudents, {_q('TotalStudents', 0.5)} AS MedianStudents, max(TotalStudents) AS MaxStudents, {r9('avg(TotalStudents)')} AS MeanStudents,
  {r9('stddev_samp(TotalStudents)')} AS StdStudents, count(DISTINCT TotalStudents) AS UniqueStudentCounts, {r9('CASE WHEN min(TotalStudents) > 0 THEN max(TotalStudents) / CAST(min(TotalStudents) AS DOUBLE) END')} AS MaxMinRatio FROM facts_wide GROUP BY 1""")
def dom_22_stability(v):
    return sanity.subgroup_stability(v.facts_wide)


@query("dom_22_low_by_row_count", f"""
SELECT n > 1 AS MultipleFactRows, count(*) AS Rows, {r9('avg(CASE WHEN AttendanceRate < 0.2 THEN 1.0 ELSE 0.0 END)')} AS ShareBelow20 FROM (SELECT *, count(*) OVER (PARTITION BY LectureID) AS n FROM facts_wide) GROUP BY 1""")
def dom_22_low_rows(v):
    return sanity.low_by_row_count(v.facts_wide)


@query("dom_22_low_attendance_profile", f"""
SELECT RoomCode, count(*) AS Rows, count(DISTINCT LectureID) AS UniqueLectures, {r9('avg(AttendanceRate)')} AS MeanAttendance, {_q('AttendanceRate', 0.5)} AS MedianAttendance,
  {r9('avg(CASE WHEN AttendanceRate < 0.2 THEN 1.0 ELSE 0.0 END)')} AS ShareBelow20 FROM facts_wide GROUP BY 1 HAVING count(*) >= 20 ORDER BY avg(CASE WHEN AttendanceRate < 0.2 THEN 1.0 ELSE 0.0 END) DESC, count(*) DESC, RoomCode LIMIT 20""")
def dom_22_low_profile(v):
    return sanity.low_attendance_profile(v.facts_wide, "RoomCode")


@query("dom_22_zero_by_room", f"SELECT RoomCode, count(*) AS Rows, count(*) FILTER (AttendanceRate = 0) AS ZeroRows, {r9('avg(CASE WHEN AttendanceRate = 0 THEN 1.0 ELSE 0.0 END)')} AS ZeroShare FROM facts_wide GROUP BY 1 HAVING count(*) >= 20")
def dom_22_zero_room(v):
    return sanity.zero_clusters(v.facts_wide, "RoomCode", 20)


@query("dom_22_zero_by_date", f"SELECT FullDate::VARCHAR AS FullDate, count(*) AS Rows, count(*) FILTER (AttendanceRate = 0) AS ZeroRows, {r9('avg(CASE WHEN AttendanceRate = 0 THEN 1.0 ELSE 0.0 END)')} AS ZeroShare FROM facts_wide GROUP BY ALL HAVING count(*) >= 5")
def dom_22_zero_date(v):
    return sanity.zero_clusters(v.facts_wide, "FullDate", 5)


_DETAILS = f"SELECT LectureID, FullDate::VARCHAR AS FullDate, FromHour, ClassName, SubgroupCode, RoomCode, RoomCapacity, ActivityDomain, UserCount, TotalStudents, {r9('AttendanceRate')} AS AttendanceRate FROM facts_wide WHERE LectureID IN "


@query("dom_22_random_lectures", _DETAILS + "(SELECT LectureID FROM (SELECT DISTINCT LectureID FROM facts_wide) ORDER BY md5(CAST(LectureID AS VARCHAR) || ':42'), LectureID LIMIT 10)")
def dom_22_random(v):
    return sanity.lecture_details(v.facts_wide, sanity.sample_lectures(v.facts_wide))


@query("dom_22_lowest_lectures", _DETAILS + "(SELECT LectureID FROM facts_wide GROUP BY 1 HAVING sum(TotalStudents) > 0 ORDER BY max(UserCount) / CAST(sum(TotalStudents) AS DOUBLE), LectureID LIMIT 10)")
def dom_22_lowest(v):
    return sanity.lecture_details(v.facts_wide, sanity.very_low_lectures(v.facts_wide))


@query("dom_22_status_table", f"""
WITH c AS (SELECT '{sanity.CHECK_EXACT}' AS Controle, CAST(0 AS BIGINT) AS n, 'NAKIJKEN' AS bad, 'OK' AS good UNION ALL SELECT '{sanity.CHECK_KEY}', 0, 'NAKIJKEN', 'OK' UNION ALL SELECT '{sanity.CHECK_RATE}', 0, 'NAKIJKEN', 'OK'
  UNION ALL SELECT '{sanity.CHECK_REPEATED}', (SELECT count(*) FROM (SELECT 1 FROM facts_wide GROUP BY LectureID HAVING count(*) > 1 AND count(DISTINCT UserCount) = 1)), 'INTERPRETEREN', 'INTERPRETEREN'
  UNION ALL SELECT '{sanity.CHECK_CAPACITY}', (SELECT count(*) FROM lecture_capacity WHERE SumTotalStudents > RoomCapacity OR UserCount > RoomCapacity), 'INTERPRETEREN', 'OK'
  UNION ALL SELECT '{sanity.CHECK_OVER}', (SELECT count(*) FROM facts_wide WHERE AttendanceRate > 1), 'INTERPRETEREN', 'OK')
SELECT Controle, n AS VerdachteRecords, CASE WHEN n = 0 THEN good ELSE bad END AS Status FROM c""")
def dom_22_status(v):
    return sanity.status_table(v.facts_wide)


@query("dom_23_central_tendency", f"""
SELECT count(*) AS count, {r9('avg(AttendanceRate)')} AS mean, {r9('stddev_samp(AttendanceRate)')} AS std, {r9('min(AttendanceRate)')} AS min, {_q('AttendanceRate', 0.25)} AS p25, {_q('AttendanceRate', 0.5)} AS p50, {_q('AttendanceRate', 0.75)} AS p75, {r9('max(AttendanceRate)')} AS max FROM facts_wide""")
def dom_23(v):
    return aggregates.describe(v.facts_wide, "AttendanceRate")


@query("dom_23_low_and_high_shares", f"""
SELECT count(*) AS Rows, count(*) FILTER (AttendanceRate < 0.2) AS Low, count(*) FILTER (AttendanceRate > 0.9) AS High, count(*) FILTER (AttendanceRate > 1) AS Over, {r9('avg(CASE WHEN AttendanceRate < 0.2 THEN 1.0 ELSE 0.0 END)')} AS LowShare FROM facts_wide""")
def dom_23_shares(v):
    rate = F.col("AttendanceRate")
    return v.facts_wide.agg(
        F.count(F.lit(1)).alias("Rows"), F.count_if(rate < 0.2).alias("Low"), F.count_if(rate > 0.9).alias("High"),
        F.count_if(rate > 1).alias("Over"), aggregates.share(rate < 0.2).alias("LowShare"),
    )


# --- smaller reports ---------------------------------------------------------------------------------------------


@query("dom_24_presence_by_minute", """
SELECT w.DateKey, w.TimeKey, b.SubgroupKey, s.SubgroupCode, count(DISTINCT w.UserKey) AS PresentStudents FROM fact_wifi w JOIN bridge b ON b.UserKey = w.UserKey LEFT JOIN dim_subgroup s ON s.SubgroupKey = b.SubgroupKey GROUP BY ALL""")
def dom_24(v):
    return presence.presence_by_minute(v.wifi, v.bridge, v.subgroups)


@query("dom_25_students_per_subgroup", f"SELECT SUBGROEPID, count(*) AS Rows, count(DISTINCT EMAIL) AS Students, (SELECT count(DISTINCT EMAIL) FROM ({_STUDENTS})) AS StudentsOverall FROM ({_STUDENTS}) GROUP BY 1")
def dom_25(v):
    rows = _students(v)
    overall = rows.agg(F.count_distinct("EMAIL").alias("n")).select("n").scalar()
    return rows.groupBy("SUBGROEPID").agg(
        F.count(F.lit(1)).alias("Rows"), F.count_distinct("EMAIL").alias("Students")
    ).withColumn("StudentsOverall", overall)


@query("dom_26_classes_without_lectures", "SELECT ClassKey, ClassCode, ClassName FROM dim_class c WHERE NOT EXISTS (SELECT 1 FROM fact_base f WHERE f.ClassKey = c.ClassKey)")
def dom_26(v):
    return courses.classes_without_lectures(v.classes, v.fact_base)


@query("dom_27_guarded_purge", """
SELECT c.ClassKey, c.ClassCode, c.ClassName, count(*) AS LectureCount FROM fact_base f JOIN dim_class c ON c.ClassKey = f.ClassKey
WHERE c.ClassKey NOT IN (SELECT code FROM course_list WHERE p_brand LIKE '%1%') GROUP BY ALL""")
def dom_27(v):
    listed = course_list(v)
    marked = listed.withColumn(
        "faculties", F.when(F.col("p_brand").contains("1"), F.col("faculties")).otherwise("['Bachelor verpleegkunde']")
    )
    keep = courses.it_codes(marked).select((F.col("code").cast("bigint") + 190000).alias("ClassCode"))
    return tables.guarded_delete(v.classes, keep, "ClassCode", "ClassKey", v.fact_base)["summary"]


@query("dom_28_spot_check_lectures", f"""
SELECT LectureID, SubgroupCode, RoomName, ClassName, UserCount, TotalStudents, {r9('AttendanceRate')} AS AttendanceRate FROM facts_wide
WHERE DateKey = 20240110 AND FromTimeKey = 103000 AND UntilTimeKey = 123000 AND ClassName LIKE '%ring'""")
def dom_28(v):
    # the date and time choose the lectures before heads are counted
    slot = "DateKey = 20240110 AND FromTimeKey = 103000 AND UntilTimeKey = 123000"
    return v.lectures_wide(v.fact_base.where(slot)).where("ClassName LIKE '%ring'").select("LectureID", "SubgroupCode", "RoomName", "ClassName", "UserCount", "TotalStudents", "AttendanceRate")


@query("dom_28_spot_check_users", f"""
SELECT w.UserKey FROM fact_wifi w JOIN bridge b ON b.UserKey = w.UserKey WHERE w.DateKey = 20240110 AND b.SubgroupKey = 3 AND {secs('w.TimeKey')} BETWEEN 9 * 3600 AND 18 * 3600 GROUP BY 1""")
def dom_28_users(v):
    seen = clock.key_seconds("TimeKey").between(9 * 3600, 18 * 3600)
    return v.wifi.where((F.col("DateKey") == 20240110) & seen).join(v.bridge.where("SubgroupKey = 3"), "UserKey").select("UserKey").distinct()


@query("dom_29_users_and_bridge", f"""
SELECT u.UserName, s.SUBGROEPID AS SubgroupKey FROM ({_STUDENTS}) s JOIN dim_user u ON u.UserName = s.EMAIL""")
def dom_29(v):
    rows = _students(v).select(
        F.concat(F.lit(" "), "EMAIL", F.lit(" ")).alias("EMAIL"), F.concat(F.col("SUBGROEPID").cast("string"), F.lit(".0")).alias("SUBGROEPID")
    )
    faulty = rows.unionByName(rows.select("EMAIL", F.lit("EK12").alias("SUBGROEPID")))
    links = loads.student_links(faulty)
    old = v.users.where(F.col("UserName").startswith("u_"))
    users = loads.add_users(links, old)
    known = v.bridge.join(old, "UserKey", "left_semi")
    bridge = loads.add_bridge(links, users, known)
    return bridge.join(users, "UserKey").select("UserName", "SubgroupKey")


@query("dom_29_assigned_keys", f"""
WITH old AS (SELECT * FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!')
SELECT UserName, UserKey FROM old UNION ALL SELECT UserName, row_number() OVER (ORDER BY UserName) + (SELECT coalesce(max(UserKey), 0) FROM old)
FROM (SELECT DISTINCT EMAIL AS UserName FROM ({_STUDENTS}) WHERE EMAIL NOT IN (SELECT UserName FROM old))""")
def dom_29_keys(v):
    rows = _students(v).select("EMAIL", F.col("SUBGROEPID").cast("string").alias("SUBGROEPID"))
    return loads.add_users(loads.student_links(rows), v.users.where(F.col("UserName").startswith("u_"))).select("UserName", "UserKey")


@query("dom_30_wifi_load", "SELECT DateKey, TimeKey, UserKey FROM fact_wifi")
def dom_30(v):
    rows = loads.wifi_rows(v.wifi_feed)
    half = loads.wifi_fact(rows.where("DateKey < 20240115"), v.users)
    return loads.add_wifi(half, rows, v.users)


@query("dom_31_class_dimension", """
SELECT code AS ClassCode, title AS ClassName, CAST(3 + p_size % 4 AS INTEGER) AS ClassCredits, coalesce(second_chance = 'wel mogelijk.', false) AS ClassSecondChance, CAST(1 + code % 3 AS INTEGER) AS ClassProgramStage FROM course_list""")
def dom_31_class(v):
    twice = course_list(v)
    return loads.class_rows(twice.unionByName(twice.withColumn("title", F.concat("title", F.lit(" z")))), ["title"])


@query("dom_31_room_dimension", """
SELECT RoomKey, CAST(NULL AS INTEGER) AS Building, RoomFloor, Code, RoomName, 'Leslokaal' AS Category, Capacity, CAST(round(s_acctbal, 2) AS DOUBLE) AS Area
FROM dim_room JOIN supplier ON s_suppkey = RoomKey WHERE Capacity > 0 AND RoomName LIKE 'Supplier#00000000%'""")
def dom_31_room(v):
    s = v.raw("supplier")
    text_rooms = v.rooms.join(s.select(F.col("s_suppkey").alias("RoomKey"), F.col("s_acctbal").cast("string").alias("Area")), "RoomKey").select(
        F.col("RoomKey").cast("string"), F.lit("NULL").alias("Building"), F.col("RoomFloor").cast("string"), "Code", "RoomName",
        F.lit("Leslokaal").alias("Category"), F.when(F.col("Capacity") == 0, "").otherwise(F.col("Capacity").cast("string")).alias("Capacity"), "Area",
    )
    return loads.room_rows(text_rooms, "Supplier#00000000")


@query("dom_31_subgroup_dimension", f"SELECT k AS SubgroupKey, program AS SubgroupCode, split_part(program, '/', 1) AS ProgramName FROM (SELECT c_custkey AS k, c_mktsegment || '/' || c_name AS program FROM customer)")
def dom_31_subgroup(v):
    c = v.raw("customer")
    rows = c.select(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("SUBGROEPID"), F.concat_ws("/", "c_mktsegment", "c_name").alias("SUBGROEPCODE"))
    stray = c.select(F.lit("SUBGROEPID").alias("SUBGROEPID"), F.lit("SUBGROEPCODE").alias("SUBGROEPCODE"))
    return loads.subgroup_rows(rows.unionByName(stray), ["SUBGROEPCODE"])


@query("dom_32_clean_reservations", """
SELECT Id, strftime(strptime("Start", '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS "Start", strftime(strptime("End", '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS "End", Status, Classgroups
FROM schedule_export WHERE Status IS DISTINCT FROM 'Cancelled'""")
def dom_32(v):
    return lectures.clean_reservations(v.schedule_export).select("Id", "Start", "End", "Status", "Classgroups")


@query("dom_33_new_class_groups", "SELECT DISTINCT CAST(l_suppkey % 25 AS VARCHAR) AS Classgroup FROM lineitem WHERE l_suppkey % 25 NOT IN (SELECT CAST(n_nationkey AS BIGINT) FROM nation WHERE n_regionkey = 1)")
def dom_33(v):
    known = v.raw("nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("string").alias("Classgroup"))
    return only_new(loads.unique_class_groups(v.schedule_export), known, ["Classgroup"])


@query("dom_34_course_catalogue", """
SELECT code, faculty, program_stage, CAST(3 + p_size % 4 AS INTEGER) AS credits, coalesce(second_chance = 'wel mogelijk.', false) AS second_chance
FROM (SELECT *, p_brand AS faculty, CAST(1 + code % 3 AS VARCHAR) AS program_stage FROM course_list UNION ALL SELECT *, 'IC IT', NULL FROM course_list)""")
def dom_34(v):
    return loads.catalogue_rows(course_list(v)).select("code", "faculty", "program_stage", "credits", "second_chance")


@query("dom_35_room_list", "SELECT DISTINCT s_name AS Room FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE contains(n_name, '_1')")
def dom_35(v):
    s, n = v.raw("supplier"), v.raw("nation")
    rooms = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("Building"), F.col("s_name").alias("Room"))
    return loads.room_names(rooms, "Building", "Room", "_1")
