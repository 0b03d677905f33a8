"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.registry import query
from rollcall.catalogue.source_queries import _export_files, course_list
from rollcall.catalogue.views import r9, secs
from rollcall.functions import clock, maths, text
from rollcall.operators import columns
from rollcall.operators.aggregates import value_counts
from rollcall.operators.joins import only_known
from rollcall.plans import courses, lectures, sessions
from rollcall.schemas import RESERVATION_COLUMNS, SCHEDULE_DROP_COLUMNS
from rollcall.sources import files


@query("prj_01_existing_columns", 'SELECT Id, "Start", "End", WorkFormCourse, WorkFormExam, WorkFormEvaluation, LearningEnvironment, ExamEnvironment, Classgroups, OlodPointers, Rooms FROM schedule_export')
def prj_01(v):
    kept = columns.keep_existing(v.schedule_export, RESERVATION_COLUMNS)
    return columns.drop_existing(kept, SCHEDULE_DROP_COLUMNS)


@query("prj_02_required_columns", 'SELECT Id, "Start", "End" FROM schedule_export')
def prj_02(v):
    return columns.require(v.schedule_export, ["Id", "Start", "End"], "export").select("Id", "Start", "End")


@query("prj_03_rename", "SELECT SubgroupKey AS SUBGROEPID, SubgroupCode AS ReferenceProgramName FROM dim_subgroup")
def prj_03(v):
    renamed = columns.rename(v.subgroups, {"SubgroupKey": "SUBGROEPID", "SubgroupCode": "ReferenceProgramName"})
    return renamed.select("SUBGROEPID", "ReferenceProgramName")


@query("prj_04_source_file", "SELECT 'events.parquet' AS source_file, count(*) AS Rows FROM events")
def prj_04(v):
    return value_counts(columns.tag_source_file(v.raw("events").select("event_id", "_metadata")), ["source_file"])


@query("prj_05_trim_headers", "SELECT UserKey, UserName FROM dim_user")
def prj_05(v):
    return columns.trim_headers(v.users.toDF(" UserKey", "UserName  "))


@query("prj_06_first_of_repeated_names", """
SELECT f.LectureID, f.SubgroupKey, f.DateKey, f.RoomKey, c.ClassKey, c.ClassName, c.ClassCode, c.ClassCredits, c.ClassProgramStage
FROM (SELECT LectureID, SubgroupKey, DateKey, RoomKey, ClassKey FROM fact_base) f JOIN dim_class c ON c.ClassKey = f.ClassKey""")
def prj_06(v):
    fact = v.fact_base.select("LectureID", "SubgroupKey", "DateKey", "RoomKey", "ClassKey")
    repeated = v.classes.withColumn("RoomKey", F.lit(-1)).withColumn("DateKey", F.lit(-1))
    return columns.join_first_wins(fact, repeated, ["ClassKey"])


@query("prj_07_reorder", "SELECT UserName, UserKey FROM dim_user")
def prj_07(v):
    return columns.reorder(v.users, ["UserName", "Absent"])


@query("prj_08_typed_nulls", "SELECT LectureID, SubgroupKey, CAST(NULL AS BIGINT) AS UserCount, CAST(NULL AS DOUBLE) AS AttendanceRate FROM fact_base")
def prj_08(v):
    return columns.typed_nulls(v.fact_base.select("LectureID", "SubgroupKey"), {"UserCount": "bigint", "AttendanceRate": "double"})


@query("prj_09_patch_by_id", "SELECT Id, CASE WHEN Id = '7' THEN '193745' ELSE OlodPointers END AS OlodPointers FROM schedule_export")
def prj_09(v):
    return columns.patch(v.schedule_export.select("Id", "OlodPointers"), "Id", "7", "OlodPointers", "193745")


@query("prj_10_constant_tag", "SELECT SubgroupCode, 'ExactProgramName' AS InferenceType FROM dim_subgroup")
def prj_10(v):
    return columns.tag(v.subgroups.select("SubgroupCode"), "InferenceType", "ExactProgramName")


@query("prj_11_attendance_rate", f"SELECT LectureID, SubgroupKey, {r9('AttendanceRate')} AS AttendanceRate FROM fact_lecture")
def prj_11(v):
    return v.fact.select("LectureID", "SubgroupKey", maths.attendance_rate("UserCount", "TotalStudents").alias("AttendanceRate"))


@query("prj_12_choice_with_default", """
SELECT p_partkey, CASE WHEN p_name LIKE '%widget%' OR p_name LIKE '%gizmo%' THEN 'Groepswerk' WHEN p_name LIKE '%anvil%' THEN 'Niet gekoppeld' ELSE 'Gewoon vak' END AS LessonType FROM part""")
def prj_12(v):
    name = F.col("p_name")
    kind = (
        F.when(name.contains("widget") | name.contains("gizmo"), "Groepswerk")
        .when(name.contains("anvil"), "Niet gekoppeld")
        .otherwise("Gewoon vak")
    )
    return v.raw("part").select("p_partkey", kind.alias("LessonType"))


@query("prj_13_null_default", "SELECT LectureID, SubgroupKey, coalesce(UserCount, 0) AS UserCount FROM fact_lecture")
def prj_13(v):
    return v.fact.select("LectureID", "SubgroupKey", F.coalesce("UserCount", F.lit(0)).alias("UserCount"))


@query("prj_14_numeric_coercion", """
SELECT doc_id, TRY_CAST(replace(source, 'src', '') AS BIGINT) AS SourceNo, CAST(NULL AS BIGINT) AS LangNo,
       n_chars + 0 AS Chars FROM documents""")
def prj_14(v):
    rows = v.raw("documents").select(
        "doc_id", F.replace("source", F.lit("src"), F.lit("")).alias("SourceNo"), F.col("lang").alias("LangNo"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".0")).alias("Chars"),
    )
    return columns.to_number(rows, ["SourceNo", "LangNo", "Chars"])


@query("prj_15_cap_at_one", f"SELECT LectureID, SubgroupKey, {r9('CASE WHEN OccupancyRate > 1 THEN 1.0 ELSE OccupancyRate END')} AS Capped FROM fact_lecture")
def prj_15(v):
    return v.fact.select("LectureID", "SubgroupKey", maths.cap_at_one("OccupancyRate").alias("Capped"))


@query("prj_16_fill_with_provenance", """
SELECT SubgroupKey, CASE WHEN ProgramName <> 'ASIA' THEN ProgramName ELSE 'X' || SubgroupCode END AS ProgramName,
       CASE WHEN ProgramName <> 'ASIA' THEN 'students' ELSE 'inferred' END AS Source,
       CASE WHEN ProgramName <> 'ASIA' THEN NULL ELSE CAST(0.9 AS DOUBLE) END AS Confidence
FROM dim_subgroup""")
def prj_16(v):
    known = F.col("ProgramName") != "ASIA"
    rows = v.subgroups.select(
        "SubgroupKey", F.when(known, F.col("ProgramName")).alias("ProgramName"),
        F.concat(F.lit("X"), F.col("SubgroupCode")).alias("_candidate"),
        F.when(known, "students").alias("Source"), F.lit(None).cast("double").alias("Confidence"),
    )
    return columns.fill_with_source(
        rows, "ProgramName", F.col("_candidate"), "Source", "inferred", {"Confidence": F.lit(0.9)}
    ).drop("_candidate")


@query("prj_17_overwrite_from_reference", """
SELECT SubgroupKey, SubgroupCode AS ProgramName, 'override' AS Source FROM dim_subgroup""")
def prj_17(v):
    rows = v.subgroups.withColumn("Source", F.lit("students"))
    differs = F.col("ProgramName") != F.col("SubgroupCode")
    return columns.fill_with_source(
        rows, "ProgramName", F.col("SubgroupCode"), "Source", "override", overwrite_when=differs
    ).select("SubgroupKey", "ProgramName", "Source")


@query("prj_18_truncate_text", "SELECT doc_id, left(text, 150) AS Title FROM documents")
def prj_18(v):
    return v.raw("documents").select("doc_id", text.truncate("text", 150).alias("Title"))


@query("prj_19_column_by_alias", "SELECT c_custkey AS k, c_name AS n FROM customer")
def prj_19(v):
    c = v.raw("customer")
    key, name = columns.find_column(c, ["CustKey", "C CUST KEY"]), columns.find_column(c, ["naam", "c-name"])
    absent = columns.find_column(c, ["email"], required=False)
    assert absent is None
    return c.select(F.col(key).alias("k"), F.col(name).alias("n"))


# --- filters -----------------------------------------------------------------------------


@query("flt_01_bound_predicates", """
SELECT LectureID, SubgroupKey FROM schedule WHERE ProgramName LIKE 'A%' AND ClassName IN ('hot ring', 'old rod') AND DateKey BETWEEN 20240105 AND 20240125 AND SubgroupKey <> 3""")
def flt_01(v):
    return v.schedule.where(
        F.col("ProgramName").like("A%") & F.col("ClassName").isin("hot ring", "old rod")
        & F.col("DateKey").between(20240105, 20240125) & (F.col("SubgroupKey") != 3)
    ).select("LectureID", "SubgroupKey")


@query("flt_02_escaped_like", "SELECT UserKey FROM dim_user WHERE UserName LIKE 'enc\\_%' ESCAPE '\\'")
def flt_02(v):
    return v.users.where(F.col("UserName").startswith("enc_")).select("UserKey")


@query("flt_03_network", "SELECT username, count(*) AS Rows FROM wifi_feed WHERE ssid = 'eduroam' GROUP BY 1")
def flt_03(v):
    return value_counts(v.wifi_feed.where("ssid = 'eduroam'"), ["username"])


@query("flt_04_not_cancelled", "SELECT Id FROM schedule_export WHERE lower(Status) IS DISTINCT FROM 'cancelled'")
def flt_04(v):
    return v.schedule_export.where(lectures.not_cancelled()).select("Id")


@query("flt_05_prefix_and_substring", "SELECT RoomKey FROM dim_room WHERE Code LIKE 'B.3%' OR RoomName LIKE '%#00000004%'")
def flt_05(v):
    no = F.lit(False)
    return v.rooms.where(
        F.coalesce(F.col("Code").startswith("B.3"), no) | F.coalesce(F.col("RoomName").contains("#00000004"), no)
    ).select("RoomKey")


@query("flt_06_drop_null_subset", "SELECT Id FROM schedule_export WHERE Status IS NOT NULL AND Classgroups IS NOT NULL")
def flt_06(v):
    return v.schedule_export.dropna(subset=["Status", "Classgroups"]).select("Id")


@query("flt_07_numeric_ids", "SELECT count(*) AS Rows, sum(CAST(k AS BIGINT))::BIGINT AS Total FROM (SELECT json_extract_string(props, '$.k') AS k FROM events) WHERE regexp_full_match(k, '\\d+')")
def flt_07(v):
    k = F.get_json_object("props", "$.k")
    return v.raw("events").select(k.alias("k")).where(F.col("k").rlike(r"^\d+$")).agg(
        F.count(F.lit(1)).alias("Rows"), F.sum(F.col("k").cast("bigint")).alias("Total")
    )


@query("flt_08_date_window", "SELECT LectureID, SubgroupKey FROM schedule WHERE FullDate BETWEEN DATE '2024-01-08' AND DATE '2024-01-25' AND FullDate < DATE '2024-01-25'")
def flt_08(v):
    day = F.col("FullDate")
    return v.schedule.where(
        day.between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-25").cast("date")) & (day < v.now.cast("date"))
    ).select("LectureID", "SubgroupKey")


@query("flt_09_group_size", "SELECT SubgroupKey, ClassKey, count(*) AS Rows FROM fact_base GROUP BY ALL HAVING count(*) >= 2")
def flt_09(v):
    return value_counts(v.fact_base, ["SubgroupKey", "ClassKey"]).where("Rows >= 2")


@query("flt_10_duration_band", "SELECT SessionID FROM course_sessions WHERE SessionDurationMinutes BETWEEN 120 AND 300")
def flt_10(v):
    built = sessions.course_sessions(sessions.course_blocks(v.typed_schedule.where("LessonType <> 'Niet gekoppeld'")))
    return built.where(F.col("SessionDurationMinutes").between(120, 300)).select("SessionID")


@query("flt_11_thresholds", """
SELECT LectureID, SubgroupKey, CASE WHEN AttendanceRate = 0 THEN 'zero' WHEN AttendanceRate < 0.2 THEN 'low' WHEN AttendanceRate > 1 THEN 'over' ELSE 'high' END AS Kind
FROM fact_lecture WHERE AttendanceRate < 0.2 OR AttendanceRate > 0.9""")
def flt_11(v):
    rate = F.col("AttendanceRate")
    kind = F.when(rate == 0, "zero").when(rate < 0.2, "low").when(rate > 1, "over").otherwise("high")
    return v.fact.where((rate < 0.2) | (rate > 0.9)).select("LectureID", "SubgroupKey", kind.alias("Kind"))


@query("flt_12_key_membership", "SELECT DateKey, TimeKey, UserKey FROM fact_wifi WHERE UserKey IN (SELECT UserKey FROM dim_user WHERE UserName LIKE 'u!_%' ESCAPE '!')")
def flt_12(v):
    return only_known(v.wifi, v.users.where(F.col("UserName").startswith("u_")), ["UserKey"])


@query("flt_13_it_faculty", "SELECT code FROM course_list WHERE lower(faculties) LIKE '%ic it%' OR lower(faculties) LIKE '%toegepaste informatica%'")
def flt_13(v):
    return course_list(v).where(text.is_it_faculty("faculties")).select("code")


@query("flt_14_valid_observation", """
SELECT SessionID FROM course_results WHERE LessonType IN ('Groepswerk', 'Gewoon vak') AND ExpectedStudents > 0 AND AttendanceRate >= 0""")
def flt_14(v):
    return v.course_results.where(
        F.col("LessonType").isin("Groepswerk", "Gewoon vak") & (F.col("ExpectedStudents") > 0) & (F.col("AttendanceRate") >= 0)
    ).select("SessionID")


@query("flt_15_filled_name", "SELECT event_id FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND length(json_extract_string(props, '$.k')) > 0")
def flt_15(v):
    name = F.get_json_object("props", "$.k")
    return v.raw("events").where(name.isNotNull() & (F.length(name) > 0)).select("event_id")
