"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.registry import query
from rollcall.catalogue.views import r9, secs
from rollcall.functions import clock, text
from rollcall.operators import joins
from rollcall.operators.aggregates import value_counts
from rollcall.plans import course_types, lectures, loads, presence, programs, sessions, slots
from rollcall.schemas import ACTIVITY_COLUMNS
from rollcall.sources.generators import fixed_table


@query("jn_01_star_join", f"""
SELECT LectureID, SubgroupKey, FullDate::VARCHAR AS FullDate, FromHour, ClassName, SubgroupCode, ProgramName, CanonicalActivity, RoomCode, {r9('AttendanceRate')} AS AttendanceRate FROM facts_wide""")
def jn_01(v):
    return v.facts_wide.select(
        "LectureID", "SubgroupKey", "FullDate", "FromHour", "ClassName", "SubgroupCode", "ProgramName",
        "CanonicalActivity", "RoomCode", "AttendanceRate",
    )


@query("jn_02_role_playing_dimension", """
SELECT b.LectureID, b.SubgroupKey, f.FullTime AS FromTime, u.FullTime AS UntilTime FROM fact_base b
JOIN dim_time f ON f.TimeKey = b.FromTimeKey JOIN dim_time u ON u.TimeKey = b.UntilTimeKey""")
def jn_02(v):
    start = v.times.select(F.col("TimeKey").alias("FromTimeKey"), F.col("FullTime").alias("FromTime"))
    end = v.times.select(F.col("TimeKey").alias("UntilTimeKey"), F.col("FullTime").alias("UntilTime"))
    return v.fact_base.join(start, "FromTimeKey").join(end, "UntilTimeKey").select(
        "LectureID", "SubgroupKey", "FromTime", "UntilTime"
    )


@query("jn_03_first_key_lookup", """
SELECT b.LectureID, b.SubgroupKey, m.k AS FirstKey FROM schedule b LEFT JOIN (SELECT ClassName, min(ClassKey) AS k FROM dim_class GROUP BY 1) m ON m.ClassName = b.ClassName""")
def jn_03(v):
    table = v.classes.select(F.col("ClassName").alias("Name"), F.col("ClassKey").alias("FirstKey"))
    rows = v.schedule.select("LectureID", "SubgroupKey", "ClassName")
    return joins.lookup(rows, table, {"ClassName": "Name"}, ["FirstKey"], ["FirstKey"]).drop("ClassName")


@query("jn_04_validated_join", "SELECT LectureID, SubgroupKey, ClassName FROM schedule")
def jn_04(v):
    rows = v.fact_base.select("LectureID", "SubgroupKey", "ClassKey")
    known = rows.join(v.subgroups.select("SubgroupKey"), "SubgroupKey", "left_semi")
    return joins.validated_join(known, v.classes.select("ClassKey", "ClassName"), ["ClassKey"], validate="m:1").drop("ClassKey")


@query("jn_05_co_occurrence", """
SELECT a.SubgroupKey, s.ProgramName, count(DISTINCT a.LectureID) AS EvidenceCount FROM fact_base a JOIN fact_base b ON b.LectureID = a.LectureID
JOIN dim_subgroup s ON s.SubgroupKey = b.SubgroupKey GROUP BY ALL""")
def jn_05(v):
    links = v.fact_base.select(F.col("LectureID").alias("Id"), F.col("SubgroupKey").alias("SubgroupCode"))
    known = v.subgroups.select(F.col("SubgroupKey").alias("SubgroupCode"), "ProgramName")
    return programs.votes(links, known, known, "ProgramName").withColumnRenamed("SubgroupCode", "SubgroupKey")


@query("jn_06_anti_join_all_keys", """
SELECT DateKey, TimeKey, UserKey FROM fact_wifi WHERE DateKey >= 20240115""")
def jn_06(v):
    return joins.only_new(v.wifi, v.wifi.where("DateKey < 20240115"), ["DateKey", "TimeKey", "UserKey"])


@query("jn_07_anti_join", "SELECT ClassKey FROM dim_class c WHERE NOT EXISTS (SELECT 1 FROM fact_base f WHERE f.ClassKey = c.ClassKey)")
def jn_07(v):
    return joins.only_new(v.classes.select("ClassKey"), v.fact_base, ["ClassKey"])


@query("jn_08_semi_join", "SELECT ClassKey FROM dim_class c WHERE EXISTS (SELECT 1 FROM fact_base f WHERE f.ClassKey = c.ClassKey)")
def jn_08(v):
    return joins.only_known(v.classes.select("ClassKey"), v.fact_base, ["ClassKey"])


@query("jn_09_outer_compare", """
SELECT coalesce(c.ClassKey, f.ClassKey) AS ClassKey, CASE WHEN f.ClassKey IS NULL THEN 'left_only' WHEN c.ClassKey IS NULL THEN 'right_only' ELSE 'both' END AS Side
FROM (SELECT ClassKey FROM dim_class WHERE ClassProgramStage <> 2) c FULL JOIN (SELECT DISTINCT ClassKey FROM fact_base) f ON f.ClassKey = c.ClassKey""")
def jn_09(v):
    listed = v.classes.where("ClassProgramStage <> 2").select("ClassKey")
    return joins.outer_compare(listed, v.fact_base.select("ClassKey").distinct(), ["ClassKey"])


@query("jn_10_interval_join", f"""
SELECT f.SubgroupKey, f.DateKey, f.FromTimeKey, f.UntilTimeKey, w.UserKey, count(*) AS Connections
FROM (SELECT DISTINCT SubgroupKey, DateKey, FromTimeKey, UntilTimeKey FROM fact_base) f JOIN bridge b ON b.SubgroupKey = f.SubgroupKey
JOIN fact_wifi w ON w.UserKey = b.UserKey AND w.DateKey = f.DateKey AND {secs('w.TimeKey')} BETWEEN {secs('f.FromTimeKey')} + 900 AND {secs('f.UntilTimeKey')}
GROUP BY ALL""")
def jn_10(v):
    spans = v.fact_base.select(*presence.WINDOW).distinct().withColumns({
        "_from": clock.key_seconds("FromTimeKey") + 900, "_until": clock.key_seconds("UntilTimeKey"),
    })
    points = presence.wifi_by_subgroup(v.wifi, v.bridge)
    hits = joins.interval_join(points, spans, ["SubgroupKey", "DateKey"], "Second", "_from", "_until")
    return value_counts(hits, [*presence.WINDOW, "UserKey"], out="Connections")


@query("jn_11_interval_join_by_date", "SELECT UserKey, SessionID, SessionSlot FROM lab_presence")
def jn_11(v):
    return v.lab_presence.select("UserKey", "SessionID", "SessionSlot")


@query("jn_12_expected_users_in_session", f"""
SELECT DISTINCT c.SessionID, w.UserKey FROM course_sessions c JOIN course_links l ON l.SessionID = c.SessionID JOIN bridge b ON b.SubgroupKey = l.SubgroupKey
JOIN fact_wifi w ON w.UserKey = b.UserKey AND w.DateKey = CAST(strftime(c.FullDate, '%Y%m%d') AS INTEGER) AND {secs('w.TimeKey')} BETWEEN c.a AND c.b""")
def jn_12(v):
    built = sessions.course_session_sets(course_types.classified(v.typed_schedule))
    return course_types.present_users(built, v.wifi, v.bridge)


@query("jn_13_window_users_no_grace", f"""
SELECT DISTINCT f.SubgroupKey, f.DateKey, f.FromTimeKey, f.UntilTimeKey, w.UserKey FROM fact_base f JOIN bridge b ON b.SubgroupKey = f.SubgroupKey
JOIN fact_wifi w ON w.UserKey = b.UserKey AND w.DateKey = f.DateKey AND {secs('w.TimeKey')} BETWEEN {secs('f.FromTimeKey')} AND {secs('f.UntilTimeKey')}""")
def jn_13(v):
    return presence.window_users(presence.time_windows(v.fact_base), v.wifi, v.bridge)


@query("jn_14_bridge_join", """
SELECT b.UserKey, count(DISTINCT f.LectureID) AS Lectures FROM bridge b JOIN fact_base f ON f.SubgroupKey = b.SubgroupKey GROUP BY 1""")
def jn_14(v):
    # lectures with one set of subgroups are counted once, and their number reaches users through cohorts
    sets = v.fact_base.groupBy("LectureID").agg(F.array_sort(F.collect_set("SubgroupKey")).alias("_set"))
    sizes = sets.withColumn("_sig", presence.signature("_set")).groupBy("_sig").agg(
        F.any_value("_set").alias("_set"), F.count(F.lit(1)).alias("_n")
    )
    lectures_of = presence.touched_cohorts(sizes, v.bridge).join(sizes.select("_sig", "_n"), "_sig").groupBy("Cohort").agg(
        F.sum("_n").alias("Lectures")
    )
    return presence.user_cohorts(v.bridge).join(lectures_of, "Cohort").select("UserKey", "Lectures")


@query("jn_15_parameter_row", "SELECT LectureID, SubgroupKey FROM fact_base WHERE DateKey < (SELECT CAST(strftime(max(ts), '%Y%m%d') AS INTEGER) FROM events)")
def jn_15(v):
    latest = v.raw("events").agg(F.max("ts").alias("t")).select(clock.date_key("t")).scalar()
    return v.fact_base.where(F.col("DateKey") < latest).select("LectureID", "SubgroupKey")


@query("jn_16_code_lookup_with_fallback", """
SELECT b.LectureID, b.SubgroupKey, b.RoomKey FROM fact_base b JOIN dim_room r ON r.RoomKey = b.RoomKey""")
def jn_16(v):
    coded = v.fact_base.join(v.rooms.select("RoomKey", "Code", "RoomFloor"), "RoomKey")
    typed = F.when(F.col("RoomFloor") > 1, F.col("Code")).otherwise(F.replace("Code", F.lit("."), F.lit("")))
    rows = coded.select("LectureID", "SubgroupKey", typed.alias("RoomCode"))
    return joins.code_lookup(rows, v.rooms, "RoomCode", "Code", "RoomKey").drop("RoomCode")


@query("jn_17_time_key_lookup", "SELECT event_id, CAST(hour(ts) * 10000 + minute(ts) * 100 AS INTEGER) AS TimeKey FROM events")
def jn_17(v):
    minute = (F.hour("ts") * 10000 + F.minute("ts") * 100).alias("_k")
    rows = v.raw("events").select("event_id", minute)
    return rows.join(v.times, rows["_k"] == v.times["TimeKey"], "left").select(
        "event_id", F.coalesce("TimeKey", F.raise_error(F.lit("no such time")).cast("int")).alias("TimeKey")
    )


@query("jn_18_first_filled_lookup", """
SELECT Id, CASE WHEN WorkFormCourse = 'Practicum' THEN 9 WHEN WorkFormExam = 'Schriftelijk examen' THEN 18
                WHEN EducationActivity = 'Feedback' THEN 29 ELSE 1 END AS ActivityKey FROM schedule_export""")
def jn_18(v):
    default = v.activities.where("SourceValue = ''").select(F.min("ActivityKey")).scalar()
    rows = v.schedule_export.select("Id", *ACTIVITY_COLUMNS)
    return joins.first_filled_lookup(rows, v.activities, ACTIVITY_COLUMNS, "ActivityKey", default, "ActivityKey").select(
        "Id", "ActivityKey"
    )


@query("jn_19_names_to_keys", """
SELECT f.username, f.ssid, u.UserKey, count(*) AS Rows FROM wifi_feed f LEFT JOIN (SELECT UserName, min(UserKey) AS UserKey FROM dim_user WHERE UserName LIKE 'enc%' GROUP BY 1) u ON u.UserName = f.username GROUP BY ALL""")
def jn_19(v):
    known = v.users.where(F.col("UserName").startswith("enc_"))
    mapped = joins.lookup(v.wifi_feed, known, {"username": "UserName"}, ["UserKey"], ["UserKey"])
    return value_counts(mapped, ["username", "ssid", "UserKey"])


@query("jn_20_converted_key", "SELECT c.ClassKey FROM dim_class c JOIN part p ON trim(CAST(c.ClassCode AS VARCHAR)) = trim(CAST(p.p_partkey + 190000 AS VARCHAR))")
def jn_20(v):
    codes = v.raw("part").select(F.concat(F.lit(" "), (F.col("p_partkey") + 190000).cast("string")).alias("code"))
    return v.classes.join(codes, F.trim(F.col("ClassCode").cast("string")) == F.trim("code")).select("ClassKey")


@query("jn_21_align_to_key_list", f"""
SELECT d.name AS NameDayDutch, {r9('avg(AttendanceRate)')} AS mean FROM (VALUES ('Maandag'), ('Dinsdag'), ('Woensdag'), ('Donderdag'), ('Vrijdag'), ('Feestdag')) d(name)
JOIN facts_wide f ON f.NameDayDutch = d.name GROUP BY 1""")
def jn_21(v):
    days = [*clock.DAYS_DUTCH[:5], "Feestdag"]
    spine = fixed_table(v.spark, ["NameDayDutch"], [(d,) for d in days])
    means = v.facts_wide.groupBy("NameDayDutch").agg(F.avg("AttendanceRate").alias("mean"))
    return joins.align_to(spine, means, ["NameDayDutch"], ["mean"])


@query("jn_22_chained_left_joins", "SELECT SessionID, ExpectedStudents, PresentStudents FROM course_results")
def jn_22(v):
    return v.course_results.select("SessionID", "ExpectedStudents", "PresentStudents")
