"""Scalar functions on text, dates, numbers, arrays and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.catalogue.registry import query
from rollcall.catalogue.source_queries import _FOUND_STUDENTS, _student_files, course_list
from rollcall.catalogue.views import CTES, r9, secs
from rollcall.functions import clock, maths, text
from rollcall.plans import courses, loads
from rollcall.sources import files


@query("sx_01_trim", "SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS Body FROM (SELECT doc_id, ' ' || text || chr(10) AS text FROM documents)")
def sx_01(v):
    return v.raw("documents").select("doc_id", text.strip(F.concat(F.lit(" "), "text", F.lit("\n"))).alias("Body"))


@query("sx_02_first_item", "SELECT Id, split_part(Rooms, '|', 1) AS FirstRoom, split_part(OlodPointers, '|', 1) AS FirstCourse FROM schedule_export")
def sx_02(v):
    return v.schedule_export.select(
        "Id", text.first_item("Rooms").alias("FirstRoom"), text.first_filled_item("OlodPointers").alias("FirstCourse")
    )


@query("sx_03_explode_keep_empty", "SELECT Id, unnest(CASE WHEN Classgroups IS NULL THEN [NULL] ELSE string_split(Classgroups, '|') END) AS SubgroupKey FROM schedule_export")
def sx_03(v):
    return text.explode_items(v.schedule_export, "Classgroups", "SubgroupKey").select("Id", "SubgroupKey")


@query("sx_04_explode_drop_empty", "SELECT Id, unnest(string_split(Classgroups, '|')) AS SubgroupKey FROM schedule_export")
def sx_04(v):
    return text.explode_items(v.schedule_export, "Classgroups", "SubgroupKey", keep_empty=False).select("Id", "SubgroupKey")


@query("sx_05_split_pair", "SELECT code, p_brand AS faculty, CAST(1 + code % 3 AS VARCHAR) AS program_stage FROM course_list")
def sx_05(v):
    rows = course_list(v).withColumn("first", loads.first_literal("faculties"))
    return text.split_pair(rows, "first", "faculty", "program_stage", ", trajectschijf ").select("code", "faculty", "program_stage")


@query("sx_06_drop_float_suffix", "SELECT CAST(c_custkey AS VARCHAR) AS Code, c_custkey AS k FROM customer")
def sx_06(v):
    k = F.col("c_custkey")
    typed = F.when(F.col("c_acctbal") > 0, F.concat(k.cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
    return v.raw("customer").select(text.drop_float_suffix(typed).alias("Code"), k.alias("k"))


@query("sx_07_collapse_blanks", "SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), '^ | $', '', 'g') AS Body FROM documents")
def sx_07(v):
    return v.raw("documents").select("doc_id", text.squish("text").alias("Body"))


@query("sx_08_null_words", "SELECT Id, CASE WHEN Status = 'Cancelled' THEN NULL ELSE coalesce(Status, 'open') END AS Status FROM schedule_export")
def sx_08(v):
    spelled = F.when(F.col("Status") == "Cancelled", " NaN ").otherwise(F.coalesce("Status", F.lit("open")))
    return v.schedule_export.select("Id", text.null_words(spelled, any_case=True).alias("Status"))


@query("sx_09_letter_case", "SELECT doc_id, upper(lang) AS Upper, lower(source) AS Lower FROM documents")
def sx_09(v):
    return v.raw("documents").select("doc_id", F.upper("lang").alias("Upper"), F.lower("source").alias("Lower"))


@query("sx_10_normalise_text", "SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS Title FROM documents")
def sx_10(v):
    return v.raw("documents").select("doc_id", text.normalise_title("text").alias("Title"))


@query("sx_11_first_number", "SELECT doc_id, TRY_CAST(nullif(regexp_extract(source, '(\\d+)', 1), '') AS INTEGER) AS n FROM documents")
def sx_11(v):
    return v.raw("documents").select("doc_id", text.first_number("source").alias("n"))


@query("sx_12_remove_literals", "SELECT code, replace(replace(credits, 'studiepunten', ''), 'studiepunt', '') AS credits FROM course_list")
def sx_12(v):
    return course_list(v).select("code", text.plain_text("credits", *loads.CREDIT_WORDS).alias("credits"))


@query("sx_13_whole_word", r"SELECT doc_id, regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])the([^\p{L}\p{N}_]|$)') AS HasWord FROM documents")
def sx_13(v):
    return v.raw("documents").select("doc_id", text.whole_word("text", "the").alias("HasWord"))


_CODES = """SELECT c_custkey AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 'pba-tin/2A' WHEN 'AUTOMOBILE' THEN 'PBA-SOLO/1' WHEN 'MACHINERY' THEN 'ic it'
    WHEN 'HOUSEHOLD' THEN 'PBA-VOE' ELSE c_mktsegment END AS program FROM customer"""


def _codes(v):
    m = F.col("c_mktsegment")
    program = (
        F.when(m == "BUILDING", "pba-tin/2A").when(m == "AUTOMOBILE", "PBA-SOLO/1").when(m == "MACHINERY", "ic it")
        .when(m == "HOUSEHOLD", "PBA-VOE").otherwise(m)
    )
    return v.raw("customer").select(F.col("c_custkey").alias("k"), program.alias("program"))


@query("sx_14_study_program", f"""
SELECT k, CASE program WHEN 'pba-tin/2A' THEN 'Toegepaste Informatica' WHEN 'PBA-SOLO/1' THEN 'Sociaal Werk' WHEN 'ic it' THEN 'Toegepaste Informatica' WHEN 'PBA-VOE' THEN 'Voedings- en Dieetkunde' END AS StudyProgram,
       CASE program WHEN 'pba-tin/2A' THEN 'Toegepaste Informatica' WHEN 'PBA-SOLO/1' THEN 'Secundair Onderwijs' WHEN 'ic it' THEN 'Toegepaste Informatica' WHEN 'PBA-VOE' THEN 'Voedings- en Dieetkunde' END AS LongestFirst
FROM ({_CODES})""")
def sx_14(v):
    return _codes(v).select(
        "k", text.study_program("program").alias("StudyProgram"), text.study_program("program", longest_first=True).alias("LongestFirst")
    )


@query("sx_15_program_family", f"SELECT k, split_part(program, '/', 1) AS Family, upper(split_part(program, '/', 1)) AS UpperFamily FROM ({_CODES})")
def sx_15(v):
    return _codes(v).select("k", text.program_family("program").alias("Family"), text.program_family("program", upper=True).alias("UpperFamily"))


@query("sx_16_clock_text", "SELECT DISTINCT FromTimeKey, strftime(make_timestamp(2024, 1, 1, FromTimeKey // 10000, FromTimeKey // 100 % 100, 0.0), '%H:%M:%S') AS FromTime FROM fact_base")
def sx_16(v):
    return v.fact_base.select("FromTimeKey", clock.key_clock_text("FromTimeKey").alias("FromTime")).distinct()


@query("sx_17_built_labels", "SELECT SessionID, SessionSlot, YearWeek FROM day_sessions")
def sx_17(v):
    return v.day_sessions.select("SessionID", "SessionSlot", "YearWeek")


@query("sx_18_value_map", "SELECT code, coalesce(second_chance = 'wel mogelijk.', false) AS SecondChance FROM course_list")
def sx_18(v):
    mapped = F.coalesce(text.value_map("second_chance", loads.SECOND_CHANCE), F.lit(False))
    return course_list(v).select("code", mapped.alias("SecondChance"))


# --- dates and times -----------------------------------------------------------------------


@query("dx_01_parse_datetime", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS Parsed FROM orders""")
def dx_01(v):
    day = F.col("o_orderdate")
    typed = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "MM/dd/yyyy HH:mm:ss"))
        .when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise("geen datum")
    )
    return v.raw("orders").select("o_orderkey", clock.parse_datetime(typed).alias("Parsed"))


@query("dx_02_date_and_time_keys", "SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS DateKey, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS TimeKey FROM events")
def dx_02(v):
    return v.raw("events").select("event_id", clock.date_key("ts").alias("DateKey"), clock.time_key("ts").alias("TimeKey"))


@query("dx_03_keys_to_times", f"SELECT DateKey, TimeKey, UserKey, strftime(strptime(CAST(DateKey AS VARCHAR), '%Y%m%d') + to_seconds({secs('TimeKey')}), '%Y-%m-%d %H:%M:%S') AS SeenAt FROM fact_wifi")
def dx_03(v):
    return v.wifi.withColumn("SeenAt", clock.at_second(clock.key_date("DateKey"), clock.key_seconds("TimeKey")))


@query("dx_04_local_time", """
SELECT o_orderkey, strftime(timezone('Europe/Brussels', timezone('UTC', o_orderdate + to_minutes(o_orderkey % 1440))), '%Y-%m-%d %H:%M:%S') AS LocalTime FROM orders""")
def dx_04(v):
    minute = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_orderkey") % 1440).cast("int"))
    utc = F.col("o_orderdate") + minute
    return v.raw("orders").select("o_orderkey", clock.local_time(utc).alias("LocalTime"))


@query("dx_05_round_half_even", """
SELECT event_id, strftime(make_timestamp(CAST(round_even(epoch_us(ts) / 300000000.0, 0) AS BIGINT) * 300000000), '%Y-%m-%d %H:%M:%S') AS FiveMinutes,
       strftime(make_timestamp(CAST(round_even(epoch_us(ts) / 60000000.0, 0) AS BIGINT) * 60000000), '%Y-%m-%d %H:%M:%S') AS OneMinute FROM events""")
def dx_05(v):
    return v.raw("events").select("event_id", clock.rounded("ts", 300).alias("FiveMinutes"), clock.rounded("ts", 60).alias("OneMinute"))


@query("dx_06_grace", f"SELECT DISTINCT FromTimeKey, CAST({secs('FromTimeKey')} + 900 AS INTEGER) AS CountsFrom FROM fact_base")
def dx_06(v):
    return v.fact_base.select("FromTimeKey", (clock.key_seconds("FromTimeKey") + 900).alias("CountsFrom")).distinct()


@query("dx_07_minutes_between", f"SELECT DISTINCT FromTimeKey, UntilTimeKey, {r9(f'({secs("UntilTimeKey")} - {secs("FromTimeKey")}) / 60.0')} AS Minutes FROM fact_base")
def dx_07(v):
    minutes = clock.minutes_between(clock.key_seconds("FromTimeKey"), clock.key_seconds("UntilTimeKey"))
    return v.fact_base.select("FromTimeKey", "UntilTimeKey", minutes.alias("Minutes")).distinct()


@query("dx_08_calendar_parts", """
SELECT o_orderkey, CAST(isodow(d) - 1 AS INTEGER) AS WeekdayNumber, dayname(d) AS WeekdayName, strftime(d, '%G-W%V') AS YearWeek,
       strftime(date_trunc('week', d), '%Y-%m-%d') AS WeekStart FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def dx_08(v):
    day = F.col("o_orderdate").cast("date")
    return v.raw("orders").select(
        "o_orderkey", clock.weekday_number(day).alias("WeekdayNumber"), clock.weekday_name(day).alias("WeekdayName"),
        clock.iso_year_week(day).alias("YearWeek"), clock.week_monday(day).alias("WeekStart"),
    )


@query("dx_09_calendar_attributes", "SELECT o_orderkey, " + CTES["dim_date"].split("FROM (SELECT")[0].replace("SELECT ", "", 1).replace("d AS FullDate", "CAST(d AS VARCHAR) AS FullDate") + " FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def dx_09(v):
    parts = clock.calendar_columns(F.col("o_orderdate").cast("date"))
    return v.raw("orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("dx_10_half_of_day", "SELECT event_id, CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS Half FROM events")
def dx_10(v):
    return v.raw("events").select("event_id", clock.half_of_day(F.hour("ts")).alias("Half"))


@query("dx_11_key_plus_minutes", "SELECT event_id, CAST(strftime(date_trunc('minute', ts) + INTERVAL 15 MINUTE, '%H%M%S') AS INTEGER) AS TimeKey FROM events")
def dx_11(v):
    minute = F.hour("ts") * 10000 + F.minute("ts") * 100
    later = (clock.key_seconds(minute) + 900) % clock.DAY_SECONDS
    return v.raw("events").select("event_id", clock.seconds_key(later).alias("TimeKey"))


@query("dx_12_finished", "SELECT LectureID, SubgroupKey, UserCount IS NOT NULL AS Finished FROM fact_lecture")
def dx_12(v):
    return v.fact_base.select("LectureID", "SubgroupKey", clock.finished("DateKey", "UntilTimeKey", v.now).alias("Finished"))


# --- numbers ---------------------------------------------------------------------------------


@query("mx_01_safe_ratio", f"SELECT LectureID, SubgroupKey, {r9('CASE WHEN Capacity > 0 THEN UserCount / CAST(Capacity AS DOUBLE) END')} AS Ratio FROM fact_lecture f JOIN dim_room r ON r.RoomKey = f.RoomKey")
def mx_01(v):
    rows = v.fact.join(v.rooms.select("RoomKey", "Capacity"), "RoomKey")
    return rows.select("LectureID", "SubgroupKey", maths.ratio("UserCount", "Capacity").alias("Ratio"))


@query("mx_02_tolerance", "SELECT count(*) FILTER (abs(round(AttendanceRate, 2) - AttendanceRate) > 0.0001) AS Different FROM fact_lecture")
def mx_02(v):
    return v.fact.agg(F.count_if(maths.differs(F.round("AttendanceRate", 2), "AttendanceRate")).alias("Different"))


@query("mx_03_max_min_ratio", f"SELECT SubgroupKey, {r9('CASE WHEN min(UserCount) > 0 THEN max(UserCount) / CAST(min(UserCount) AS DOUBLE) END')} AS MaxMinRatio FROM fact_lecture GROUP BY 1")
def mx_03(v):
    edges = v.fact.groupBy("SubgroupKey").agg(F.max("UserCount").alias("a"), F.min("UserCount").alias("b"))
    return edges.select("SubgroupKey", maths.ratio("a", "b").alias("MaxMinRatio"))


@query("mx_04_two_decimals", "SELECT p_partkey, CAST(CAST(round(p_retailprice, 2) AS DECIMAL(10, 2)) AS DOUBLE) AS Area FROM part")
def mx_04(v):
    return v.raw("part").select("p_partkey", F.round("p_retailprice", 2).cast("decimal(10,2)").alias("Area"))


@query("mx_05_percentage", f"SELECT SessionID, {r9('AttendanceRate * 100')} AS AttendancePercentage FROM course_results")
def mx_05(v):
    return v.course_results.select("SessionID", "AttendancePercentage")


# --- arrays and documents ----------------------------------------------------------------------

_EVALUATION = """SELECT p_partkey AS code, p_name || CASE WHEN p_size % 7 = 0 THEN ' project' ELSE '' END AS title,
    CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 5 = 0 THEN '{''format'': ''Mondeling  examen'' kapot'
         ELSE '[[{''moment'': ''Binnen examenrooster'', ''format'': ''' || f || ''', ''percentage'': ''60''}, {''moment'': ''x'', ''format'': ''Verslag'', ''percentage'': ''40''}]]' END AS evaluation_methods, f
    FROM (SELECT *, CASE p_size % 4 WHEN 0 THEN 'Schriftelijk examen' WHEN 1 THEN 'Observatie van functioneren van de student' ELSE 'Portfolio' END AS f FROM part)"""
CTES.setdefault("evaluated_courses", _EVALUATION)


def evaluated_courses(v):
    """Courses with evaluation literals, some of which do not parse."""
    size = F.col("p_size")
    form = (
        F.when(size % 4 == 0, "Schriftelijk examen")
        .when(size % 4 == 1, "Observatie van functioneren van de student")
        .otherwise("Portfolio")
    )
    literal = F.concat(
        F.lit("[[{'moment': 'Binnen examenrooster', 'format': '"), form,
        F.lit("', 'percentage': '60'}, {'moment': 'x', 'format': 'Verslag', 'percentage': '40'}]]"),
    )
    return v.raw("part").select(
        F.col("p_partkey").alias("code"),
        F.concat("p_name", F.when(size % 7 == 0, " project").otherwise("")).alias("title"),
        F.when(size % 11 == 0, None).when(size % 5 == 0, "{'format': 'Mondeling  examen' kapot").otherwise(literal).alias("evaluation_methods"),
    )


_FORMATS = "CASE WHEN evaluation_methods IS NULL THEN '' WHEN evaluation_methods LIKE '{%' THEN 'mondeling examen' ELSE lower(f) || ' | verslag' END"


@query("ax_01_explode", "SELECT code, unnest([p_brand || ', trajectschijf ' || CAST(1 + code % 3 AS VARCHAR), 'IC IT']) AS faculty FROM course_list")
def ax_01(v):
    return course_list(v).select("code", F.explode(loads.literal_list("faculties")).alias("faculty"))


@query("ax_02_nested_formats", f"SELECT code, {_FORMATS} AS formats FROM evaluated_courses")
def ax_02(v):
    return evaluated_courses(v).select("code", F.array_join(courses.evaluation_formats("evaluation_methods"), " | ").alias("formats"))


@query("ax_03_any_item_contains", f"SELECT code, {_FORMATS} LIKE '%schriftelijk examen%' AS Written FROM evaluated_courses")
def ax_03(v):
    formats = courses.evaluation_formats("evaluation_methods")
    return evaluated_courses(v).select("code", courses.any_contains(formats, courses.WRITTEN_EXAM).alias("Written"))


@query("ax_04_joined_list", "SELECT Id, replace(Classgroups, '|', ' | ') AS Joined FROM schedule_export")
def ax_04(v):
    return v.schedule_export.select("Id", F.when(F.col("Classgroups").isNotNull(), F.array_join(text.items("Classgroups"), " | ")).alias("Joined"))


@query("ax_05_number_of_first_item", "SELECT code, CAST(1 + code % 3 AS INTEGER) AS stage FROM course_list")
def ax_05(v):
    stage = F.regexp_extract(loads.first_literal("faculties"), rf"{loads.STAGE_WORD} (\d+)", 1)
    return course_list(v).select("code", stage.try_cast("int").alias("stage"))


@query("jx_01_wrapped_documents", f"SELECT SUBGROEPID, count(*) AS Students, count(DISTINCT EMAIL) AS Names FROM ({_FOUND_STUDENTS}) GROUP BY 1")
def jx_01(v):
    return files.student_documents(v.spark, _student_files(v)).groupBy("SUBGROEPID").agg(
        F.count(F.lit(1)).alias("Students"), F.count_distinct("EMAIL").alias("Names")
    )
