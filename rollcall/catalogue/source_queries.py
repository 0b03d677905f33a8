"""Sources and sinks: written from the bound tables, read back, compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.catalogue.registry import query
from rollcall.catalogue.views import CTES
from rollcall.operators.aggregates import value_counts
from rollcall.operators.joins import only_known
from rollcall.plans import courses, lectures, loads, presence, slots
from rollcall.session import scratch_path
from rollcall.sources import files, generators, pages, sinks
from rollcall.streaming import feed as stream

_EXPORT = schemas.SCHEDULE_EXPORT_COLUMNS
_SHOWN = ["Id", "Start", "End", "Status", "WorkFormCourse", "EducationActivity", "Classgroups", "OlodPointers", "Rooms"]
_SHOWN_SQL = 'Id, "Start", "End", Status, WorkFormCourse, EducationActivity, Classgroups, OlodPointers, Rooms'


def _raw_lines(df, header: str, path: str) -> str:
    """Text files of ready-made lines, each file with the header line."""
    df.select(F.col("line").alias(header)).write.csv(path, header=True, sep="\x01", quote="\x00", emptyValue="")
    return path


def _export_files(v, sep: str = ";") -> str:
    """Exports with faults: a field too many on cancelled rows, short unconfirmed rows."""
    rows = v.schedule_export
    cell = lambda c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")
    full = F.concat_ws(sep, *[cell(c) for c in _EXPORT])
    short = F.concat_ws(sep, *[cell(c) for c in _EXPORT[: _EXPORT.index("Rooms") + 1]])
    line = F.when(F.col("Status") == "Cancelled", F.concat(full, F.lit(sep + "too many"))).when(
        F.col("Status").isNull(), short
    ).otherwise(full)
    return _raw_lines(rows.select(line.alias("line")), sep.join(_EXPORT), scratch_path(v.spark, "exports"))


@query("src_01_schedule_exports", f"SELECT {_SHOWN_SQL} FROM schedule_export WHERE Status IS DISTINCT FROM 'Cancelled'")
def src_01(v):
    return files.schedule_exports(v.spark, _export_files(v)).select(*_SHOWN)


@query("src_02_detect_separator", "SELECT CAST(UserKey AS VARCHAR) AS UserKey, UserName FROM dim_user")
def src_02(v):
    path = scratch_path(v.spark, "users")
    users = v.users.select(F.col("UserKey").alias(" UserKey "), F.col("UserName").alias("UserName "))
    users.write.csv(path, header=True, sep="\t", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.delimited(v.spark, path)


# cells with separators, quotes and line breaks; one user in 50 has a field too many, one in 7 a field too few
_NOTE_SQL = """CASE WHEN UserKey % 5 = 0 THEN 'first; "line" of ' || UserName || chr(10) || chr(10) || 'last, line' WHEN UserKey % 5 = 1 THEN '5" pipe' ELSE 'plain' END"""


def _noted_files(v) -> str:
    """Two folders of files: other separators, other orders of columns, each file with its header."""
    path = scratch_path(v.spark, "noted")
    key, name = F.col("UserKey"), F.col("UserName")
    note = F.when(key % 5 == 0, F.concat(F.lit('first; "line" of '), name, F.lit("\n\nlast, line"))).when(key % 5 == 1, '5" pipe').otherwise("plain")
    # a quote inside a cell that isn't quoted is a character like any other
    cell = F.when(key % 5 == 0, F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(note)
    more = lambda sep: F.when(key % 50 == 3, F.lit(sep + "too many")).otherwise("")
    semicolons = F.concat(F.concat_ws(";", key.cast("string"), name), F.when(key % 7 == 2, "").otherwise(F.concat(F.lit(";"), cell, more(";"))))
    commas = F.concat(F.concat_ws(",", cell, key.cast("string")), F.when(key % 7 == 2, "").otherwise(F.concat(F.lit(","), name, more(","))))
    parity = key % 2
    line = F.when(parity == 0, semicolons).otherwise(commas)
    header = F.when(F.col("parity") == 0, "UserKey;UserName;Note").otherwise("Note,UserKey,UserName")
    # a file for each 1,000 users
    text = v.users.groupBy(F.floor(key / 1000).alias("file"), parity.alias("parity")).agg(F.concat_ws("\n", F.collect_list(line)).alias("lines"))
    text.select("file", "parity", F.concat_ws("\n", header, "lines").alias("value")).write.partitionBy("file", "parity").text(path)
    return path


@query("src_02_quoted_records", f"""
SELECT CAST(UserKey AS VARCHAR) AS UserKey, CASE WHEN UserKey % 2 = 0 OR UserKey % 7 <> 2 THEN UserName END AS UserName,
  CASE WHEN UserKey % 2 = 1 OR UserKey % 7 <> 2 THEN {_NOTE_SQL} END AS Note
FROM dim_user WHERE UserKey % 50 <> 3 OR UserKey % 7 = 2""")
def src_02_quoted(v):
    return files.delimited(v.spark, _noted_files(v), candidates=";,").select("UserKey", "UserName", "Note")


@query("src_03_null_tokens", """
SELECT CAST(RoomKey AS VARCHAR) AS RoomKey, RoomName, CASE WHEN Capacity > 0 THEN CAST(Capacity AS VARCHAR) END AS Capacity FROM dim_room""")
def src_03(v):
    path = scratch_path(v.spark, "rooms")
    capacity = F.when(F.col("Capacity") == 0, "NULL").otherwise(F.col("Capacity").cast("string"))
    v.rooms.select(F.col("RoomKey").cast("string"), "RoomName", capacity.alias("Capacity")).write.csv(path, header=True)
    return files.delimited_with_nulls(
        v.spark, path, ",", "RoomKey string, RoomName string, Capacity string", ["NULL", "", "nan"]
    )


@query("src_04_parquet_columns", "SELECT user_id, event_type, count(*) AS Rows FROM events GROUP BY ALL")
def src_04(v):
    return value_counts(
        files.parquet_columns(v.spark, f"{v.dir}/events.parquet", ["user_id", "event_type"]), ["user_id", "event_type"]
    )


@query("src_05_parquet_folder", "SELECT username, count(*) AS Rows FROM wifi_feed WHERE ssid = 'eduroam' GROUP BY 1")
def src_05(v):
    path = scratch_path(v.spark, "feed")
    v.wifi_feed.write.parquet(path)
    folder = files.parquet_folder(v.spark, path).where("ssid = 'eduroam'")
    return value_counts(folder, ["username"])


_STUDENTS = """SELECT b.SubgroupKey AS SUBGROEPID, s.SubgroupCode AS SUBGROEPCODE, u.UserName AS EMAIL
FROM bridge b JOIN dim_subgroup s ON s.SubgroupKey = b.SubgroupKey JOIN dim_user u ON u.UserKey = b.UserKey"""
_FOUND_STUDENTS = f"{_STUDENTS} WHERE b.UserKey % 11 <> 10"


def _students(v):
    return v.bridge.join(v.subgroups, "SubgroupKey").join(v.users, "UserKey").select(
        F.col("SubgroupKey").alias("SUBGROEPID"), F.col("SubgroupCode").alias("SUBGROEPCODE"),
        F.lit(None).cast("bigint").alias("DEELGROEPID"), F.lit("x").alias("NAAM"), F.col("UserName").alias("EMAIL"),
        "UserKey",
    )


# --- wrappers of student documents: the list stands for %s; the last three hold none that counts
_WRAPPERS = [
    '{"students": %s, "count": 1}', '{"students": {"students": %s, "count": 1}}', "%s", '{" Students ": %s}',
    '{"data": {"page": 1, "STUDENTS": {"note": "[]", "students": %s}}}', '{"count": 1, "result": %s}',
    '{"z": {"deep": {"deeper": {"list": %s}}}, "a": {"students": [{"EMAIL": "later"}]}}', '{"students": [], "other": %s}', '{"students": %s', '{"text": "[]"}',
]


def _student_files(v) -> str:
    """One document per 500 users, in wrappers of every kind; every eleventh user is in the documents that hold none."""
    path = scratch_path(v.spark, "documents")
    key = F.col("UserKey")
    lost = F.when(key % 11 == 10, F.lit(1)).otherwise(0)
    rows = _students(v).withColumn("doc", F.floor(key / 500) * 2 + lost).withColumn("kind", F.when(lost == 1, 7 + F.floor(key / 500) % 3).otherwise(F.floor(key / 50) % 7))
    docs = rows.groupBy("doc", "kind").agg(
        F.collect_list(F.struct("SUBGROEPID", "SUBGROEPCODE", "DEELGROEPID", "NAAM", "EMAIL")).alias("s")
    )
    wrapper = F.get(F.array(*[F.lit(w) for w in _WRAPPERS]), F.col("kind").cast("int"))
    text = F.concat(F.when(F.col("kind") % 2 == 0, "\ufeff").otherwise(""), F.replace(wrapper, F.lit("%s"), F.to_json("s")))
    docs.select("doc", "kind", text.alias("value")).write.partitionBy("doc", "kind").text(path)
    return path


@query("src_06_student_documents", _FOUND_STUDENTS)
def src_06(v):
    return files.student_documents(v.spark, _student_files(v)).select("SUBGROEPID", "SUBGROEPCODE", "EMAIL")


@query("src_07_parametrised_query", """
SELECT f.LectureID, f.SubgroupKey, s.ProgramName FROM fact_base f JOIN dim_subgroup s ON s.SubgroupKey = f.SubgroupKey
WHERE s.ProgramName LIKE 'A%' AND f.DateKey BETWEEN 20240108 AND 20240121""")
def src_07(v):
    sql = """SELECT f.LectureID, f.SubgroupKey, s.ProgramName FROM {fact} f JOIN {subgroups} s ON s.SubgroupKey = f.SubgroupKey
        WHERE s.ProgramName LIKE :program AND f.DateKey BETWEEN :first AND :last"""
    return files.table_query(
        v.spark, sql, {"program": "A%", "first": 20240108, "last": 20240121}, fact=v.fact_base, subgroups=v.subgroups
    )


_COURSES = """SELECT p_partkey AS code, p_name AS title,
    '[''' || p_brand || ', trajectschijf ' || CAST(1 + p_partkey % 3 AS VARCHAR) || ''', "IC IT"]' AS faculties,
    CASE WHEN p_size % 2 = 0 THEN 'wel mogelijk.' WHEN p_size % 3 = 0 THEN 'niet mogelijk.' END AS second_chance,
    CAST(3 + p_size % 4 AS VARCHAR) || ' studiepunten' AS credits, p_brand, p_size FROM part"""
CTES.setdefault("course_list", _COURSES)


def course_list(v):
    """Courses with literal cells as the scraped catalogue has them."""
    p = v.raw("part")
    k, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        k.alias("code"), F.col("p_name").alias("title"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit(", trajectschijf "), (1 + k % 3).cast("string"), F.lit("', \"IC IT\"]")).alias("faculties"),
        F.when(size % 2 == 0, "wel mogelijk.").when(size % 3 == 0, "niet mogelijk.").alias("second_chance"),
        F.concat((3 + size % 4).cast("string"), F.lit(" studiepunten")).alias("credits"),
        "p_brand", "p_size",
    )


@query("src_08_literal_columns", """
SELECT code, 2 AS Items, p_brand || ', trajectschijf ' || CAST(1 + code % 3 AS VARCHAR) AS FirstItem, 'IC IT' AS SecondItem FROM course_list""")
def src_08(v):
    items = loads.literal_list("faculties")
    return course_list(v).select(
        "code", F.size(items).alias("Items"), F.get(items, F.lit(0)).alias("FirstItem"), F.get(items, F.lit(1)).alias("SecondItem")
    )


def _plain_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]*>', '', 'gs')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim({out})"


@query("src_09_page_extraction", f"""
SELECT page_id, nullif({_plain_sql("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")}, '') AS title,
       nullif(regexp_extract(url, '/(\\d+)', 1), '') AS code,
       len(regexp_extract_all(regexp_extract(html, '(?is)^.*?<ul\\b[^>]*>(.*?)</ul>', 1), '(?is)<li\\b[^>]*>(.*?)</li>', 1)) AS items,
       nullif({_plain_sql("regexp_extract(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1)")}, '') AS first_item, 0 AS evaluation_rows
FROM pages""")
def src_09(v):
    items = pages.items_after("html", None)
    first = F.get(items, F.lit(0))
    return v.raw("pages").select(
        "page_id",
        pages.element("html", "h1").alias("title"),
        pages.page_code("url", r"/(\d+)").alias("code"),
        F.size(items).cast("bigint").alias("items"),
        F.when(first != "", first).alias("first_item"),
        F.size(pages.table_rows("html", pages.EVALUATION_MARKER)).alias("evaluation_rows"),
    )


@query("src_09_evaluation_tables", f"""
SELECT page_id, CAST(page_id % 4 AS BIGINT) AS evaluation_rows, CASE WHEN page_id % 4 > 0 THEN 'moment 1' END AS moment, CASE WHEN page_id % 4 > 0 THEN 'form & ' || page_id END AS format,
  nullif(regexp_extract(url, '/(\\d+)', 1), '') AS code FROM pages""")
def src_09_tables(v):
    """Course pages whose html has a table after the marker: as many rows as the page number says, and one too short."""
    k = F.col("page_id")
    cell = lambda *parts: F.concat(F.lit("<td> "), *parts, F.lit(" </td>"))
    row = lambda i: F.concat(F.lit("<tr>"), cell(F.lit("moment "), i.cast("string")), cell(F.lit("<b>form</b> &amp; "), k.cast("string")), cell(F.lit("50%")), F.lit("</tr>"))
    numbers = F.when(k % 4 > 0, F.sequence(F.lit(1), (k % 4).cast("int"))).otherwise(F.array().cast("array<int>"))
    table = F.concat(F.lit(f"{pages.EVALUATION_MARKER}<table><tr><td>short</td></tr>"), F.array_join(F.transform(numbers, row), ""), F.lit("</table>"))
    built = pages.course_pages(v.raw("pages").withColumn("html", F.concat("html", table)).select("page_id", "url", "html"), code=r"/(\d+)", keep=["page_id"])
    first = F.get("evaluation_methods", F.lit(0))
    return built.select("page_id", F.size("evaluation_methods").cast("bigint").alias("evaluation_rows"), first["moment"].alias("moment"),
                        first["format"].alias("format"), "code")


@query("src_10_feed_stream", "SELECT username, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, ssid FROM wifi_feed")
def src_10(v):
    events = v.raw("events").schema
    rows = v.spark.readStream.schema(events).option("pathGlobFilter", "events.parquet").parquet(v.dir)
    out, check = scratch_path(v.spark, "feed"), scratch_path(v.spark, "feed-checkpoint")
    landed = rows.select(_name("user_id").alias("username"), F.col("ts").alias("timestamp"), _network().alias("ssid"))
    landed.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
    again = stream.read_feed(v.spark, out)
    table, check = scratch_path(v.spark, "table"), scratch_path(v.spark, "table-checkpoint")
    again.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(table).awaitTermination()
    feed = v.spark.read.parquet(table)
    return feed.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _name(key):
    from rollcall.catalogue.views import user_name

    return user_name(key)


def _network():
    from rollcall.catalogue.views import CAMPUS_EVENTS, NETWORK

    return F.when(F.col("event_type").isin(CAMPUS_EVENTS), NETWORK).otherwise(F.col("event_type"))


@query("src_11_calendar", "SELECT * REPLACE (CAST(FullDate AS VARCHAR) AS FullDate) FROM dim_date")
def src_11(v):
    return v.dates


@query("src_12_minutes_of_day", """
SELECT t.*, count(w.UserKey) AS Connections FROM dim_time t LEFT JOIN fact_wifi w ON w.TimeKey = t.TimeKey GROUP BY ALL""")
def src_12(v):
    counts = v.wifi.groupBy("TimeKey").agg(F.count("UserKey").alias("_n"))
    return v.times.join(counts, "TimeKey", "left").withColumn("Connections", F.coalesce("_n", F.lit(0))).drop("_n")


@query("src_13_activity_seed", """
SELECT a.*, count(f.LectureID) AS FactRows FROM dim_activity a LEFT JOIN fact_base f ON f.ActivityKey = a.ActivityKey GROUP BY ALL""")
def src_13(v):
    counts = v.fact_base.groupBy("ActivityKey").agg(F.count(F.lit(1)).alias("_n"))
    return v.activities.join(counts, "ActivityKey", "left").withColumn("FactRows", F.coalesce("_n", F.lit(0))).drop("_n")


@query("src_14_lookup_list", """
SELECT ClassName, count(*) AS Rows FROM schedule WHERE ClassName IN (SELECT p_name FROM part WHERE p_name LIKE '%widget%' OR p_name LIKE '%gizmo%') GROUP BY 1""")
def src_14(v):
    path = scratch_path(v.spark, "titles")
    titles = v.raw("part").where("p_name LIKE '%widget%' OR p_name LIKE '%gizmo%'").select("p_partkey", F.col("p_name").alias("title"))
    titles.write.csv(path, header=True)
    wanted = files.lookup_list(v.spark, path, "title").withColumnRenamed("title", "ClassName")
    return value_counts(only_known(v.schedule, wanted, ["ClassName"]), ["ClassName"])


# --- sinks -----------------------------------------------------------------------------


@query("snk_01_csv_semicolon", f"SELECT {_SHOWN_SQL} FROM schedule_export")
def snk_01(v):
    path = sinks.write_csv(v.schedule_export.select(*_SHOWN), scratch_path(v.spark, "csv"))
    return files.delimited(v.spark, path)


@query("snk_02_csv_results", "SELECT CAST(SubgroupKey AS VARCHAR) AS SubgroupKey, CAST(TotalStudents AS VARCHAR) AS TotalStudents FROM roster")
def snk_02(v):
    path = sinks.write_csv(presence.roster_sizes(v.bridge, v.users, v.subgroups), scratch_path(v.spark, "csv"), sep=",")
    return files.delimited(v.spark, path)


@query("snk_03_append", "SELECT ssid, count(*) AS Rows FROM wifi_feed GROUP BY 1")
def snk_03(v):
    path = scratch_path(v.spark, "append")
    sinks.append(v.wifi_feed.where("ssid = 'eduroam'"), path)
    sinks.append(v.wifi_feed.where("ssid <> 'eduroam'"), path)
    return value_counts(v.spark.read.parquet(path), ["ssid"])


@query("snk_04_reload", "SELECT * FROM fact_wifi")
def snk_04(v):
    path = scratch_path(v.spark, "reload")
    sinks.reload(v.wifi_feed.select("username"), path)
    sinks.reload(v.wifi, path)
    return v.spark.read.parquet(path)


_GROUPS = "SELECT DISTINCT unnest(string_split(Classgroups, '|')) AS Classgroup FROM schedule_export"


@query("snk_05_append_new_keys", _GROUPS)
def snk_05(v):
    path = scratch_path(v.spark, "groups")
    sinks.append(loads.unique_class_groups(v.schedule_export.where("Status = 'Cancelled'")), path)
    sinks.append_new(loads.unique_class_groups(v.schedule_export), v.spark.read.parquet(path), ["Classgroup"], path)
    return v.spark.read.parquet(path)


@query("snk_06_split_output", """
SELECT 'valid' AS Part, count(*) AS Rows FROM fact_lecture WHERE coalesce(UserCount > 0, false)
UNION ALL SELECT 'quarantine', count(*) FROM fact_lecture WHERE NOT coalesce(UserCount > 0, false)""")
def snk_06(v):
    good, bad = sinks.split_write(
        v.fact.select("LectureID", "SubgroupKey", "UserCount"), F.col("UserCount") > 0,
        scratch_path(v.spark, "valid"), scratch_path(v.spark, "quarantine"),
    )
    count = lambda path, label: v.spark.read.csv(path, sep=";", header=True).agg(
        F.lit(label).alias("Part"), F.count(F.lit(1)).alias("Rows")
    )
    return count(good, "valid").unionByName(count(bad, "quarantine"))


@query("snk_07_batch_snapshots", "SELECT username, ssid, count(*) AS Rows FROM wifi_feed GROUP BY ALL")
def snk_07(v):
    landed, out, check = (scratch_path(v.spark, n) for n in ("landed", "snapshots", "snapshots-checkpoint"))
    v.wifi_feed.write.parquet(landed)
    polls = stream.read_feed(v.spark, landed, files_per_batch=1)
    write = lambda batch, epoch: sinks.snapshot(batch, out, f"{epoch:06d}")
    polls.writeStream.foreachBatch(lambda b, e: (write(b, e), None)[1]).option("checkpointLocation", check).trigger(
        availableNow=True
    ).start().awaitTermination()
    return value_counts(v.spark.read.parquet(out), ["username", "ssid"])


@query("snk_08_private_export", "SELECT SessionSlot, CAST(count(*) AS VARCHAR) AS NumberOfSessions FROM lab_sessions GROUP BY 1")
def snk_08(v):
    sizes = v.lab_sessions.groupBy("SessionSlot").agg(F.count(F.lit(1)).alias("NumberOfSessions"))
    path = sinks.export_aggregates(sizes, ["SessionSlot", "NumberOfSessions"], scratch_path(v.spark, "export"))
    return files.delimited(v.spark, path)


@query("snk_09_merged_documents", _FOUND_STUDENTS)
def snk_09(v):
    students = files.student_documents(v.spark, _student_files(v)).drop("source_file")
    path = sinks.merge_documents(students, scratch_path(v.spark, "merged"))
    return v.spark.read.schema(schemas.STUDENT).json(path).select("SUBGROEPID", "SUBGROEPCODE", "EMAIL")
