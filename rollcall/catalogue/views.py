"""Warehouse views over the driver tables, once for Spark and once as SQL.

Both sides use the same whole-number formulas: lectures come from orders and their line
items, wifi connections from events, users from customers, subgroups from nations,
rooms from suppliers, classes from parts.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions import clock
from rollcall.operators.aggregates import distinct_list
from rollcall.plans import course_types, presence, sessions, slots
from rollcall.session import stored
from rollcall.sources import generators

NOW = "2024-01-25 12:00:00"
NETWORK = "eduroam"
CAMPUS_EVENTS = ["click", "view", "purchase"]
GROUP_WORDS = ["widget", "gizmo"]
UNMATCHED_WORD = "anvil"
# five blocks of two hours, 135 minutes apart from 08:15
SLOT_FROM = [81500, 103000, 124500, 150000, 171500]
SLOT_UNTIL = [101500, 123000, 144500, 170000, 191500]


class Views:
    """Lazy frames; nothing is read before a query uses it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def now(self):
        return F.lit(NOW).cast("timestamp_ntz")

    @cached_property
    def wifi_feed(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            user_name("user_id").alias("username"),
            F.col("ts").alias("timestamp"),
            F.when(F.col("event_type").isin(CAMPUS_EVENTS), NETWORK).otherwise(F.col("event_type")).alias("ssid"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("UserKey"), user_name("c_custkey").alias("UserName")
        )

    @cached_property
    def bridge(self) -> DataFrame:
        c = self.raw("customer")
        home = c.select(F.col("c_custkey").alias("UserKey"), F.col("c_nationkey").cast("bigint").alias("SubgroupKey"))
        extra = c.select(F.col("c_custkey").alias("UserKey"), (F.col("c_custkey") % 7).alias("SubgroupKey"))
        return home.union(extra).distinct()

    @cached_property
    def wifi(self) -> DataFrame:
        """Fact rows with the user id as key, rounded to the minute."""
        e = self.raw("events").where(F.col("event_type").isin(CAMPUS_EVENTS))
        day, time = clock.rounded_keys("ts", 60)
        return e.select(day.alias("DateKey"), time.alias("TimeKey"), F.col("user_id").alias("UserKey")).distinct()

    @cached_property
    def subgroups(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").cast("bigint").alias("SubgroupKey"),
            F.col("n_name").alias("SubgroupCode"),
            F.col("r_name").alias("ProgramName"),
        )

    @cached_property
    def rooms(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").select(
            k.alias("RoomKey"),
            F.col("s_name").alias("RoomName"),
            F.concat(F.lit("B."), (k % 5).cast("string"), F.lit("."), F.lpad(k.cast("string"), 6, "0")).alias("Code"),
            (k % 5).cast("int").alias("RoomFloor"),
            F.when(k % 17 == 0, 0).otherwise(10 + k % 40).cast("int").alias("Capacity"),
        )

    @cached_property
    def classes(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            k.alias("ClassKey"),
            F.col("p_name").alias("ClassName"),
            (k + 190000).alias("ClassCode"),
            (3 + F.col("p_size") % 4).cast("int").alias("ClassCredits"),
            (1 + k % 3).cast("int").alias("ClassProgramStage"),
        )

    @cached_property
    def dates(self) -> DataFrame:
        return generators.calendar(self.raw("events"), "ts", "ts")

    @cached_property
    def times(self) -> DataFrame:
        return generators.dim_time(self.spark)

    @cached_property
    def activities(self) -> DataFrame:
        return generators.dim_activity(self.spark)

    @cached_property
    def fact_base(self) -> DataFrame:
        """Lecture keys, one row per lecture and subgroup."""
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        l = self.raw("lineitem").select("l_orderkey", "l_suppkey")
        pairs = (
            l.groupBy("l_orderkey", (F.col("l_suppkey") % 25).alias("SubgroupKey"))
            .agg(F.min("l_suppkey").alias("RoomKey"))
            .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        )
        k = F.col("o_orderkey")
        slot = (clock.whole(k, 30) % 5).cast("int")
        return pairs.select(
            k.alias("LectureID"),
            (20240101 + k % 30).cast("int").alias("DateKey"),
            F.get(F.array(*[F.lit(t) for t in SLOT_FROM]), slot).alias("FromTimeKey"),
            F.get(F.array(*[F.lit(t) for t in SLOT_UNTIL]), slot).alias("UntilTimeKey"),
            F.col("o_custkey").alias("ClassKey"),
            "SubgroupKey",
            "RoomKey",
            (F.substring("o_orderpriority", 1, 1).cast("int") * 7).alias("ActivityKey"),
        )

    def with_counts(self, lectures: DataFrame) -> DataFrame:
        """Lectures with head counts, rates and occupancy as of NOW."""
        counted = presence.refresh_attendance(lectures, self.wifi, self.bridge, self.users, self.subgroups, self.now)
        return presence.refresh_occupancy(counted, self.rooms)

    @cached_property
    def counted(self) -> DataFrame:
        """Lectures with head counts and rates as of NOW."""
        return presence.refresh_attendance(self.fact_base, self.wifi, self.bridge, self.users, self.subgroups, self.now)

    @cached_property
    def fact(self) -> DataFrame:
        """Counted lectures with occupancy."""
        return self.with_counts(self.fact_base)

    def lectures_wide(self, lectures: DataFrame) -> DataFrame:
        """The finished ones of these lectures, counted and joined with every dimension."""
        return (
            self.with_counts(lectures).where(F.col("AttendanceRate").isNotNull())
            .join(self.dates, "DateKey")
            .join(self.times.select(F.col("TimeKey").alias("FromTimeKey"), F.col("Hour").alias("FromHour")), "FromTimeKey")
            .join(self.classes, "ClassKey")
            .join(self.subgroups, "SubgroupKey")
            .join(self.activities, "ActivityKey")
            .join(self.rooms.select("RoomKey", F.col("Code").alias("RoomCode"), "RoomName", F.col("Capacity").alias("RoomCapacity")), "RoomKey")
        )

    @cached_property
    def facts_wide(self) -> DataFrame:
        """Finished lectures joined with every dimension."""
        return self.lectures_wide(self.fact_base)

    @cached_property
    def schedule(self) -> DataFrame:
        """Lectures with class, subgroup and seconds of the day."""
        base = self.fact_base.join(self.classes.select("ClassKey", "ClassName"), "ClassKey").join(
            self.subgroups, "SubgroupKey"
        )
        return sessions.with_times(base)

    @cached_property
    def group_titles(self) -> DataFrame:
        names = self.raw("part").where(word_in("p_name", GROUP_WORDS))
        return course_types.title_set(names, "p_name")

    @cached_property
    def regular_titles(self) -> DataFrame:
        names = self.raw("part").where(~word_in("p_name", [*GROUP_WORDS, UNMATCHED_WORD]))
        return course_types.title_set(names, "p_name")

    def keyed_titles(self, words: list[str], inside: bool) -> DataFrame:
        names = self.classes.where(word_in("ClassName", words) if inside else ~word_in("ClassName", words))
        return course_types.title_set(names.select(keyed_name().alias("title")), "title")

    @cached_property
    def typed_schedule(self) -> DataFrame:
        """Lectures with lesson types; part names repeat, so a class is named by its key too, with a hyphen that normalising removes."""
        named = self.schedule.withColumn("ClassName", keyed_name())
        return course_types.with_lesson_type(
            named, self.keyed_titles(GROUP_WORDS, True), self.keyed_titles([*GROUP_WORDS, UNMATCHED_WORD], False)
        )

    @cached_property
    def course_results(self) -> DataFrame:
        known = course_types.classified(self.typed_schedule)
        sets = stored(sessions.course_session_sets(known), "course-sessions")
        return course_types.rate_sessions(sets, self.wifi, self.bridge)

    @cached_property
    def course_valid(self) -> DataFrame:
        return course_types.valid(self.course_results)

    # the whole timetable as one course: bounded sessions per day
    @cached_property
    def day_rows(self) -> DataFrame:
        rows = self.fact.join(self.subgroups, "SubgroupKey").join(
            self.rooms.select("RoomKey", F.col("Code").alias("RoomCode")), "RoomKey"
        )
        return sessions.with_times(rows)

    @cached_property
    def day_blocks(self) -> DataFrame:
        return sessions.bounded_blocks(sessions.with_times(self.fact_base))

    @cached_property
    def day_sessions(self) -> DataFrame:
        return sessions.bounded_schedule(self.day_blocks)

    @cached_property
    def lab_sessions(self) -> DataFrame:
        # read by the join, the first-week rule and the result, so kept as a table
        return stored(self.day_sessions.where("LooksLikeFourHourSession"), "lab-sessions")

    @cached_property
    def lab_presence(self) -> DataFrame:
        users = slots.course_wifi(self.wifi, self.bridge, self.fact_base)
        return stored(slots.session_presence(self.lab_sessions, users), "lab-presence")

    @cached_property
    def lab_assigned(self) -> DataFrame:
        return slots.assign_slots(slots.user_slot_counts(self.lab_presence, self.lab_sessions))

    @cached_property
    def day_attendance(self) -> DataFrame:
        rows = sessions.session_rows(self.day_rows, self.day_blocks)
        return sessions.session_attendance(rows, self.day_sessions)

    @cached_property
    def lab_attendance(self) -> DataFrame:
        return self.day_attendance.where("LooksLikeFourHourSession")

    @cached_property
    def schedule_export(self) -> DataFrame:
        """Reservations as the strings of a timetable export."""
        o = self.raw("orders")
        l = self.raw("lineitem")
        k = F.col("o_orderkey")
        groups = l.groupBy("l_orderkey").agg(
            distinct_list((F.col("l_suppkey") % 25).cast("string"), "|").alias("Classgroups"),
            distinct_list(F.col("l_suppkey").cast("string"), "|").alias("Rooms"),
        )
        minutes = F.lit(495) + (clock.whole(k, 30) % 5) * 135
        day = F.lpad((1 + k % 30).cast("string"), 2, "0")
        form = F.substring("o_orderpriority", 1, 1)
        stamp = lambda m: F.concat(F.lit("01/"), day, F.lit("/2024 "), clock.hhmm(m * 60), F.lit(":00"))
        return o.join(groups, k == F.col("l_orderkey"), "left").select(
            k.cast("string").alias("Id"),
            stamp(minutes).alias("Start"),
            stamp(minutes + 120).alias("End"),
            F.when(F.col("o_orderstatus") == "P", "Cancelled").when(F.col("o_orderstatus") == "F", "Confirmed").alias("Status"),
            F.when(form == "1", "Practicum").when(form == "2", "Nieuwe werkvorm").alias("WorkFormCourse"),
            F.when(form == "3", "Schriftelijk examen").alias("WorkFormExam"),
            F.lit(None).cast("string").alias("WorkFormEvaluation"),
            F.when(form.isin("2", "4"), "Feedback").alias("EducationActivity"),
            F.when(form == "5", "Zoom").alias("LearningEnvironment"),
            F.lit(None).cast("string").alias("ExamEnvironment"),
            "Classgroups",
            F.concat((F.col("o_custkey") + 190000).cast("string"), F.lit("|1")).alias("OlodPointers"),
            F.col("Rooms"),
        )


def keyed_name():
    return F.concat("ClassName", F.lit("-"), F.col("ClassKey").cast("string"))


def user_name(key: str):
    k = F.col(key)
    return F.concat(F.when(k % 10 == 9, "u_").otherwise("enc_"), k.cast("string"))


def word_in(column: str, words: list[str]):
    out = F.lit(False)
    for word in words:
        out = out | F.col(column).contains(word)
    return out


# --- the same views as SQL -----------------------------------------------------------


def secs(key: str) -> str:
    return f"(({key} // 10000) * 3600 + ({key} // 100 % 100) * 60 + {key} % 100)"


def r9(expr: str) -> str:
    return f"round({expr}, 9)"


def _quoted(values) -> str:
    return ", ".join("NULL" if v is None else str(v).upper() if isinstance(v, bool) else repr(v) for v in values)


_ROUND = "CAST(round_even(epoch_us(ts) / {us}.0, 0) AS BIGINT) * {us}"
_NAME = "CASE WHEN {k} % 10 = 9 THEN 'u_' ELSE 'enc_' END || CAST({k} AS VARCHAR)"
_EVENTS = ", ".join(repr(e) for e in CAMPUS_EVENTS)
_MONTHS = lambda names: "[" + ", ".join(repr(n) for n in names) + "]"

CTES: dict[str, str] = {
    "wifi_feed": f"""SELECT {_NAME.format(k='user_id')} AS username, ts AS timestamp,
        CASE WHEN event_type IN ({_EVENTS}) THEN '{NETWORK}' ELSE event_type END AS ssid FROM events""",
    "dim_user": f"SELECT c_custkey AS UserKey, {_NAME.format(k='c_custkey')} AS UserName FROM customer",
    "bridge": """SELECT c_custkey AS UserKey, CAST(c_nationkey AS BIGINT) AS SubgroupKey FROM customer
        UNION SELECT c_custkey, c_custkey % 7 FROM customer""",
    "fact_wifi": f"""SELECT DISTINCT CAST(strftime(t, '%Y%m%d') AS INTEGER) AS DateKey,
        CAST(strftime(t, '%H%M%S') AS INTEGER) AS TimeKey, user_id AS UserKey
        FROM (SELECT make_timestamp({_ROUND.format(us=60000000)}) AS t, user_id FROM events
              WHERE event_type IN ({_EVENTS}))""",
    "dim_subgroup": """SELECT CAST(n_nationkey AS BIGINT) AS SubgroupKey, n_name AS SubgroupCode,
        r_name AS ProgramName FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_room": """SELECT s_suppkey AS RoomKey, s_name AS RoomName,
        'B.' || CAST(s_suppkey % 5 AS VARCHAR) || '.' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS Code,
        CAST(s_suppkey % 5 AS INTEGER) AS RoomFloor,
        CAST(CASE WHEN s_suppkey % 17 = 0 THEN 0 ELSE 10 + s_suppkey % 40 END AS INTEGER) AS Capacity FROM supplier""",
    "dim_class": """SELECT p_partkey AS ClassKey, p_name AS ClassName, p_partkey + 190000 AS ClassCode,
        CAST(3 + p_size % 4 AS INTEGER) AS ClassCredits, CAST(1 + p_partkey % 3 AS INTEGER) AS ClassProgramStage FROM part""",
    "dim_date": f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
        dayname(d) AS NameDay, {_MONTHS(clock.MONTHS_DUTCH)}[month(d)] AS NameMonthDutch, monthname(d) AS NameMonthEN,
        {_MONTHS(clock.DAYS_DUTCH)}[isodow(d)] AS NameDayDutch, dayname(d) AS NameDayEN,
        'Q' || CAST(quarter(d) AS VARCHAR) AS NameQuarter, CAST(quarter(d) AS INTEGER) AS NumberQuarter,
        CAST(CASE WHEN month(d) IN (9, 10, 11, 12, 1) THEN 1 WHEN month(d) IN (7, 8) THEN 3 ELSE 2 END AS INTEGER) AS NumberSemester,
        CAST(month(d) AS INTEGER) AS Month, CAST(year(d) AS INTEGER) AS Year, CAST(isodow(d) AS INTEGER) AS Weekday,
        CAST(dayofyear(d) AS INTEGER) AS DayOfYear,
        CASE WHEN strftime(d, '%m%d') >= '1221' OR strftime(d, '%m%d') <= '0320' THEN 'Winter'
             WHEN strftime(d, '%m%d') <= '0620' THEN 'Spring' WHEN strftime(d, '%m%d') <= '0922' THEN 'Summer'
             ELSE 'Fall' END AS Season
        FROM (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM events)""",
    "dim_time": """SELECT CAST(m // 60 * 10000 + m % 60 * 100 AS INTEGER) AS TimeKey, CAST(m // 60 AS INTEGER) AS Hour,
        CAST(m % 60 AS INTEGER) AS Minutes, 0 AS Seconds,
        lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00' AS FullTime,
        CASE WHEN m < 720 THEN 'AM' ELSE 'PM' END AS TimeAM_PM FROM range(1440) t(m)""",
    "dim_activity": "SELECT * FROM (VALUES "
    + ", ".join(f"({_quoted(row)})" for row in generators.activity_rows())
    + ") t(ActivityKey, CanonicalActivity, ActivityDomain, ActivityGroup, SourceColumn, SourceValue, "
    + ", ".join(generators.ACTIVITY_FLAGS) + ")",
    "fact_base": """SELECT o_orderkey AS LectureID, CAST(20240101 + o_orderkey % 30 AS INTEGER) AS DateKey,
        CAST(f // 60 * 10000 + f % 60 * 100 AS INTEGER) AS FromTimeKey,
        CAST((f + 120) // 60 * 10000 + (f + 120) % 60 * 100 AS INTEGER) AS UntilTimeKey,
        o_custkey AS ClassKey, SubgroupKey, RoomKey, CAST(left(o_orderpriority, 1) AS INTEGER) * 7 AS ActivityKey
        FROM (SELECT o_orderkey, o_custkey, o_orderpriority, 495 + (o_orderkey // 30) % 5 * 135 AS f,
                     l_suppkey % 25 AS SubgroupKey, min(l_suppkey) AS RoomKey
              FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)""",
    "window_count": f"""SELECT w.SubgroupKey, w.DateKey, w.FromTimeKey, w.UntilTimeKey, count(DISTINCT f.UserKey) AS n
        FROM (SELECT DISTINCT SubgroupKey, DateKey, FromTimeKey, UntilTimeKey FROM fact_base) w
        JOIN bridge b ON b.SubgroupKey = w.SubgroupKey
        JOIN fact_wifi f ON f.UserKey = b.UserKey AND f.DateKey = w.DateKey
          AND {secs('f.TimeKey')} BETWEEN {secs('w.FromTimeKey')} + 900 AND {secs('w.UntilTimeKey')}
        GROUP BY ALL""",
    "roster": """SELECT SubgroupKey, count(DISTINCT b.UserKey) AS TotalStudents FROM bridge b
        JOIN dim_user u ON u.UserKey = b.UserKey WHERE UserName LIKE 'enc\\_%' ESCAPE '\\' GROUP BY SubgroupKey""",
    "fact_lecture": f"""SELECT x.*, CASE WHEN TotalStudents = 0 THEN 0.0 ELSE CAST(UserCount AS DOUBLE) / TotalStudents END AS AttendanceRate,
        CASE WHEN Capacity > 0 THEN CAST(UserCount AS DOUBLE) / Capacity END AS OccupancyRate
        FROM (SELECT b.*, CASE WHEN b.DateKey < 20240125 OR (b.DateKey = 20240125 AND {secs('b.UntilTimeKey')} <= 43200)
                               THEN coalesce(n, 0) END AS UserCount, coalesce(TotalStudents, 0) AS TotalStudents
              FROM fact_base b
              LEFT JOIN window_count w ON w.SubgroupKey = b.SubgroupKey AND w.DateKey = b.DateKey
                AND w.FromTimeKey = b.FromTimeKey AND w.UntilTimeKey = b.UntilTimeKey
              LEFT JOIN roster r ON r.SubgroupKey = b.SubgroupKey) x
        LEFT JOIN dim_room r ON r.RoomKey = x.RoomKey""",
    "facts_wide": """SELECT f.*, d.* EXCLUDE (DateKey), t.Hour AS FromHour, c.* EXCLUDE (ClassKey), s.* EXCLUDE (SubgroupKey),
        a.* EXCLUDE (ActivityKey), r.Code AS RoomCode, r.RoomName, r.Capacity AS RoomCapacity
        FROM fact_lecture f JOIN dim_date d ON d.DateKey = f.DateKey JOIN dim_time t ON t.TimeKey = f.FromTimeKey
        JOIN dim_class c ON c.ClassKey = f.ClassKey JOIN dim_subgroup s ON s.SubgroupKey = f.SubgroupKey
        JOIN dim_activity a ON a.ActivityKey = f.ActivityKey JOIN dim_room r ON r.RoomKey = f.RoomKey
        WHERE AttendanceRate IS NOT NULL""",
    "schedule": f"""SELECT b.*, c.ClassName, s.SubgroupCode, s.ProgramName, strptime(CAST(b.DateKey AS VARCHAR), '%Y%m%d')::DATE AS FullDate,
        {secs('FromTimeKey')} AS StartSecond, {secs('UntilTimeKey')} AS EndSecond
        FROM fact_base b JOIN dim_class c ON c.ClassKey = b.ClassKey JOIN dim_subgroup s ON s.SubgroupKey = b.SubgroupKey""",
    "typed_schedule": f"""SELECT * REPLACE (ClassName || '-' || CAST(ClassKey AS VARCHAR) AS ClassName), ClassName || ' ' || CAST(ClassKey AS VARCHAR) AS NormalizedClassName,
        CASE WHEN {' OR '.join(f"ClassName LIKE '%{w}%'" for w in GROUP_WORDS)} THEN '{course_types.GROUP}'
             WHEN ClassName LIKE '%{UNMATCHED_WORD}%' THEN '{course_types.UNMATCHED}' ELSE '{course_types.REGULAR}' END AS LessonType FROM schedule""",
    # sessions per class and day: gap above 30 minutes to the running end starts a new one
    "course_blocks": """SELECT *, NormalizedClassName || '_' || strftime(FullDate, '%Y%m%d') || '_' || CAST(SessionNumber AS VARCHAR) AS SessionID
        FROM (SELECT *, CAST(sum(opens) OVER (PARTITION BY ClassName, FullDate ORDER BY StartSecond, EndSecond ROWS UNBOUNDED PRECEDING) AS INTEGER) AS SessionNumber
              FROM (SELECT *, CASE WHEN reach IS NULL OR StartSecond - reach > 1800 THEN 1 ELSE 0 END AS opens
                    FROM (SELECT *, max(EndSecond) OVER (PARTITION BY ClassName, FullDate ORDER BY StartSecond, EndSecond
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
                          FROM (SELECT DISTINCT ClassName, NormalizedClassName, LessonType, FullDate, StartSecond, EndSecond
                                FROM typed_schedule WHERE LessonType <> 'Niet gekoppeld'))))""",
    "course_sessions": """SELECT *, dayname(FullDate) || ' ' || strftime(SessionStart, '%H:%M') || '-' || strftime(SessionEnd, '%H:%M') AS SessionSlot
        FROM (SELECT ClassName, NormalizedClassName, LessonType, FullDate, SessionID, min(StartSecond) AS a, max(EndSecond) AS b,
                     count(DISTINCT StartSecond) AS NumberOfTimeBlocks, (max(EndSecond) - min(StartSecond)) / 60.0 AS SessionDurationMinutes,
                     FullDate + to_seconds(min(StartSecond)) AS SessionStart, FullDate + to_seconds(max(EndSecond)) AS SessionEnd
              FROM course_blocks GROUP BY ClassName, NormalizedClassName, LessonType, FullDate, SessionID)""",
    "course_links": """SELECT DISTINCT SessionID, SubgroupKey FROM typed_schedule s
        JOIN course_blocks k ON k.ClassName = s.ClassName AND k.FullDate = s.FullDate AND k.StartSecond = s.StartSecond AND k.EndSecond = s.EndSecond""",
    # users with equal sets of subgroups are a cohort; distinct spans are counted per cohort once, whatever the sessions in them
    "user_cohort": "SELECT UserKey, list(SubgroupKey ORDER BY SubgroupKey) AS Cohort FROM bridge GROUP BY 1",
    "cohort_member": "SELECT Cohort, n, unnest(Cohort) AS SubgroupKey FROM (SELECT Cohort, count(*) AS n FROM user_cohort GROUP BY 1)",
    "session_cohort": "SELECT DISTINCT SessionID, Cohort, n FROM course_links JOIN cohort_member USING (SubgroupKey)",
    "session_users": f"""SELECT FullDate, a, b, Cohort, count(DISTINCT UserKey) AS n FROM (SELECT DISTINCT FullDate, a, b FROM course_sessions) c
        JOIN fact_wifi w ON w.DateKey = CAST(strftime(c.FullDate, '%Y%m%d') AS INTEGER) AND {secs('w.TimeKey')} BETWEEN c.a AND c.b
        JOIN user_cohort USING (UserKey) GROUP BY ALL""",
    "course_results": f"""SELECT s.* EXCLUDE (a, b), coalesce(e.n, 0) AS ExpectedStudents, coalesce(p.n, 0) AS PresentStudents,
        CASE WHEN coalesce(e.n, 0) > 0 THEN coalesce(p.n, 0) / CAST(e.n AS DOUBLE) END AS AttendanceRate
        FROM course_sessions s
        LEFT JOIN (SELECT SessionID, CAST(sum(n) AS BIGINT) AS n FROM session_cohort GROUP BY 1) e ON e.SessionID = s.SessionID
        LEFT JOIN (SELECT t.SessionID, CAST(sum(k.n) AS BIGINT) AS n FROM session_cohort t JOIN course_sessions c ON c.SessionID = t.SessionID
                   JOIN session_users k ON k.FullDate = c.FullDate AND k.a = c.a AND k.b = c.b AND k.Cohort = t.Cohort GROUP BY 1) p ON p.SessionID = s.SessionID""",
    "course_valid": "SELECT * FROM course_results WHERE ExpectedStudents > 0",
    # bounded sessions per day, folded by recursion over the ordered blocks
    "day_blocks": f"""SELECT FullDate, StartSecond, EndSecond, SessionNumber, strftime(FullDate, '%Y%m%d') || '_' || CAST(SessionNumber AS VARCHAR) AS SessionID
        FROM (WITH RECURSIVE b AS (
                SELECT FullDate, s, e, row_number() OVER (PARTITION BY FullDate ORDER BY s, e) AS rn
                FROM (SELECT DISTINCT strptime(CAST(DateKey AS VARCHAR), '%Y%m%d')::DATE AS FullDate, {secs('FromTimeKey')} AS s, {secs('UntilTimeKey')} AS e FROM fact_base)),
              f AS (
                SELECT FullDate, s, e, rn, s AS cs, e AS ce, 1 AS no FROM b WHERE rn = 1
                UNION ALL
                SELECT b.FullDate, b.s, b.e, b.rn,
                  CASE WHEN b.s - f.ce <= 1800 AND greatest(f.ce, b.e) - f.cs <= 18000 THEN f.cs ELSE b.s END,
                  CASE WHEN b.s - f.ce <= 1800 AND greatest(f.ce, b.e) - f.cs <= 18000 THEN greatest(f.ce, b.e) ELSE b.e END,
                  CASE WHEN b.s - f.ce <= 1800 AND greatest(f.ce, b.e) - f.cs <= 18000 THEN f.no ELSE f.no + 1 END
                FROM f JOIN b ON b.FullDate = f.FullDate AND b.rn = f.rn + 1)
              SELECT FullDate, s AS StartSecond, e AS EndSecond, no AS SessionNumber FROM f)""",
    "day_sessions": """SELECT *, SessionDurationMinutes BETWEEN 210 AND 300 AS LooksLikeFourHourSession,
        WeekdayName || ' ' || SessionStartTime || '-' || SessionEndTime AS SessionSlot
        FROM (SELECT FullDate, SessionID, min(StartSecond) AS a, max(EndSecond) AS b, count(*) AS NumberOfTimeBlocks,
                (max(EndSecond) - min(StartSecond)) / 60.0 AS SessionDurationMinutes,
                FullDate + to_seconds(min(StartSecond)) AS SessionStart, FullDate + to_seconds(max(EndSecond)) AS SessionEnd,
                CAST(isodow(FullDate) - 1 AS INTEGER) AS WeekdayNumber, dayname(FullDate) AS WeekdayName,
                strftime(FullDate + to_seconds(min(StartSecond)), '%H:%M') AS SessionStartTime,
                strftime(FullDate + to_seconds(max(EndSecond)), '%H:%M') AS SessionEndTime,
                strftime(FullDate, '%G-W%V') AS YearWeek
              FROM day_blocks GROUP BY FullDate, SessionID)""",
    "lab_sessions": "SELECT * FROM day_sessions WHERE LooksLikeFourHourSession",
    "day_rows": f"""SELECT f.*, s.SubgroupCode, r.Code AS RoomCode, k.SessionID, k.FullDate, k.StartSecond
        FROM fact_lecture f JOIN dim_subgroup s ON s.SubgroupKey = f.SubgroupKey JOIN dim_room r ON r.RoomKey = f.RoomKey
        JOIN day_blocks k ON CAST(strftime(k.FullDate, '%Y%m%d') AS INTEGER) = f.DateKey
          AND k.StartSecond = {secs('f.FromTimeKey')} AND k.EndSecond = {secs('f.UntilTimeKey')}""",
    "day_attendance": """SELECT s.*, p.EstimatedPresentStudents, p.AdministrativeExpectedStudents, p.NumberOfSubgroups, m.NumberOfDistinctRooms, m.Rooms
        FROM (SELECT FullDate, SessionID, CAST(sum(u) AS BIGINT) AS EstimatedPresentStudents, CAST(sum(t) AS BIGINT) AS AdministrativeExpectedStudents, count(*) AS NumberOfSubgroups
              FROM (SELECT FullDate, SessionID, SubgroupCode, max(UserCount) AS u, max(TotalStudents) AS t FROM day_rows GROUP BY ALL) GROUP BY ALL) p
        JOIN day_sessions s ON s.FullDate = p.FullDate AND s.SessionID = p.SessionID
        JOIN (SELECT SessionID, count(DISTINCT RoomCode) AS NumberOfDistinctRooms, string_agg(DISTINCT RoomCode, ', ' ORDER BY RoomCode) AS Rooms FROM day_rows GROUP BY 1) m ON m.SessionID = s.SessionID""",
    "lab_attendance": "SELECT * FROM day_attendance WHERE LooksLikeFourHourSession",
    "lab_expected": """SELECT SessionSlot, max(EstimatedPresentStudents) AS ExpectedStudentsForSlot,
        quantile_cont(CAST(EstimatedPresentStudents AS DOUBLE), 0.95) AS P95StudentsForSlot, count(DISTINCT SessionID) AS NumberOfObservedSessions
        FROM lab_attendance GROUP BY 1""",
    "lab_corrected": """SELECT a.*, e.* EXCLUDE (SessionSlot),
        CASE WHEN e.ExpectedStudentsForSlot > 0 THEN EstimatedPresentStudents / CAST(e.ExpectedStudentsForSlot AS DOUBLE) END AS CorrectedAttendanceRate,
        CASE WHEN AdministrativeExpectedStudents > 0 THEN EstimatedPresentStudents / CAST(AdministrativeExpectedStudents AS DOUBLE) END AS AdministrativeAttendanceRate
        FROM lab_attendance a LEFT JOIN lab_expected e ON e.SessionSlot = a.SessionSlot""",
    "lab_presence": f"""SELECT DISTINCT w.UserKey, s.SessionID, s.FullDate, s.SessionSlot, s.YearWeek
        FROM lab_sessions s JOIN fact_wifi w ON w.DateKey = CAST(strftime(s.FullDate, '%Y%m%d') AS INTEGER)
          AND {secs('w.TimeKey')} BETWEEN s.a AND s.b
        WHERE w.UserKey IN (SELECT UserKey FROM bridge WHERE SubgroupKey IN (SELECT SubgroupKey FROM fact_base))""",
    "lab_counts": """SELECT UserKey, SessionSlot, count(DISTINCT SessionID) AS SessionsObserved, min(FullDate) AS FirstSeen, max(FullDate) AS LastSeen
        FROM lab_presence WHERE YearWeek <> (SELECT min(YearWeek) FROM lab_sessions) GROUP BY ALL""",
    "lab_assigned": """SELECT UserKey,
        CASE WHEN total < 2 THEN 'Unassigned' WHEN winners = 1 THEN slot ELSE 'Unassigned' END AS AssignedSessionSlot,
        CASE WHEN total < 2 THEN 'Too few observations' WHEN winners = 1 THEN 'Unique maximum' ELSE 'Tie' END AS AssignmentReason,
        total AS TotalObservedSessions, best AS BestSlotObservations, coalesce(second, 0) AS SecondBestSlotObservations,
        (best - coalesce(second, 0)) / CAST(best AS DOUBLE) AS AssignmentConfidence
        FROM (SELECT UserKey, CAST(sum(SessionsObserved) AS BIGINT) AS total, max(SessionsObserved) AS best,
                count(*) FILTER (SessionsObserved = m) AS winners, min(SessionSlot) FILTER (SessionsObserved = m) AS slot,
                max(SessionsObserved) FILTER (rn = 2) AS second
              FROM (SELECT *, max(SessionsObserved) OVER (PARTITION BY UserKey) AS m,
                      row_number() OVER (PARTITION BY UserKey ORDER BY SessionsObserved DESC) AS rn FROM lab_counts) GROUP BY 1)""",
    "lab_results": """SELECT s.SessionID, s.FullDate, s.SessionSlot, s.SessionStart, s.SessionEnd, s.YearWeek,
        coalesce(e.n, 0) AS ExpectedStudents, coalesce(p.n, 0) AS PresentAssignedStudents,
        CASE WHEN coalesce(e.n, 0) > 0 THEN coalesce(p.n, 0) / CAST(e.n AS DOUBLE) END AS AttendanceRate
        FROM lab_sessions s
        LEFT JOIN (SELECT AssignedSessionSlot AS slot, count(*) AS n FROM lab_assigned GROUP BY 1) e ON e.slot = s.SessionSlot
        LEFT JOIN (SELECT p.SessionID, count(DISTINCT p.UserKey) AS n FROM lab_presence p
                   JOIN lab_assigned a ON a.UserKey = p.UserKey AND a.AssignedSessionSlot = p.SessionSlot GROUP BY 1) p ON p.SessionID = s.SessionID""",
    "schedule_export": f"""SELECT CAST(o_orderkey AS VARCHAR) AS Id,
        '01/' || lpad(CAST(1 + o_orderkey % 30 AS VARCHAR), 2, '0') || '/2024 ' || lpad(CAST(f // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(f % 60 AS VARCHAR), 2, '0') || ':00' AS "Start",
        '01/' || lpad(CAST(1 + o_orderkey % 30 AS VARCHAR), 2, '0') || '/2024 ' || lpad(CAST((f + 120) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((f + 120) % 60 AS VARCHAR), 2, '0') || ':00' AS "End",
        CASE o_orderstatus WHEN 'P' THEN 'Cancelled' WHEN 'F' THEN 'Confirmed' END AS Status,
        CASE p WHEN '1' THEN 'Practicum' WHEN '2' THEN 'Nieuwe werkvorm' END AS WorkFormCourse,
        CASE p WHEN '3' THEN 'Schriftelijk examen' END AS WorkFormExam, CAST(NULL AS VARCHAR) AS WorkFormEvaluation,
        CASE WHEN p IN ('2', '4') THEN 'Feedback' END AS EducationActivity, CASE p WHEN '5' THEN 'Zoom' END AS LearningEnvironment,
        CAST(NULL AS VARCHAR) AS ExamEnvironment, Classgroups, CAST(o_custkey + 190000 AS VARCHAR) || '|1' AS OlodPointers, Rooms
        FROM (SELECT *, 495 + (o_orderkey // 30) % 5 * 135 AS f, left(o_orderpriority, 1) AS p FROM orders)
        LEFT JOIN (SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey % 25 AS VARCHAR), '|' ORDER BY CAST(l_suppkey % 25 AS VARCHAR)) AS Classgroups,
                          string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), '|' ORDER BY CAST(l_suppkey AS VARCHAR)) AS Rooms
                   FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
}


def with_views(body: str) -> str:
    """The query with the views it names, and theirs, as common table expressions."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                needed[name] = None

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in needed)
    rest = body.strip()
    if rest.upper().startswith("WITH "):
        return f"WITH {parts},\n{rest[5:]}"
    return f"WITH {parts}\n{rest}"
