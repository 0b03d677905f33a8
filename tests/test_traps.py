"""Small hand-made frames, one per rule that is easy to get wrong."""

import datetime as dt
import re
import sys
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.functions import clock, maths, text
from rollcall.operators import columns, joins, tables, windows
from rollcall.operators.aggregates import histogram, weekly_mean
from rollcall.plans import course_types, courses, lectures, loads, presence, programs, slots
from rollcall.sources import generators
from tests.conftest import rows

NOON = "2025-11-24 12:00:00"


def lecture(lecture_id, day, start, end, subgroup=1):
    return (lecture_id, day, start, end, 10, subgroup, 5, 1)


LECTURE = "LectureID bigint, DateKey int, FromTimeKey int, UntilTimeKey int, ClassKey bigint, SubgroupKey bigint, RoomKey bigint, ActivityKey int"


def attendance(spark, facts, wifi, bridge, users, now=NOON):
    subgroups = spark.createDataFrame([(1, "A", "P"), (2, "B", "P"), (3, "C", "P")], schemas.DIM_SUBGROUP)
    return presence.refresh_attendance(
        spark.createDataFrame(facts, LECTURE), spark.createDataFrame(wifi, schemas.FACT_WIFI),
        spark.createDataFrame(bridge, schemas.BRIDGE), spark.createDataFrame(users, schemas.DIM_USER), subgroups,
        F.lit(now).cast("timestamp_ntz"),
    )


def test_grace_and_both_ends_of_the_window(spark):
    day = 20251124
    wifi = [(day, 82900, 1), (day, 83000, 2), (day, 101500, 3), (day, 101600, 4), (day, 90000, 9)]
    bridge = [(u, 1) for u in (1, 2, 3, 4)]
    users = [(u, f"enc_{u}") for u in (1, 2, 3, 4, 9)]
    out = attendance(spark, [lecture(1, day, 81500, 101500)], wifi, bridge, users).first()
    # 08:29 is inside the grace, 10:16 after the end, user 9 is in no subgroup
    assert (out.UserCount, out.TotalStudents) == (2, 4)


def test_user_in_two_subgroups_counts_in_both(spark):
    facts = [lecture(1, 20251124, 81500, 101500, 1), lecture(1, 20251124, 81500, 101500, 2)]
    out = attendance(spark, facts, [(20251124, 90000, 1)], [(1, 1), (1, 2)], [(1, "enc_1")])
    assert [r.UserCount for r in out.collect()] == [1, 1]


def test_older_scheme_is_present_but_not_on_the_roster(spark):
    out = attendance(
        spark, [lecture(1, 20251124, 81500, 101500)], [(20251124, 90000, 1), (20251124, 90000, 2)],
        [(1, 1), (2, 1)], [(1, "enc_1"), (2, "u_2")],
    ).first()
    assert (out.UserCount, out.TotalStudents, out.AttendanceRate) == (2, 1, 2.0)


def test_count_is_null_until_the_lecture_is_over(spark):
    facts = [
        lecture(1, 20251123, 130000, 140000), lecture(2, 20251124, 100000, 120000),
        lecture(3, 20251124, 110000, 120100), lecture(4, 20251125, 80000, 90000),
    ]
    out = attendance(spark, facts, [], [(1, 1)], [(1, "enc_1")])
    assert {r.LectureID: r.UserCount for r in out.collect()} == {1: 0, 2: 0, 3: None, 4: None}


def test_rates_of_empty_rosters_and_rooms(spark):
    df = spark.createDataFrame([(5, 0), (None, 10), (12, 10)], "u int, t int")
    out = [r[0] for r in df.select(maths.attendance_rate("u", "t")).collect()]
    assert out == [0.0, None, 1.2]
    capped = [r[0] for r in df.select(maths.cap_at_one(maths.ratio("u", "t"))).collect()]
    assert capped == [None, None, 1.0]


def test_occupancy_keeps_rows_without_room(spark):
    facts = spark.createDataFrame([(1, 5, 10), (2, 6, 10), (3, 9, 10)], "LectureID int, RoomKey bigint, UserCount bigint")
    rooms = spark.createDataFrame([(5, 20), (6, 0)], "RoomKey bigint, Capacity int")
    out = {r.LectureID: r.OccupancyRate for r in presence.refresh_occupancy(facts, rooms).collect()}
    assert out == {1: 0.5, 2: None, 3: None}


@pytest.mark.parametrize("at, step, date, time", [
    ("2025-11-24 08:02:30", 300, 20251124, 80000),   # tie to the even step
    ("2025-11-24 08:07:30", 300, 20251124, 81000),
    ("2025-11-24 23:58:00", 300, 20251125, 0),
    ("2025-11-24 08:00:30", 60, 20251124, 80000),
    ("2025-11-24 08:01:30", 60, 20251124, 80200),
    ("2025-12-31 23:59:30.000001", 60, 20260101, 0),
    ("1969-12-31 23:59:30", 60, 19700101, 0),
])
def test_rounding_ties_and_midnight(spark, at, step, date, time):
    df = spark.createDataFrame([(at,)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    day, key = clock.rounded_keys("t", step)
    assert tuple(df.select(day, key).first()) == (date, time)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Brussels"])
def test_keys_do_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([("2025-10-26 02:30:10",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        day, key = clock.rounded_keys("t", 60)
        assert tuple(df.select(day, key).first()) == (20251026, 23000)
        local = df.select(clock.local_time(F.lit("2025-07-01 10:00:00").cast("timestamp_ntz")).cast("string")).first()[0]
        assert local == "2025-07-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_both_sides_of_the_clock_change_are_half_past_two(spark):
    df = spark.createDataFrame([("2025-10-26 00:30:00",), ("2025-10-26 01:30:00",)], "s string")
    out = df.select(clock.local_time(F.col("s").cast("timestamp_ntz")).cast("string")).collect()
    assert [r[0] for r in out] == ["2025-10-26 02:30:00"] * 2


def test_time_keys_round_trip(spark):
    df = spark.range(86400).select(F.col("id").cast("int").alias("s"))
    assert df.where(clock.key_seconds(clock.seconds_key("s")) != F.col("s")).count() == 0
    assert df.where(clock.seconds_key("s") == 235959).first().s == 86399


def test_dates_of_exports(spark):
    df = spark.createDataFrame([("07/28/2025 07:38:54",), ("2025-07-28 07:38:54",), ("niets",), (None,)], "s string")
    out = [r[0] for r in df.select(clock.parse_datetime("s")).collect()]
    same = dt.datetime(2025, 7, 28, 7, 38, 54)
    assert out == [same, same, None, None]


@pytest.mark.parametrize("cell, parts", [
    (None, [None]), ("", [None]), ("a", ["a"]), ("a|b", ["a", "b"]), ("a||b", ["a", "b"]), (" a | b ", ["a", "b"]), ("|", [None]),
])
def test_cells_with_several_values(spark, cell, parts):
    df = spark.createDataFrame([(cell,)], "c string")
    kept = [r.x for r in text.explode_items(df, "c", "x").collect()]
    dropped = [r.x for r in text.explode_items(df, "c", "x", keep_empty=False).collect()]
    assert kept == parts
    assert dropped == [p for p in parts if p is not None]


def test_ids_in_every_spelling(spark):
    df = spark.createDataFrame([("5717692",), ("5717692.0",), (" 5717692 ",), ("nan",), (None,)], "c string")
    out = [r[0] for r in df.select(text.clean_identifier("c")).collect()]
    assert out == ["5717692", "5717692", "5717692", None, None]
    numbers = [r.c for r in columns.to_number(df, ["c"]).collect()]
    assert numbers == [5717692, 5717692, 5717692, None, None]


def test_unknown_status_is_kept(spark):
    df = spark.createDataFrame([("Confirmed",), ("cancelled",), ("Cancelled",), (None,)], "Status string")
    assert [r[0] for r in df.where(lectures.not_cancelled()).collect()] == ["Confirmed", None]


def test_exports_with_and_without_cancelled(spark):
    cols = ["Id", "Start", "End", "Status", "OlodPointers", "Rooms", "Classgroups"]
    data = [("1", "07/28/2025 08:15:00", "07/28/2025 10:15:00", s, "7|8", "R1|R2", "11|12") for s in ("Confirmed", "Cancelled")]
    exports = spark.createDataFrame(data, cols)
    classes = spark.createDataFrame([(1, 7)], "ClassKey bigint, ClassCode bigint")
    rooms = spark.createDataFrame([(4, "R1")], "RoomKey bigint, Code string")
    seed = generators.dim_activity(spark)
    out = lectures.format_lectures(exports, classes, rooms, seed)
    assert rows(out.select("SubgroupKey", "ClassKey", "RoomKey", "ActivityKey")) == [(1, 1, 4, "11"), (1, 1, 4, "12")]
    assert lectures.format_lectures(exports, classes, rooms, seed, drop_cancelled=False).count() == 2
    patched = lectures.format_lectures(exports, classes, rooms, seed, patches=[("1", "OlodPointers", "99")])
    assert lectures.split_by_keys(patched)[1].count() == 2


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Rooms, Classgroups"):
        lectures.clean_schedule(spark.createDataFrame([], "Id string, Start string, End string, OlodPointers string"))


def test_unknown_activity_falls_through_to_the_next_column(spark):
    table = generators.dim_activity(spark)
    data = [("Onbekend", None, "Feedback"), (None, " Presentatie ", None), ("x", "y", "z")]
    df = spark.createDataFrame(data, "WorkFormCourse string, WorkFormExam string, EducationActivity string")
    out = joins.first_filled_lookup(df, table, df.columns, "ActivityKey", F.lit(1), "k")
    assert sorted(r.k for r in out.collect()) == [1, 17, 29]


def test_reload_clears_counts_and_keeps_the_last_row(spark):
    target = spark.createDataFrame([(1, 20250101, 80000, 90000, 1, 1, 1, 1, 30, 40)], LECTURE + ", UserCount bigint, TotalStudents bigint")
    formatted = spark.createDataFrame(
        [("1.0", 20250101, 80000, 90000, 2, "1", 1, 1, None, None, None), ("1", 20250102, 80000, 90000, 3, "1", 1, 1, None, None, None),
         ("2", 20250102, 80000, 90000, 3, "99", 1, 1, None, None, None), ("3", None, 80000, 90000, 3, "1", 1, 1, None, None, None)],
        "LectureId string, DateKey int, FromTimeKey int, UntilTimeKey int, ClassKey bigint, SubgroupKey string, RoomKey bigint,"
        " ActivityKey int, UserCount bigint, TotalStudents bigint, AttendanceRate double",
    )
    subgroups = spark.createDataFrame([(1, "A", "P")], schemas.DIM_SUBGROUP)
    out = lectures.load_fact(target, formatted, subgroups, ["DateKey"]).collect()
    assert [(r.LectureID, r.DateKey, r.ClassKey, r.UserCount) for r in out] == [(1, 20250102, 3, None)]


def test_sessions_stop_at_their_maximum_length(spark):
    blocks = [(1, 495, 615), (1, 630, 750), (1, 795, 915), (1, 930, 1065)]
    df = spark.createDataFrame(blocks, "d int, s int, e int")
    out = windows.bounded_sessions(df, ["d"], "s", "e", 30, 300)
    assert [r.SessionNumber for r in out.orderBy("s").collect()] == [1, 1, 2, 2]
    three = spark.createDataFrame([(1, 495, 615), (1, 630, 750), (1, 765, 885)], "d int, s int, e int")
    assert [r.SessionNumber for r in windows.bounded_sessions(three, ["d"], "s", "e", 30, 300).orderBy("s").collect()] == [1, 1, 2]
    assert [r.SessionNumber for r in windows.island_sessions(three, ["d"], "s", "e", 30).orderBy("s").collect()] == [1, 1, 1]


def test_votes_need_three_lectures_four_fifths_and_one_winner(spark):
    groups = spark.createDataFrame(
        [(1, "1", "PBA-TIN/1A"), (2, "2", "PBA-SO/2B"), (3, "3", "nan"), (4, "4", None), (5, "5", "None"), (6, "6", "")],
        "SubgroupKey bigint, SubgroupCode string, ProgramName string",
    )
    lessons = [("a", "1|3"), ("b", "1|3|3"), ("c", "1|3"), ("d", "1|4"), ("e", "1|4"), ("f", "1|5"), ("g", "1|5"), ("h", "1|5"),
               ("i", "2|5"), ("j", "2|5"), ("k", "6")]
    schedule = spark.createDataFrame(lessons, "Id string, Classgroups string")
    out = {r.SubgroupCode: (r.ProgramName, r.ProgramNameSource, r.InferenceConfidence) for r in programs.infer_programs(groups, schedule).collect()}
    assert out["3"] == ("PBA-TIN/1A", "lecture_subgroup_cooccurrence", 1.0)
    assert out["4"] == (None, None, None)      # two lectures only
    assert out["5"] == (None, None, None)      # 3 of 5
    assert out["6"] == (None, None, None)
    assert out["1"] == ("PBA-TIN/1A", "students", None)


def test_program_order_hides_the_longer_prefix(spark):
    df = spark.createDataFrame([("PBA-TIN/1A",), ("PBA-SOLO/2",), ("ic it",), (None,), ("x",)], "p string")
    out = [tuple(r) for r in df.select(text.study_program("p"), text.study_program("p", longest_first=True)).collect()]
    assert out == [
        ("Toegepaste Informatica",) * 2, ("Sociaal Werk", "Secundair Onderwijs"), ("Toegepaste Informatica",) * 2, (None, None), (None, None),
    ]


def test_attribute_keys_must_be_unique(spark):
    twice = spark.createDataFrame([(1, "1", "a", None), (1, "2", "b", None)], "SubgroupKey int, SubgroupCode string, ProgramName string, ProgramFamily string")
    with pytest.raises(PySparkException, match="not unique"):
        programs.program_attributes(twice).collect()


def test_reference_conflicts_stop_the_comparison(spark):
    generated = spark.createDataFrame([("1", None, None)], "SubgroupCode string, ProgramName string, ProgramNameSource string")
    bad = spark.createDataFrame([("1", "A"), ("1", "B")], "SUBGROEPID string, SUBGROEPCODE string")
    assert programs.reference_conflicts(programs.reference_programs(bad)).count() == 2
    with pytest.raises(PySparkException, match="not unique"):
        programs.reconcile(generated, bad).collect()
    good = spark.createDataFrame([("1", "A"), ("1.0", " A ")], "SUBGROEPID string, SUBGROEPCODE string")
    filled = programs.fill_from_reference(programs.reconcile(generated, good)).first()
    assert (filled.ProgramName, filled.ProgramNameSource) == ("A", "cleaned_unique_subgroups")


def test_titles_in_both_sets_stop_the_job(spark):
    one = spark.createDataFrame([("Statistiek",)], "NormalizedClassName string")
    with pytest.raises(PySparkException, match="title in both sets"):
        course_types.check_disjoint(one, one).collect()


def test_titles_match_without_accents_and_signs(spark):
    df = spark.createDataFrame([("Économie & Gestión—2",), ("  ﬁnancieel  ",), (None,)], "t string")
    assert [r[0] for r in df.select(text.normalise_title("t")).collect()] == ["economie gestion 2", "financieel", ""]


def test_titles_of_every_character_fold_without_python(spark):
    """Each character between letters, and whole blocks of them, as Python's decomposition of the text has it."""
    def folded(t):
        plain = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        return re.sub("[^a-z0-9]+", " ", plain.lower()).strip()

    every = [chr(i) for i in (*range(0xD800), *range(0xE000, sys.maxunicode + 1))]
    texts = ["".join(f"a{c}B" for c in every[i:i + 400]) for i in range(0, len(every), 400)] + ["".join(every[i:i + 700]) for i in range(0, len(every), 700)]
    out = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.normalise_title("t").alias("t"))
    assert "Python" not in out._jdf.queryExecution().toString()
    assert {r.i: r.t for r in out.collect()} == {i: folded(t) for i, t in enumerate(texts)}


def test_group_project_rules_in_order(spark):
    def literal(form):
        return f"[[{{'moment': 'x', 'format': '{form}', 'percentage': '1'}}]]"

    data = [
        ("Project X", literal("Schriftelijk examen")), ("Project X", literal("Mondeling  examen")), ("Groot project", literal("Verslag")),
        ("Projecten", literal("Verslag")), ("Lab", literal("Observatie van functioneren van de student tijdens")), ("Lab", None),
        ("Lab", "kapot 'format': 'Schriftelijk examen' }"),
    ]
    out = [r.classification_reason for r in courses.classify_courses(spark.createDataFrame(data, "title string, evaluation_methods string")).collect()]
    assert out == [
        courses.REASON_WRITTEN, courses.REASON_ORAL, courses.REASON_PROJECT, courses.REASON_NONE, courses.REASON_OBSERVATION,
        courses.REASON_NONE, courses.REASON_WRITTEN,
    ]


def test_no_it_course_stops_the_purge(spark):
    df = spark.createDataFrame([("['Bachelor verpleegkunde']", "1")], "faculties string, code string")
    with pytest.raises(ValueError, match="no IT courses"):
        courses.it_codes(df)


def test_slot_assignment_rules(spark):
    day = dt.date
    data = [
        (1, "Mon", 1, day(2026, 2, 9), day(2026, 2, 9)),
        (2, "Mon", 3, day(2026, 2, 9), day(2026, 3, 2)), (2, "Tue", 1, day(2026, 2, 10), day(2026, 2, 10)),
        (3, "Mon", 2, day(2026, 2, 9), day(2026, 2, 16)), (3, "Tue", 2, day(2026, 2, 10), day(2026, 2, 17)),
    ]
    counts = spark.createDataFrame(data, "UserKey int, SessionSlot string, SessionsObserved bigint, FirstSeen date, LastSeen date")
    out = {r.UserKey: (r.AssignedSessionSlot, r.AssignmentReason, r.AssignmentConfidence) for r in slots.assign_slots(counts).collect()}
    assert out[1][:2] == ("Unassigned", "Too few observations")
    assert out[2][:2] == ("Mon", "Unique maximum") and out[2][2] == pytest.approx(2 / 3)
    assert out[3] == ("Unassigned", "Tie", 0.0)
    latest = {r.UserKey: r.AssignedSessionSlot for r in slots.assign_slots(counts, tie="latest").collect()}
    assert latest[3] == "Tue"


def test_guarded_delete(spark):
    classes = spark.createDataFrame([(1, 11, "a"), (2, 12, "b")], "ClassKey int, ClassCode int, ClassName string")
    keep = spark.createDataFrame([(" 11 ",)], "ClassCode string")
    used = spark.createDataFrame([(2,)], "ClassKey int")
    blocked = tables.guarded_delete(classes, keep, "ClassCode", "ClassKey", used)
    assert blocked["result"].count() == 2 and blocked["report"].first().Deleted == 0
    assert blocked["summary"].first().LectureCount == 1
    free = tables.guarded_delete(classes, keep, "ClassCode", "ClassKey", used.where("ClassKey = 1"))
    assert [r.ClassKey for r in free["result"].collect()] == [1] and free["report"].first().Deleted == 1


def test_validated_join_fails_on_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    with pytest.raises(PySparkException, match="not unique"):
        joins.validated_join(left, left.withColumnRenamed("x", "y"), ["k"]).collect()
    single = spark.createDataFrame([(1, "c")], "k int, y string")
    assert joins.validated_join(left, single, ["k"]).count() == 2


def test_histogram_keeps_the_top_edge_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    assert rows(histogram(df, "x", 10).select("Bin", "Rows")) == [(i, 2 if i == 9 else 1) for i in range(10)]
    assert rows(histogram(df.where("x = 1"), "x", 10).select("Bin", "Rows")) == [(0, 1)]


def test_weekly_mean_shows_empty_weeks(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 2), 1.0), (dt.date(2026, 2, 8), 0.0), (dt.date(2026, 2, 20), 0.5)], "d date, r double")
    out = {r.WeekEnd: r.Mean for r in weekly_mean(df, "d", "r").collect()}
    assert out == {dt.date(2026, 2, 8): 0.5, dt.date(2026, 2, 15): None, dt.date(2026, 2, 22): 0.5}


def test_seasons_and_semesters(spark):
    days = ["2025-03-20", "2025-03-21", "2025-06-20", "2025-06-21", "2025-09-22", "2025-09-23", "2025-12-20", "2025-12-21", "2025-08-01"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(F.col("s").cast("date").alias("d"))
    assert [r[0] for r in df.select(clock.season("d")).collect()] == [
        "Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall", "Winter", "Summer"
    ]
    assert [r[0] for r in df.select(clock.semester("d")).collect()] == [2, 2, 2, 2, 1, 1, 1, 1, 3]


def test_dimensions(spark):
    assert generators.dim_time(spark).count() == 1440
    assert generators.calendar_between(spark, "2025-01-01", "2026-12-31").count() == 730
    seed = generators.dim_activity(spark)
    assert seed.count() == 37 and seed.where("IsCourse").count() == 11 and seed.where("IsMakeUp").count() == 4


def test_new_users_continue_the_keys(spark):
    users = spark.createDataFrame([(7, "enc_a")], schemas.DIM_USER)
    names = spark.createDataFrame([("enc_c",), ("enc_a",), ("enc_b",), ("enc_b",)], "UserName string")
    assert rows(loads.add_users(names, users)) == [(7, "enc_a"), (8, "enc_b"), (9, "enc_c")]
    assert rows(loads.add_users(names, spark.createDataFrame([], schemas.DIM_USER))) == [(1, "enc_a"), (2, "enc_b"), (3, "enc_c")]
