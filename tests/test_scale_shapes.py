"""Operators against brute force on random and on skewed data: one key holds a third."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rollcall.operators import joins, windows
from rollcall.operators.aggregates import describe, session_metrics
from rollcall.operators.dedupe import duplicate_rows, keep_one, with_group_size
from rollcall.plans import course_types, presence, programs
from tests.conftest import rows

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(n, keys, seed=1):
    r = random.Random(seed)
    return [0 if i % 3 == 0 else r.randrange(keys) for i in range(n)]


def fold(blocks, gap, length):
    """Reference for bounded sessions."""
    out, number, start, end = {}, 0, None, None
    for s, e in sorted(blocks):
        if start is not None and s - end <= gap and max(end, e) - start <= length:
            end = max(end, e)
        else:
            number, start, end = number + 1, s, e
        out[(s, e)] = number
    return out


@QUICK
@given(st.sets(st.tuples(st.integers(0, 1000), st.integers(1, 200)).map(lambda t: (t[0], t[0] + t[1])), min_size=1, max_size=40))
def test_bounded_sessions_equal_a_loop(spark, blocks):
    df = spark.createDataFrame([(1, s, e) for s, e in blocks], "d int, s int, e int")
    out = {(r.s, r.e): r.SessionNumber for r in windows.bounded_sessions(df, ["d"], "s", "e", 30, 300).collect()}
    assert out == fold(blocks, 30, 300)


def test_lagged_mean_equals_pandas_on_a_hot_group(spark):
    r = random.Random(3)
    g = skewed(3000, 6)
    data = [(g[i], r.randrange(40), i, r.choice([None, *range(10)])) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, c int, i int, v int").withColumn("v", F.col("v").cast("double"))
    pdf = pd.DataFrame(data, columns=["g", "c", "i", "v"]).sort_values(["c", "i"])
    for n, ranges in ((1, 7), (5, 1), (5, 7), (5, 200), (10, 200)):
        want = pdf.groupby("g")["v"].transform(lambda x: x.shift().rolling(n, min_periods=1).mean())
        want = {i: None if pd.isna(w) else round(w, 9) for i, w in zip(pdf["i"], want)}
        out = windows.lagged_mean(windows.in_ranges(df, ["c", "i"], ranges=ranges), ["g"], ["c", "i"], "v", n, "m")
        got = {x.i: None if x.m is None else round(x.m, 9) for x in out.collect()}
        assert got == want


def test_interval_join_equals_all_pairs(spark):
    r = random.Random(5)
    points = [(k, r.randrange(86400)) for k in skewed(600, 5)]
    spans = [(i, r.randrange(5), s, s + r.randrange(-60, 9000)) for i, s in enumerate(r.randrange(86400) for _ in range(120))]
    p = spark.createDataFrame(points, "k int, t int")
    q = spark.createDataFrame(spans, "id int, k int, a int, b int")
    out = sorted((x.id, x.t) for x in joins.interval_join(p, q, ["k"], "t", "a", "b").collect())
    want = sorted((i, t) for k, t in points for i, k2, a, b in spans if k == k2 and a <= t <= b)
    assert out == want


def test_interval_join_has_no_nested_loop(spark):
    p = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").cast("int").alias("t"))
    q = p.select("k", F.col("t").alias("a"), (F.col("t") + 5).alias("b"))
    plan = joins.interval_join(p, q, ["k"], "t", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_numbering_in_ranges_equals_one_window(spark):
    names = [f"enc_{random.Random(i).random():.12f}" for i in range(2000)]
    df = spark.createDataFrame([(n,) for n in set(names)], "name string")
    for ranges in (1, 7, 200):
        cut = {r.name: r.k for r in windows.number_rows(df, "name", "k", start=101, ranges=ranges).collect()}
        assert cut == {n: i + 101 for i, n in enumerate(sorted(set(names)))}


def test_two_sessions_with_one_id_fail(spark):
    """Titles that differ only in what normalising removes stop the query."""
    sessions = spark.createDataFrame(
        [("web project_20251124_1", name, 36000, 43200, [s]) for name, s in (("Web-Project", 1), ("Web Project", 2))],
        "SessionID string, ClassName string, SessionStartSecond int, SessionEndSecond int, _set array<bigint>",
    ).withColumn("FullDate", F.lit("2025-11-24").cast("date"))
    bridge = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "UserKey bigint, SubgroupKey bigint")
    wifi = spark.createDataFrame([(20251124, 110000, u) for u in (1, 2, 3)], "DateKey int, TimeKey int, UserKey bigint")
    with pytest.raises(Exception, match="not unique"):
        course_types.rate_sessions(sessions, wifi, bridge).collect()
    rated = course_types.rate_sessions(sessions.withColumn("SessionID", F.col("ClassName")), wifi, bridge).collect()
    assert {r.ClassName: (r.ExpectedStudents, r.PresentStudents) for r in rated} == {"Web-Project": (1, 1), "Web Project": (2, 2)}


def test_present_by_set_equals_pairs(spark):
    """Lectures with random times and sets: users through cohorts equal users counted one by one."""
    r = random.Random(17)
    bridge_rows = sorted({(u, r.randrange(9)) for u in range(80) for _ in range(2)})
    wifi_rows = sorted({(20251124 + r.randrange(2), r.randrange(8, 18) * 10000 + r.randrange(60) * 100, r.randrange(90)) for _ in range(900)})
    sets = [(i, 20251124 + r.randrange(2), s, s + r.randrange(600, 9000), sorted({r.randrange(9) for _ in range(r.randrange(1, 5))}))
            for i, s in enumerate(r.choices(range(28000, 60000, 900), k=60))]
    spans = spark.createDataFrame(sets, "id int, DateKey int, StartSecond int, EndSecond int, _set array<bigint>").withColumn("_sig", presence.signature("_set"))
    out = presence.present_by_set(
        spans, spark.createDataFrame(wifi_rows, "DateKey int, TimeKey int, UserKey bigint"), spark.createDataFrame(bridge_rows, "UserKey bigint, SubgroupKey bigint"), "n"
    )
    got = {x.id: x.n for x in spans.join(out, ["DateKey", "StartSecond", "EndSecond", "_sig"], "left").collect()}
    second = lambda t: t // 10000 * 3600 + t // 100 % 100 * 60
    for i, day, a, b, own in sets:
        users = {u for u, s in bridge_rows if s in own}
        assert (got[i] or 0) == len({u for d, t, u in wifi_rows if d == day and a <= second(t) <= b and u in users})


def test_one_row_per_key_on_a_hot_key(spark):
    data = [(k, i % 97, i) for i, k in enumerate(skewed(2000, 20))]
    df = spark.createDataFrame(data, "k int, o int, i int")
    pdf = pd.DataFrame(data, columns=["k", "o", "i"]).sort_values(["o", "i"])
    first = pdf.drop_duplicates("k", keep="first")
    last = pdf.drop_duplicates("k", keep="last")
    assert rows(keep_one(df, ["k"], ["o"])) == rows_of(first)
    assert rows(keep_one(df, ["k"], ["o"], last=True)) == rows_of(last)


def rows_of(pdf):
    return sorted((tuple(int(x) for x in r) for r in pdf[["i", "k", "o"]].itertuples(index=False)), key=lambda r: tuple(str(x) for x in r))


def test_group_sizes_keep_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, x string")
    assert {r.x: r.n for r in with_group_size(df, ["k"], "n").collect()} == {"a": 2, "b": 2, "c": 2, "d": 2, "e": 1}
    assert sorted(r.x for r in duplicate_rows(df, ["k"]).collect()) == ["a", "b", "c", "d"]


def test_expected_users_equal_a_distinct_count(spark):
    r = random.Random(9)
    bridge = {(u, r.randrange(8)) for u in range(200) for _ in range(3)} | {(u, 0) for u in range(70)}
    links = {(i, r.randrange(10)) for i in range(60) for _ in range(4)}
    out = presence.expected_users(
        spark.createDataFrame(list(links), "LectureID bigint, SubgroupKey bigint"), "LectureID",
        spark.createDataFrame(list(bridge), "UserKey bigint, SubgroupKey bigint"), "n",
    )
    want = {i: len({u for u, s in bridge if (i, s) in links}) for i, _ in links}
    assert {r.LectureID: r.n for r in out.collect()} == {i: n for i, n in want.items() if n}


def test_votes_equal_all_pairs(spark):
    r = random.Random(11)
    links = {(i, str(r.randrange(12))) for i in range(300) for _ in range(r.randrange(1, 5))}
    known = {str(s): f"P{s % 3}" for s in range(6)}
    out = programs.votes(
        spark.createDataFrame([(str(i), s) for i, s in links], "Id string, SubgroupCode string"),
        spark.createDataFrame(list(known.items()), "SubgroupCode string, ProgramName string"),
        spark.createDataFrame([(str(s),) for s in range(6, 12)], "SubgroupCode string"), "ProgramName",
    )
    want = {}
    for s in map(str, range(6, 12)):
        for i in {i for i, x in links if x == s}:
            for p in {known[x] for j, x in links if j == i and x in known}:
                want[s, p] = want.get((s, p), 0) + 1
    assert {(r.SubgroupCode, r.ProgramName): r.EvidenceCount for r in out.collect()} == want


def test_present_never_exceeds_expected(spark):
    r = random.Random(13)
    sessions = spark.createDataFrame(
        [(f"s{i}", 20251124, r.randrange(30000, 60000), [int(x) for x in sorted({r.randrange(6) for _ in range(3)})]) for i in range(40)],
        "SessionID string, DateKey int, SessionStartSecond int, _set array<bigint>",
    ).withColumn("SessionEndSecond", F.col("SessionStartSecond") + 7200).withColumn("FullDate", F.lit("2025-11-24").cast("date"))
    bridge = spark.createDataFrame([(u, (u + d) % 6) for u in range(90) for d in (0, 1)], "UserKey bigint, SubgroupKey bigint")
    wifi = spark.createDataFrame(
        [(20251124, r.randrange(8, 18) * 10000 + r.randrange(60) * 100, r.randrange(90)) for _ in range(600)], "DateKey int, TimeKey int, UserKey bigint"
    ).distinct()
    out = course_types.rate_sessions(sessions, wifi, bridge)
    assert out.count() == 40
    assert out.where("PresentStudents > ExpectedStudents").count() == 0
    direct = course_types.present_users(sessions, wifi, bridge).groupBy("SessionID").count()
    assert out.join(direct, "SessionID").where("PresentStudents <> count").count() == 0


def test_describe_equals_pandas(spark):
    values = [float(x) for x in skewed(500, 50)]
    out = describe(spark.createDataFrame([(x,) for x in values], "x double"), "x", [0.1, 0.25, 0.5, 0.9]).first()
    s = pd.Series(values)
    assert [out.p10, out.p25, out.p50, out.p90] == [s.quantile(p) for p in (0.1, 0.25, 0.5, 0.9)]
    assert abs(out["std"] - s.std()) < 1e-9


def test_session_users_are_not_compared(spark):
    """A user of two subgroups of a session comes once, though no pair is shuffled or made distinct."""
    r = random.Random(8)
    spans = [(36000, 43200), (39600, 50400), (54000, 57600)]
    made = [(f"s{i}", f"2024-01-{1 + i % 2:02d}", *r.choice(spans), r.sample(range(4), 2)) for i in range(30)]
    sessions = spark.createDataFrame(made, "SessionID string, day string, SessionStartSecond int, SessionEndSecond int, _set array<bigint>").select(
        "SessionID", F.to_date("day").alias("FullDate"), "SessionStartSecond", "SessionEndSecond", F.array_sort("_set").alias("_set"))
    links = {(u, g) for u in range(25) for g in r.sample(range(5), 2)}
    hits = {(20240101 + r.randrange(3), 10000 * r.randrange(9, 17), u) for u in range(30) for _ in range(4)}
    out = course_types.present_users(
        sessions, spark.createDataFrame(list(hits), "DateKey int, TimeKey int, UserKey long"), spark.createDataFrame(list(links), "UserKey long, SubgroupKey long"))
    seconds = lambda k: k // 10000 * 3600
    expected = {(s, u) for s, day, a, b, own in made for d, t, u in hits
                if d == int(day.replace("-", "")) and a <= seconds(t) <= b and any((u, g) in links for g in own)}
    assert rows(out) == sorted(expected, key=lambda x: (x[0], str(x[1])))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not plan[0].startswith("Aggregate") and plan[1].strip(" +-").startswith("Join Inner")


def test_lectures_are_grouped_once(spark):
    """The result reads the stored lectures, not the timetable for each of its uses."""
    names = "LectureID long, SubgroupCode string, SubgroupKey long, DateKey int, StartSecond int, EndSecond int, ClassName string"
    made = [(1, "A", 1, 20240101, 36000, 43200, "x"), (1, "B", 2, 20240101, 36000, 43200, "x"), (2, "B", 2, 20240102, 36000, 43200, "y")]
    schedule = spark.createDataFrame(made, names).withColumns({
        "FullDate": F.to_date(F.col("DateKey").cast("string"), "yyyyMMdd"), "NormalizedClassName": F.col("ClassName"),
        "LessonType": F.lit(course_types.GROUP), "ProgramName": F.lit("p")})
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "UserKey long, SubgroupKey long")
    wifi = spark.createDataFrame([(20240101, 103000, 1), (20240102, 103000, 3)], "DateKey int, TimeKey int, UserKey long")
    out = course_types.lecture_results(schedule, wifi, bridge).select("LectureID", "SubgroupCodes", "TotalStudents", "UserCount")
    assert "SubgroupCode#" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out) == [(1, "A, B", 2, 1), (2, "B", 2, 0)]


def test_rows_of_metrics_are_built_once(spark):
    """Sums and percentiles read stored rows, and the counted values are read back, not counted again."""
    made = [("a" if i % 3 else None, f"s{i}", 10, i % 7, (i % 7) / 10) for i in range(60)]
    df = spark.createDataFrame(made, "k string, SessionID string, ExpectedStudents long, PresentStudents long, AttendanceRate double")
    out = session_metrics(df.withColumn("SessionID", F.concat(F.lit("built-"), "SessionID")), ["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "built-" not in plan and plan.count("Join") == 2
    got = {r.k: (r.SessionCount, r.MedianAttendanceRate, r.Percentile90) for r in out.collect()}
    for k in ("a", None):
        rates = pd.Series([x[4] for x in made if x[0] == k])
        assert got[k] == (len(rates), pytest.approx(rates.quantile(0.5)), pytest.approx(rates.quantile(0.9)))


def test_sets_meet_no_cohorts(spark):
    """Users of a set come from its own subgroups: sums leave the join, no (set, cohort) is made distinct."""
    sets = spark.createDataFrame([(1, [1, 2]), (2, [3])], "id int, _set array<bigint>")
    bridge = spark.createDataFrame([(u, (u + d) % 4) for u in range(20) for d in (0, 1)], "UserKey bigint, SubgroupKey bigint")
    out = presence.summed_over_sets(sets, ["id"], presence.expected_counts(bridge), [], "n")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Join") == 1
    want = {i: len({u for u in range(20) if {u % 4, (u + 1) % 4} & set(s)}) for i, s in ((1, [1, 2]), (2, [3]))}
    assert {r.id: r.n for r in out.collect()} == want


def test_unread_columns_are_not_shuffled_by_the_check(spark):
    df = spark.createDataFrame([(1, "a", "long text"), (2, "b", "long text")], "k int, x string, unread string")
    out = joins.unique_on(df, ["k"], "rows").select("k", "x")
    assert "unread" not in out._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert rows(out) == [(1, "a"), (2, "b")]


def test_sessions_are_dealt_out_for_subgroups(spark):
    """What meets the users is a row for each subgroup of a session, whatever the number of cohorts."""
    sessions = spark.createDataFrame([("s", 36000, 43200, [1, 2])], "SessionID string, SessionStartSecond int, SessionEndSecond int, _set array<bigint>")
    sessions = sessions.withColumn("FullDate", F.to_date(F.lit("2024-01-01")))
    bridge = spark.createDataFrame([(u, s) for u in range(9) for s in (1, 10 + u)] + [(0, 2)], "UserKey long, SubgroupKey long")
    wifi = spark.createDataFrame([(20240101, 110000, u) for u in range(9)], "DateKey int, TimeKey int, UserKey long")
    out = course_types.present_users(sessions, wifi, bridge)
    assert sorted(r.UserKey for r in out.collect()) == list(range(9))
    assert "Cohort" not in out._jdf.queryExecution().optimizedPlan().toString()
