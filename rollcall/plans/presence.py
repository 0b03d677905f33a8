"""Who was there: head counts, roster sizes and rates of lectures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import clock, maths
from rollcall.operators.joins import interval_join
from rollcall.plans import heads
from rollcall.session import stored

SPAN = ["DateKey", "StartSecond", "EndSecond"]
WINDOW = ["SubgroupKey", "DateKey", "FromTimeKey", "UntilTimeKey"]
CURRENT_SCHEME = "enc_"


def wifi_by_subgroup(wifi: DataFrame, bridge: DataFrame) -> DataFrame:
    """Connections with the subgroups of their user and the second of the day."""
    return wifi.join(bridge, "UserKey").select(
        "SubgroupKey", "DateKey", "UserKey", clock.key_seconds("TimeKey").alias("Second")
    )


def time_windows(lectures: DataFrame) -> DataFrame:
    """Distinct (subgroup, date, from, until)."""
    return lectures.select(*WINDOW).distinct()


def spanned(windows: DataFrame, grace_minutes: int = 0) -> DataFrame:
    """Windows with the seconds of the day at which they begin to count and end."""
    return windows.withColumns({
        "_from": clock.key_seconds("FromTimeKey") + F.lit(60 * grace_minutes),
        "_until": clock.key_seconds("UntilTimeKey"),
    })


def window_users(windows: DataFrame, wifi: DataFrame, bridge: DataFrame, grace_minutes: int = 0) -> DataFrame:
    """Distinct users of a subgroup seen inside each of the distinct time windows.

    Lectures that share a subgroup and a time window share their head count, so the
    interval join runs over distinct windows and never over fact rows.
    """
    seen = wifi_by_subgroup(wifi, bridge)
    hits = interval_join(seen, spanned(windows, grace_minutes), ["SubgroupKey", "DateKey"], "Second", "_from", "_until")
    return hits.select(*WINDOW, "UserKey").distinct()


def user_counts(
    fact: DataFrame, wifi: DataFrame, bridge: DataFrame, subgroups: DataFrame, grace_minutes: int = 15
) -> DataFrame:
    """Distinct users per time window; the first minutes of a lecture do not count.

    Lectures that share a subgroup and a time window share their count, which is taken from words of
    members (``heads``): users don't meet windows.
    """
    known = time_windows(fact).join(subgroups.select("SubgroupKey"), "SubgroupKey", "left_semi")
    return heads.heads_in_spans(spanned(known, grace_minutes), WINDOW, wifi, heads.numbered_members(bridge, "SubgroupKey"), "SubgroupKey", "_present")


def roster_sizes(bridge: DataFrame, users: DataFrame, subgroups: DataFrame) -> DataFrame:
    """Students per subgroup.  Only names of the current scheme count: the same people
    also occur under an older scheme, and would be counted twice."""
    current = users.where(F.col("UserName").startswith(CURRENT_SCHEME)).select("UserKey")
    return (
        bridge.join(subgroups.select("SubgroupKey"), "SubgroupKey", "left_semi")
        .join(current, "UserKey", "left_semi")
        .groupBy("SubgroupKey")
        .agg(F.count_distinct("UserKey").alias("TotalStudents"))
    )


def refresh_attendance(
    fact: DataFrame,
    wifi: DataFrame,
    bridge: DataFrame,
    users: DataFrame,
    subgroups: DataFrame,
    now: Column,
    grace_minutes: int = 15,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with new UserCount, TotalStudents and AttendanceRate.

    The count is null until the lecture is over, then 0 when nobody was seen.
    ``counts`` are head counts per time window from ``user_counts``.  Stored in a table
    their size is known when the join is planned, and the facts are only shuffled when
    the counts are too large to broadcast.
    """
    keys = [c for c in fact.columns if c not in ("UserCount", "TotalStudents", "AttendanceRate")]
    if counts is None:
        counts = user_counts(fact, wifi, bridge, subgroups, grace_minutes)
    totals = roster_sizes(bridge, users, subgroups).withColumnRenamed("TotalStudents", "_total")
    over = clock.finished("DateKey", "UntilTimeKey", now)
    filled = fact.select(*keys).join(counts, WINDOW, "left").join(totals, "SubgroupKey", "left")
    filled = filled.withColumns({
        "UserCount": F.when(over, F.coalesce("_present", F.lit(0))),
        "TotalStudents": F.coalesce("_total", F.lit(0)),
    })
    return filled.select(
        *keys, "UserCount", "TotalStudents",
        maths.attendance_rate("UserCount", "TotalStudents").alias("AttendanceRate"),
    )


def refresh_occupancy(fact: DataFrame, rooms: DataFrame) -> DataFrame:
    """UserCount over room capacity; null without capacity.  Rows without a known room
    keep the value they have."""
    old = F.col("OccupancyRate") if "OccupancyRate" in fact.columns else F.lit(None).cast("double")
    capacity = rooms.select("RoomKey", F.col("Capacity").alias("_capacity"), F.lit(True).alias("_room"))
    rate = F.when(F.col("_room"), maths.occupancy_rate("UserCount", "_capacity")).otherwise(old)
    return fact.join(capacity, "RoomKey", "left").withColumn("OccupancyRate", rate).drop("_capacity", "_room")


def presence_by_minute(wifi: DataFrame, bridge: DataFrame, subgroups: DataFrame) -> DataFrame:
    """Distinct users per time stamp and subgroup, with the subgroup code where known."""
    seen = wifi.join(heads.numbered_members(bridge, "SubgroupKey"), "UserKey").withColumnRenamed("_bit", "_bits")
    counts = heads.count_members(seen, ["DateKey", "TimeKey", "SubgroupKey"], "PresentStudents")
    codes = subgroups.select("SubgroupKey", "SubgroupCode")
    return counts.join(codes, "SubgroupKey", "left").select(
        "DateKey", "TimeKey", "SubgroupKey", "SubgroupCode", "PresentStudents"
    )


def user_cohorts(bridge: DataFrame) -> DataFrame:
    """(UserKey, Cohort): users with the same set of subgroups share a cohort; each user has one."""
    members = bridge.groupBy("UserKey").agg(F.array_sort(F.collect_set("SubgroupKey")).alias("_subgroups"))
    return members.select("UserKey", signature("_subgroups").alias("Cohort"))


def touched_cohorts(sets: DataFrame, bridge: DataFrame) -> DataFrame:
    """Distinct (``_sig``, Cohort): the cohorts with a subgroup in each distinct set."""
    pairs, _ = cohorts(bridge)
    one = sets.groupBy("_sig").agg(F.any_value("_set").alias("_set"))
    return one.select("_sig", F.explode("_set").alias("SubgroupKey")).join(pairs, "SubgroupKey").select("_sig", "Cohort").distinct()


def first_places(bridge: DataFrame) -> DataFrame:
    """(Cohort, SubgroupKey, ``_earlier``): each subgroup of a cohort with the cohort's lower ones.

    The users of a set of subgroups are those of each of its subgroups without the users whose earlier ones the
    set holds too, so a user counts once, at the first of their subgroups in the set.
    """
    pairs, _ = cohorts(bridge)
    return _with_earlier(pairs, "Cohort")


def user_places(bridge: DataFrame) -> DataFrame:
    """(UserKey, SubgroupKey, ``_earlier``): the same for each user."""
    return _with_earlier(bridge, "UserKey")


def _with_earlier(pairs: DataFrame, member: str) -> DataFrame:
    listed = pairs.groupBy(member).agg(F.array_sort(F.collect_set("SubgroupKey")).alias("_subgroups"))
    return listed.select(member, "_subgroups", F.explode("_subgroups").alias("SubgroupKey")).select(
        member, "SubgroupKey", F.filter("_subgroups", lambda s: s < F.col("SubgroupKey")).alias("_earlier"))


def summed_over_sets(asked: DataFrame, keys: list[str], counts: DataFrame, on: list[str], out: str) -> DataFrame:
    """Users per ``keys``: ``counts`` has ``on``, SubgroupKey, ``_earlier`` and ``_n``, and is stored, so that its size is known.

    A set meets the counts of its own subgroups.  Sums leave the join's tasks, not cohorts; what is shuffled
    before, if the counts are too large to send, is a row for each subgroup of a set.
    """
    listed = asked.select(*dict.fromkeys([*keys, *on]), "_set", F.explode("_set").alias("SubgroupKey"))
    met = listed.join(counts, [*on, "SubgroupKey"]).where(~F.arrays_overlap("_set", "_earlier"))
    return met.groupBy(*keys).agg(F.sum("_n").alias(out))


def present_counts(spans: DataFrame, wifi: DataFrame, bridge: DataFrame) -> DataFrame:
    """Stored users seen per distinct span (``SPAN``), subgroup and earlier subgroups.

    Words of users are united per distinct time span and cohort (``heads``), and cohorts with the same earlier
    subgroups add up.  Rows grow with connections, not with sessions.
    """
    distinct = spans.select(*SPAN).distinct().withColumns({"_from": F.col("StartSecond"), "_until": F.col("EndSecond")})
    members = heads.numbered_members(user_cohorts(bridge), "Cohort")
    counts = heads.heads_in_spans(distinct, SPAN, wifi, members, "Cohort", "_users").join(first_places(bridge), "Cohort")
    return stored(counts.groupBy(*SPAN, "SubgroupKey", "_earlier").agg(F.sum("_users").alias("_n")), "present")


def expected_counts(bridge: DataFrame) -> DataFrame:
    """Stored users per subgroup and earlier subgroups."""
    _, sizes = cohorts(bridge)
    counts = first_places(bridge).join(sizes, "Cohort")
    return stored(counts.groupBy("SubgroupKey", "_earlier").agg(F.sum("CohortUsers").alias("_n")), "expected")


def present_by_set(spans: DataFrame, wifi: DataFrame, bridge: DataFrame, out: str) -> DataFrame:
    """Distinct users seen per distinct (DateKey, StartSecond, EndSecond, ``_sig``).

    ``spans`` has the sorted set of subgroups as ``_set`` and its text as ``_sig``.  Spans without any user are absent.
    """
    asked = spans.groupBy(*SPAN, "_sig").agg(F.any_value("_set").alias("_set"))
    return summed_over_sets(asked, [*SPAN, "_sig"], present_counts(spans, wifi, bridge), SPAN, out)


def cohorts(bridge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users grouped by the exact set of their subgroups.

    Returns (cohort, subgroup) pairs and the number of users per cohort.  The distinct
    users of any set of subgroups are the sum over the cohorts that touch it, which
    replaces a distinct count over users by one over cohorts.
    """
    members = bridge.groupBy("UserKey").agg(
        F.array_sort(F.collect_set("SubgroupKey")).alias("_subgroups")
    )
    sizes = members.groupBy("_subgroups").agg(F.count(F.lit(1)).alias("CohortUsers"))
    sizes = sizes.withColumn("Cohort", signature("_subgroups"))
    pairs = sizes.select("Cohort", F.explode("_subgroups").alias("SubgroupKey"))
    return pairs, sizes.select("Cohort", "CohortUsers")


def signature(c) -> Column:
    """Text of a sorted set of keys."""
    return F.array_join(F.transform(c, lambda s: s.cast("string")), ",")


def expected_by_set(sets: DataFrame, bridge: DataFrame, out: str) -> DataFrame:
    """Distinct users per distinct set of subgroups: (``_sig``, count).

    ``sets`` has the sorted set as ``_set`` and its text as ``_sig``.
    """
    asked = sets.groupBy("_sig").agg(F.any_value("_set").alias("_set"))
    return summed_over_sets(asked, ["_sig"], expected_counts(bridge), [], out)


def expected_users(links: DataFrame, unit: str, bridge: DataFrame, out: str) -> DataFrame:
    """Distinct users over the subgroups of each unit (lecture or session).

    Units with the same set of subgroups are answered once, through cohorts.
    Units without any user are absent.
    """
    sets = links.groupBy(unit).agg(F.array_sort(F.collect_set("SubgroupKey")).alias("_set"))
    sets = sets.withColumn("_sig", signature("_set"))
    return sets.select(unit, "_sig").join(expected_by_set(sets, bridge, out), "_sig").select(unit, out)
