"""Checks of the lecture facts before they are trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions import maths
from rollcall.operators import aggregates
from rollcall.operators.dedupe import duplicate_rows, same_digest, with_group_size

KEY = ["LectureID", "SubgroupKey"]

# --- fixed values: wording of the status table ----------------------------------------
OK, LOOK, JUDGE = "OK", "NAKIJKEN", "INTERPRETEREN"
CHECK_EXACT = "Exact identieke factrijen"
CHECK_KEY = "Dubbele LectureID + SubgroupKey"
CHECK_RATE = "AttendanceRate wijkt af van UserCount / TotalStudents"
CHECK_REPEATED = "Lessen met meerdere rijen en herhaald UserCount"
CHECK_CAPACITY = "TotalStudents per unieke les groter dan lokaalcapaciteit"
CHECK_OVER = "AttendanceRate > 100%"
SCENARIO_FACT = "Factrijniveau: gemiddelde opgeslagen AttendanceRate"
SCENARIO_MAX = "Unieke les: max(UserCount) / som(TotalStudents)"
SCENARIO_SUM = "Unieke les: som(UserCount) / som(TotalStudents)"
# ----------------------------------------------------------------------------------------


def grain_summary(facts: DataFrame) -> DataFrame:
    per_lecture = facts.groupBy("LectureID").agg(F.count(F.lit(1)).alias("n"))
    return per_lecture.agg(
        F.sum("n").alias("FactRows"),
        F.count(F.lit(1)).alias("UniqueLectures"),
        F.count_if(F.col("n") == 1).alias("LecturesWithOneRow"),
        F.count_if(F.col("n") > 1).alias("LecturesWithMoreRows"),
        F.max("n").alias("MaxRowsPerLecture"),
        F.avg("n").alias("MeanRowsPerLecture"),
    )


def duplicates(facts: DataFrame, exact: bool = False) -> DataFrame:
    return duplicate_rows(facts, None if exact else KEY)


def with_recalculated(facts: DataFrame) -> DataFrame:
    again = facts.withColumn("RecalculatedAttendanceRate", maths.ratio("UserCount", "TotalStudents"))
    return again.withColumn(
        "AttendanceRateDifference", F.abs(F.col("AttendanceRate") - F.col("RecalculatedAttendanceRate"))
    )


def consistency(facts: DataFrame) -> DataFrame:
    rows = with_recalculated(facts)
    students, users, rate = F.col("TotalStudents"), F.col("UserCount"), F.col("AttendanceRate")
    return aggregates.labelled_counts(rows, {
        "TotalStudents NULL": students.isNull(),
        "TotalStudents <= 0": F.coalesce(students, F.lit(0)) <= 0,
        "UserCount NULL": users.isNull(),
        "UserCount < 0": F.coalesce(users, F.lit(0)) < 0,
        "AttendanceRate < 0": rate < 0,
        "AttendanceRate > 1": rate > 1,
        "Afwijking opgeslagen/herberekend > 0.0001": F.col("AttendanceRateDifference") > 1e-4,
    })


def lecture_structure(facts: DataFrame) -> DataFrame:
    """Per lecture: rows, subgroups and how its counts vary over them."""
    return facts.groupBy("LectureID").agg(
        F.count(F.lit(1)).alias("FactRows"),
        F.count_distinct("SubgroupKey").alias("UniqueSubgroups"),
        F.min("UserCount").alias("MinUserCount"),
        F.max("UserCount").alias("MaxUserCount"),
        F.sum("UserCount").alias("SumUserCount"),
        F.sum("TotalStudents").alias("SumTotalStudents"),
        F.max("TotalStudents").alias("MaxTotalStudents"),
        # one value on all rows is the only case the checks ask for
        ((F.min("UserCount") == F.max("UserCount")) & F.min("UserCount").isNotNull()).alias("SameUserCount"),
    )


def repeated_counts(structure: DataFrame) -> DataFrame:
    more = structure.where("FactRows > 1")
    return more.agg(
        F.count(F.lit(1)).alias("LecturesWithMoreRows"),
        F.count_if("SameUserCount").alias("WithSameUserCount"),
        aggregates.share(F.col("SameUserCount")).alias("ShareSameUserCount"),
    )


def scenarios(facts: DataFrame) -> DataFrame:
    """Mean and median of the rate under three ways to aggregate."""
    means = facts.agg(F.avg("AttendanceRate").alias("m"))
    fact = aggregates.with_percentiles(means, facts, [], {"d": ("AttendanceRate", 0.5)}).select(
        F.lit(SCENARIO_FACT).alias("Methode"), F.col("m").alias("Gemiddelde"), F.col("d").alias("Mediaan")
    )
    rates = lecture_structure(facts).select(
        maths.ratio("MaxUserCount", "SumTotalStudents").alias("a"),
        maths.ratio("SumUserCount", "SumTotalStudents").alias("b"),
    )
    wide = aggregates.with_percentiles(rates.agg(F.avg("a").alias("ma"), F.avg("b").alias("mb")), rates, [], {"da": ("a", 0.5), "db": ("b", 0.5)})
    lecture = wide.select(F.inline(F.array(
        F.struct(F.lit(SCENARIO_MAX).alias("Methode"), F.col("ma").alias("Gemiddelde"), F.col("da").alias("Mediaan")),
        F.struct(F.lit(SCENARIO_SUM).alias("Methode"), F.col("mb").alias("Gemiddelde"), F.col("db").alias("Mediaan")),
    )))
    return fact.unionByName(lecture)


def lecture_capacity(facts: DataFrame) -> DataFrame:
    """Per lecture: the room of its first subgroup, all subgroup codes, head counts."""
    return facts.groupBy("LectureID").agg(
        F.min_by("FullDate", "SubgroupKey").alias("FullDate"),
        F.min_by("ClassName", "SubgroupKey").alias("ClassName"),
        F.min_by("RoomCode", "SubgroupKey").alias("RoomCode"),
        F.min_by("RoomCapacity", "SubgroupKey").alias("RoomCapacity"),
        aggregates.distinct_list("SubgroupCode").alias("Subgroups"),
        F.count(F.lit(1)).alias("FactRows"),
        F.max("UserCount").alias("UserCount"),
        F.sum("TotalStudents").alias("SumTotalStudents"),
    )


def suspicious_capacity(lectures: DataFrame) -> DataFrame:
    room = F.col("RoomCapacity")
    return lectures.where((F.col("SumTotalStudents") > room) | (F.col("UserCount") > room))


def capacity_checks(facts: DataFrame) -> DataFrame:
    room = F.col("RoomCapacity")
    rows = aggregates.labelled_counts(facts, {
        "Rijen met onbekende lokaalcapaciteit": room.isNull(),
        "TotalStudents > RoomCapacity": F.col("TotalStudents") > room,
        "UserCount > RoomCapacity": F.col("UserCount") > room,
    })
    lectures = aggregates.labelled_counts(lecture_capacity(facts), {
        "Som TotalStudents per les > RoomCapacity": F.col("SumTotalStudents") > room,
    })
    return rows.unionByName(lectures)


def subgroup_stability(facts: DataFrame) -> DataFrame:
    stats = facts.groupBy("SubgroupCode").agg(
        F.count_distinct("LectureID").alias("Lessons"),
        F.min("TotalStudents").alias("MinStudents"),
        F.max("TotalStudents").alias("MaxStudents"),
        F.avg("TotalStudents").alias("MeanStudents"),
        F.stddev_samp("TotalStudents").alias("StdStudents"),
        F.count_distinct("TotalStudents").alias("UniqueStudentCounts"),
    )
    stats = aggregates.with_percentiles(stats, facts, ["SubgroupCode"], {"MedianStudents": ("TotalStudents", 0.5)})
    return stats.withColumn("MaxMinRatio", maths.ratio("MaxStudents", "MinStudents"))


def low_by_row_count(facts: DataFrame) -> DataFrame:
    """Share of rates below 20% for lectures with one and with several rows."""
    sized = with_group_size(facts, ["LectureID"], "_rows")
    return sized.groupBy((F.col("_rows") > 1).alias("MultipleFactRows")).agg(
        F.count(F.lit(1)).alias("Rows"), aggregates.share(F.col("AttendanceRate") < 0.20).alias("ShareBelow20")
    )


def low_attendance_profile(facts: DataFrame, column: str, min_rows: int = 20, top: int = 20) -> DataFrame:
    """Groups with the largest share of low rates; equal shares by size, then by name."""
    groups = facts.groupBy(column).agg(
        F.count(F.lit(1)).alias("Rows"),
        F.count_distinct("LectureID").alias("UniqueLectures"),
        F.avg("AttendanceRate").alias("MeanAttendance"),
        aggregates.share(F.col("AttendanceRate") < 0.20).alias("ShareBelow20"),
    )
    groups = aggregates.with_percentiles(groups, facts, [column], {"MedianAttendance": ("AttendanceRate", 0.5)})
    return groups.where(F.col("Rows") >= min_rows).orderBy(F.desc("ShareBelow20"), F.desc("Rows"), F.asc(column)).limit(top)


def zero_clusters(facts: DataFrame, column: str, min_rows: int) -> DataFrame:
    zero = F.col("AttendanceRate") == 0
    return facts.groupBy(column).agg(
        F.count(F.lit(1)).alias("Rows"),
        F.count_if(zero).alias("ZeroRows"),
        aggregates.share(zero).alias("ZeroShare"),
    ).where(F.col("Rows") >= min_rows)


def sample_lectures(facts: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """Ids of ``n`` lectures, the same for the same seed: the lowest keyed digests."""
    digest = F.md5(F.concat(F.col("LectureID").cast("string"), F.lit(f":{seed}")))
    return facts.select("LectureID").distinct().orderBy(digest, "LectureID").limit(n)


def lecture_details(facts: DataFrame, lectures: DataFrame) -> DataFrame:
    columns = [
        "LectureID", "FullDate", "FromHour", "ClassName", "SubgroupCode", "RoomCode", "RoomCapacity",
        "ActivityDomain", "UserCount", "TotalStudents", "AttendanceRate",
    ]
    return facts.join(lectures.select("LectureID"), "LectureID", "left_semi").select(*columns)


def very_low_lectures(facts: DataFrame, n: int = 10) -> DataFrame:
    rates = lecture_structure(facts).withColumn("_rate", maths.ratio("MaxUserCount", "SumTotalStudents"))
    return rates.where("_rate is not null").orderBy("_rate", "LectureID").limit(n).select("LectureID")


def status_table(facts: DataFrame) -> DataFrame:
    """One row per check with the number of suspect records and a verdict.

    Copies of keys and of whole rows are counted by key and by digest; one row per lecture
    carries everything the other checks need.
    """
    # digests are counted per key; columns are compared only for digests that repeat
    by_key = facts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    same = same_digest(facts).groupBy(*facts.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    total = lambda rows, n, name: rows.agg(F.coalesce(F.sum(n), F.lit(0)).alias(name)).select(name).scalar().alias(name)
    copies = facts.sparkSession.range(1).select(total(same, "_n", CHECK_EXACT), total(by_key, "_rows", CHECK_KEY))
    rate, room = F.col("AttendanceRate"), F.col("_capacity")
    lectures = with_recalculated(facts).groupBy("LectureID").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("UserCount").alias("_low"),
        F.max("UserCount").alias("_high"),
        F.sum("TotalStudents").alias("_students"),
        F.min_by("RoomCapacity", "SubgroupKey").alias("_capacity"),
        F.count_if(F.col("AttendanceRateDifference") > 1e-4).alias("_different"),
        F.count_if(rate > 1).alias("_over"),
    ).agg(
        F.coalesce(F.sum("_different"), F.lit(0)).alias(CHECK_RATE),
        F.count_if((F.col("_rows") > 1) & (F.col("_low") == F.col("_high"))).alias(CHECK_REPEATED),
        F.count_if((F.col("_students") > room) | (F.col("_high") > room)).alias(CHECK_CAPACITY),
        F.coalesce(F.sum("_over"), F.lit(0)).alias(CHECK_OVER),
    )
    counts = aggregates.unpivot_row(copies, copies.columns, "Controle", "VerdachteRecords").unionByName(
        aggregates.unpivot_row(lectures, lectures.columns, "Controle", "VerdachteRecords")
    )
    label, clean = F.col("Controle"), F.col("VerdachteRecords") == 0
    status = (
        F.when(label == CHECK_REPEATED, JUDGE).when(clean, OK)
        .when(label.isin(CHECK_EXACT, CHECK_KEY, CHECK_RATE), LOOK).otherwise(JUDGE)
    )
    return counts.withColumn("Status", status)
