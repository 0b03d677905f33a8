"""Calendar, minute and activity dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall.functions import clock

# --- fixed values: activity seed -----------------------------------------------------
# (label, domain, group, source column, source value, set flags)
ACTIVITY_FLAGS = [
    "IsCourse", "IsExam", "IsAcademicEvent", "IsGuestLecture", "IsMakeUp", "IsPractical",
    "IsPresentation", "IsDigitalPossible",
]
ACTIVITY_SEED = [
    ("Unknown", "AcademicEvent", None, "Unknown", "", "IsAcademicEvent"),
    ("Activerend hoorcollege", "Course", "Lecture", "WorkFormCourse", "Activerend hoorcollege", "IsCourse"),
    ("Begeleiding", "Course", "Workshop", "WorkFormCourse", "Begeleiding", "IsCourse"),
    ("Excursie", "Course", "Field", "WorkFormCourse", "Excursie", "IsCourse"),
    ("Leerpad vast", "Course", "Lecture", "WorkFormCourse", "Leerpad vast", "IsCourse"),
    ("Leerpad vrij", "Course", "Lecture", "WorkFormCourse", "Leerpad vrij", "IsCourse"),
    ("Oefensessie", "Course", "Practice", "WorkFormCourse", "Oefensessie", "IsCourse"),
    ("Onderwijsleergesprek", "Course", "Seminar", "WorkFormCourse", "Onderwijsleergesprek", "IsCourse"),
    ("Practicum", "Course", "Lab", "WorkFormCourse", "Practicum", "IsCourse IsPractical"),
    ("Stage", "Course", "Internship", "WorkFormCourse", "Stage", "IsCourse IsPractical"),
    ("Werken aan opdracht", "Course", "Project", "WorkFormCourse", "Werken aan opdracht", "IsCourse"),
    ("Werkplekleren", "Course", "Workplace", "WorkFormCourse", "Werkplekleren", "IsCourse IsPractical"),
    ("Examen (digitaal)", "Exam", "Exam", "WorkFormExam", "Digitaal examen", "IsExam IsDigitalPossible"),
    ("Examenopdracht (indienen)", "Exam", "Exam", "WorkFormExam", "Indienen examenopdracht", "IsExam IsDigitalPossible"),
    ("Examen (mondeling + schriftelijk)", "Exam", "Exam", "WorkFormExam", "Mondeling - schriftelijk examen", "IsExam"),
    ("Examen (mondeling)", "Exam", "Exam", "WorkFormExam", "Mondeling examen", "IsExam"),
    ("Presentatie (examen)", "Exam", "Exam", "WorkFormExam", "Presentatie", "IsExam IsPresentation"),
    ("Examen (schriftelijk)", "Exam", "Exam", "WorkFormExam", "Schriftelijk examen", "IsExam"),
    ("Examen (vaardigheidstest)", "Exam", "Exam", "WorkFormExam", "Vaardigheidstest", "IsExam IsPractical"),
    ("Verdediging bachelorproef", "Exam", "Exam", "WorkFormExam", "Verdediging bachelorproef", "IsExam IsPresentation"),
    ("Examenopdracht (indienen)", "Exam", "Exam", "WorkFormEvaluation", "Indienen examenopdracht", "IsExam IsDigitalPossible"),
    ("Inhaalexamen (digitaal)", "Exam", "Exam", "WorkFormEvaluation", "Inhaalexamen Digitaal", "IsExam IsMakeUp IsDigitalPossible"),
    ("Inhaalexamen (mondeling)", "Exam", "Exam", "WorkFormEvaluation", "Inhaalexamen Mondeling", "IsExam IsMakeUp"),
    ("Inhaalexamen (schriftelijk)", "Exam", "Exam", "WorkFormEvaluation", "Inhaalexamen Schriftelijk", "IsExam IsMakeUp"),
    ("Inhaalexamen (vaardigheidstest)", "Exam", "Exam", "WorkFormEvaluation", "Inhaalexamen Vaardigheidstest", "IsExam IsMakeUp IsPractical"),
    ("Presentatie (examen)", "Exam", "Exam", "WorkFormEvaluation", "Presentatie", "IsExam IsPresentation"),
    ("Examen (schriftelijk)", "Exam", "Exam", "WorkFormEvaluation", "Schriftelijk examen", "IsExam"),
    ("Andere", "AcademicEvent", "Event", "EducationActivity", "Andere", "IsAcademicEvent"),
    ("Feedback", "AcademicEvent", "Event", "EducationActivity", "Feedback", "IsAcademicEvent"),
    ("Gastcollege", "AcademicEvent", "Lecture", "EducationActivity", "Gastcollege", "IsAcademicEvent IsGuestLecture"),
    ("Infosessie", "AcademicEvent", "Event", "EducationActivity", "Infosessie", "IsAcademicEvent"),
    ("Intervisie studenten", "AcademicEvent", "Event", "EducationActivity", "Intervisie studenten", "IsAcademicEvent"),
    ("Lokaalreservering", "AcademicEvent", "Event", "EducationActivity", "Lokaalreservering", "IsAcademicEvent"),
    ("Onthaaldag nieuwe studenten", "AcademicEvent", "Event", "EducationActivity", "Onthaaldag nieuwe studenten", "IsAcademicEvent"),
    ("Onthaalmoment", "AcademicEvent", "Event", "EducationActivity", "Onthaalmoment", "IsAcademicEvent"),
    ("Studiedag", "AcademicEvent", "Event", "EducationActivity", "Studiedag", "IsAcademicEvent"),
    ("Workshop", "AcademicEvent", "Workshop", "EducationActivity", "Workshop", "IsAcademicEvent"),
]
# ---------------------------------------------------------------------------------------


def activity_rows() -> list[tuple]:
    """Seed rows with their key and one boolean per flag."""
    return [
        (i + 1, *row[:5], *[flag in row[5].split() for flag in ACTIVITY_FLAGS])
        for i, row in enumerate(ACTIVITY_SEED)
    ]


def fixed_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A literal table.  Its size is known to the planner, unlike that of a table built
    from Python objects, so joins with it need no shuffle."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"

    lines = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(columns)})")


def dim_activity(spark: SparkSession) -> DataFrame:
    columns = [
        "ActivityKey", "CanonicalActivity", "ActivityDomain", "ActivityGroup", "SourceColumn", "SourceValue",
        *ACTIVITY_FLAGS,
    ]
    return fixed_table(spark, columns, activity_rows())


def calendar(days: DataFrame, first: str | Column, last: str | Column) -> DataFrame:
    """Calendar rows from the earliest ``first`` to the latest ``last`` of a table."""
    bounds = days.agg(
        F.min(first).cast("date").alias("_a"), F.max(last).cast("date").alias("_b")
    )
    spine = bounds.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("_day"))
    return spine.select(*[c.alias(n) for n, c in clock.calendar_columns("_day").items()])


def calendar_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    one = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return calendar(one, "a", "b")


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    minute = spark.range(1440).select((F.col("id") * 60).cast("int").alias("_s"))
    hour = clock.whole(F.col("_s"), 3600).cast("int")
    return minute.select(
        clock.seconds_key("_s").alias("TimeKey"),
        hour.alias("Hour"),
        (clock.whole(F.col("_s"), 60) % 60).cast("int").alias("Minutes"),
        F.lit(0).alias("Seconds"),
        F.concat(clock.hhmm("_s"), F.lit(":00")).alias("FullTime"),
        clock.half_of_day(hour).alias("TimeAM_PM"),
    )
