"""Group-project classification of courses and the purge of foreign ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import text
from rollcall.operators.columns import require

# --- fixed values: phrases and reasons, in order of priority -------------------------
WRITTEN_EXAM, ORAL_EXAM = "schriftelijk examen", "mondeling examen"
PROJECT_WORD = "project"
OBSERVATION = "observatie van functioneren van de student"
REASON_WRITTEN, REASON_ORAL = "Schriftelijk examen", "Mondeling examen"
REASON_PROJECT = "Project in titel"
REASON_OBSERVATION = "Observatie van functioneren van de student"
REASON_NONE = "Geen sterk signaal voor verplicht groepswerk"
FORMAT_PATTERN = r"""['"](?i:format)['"]\s*:\s*['"]([^'"]+)['"]"""
# -------------------------------------------------------------------------------------

EVALUATION = "array<array<struct<moment:string,format:string,percentage:string>>>"


def evaluation_formats(c: str) -> Column:
    """Normalised ``format`` values of a nested evaluation literal.

    Text that does not parse falls back to a pattern search; null gives an empty list.
    """
    parsed = F.flatten(F.from_json(F.col(c), EVALUATION, {"allowSingleQuotes": "true"}))
    by_parse = F.filter(F.transform(parsed, lambda m: m["format"]), lambda f: f.isNotNull())
    by_pattern = F.regexp_extract_all(F.col(c), F.lit(FORMAT_PATTERN), 1)
    found = F.when(F.size(by_parse) > 0, by_parse).otherwise(by_pattern)
    return F.coalesce(F.transform(found, lambda f: F.lower(text.squish(f))), F.array().cast("array<string>"))


def any_contains(items: Column, phrase: str) -> Column:
    return F.exists(items, lambda x: x.contains(phrase))


def classify_courses(courses: DataFrame) -> DataFrame:
    """is_group_project and classification_reason per course."""
    require(courses, ["title", "evaluation_methods"], "course table")
    rows = courses.withColumn("_formats", evaluation_formats("evaluation_methods"))
    title = F.coalesce(F.lower(text.squish(F.col("title").cast("string"))), F.lit(""))
    formats = F.col("_formats")
    reason = (
        F.when(any_contains(formats, WRITTEN_EXAM), REASON_WRITTEN)
        .when(any_contains(formats, ORAL_EXAM), REASON_ORAL)
        .when(text.whole_word(title, PROJECT_WORD), REASON_PROJECT)
        .when(any_contains(formats, OBSERVATION), REASON_OBSERVATION)
        .otherwise(REASON_NONE)
    )
    return rows.withColumns({
        "classification_reason": reason,
        "parsed_evaluation_formats": F.array_join(formats, " | "),
    }).withColumn(
        "is_group_project", F.col("classification_reason").isin(REASON_PROJECT, REASON_OBSERVATION)
    ).drop("_formats")


def it_codes(courses: DataFrame) -> DataFrame:
    """Distinct codes of IT courses.  An empty list is refused: a purge would keep nothing."""
    require(courses, ["faculties", "code"], "course table")
    codes = courses.where(text.is_it_faculty("faculties")).select(
        F.trim(F.col("code").cast("string")).alias("code")
    ).where("code <> ''").distinct()
    if codes.isEmpty():
        raise ValueError("no IT courses found")
    return codes


def classes_without_lectures(classes: DataFrame, fact: DataFrame) -> DataFrame:
    return classes.join(fact.select("ClassKey"), "ClassKey", "left_anti").select("ClassKey", "ClassCode", "ClassName")
