"""Programme information of subgroups: inference, attributes, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import text
from rollcall.operators.aggregates import labelled_counts
from rollcall.operators.columns import fill_with_source, reorder, require
from rollcall.operators.dedupe import duplicate_rows, keep_one
from rollcall.operators.joins import outer_compare, unique_on
from rollcall.operators.windows import best_candidate, with_share

MIN_EVIDENCE = 3
MIN_CONFIDENCE = 0.80
# --- fixed values: provenance labels ------------------------------------------------
FROM_STUDENTS = "students"
FROM_LECTURES = "lecture_subgroup_cooccurrence"
FROM_REFERENCE = "cleaned_unique_subgroups"
FROM_OVERRIDE = "cleaned_unique_subgroups_override"
# -------------------------------------------------------------------------------------


def lecture_links(schedule: DataFrame, lecture: str = "Id", groups: str = "Classgroups") -> DataFrame:
    """Distinct (lecture, subgroup code)."""
    rows = text.explode_items(schedule.select(lecture, groups), groups, "SubgroupCode", keep_empty=False)
    return rows.select(
        F.col(lecture).alias("Id"), text.drop_float_suffix("SubgroupCode").alias("SubgroupCode")
    ).distinct()


def lecture_sets(links: DataFrame, known: DataFrame, missing: DataFrame, candidate: str) -> DataFrame:
    """(missing subgroup, set of known candidates in a lecture) with the number of lectures.

    Each lecture carries the set of programmes of its known subgroups.  Rows of missing
    subgroups take that set as one value and are counted per set before the sets are
    unfolded, so no subgroup pairs and no (lecture, subgroup, candidate) rows arise.
    """
    programs = (
        links.join(known.select("SubgroupCode", candidate).where(F.col(candidate).isNotNull()), "SubgroupCode")
        .groupBy("Id")
        .agg(F.array_sort(F.collect_set(candidate)).alias("_set"))
    )
    return (
        links.join(missing.select("SubgroupCode"), "SubgroupCode", "left_semi")
        .join(programs, "Id")
        .groupBy("SubgroupCode", "_set")
        .agg(F.count(F.lit(1)).alias("_lectures"))
    )


def unfold(per_set: DataFrame, items: Column, candidate: str) -> DataFrame:
    return (
        per_set.select("SubgroupCode", F.explode(items).alias(candidate), "_lectures")
        .groupBy("SubgroupCode", candidate)
        .agg(F.sum("_lectures").alias("EvidenceCount"))
    )


def votes(links: DataFrame, known: DataFrame, missing: DataFrame, candidate: str) -> DataFrame:
    """(subgroup, candidate) with the number of lectures that hold both."""
    return unfold(lecture_sets(links, known, missing, candidate), F.col("_set"), candidate)


def accepted(counts: DataFrame, candidate: str, min_evidence: int, min_confidence: float) -> DataFrame:
    """Best candidates that clear the evidence, the share and the uniqueness rule."""
    best = best_candidate(counts, ["SubgroupCode"], candidate, "EvidenceCount")
    return best.where(
        (F.col("EvidenceCount") >= min_evidence)
        & (F.col("Confidence") >= min_confidence)
        & (F.col("TopCandidateCount") == 1)
    )


def prepare_subgroups(subgroups: DataFrame) -> DataFrame:
    """Cleaned code and programme, family, and provenance of what is known."""
    require(subgroups, ["SubgroupKey", "SubgroupCode", "ProgramName"], "subgroup table")
    rows = subgroups.withColumns({
        "SubgroupCode": text.drop_float_suffix("SubgroupCode"), "ProgramName": text.null_words("ProgramName"),
    }).withColumn("ProgramFamily", text.program_family("ProgramName"))
    known = F.when(F.col("ProgramName").isNotNull(), FROM_STUDENTS)
    return rows.select(
        "SubgroupKey", "SubgroupCode", "ProgramName", "ProgramFamily",
        known.alias("ProgramNameSource"), known.alias("ProgramFamilySource"),
        F.lit(None).cast("double").alias("InferenceConfidence"),
        F.lit(None).cast("bigint").alias("InferenceEvidenceCount"),
    )


def evidence(subgroups: DataFrame, schedule: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vote tables with totals and shares: (exact programme, programme family)."""
    rows = prepare_subgroups(subgroups)
    links = lecture_links(schedule)
    known = keep_one(
        rows.where("ProgramName is not null").select("SubgroupCode", "ProgramName", "ProgramFamily"),
        ["SubgroupCode"], ["ProgramName"],
    )
    missing = rows.where("ProgramName is null and SubgroupCode is not null").select("SubgroupCode").distinct()
    per_set = lecture_sets(links, known, missing, "ProgramName")
    # the family is a part of the name, so the sets of names give the sets of families
    families = F.array_distinct(F.transform("_set", lambda name: text.program_family(name)))
    exact = unfold(per_set, F.col("_set"), "ProgramName")
    family = unfold(per_set, families, "ProgramFamily")
    return tuple(with_share(t, ["SubgroupCode"], "EvidenceCount") for t in (exact, family))


def infer_programs(
    subgroups: DataFrame,
    schedule: DataFrame,
    min_evidence: int = MIN_EVIDENCE,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Fill unknown programmes, then unknown families, from lectures shared with known ones."""
    rows = prepare_subgroups(subgroups)
    exact, family = evidence(subgroups, schedule)
    best_exact = accepted(exact, "ProgramName", min_evidence, min_confidence).select(
        "SubgroupCode", F.col("ProgramName").alias("_name"), F.col("Confidence").alias("_name_conf"),
        F.col("EvidenceCount").alias("_name_n"),
    )
    best_family = accepted(family, "ProgramFamily", min_evidence, min_confidence).select(
        "SubgroupCode", F.col("ProgramFamily").alias("_family"), F.col("Confidence").alias("_family_conf"),
        F.col("EvidenceCount").alias("_family_n"),
    )
    joined = rows.join(best_exact, "SubgroupCode", "left").join(best_family, "SubgroupCode", "left")
    by_name = F.col("ProgramName").isNull() & F.col("_name").isNotNull()
    joined = joined.withColumns({
        "ProgramName": F.when(by_name, F.col("_name")).otherwise(F.col("ProgramName")),
        "ProgramFamily": F.when(by_name, text.program_family("_name")).otherwise(F.col("ProgramFamily")),
        "ProgramNameSource": F.when(by_name, FROM_LECTURES).otherwise(F.col("ProgramNameSource")),
        "ProgramFamilySource": F.when(by_name, FROM_LECTURES).otherwise(F.col("ProgramFamilySource")),
        "InferenceConfidence": F.when(by_name, F.col("_name_conf")).otherwise(F.col("InferenceConfidence")),
        "InferenceEvidenceCount": F.when(by_name, F.col("_name_n")).otherwise(F.col("InferenceEvidenceCount")),
    })
    filled = fill_with_source(
        joined, "ProgramFamily", F.col("_family"), "ProgramFamilySource", FROM_LECTURES,
        extras={
            "InferenceConfidence": F.coalesce("InferenceConfidence", "_family_conf"),
            "InferenceEvidenceCount": F.coalesce("InferenceEvidenceCount", "_family_n"),
        },
    )
    return filled.select(*rows.columns)


def evidence_table(exact: DataFrame, family: DataFrame) -> DataFrame:
    return exact.withColumn("InferenceType", F.lit("ExactProgramName")).unionByName(
        family.withColumnRenamed("ProgramFamily", "ProgramName").withColumn("InferenceType", F.lit("ProgramFamily"))
    )


def unresolved(rows: DataFrame) -> DataFrame:
    return rows.where("ProgramName is null and ProgramFamily is null")


def inference_summary(rows: DataFrame) -> DataFrame:
    name, family = F.col("ProgramName"), F.col("ProgramFamily")
    return labelled_counts(rows, {
        "Subgroups": F.lit(True),
        "KnownFromStudents": F.col("ProgramNameSource") == FROM_STUDENTS,
        "InferredExactly": F.col("ProgramNameSource") == FROM_LECTURES,
        "InferredFamilyOnly": name.isNull() & family.isNotNull(),
        "WithoutProgramName": name.isNull(),
        "WithoutAnything": name.isNull() & family.isNull(),
    })


# --- attributes ------------------------------------------------------------------------

# --- fixed values: columns of the result, in order ----------------------------------------
PREFERRED = [
    "SubgroupKey", "SubgroupCode", "ProgramName", "ProgramFamily", "StudyProgram", "IsIT",
    "ProgramInformationLevel", "ProgramNameSource", "ProgramFamilySource", "InferenceConfidence",
    "InferenceEvidenceCount",
]


def program_attributes(subgroups: DataFrame, longest_first: bool = False) -> DataFrame:
    """Family, readable programme, IT flag and information level per subgroup.

    Fails when a subgroup key or code occurs twice.
    """
    require(subgroups, ["SubgroupKey", "SubgroupCode", "ProgramName", "ProgramFamily"], "subgroup table")
    rows = subgroups.withColumns({
        "SubgroupCode": text.drop_float_suffix("SubgroupCode"),
        "ProgramName": text.null_words("ProgramName", any_case=True),
        "ProgramFamily": text.null_words("ProgramFamily", any_case=True),
    })
    rows = rows.withColumn(
        "ProgramFamily", F.coalesce(F.upper("ProgramFamily"), text.program_family("ProgramName", upper=True))
    )
    by_family = text.study_program("ProgramFamily", longest_first=longest_first)
    by_name = text.study_program("ProgramName", longest_first=longest_first)
    rows = rows.withColumn("StudyProgram", F.coalesce(by_family, by_name))
    it = F.lit(False)
    for c in ("ProgramName", "ProgramFamily", "StudyProgram"):
        it = it | F.coalesce(text.contains_any(F.upper(F.col(c)), text.IT_PATTERNS), F.lit(False))
    rows = rows.withColumns({
        "IsIT": it,
        "ProgramInformationLevel": F.when(F.col("ProgramName").isNotNull(), "ExactProgramName")
        .when(F.col("ProgramFamily").isNotNull(), "ProgramFamilyOnly")
        .otherwise("Unknown"),
    })
    return reorder(unique_on(unique_on(rows, ["SubgroupKey"], "subgroups"), ["SubgroupCode"], "subgroups"), PREFERRED)


def unknown_programs(attributes: DataFrame) -> DataFrame:
    return attributes.where("StudyProgram is null")


# --- reconciliation with a reference list -----------------------------------------------


def reference_programs(reference: DataFrame) -> DataFrame:
    """Cleaned reference list."""
    require(reference, ["SUBGROEPID", "SUBGROEPCODE"], "reference list")
    return reference.select(
        text.clean_identifier(F.col("SUBGROEPID").cast("string")).alias("SubgroupCode"),
        text.clean_program_name("SUBGROEPCODE").alias("ReferenceProgramName"),
    ).dropna()


def reference_conflicts(reference: DataFrame) -> DataFrame:
    """Reference rows whose id carries more than one name; must be empty."""
    return duplicate_rows(reference.distinct(), ["SubgroupCode"])


def reconcile(generated: DataFrame, reference: DataFrame) -> DataFrame:
    """Full outer comparison; every row has exactly one status.

    Fails when the reference contradicts itself or the generated list repeats a code.
    """
    ref = unique_on(reference_programs(reference).distinct(), ["SubgroupCode"], "reference list")
    rows = generated.withColumns({
        "SubgroupCode": text.clean_identifier(F.col("SubgroupCode").cast("string")),
        "ProgramName": text.clean_program_name("ProgramName"),
    })
    both = outer_compare(unique_on(rows, ["SubgroupCode"], "generated list"), ref, ["SubgroupCode"])
    same = F.upper(text.squish("ProgramName")) == F.upper(text.squish("ReferenceProgramName"))
    status = (
        F.when(F.col("Side") == "right_only", "only_reference")
        .when(F.col("Side") == "left_only", "only_generated")
        .when(F.col("ProgramName").isNull(), "can_fill")
        .when(same, "match")
        .otherwise("conflict")
    )
    return both.withColumn("Status", status).drop("Side")


def fill_from_reference(compared: DataFrame, overwrite_conflicts: bool = False) -> DataFrame:
    """The generated list with names filled, and on request replaced, from the reference."""
    rows = compared.where("Status <> 'only_reference'")
    extras = {}
    if "InferenceConfidence" in rows.columns:
        extras["InferenceConfidence"] = F.lit(1.0)
    if "InferenceEvidenceCount" in rows.columns:
        extras["InferenceEvidenceCount"] = F.lit(None).cast("bigint")
    filled = fill_with_source(
        rows, "ProgramName", F.col("ReferenceProgramName"), "ProgramNameSource", FROM_REFERENCE, extras
    )
    if overwrite_conflicts:
        conflict = F.col("Status") == "conflict"
        changed = {
            "ProgramName": F.when(conflict, F.col("ReferenceProgramName")).otherwise(F.col("ProgramName")),
            "ProgramNameSource": F.when(conflict, FROM_OVERRIDE).otherwise(F.col("ProgramNameSource")),
        }
        if "InferenceConfidence" in rows.columns:
            changed["InferenceConfidence"] = F.when(conflict, 1.0).otherwise(F.col("InferenceConfidence"))
        filled = filled.withColumns(changed)
    return filled.drop("ReferenceProgramName", "Status")


def coverage(compared: DataFrame) -> DataFrame:
    """Counts per status and the share of known names before and after filling."""
    generated = F.col("Status") != "only_reference"
    named = generated & F.col("ProgramName").isNotNull()
    return compared.agg(
        F.count_if(generated).alias("Generated"),
        *[F.count_if(F.col("Status") == s).alias(s) for s in
          ("match", "can_fill", "conflict", "only_reference", "only_generated")],
        F.count_if(generated & F.col("ProgramName").isNull()).alias("MissingBefore"),
        (F.count_if(named) * 100.0 / F.count_if(generated)).alias("CoverageBefore"),
        ((F.count_if(named) + F.count_if(F.col("Status") == "can_fill")) * 100.0 / F.count_if(generated)).alias(
            "CoverageAfter"
        ),
    )
