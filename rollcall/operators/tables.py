"""Table changes as pure functions (target, source) -> new target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.joins import only_known, only_new


def upsert(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key, nulls included."""
    kept = only_new(target, source, on)
    return kept.unionByName(source.select(*target.columns))


def upsert_keep_key(target: DataFrame, source: DataFrame, on: str, key: str) -> DataFrame:
    """Upsert on a business code; a known code keeps the surrogate key it has."""
    old = target.select(F.col(on).alias("_code"), F.col(key).alias("_old"))
    keyed = (
        source.join(old, source[on] == old["_code"], "left")
        .withColumn(key, F.coalesce("_old", key))
        .drop("_code", "_old")
    )
    return upsert(target, keyed, [on])


def insert_missing(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    fresh = only_new(source.select(*target.columns).dropDuplicates(on), target, on)
    return target.unionByName(fresh)


def replace_columns(target: DataFrame, values: DataFrame, on: list[str], columns: dict[str, Column]) -> DataFrame:
    """Left join with aggregates and new values for the named columns."""
    order = list(target.columns)
    joined = target.join(values, on, "left").withColumns(columns)
    return joined.select(*order, *[c for c in columns if c not in order])


def keep_referenced(fact: DataFrame, dimension: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a known key, one-row count of the dropped rows)."""
    known = dimension.select(key).distinct()
    dropped = fact.join(known, key, "left_anti").agg(F.count(F.lit(1)).alias("DroppedRows"))
    return only_known(fact, known, [key]), dropped


def guarded_delete(
    dimension: DataFrame, keep: DataFrame, code: str, key: str, fact: DataFrame
) -> dict[str, DataFrame]:
    """Delete dimension rows whose code is not in ``keep``, unless facts still use them.

    The guard runs inside the plan: ``result`` is the reduced table when no fact refers
    to a row to delete, and the unchanged table otherwise.
    """
    code_text = F.trim(F.col(code).cast("string"))
    allowed = keep.select(F.trim(F.col(code).cast("string")).alias("_code")).distinct()
    marked = dimension.withColumn("_code", code_text)
    doomed = marked.join(allowed, "_code", "left_anti").drop("_code")
    kept = marked.join(allowed, "_code", "left_semi").drop("_code")
    problems = fact.join(doomed.select(key, code, "ClassName"), key)
    summary = problems.groupBy(key, code, "ClassName").agg(F.count(F.lit(1)).alias("LectureCount"))
    blocked = problems.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    result = kept.unionByName(doomed.where(blocked > 0))
    report = doomed.agg(F.count(F.lit(1)).alias("ToDelete")).withColumns({
        "BlockingFactRows": blocked,
        "Deleted": F.when(blocked > 0, F.lit(0)).otherwise(F.col("ToDelete")).cast("bigint"),
    })
    return {"result": result, "summary": summary, "problems": problems, "report": report}


def violations(df: DataFrame, name: str, condition: Column) -> DataFrame:
    return df.where(F.coalesce(~condition, F.lit(True))).agg(F.count(F.lit(1)).alias("Violations")).select(
        F.lit(name).alias("Constraint"), "Violations"
    )


def key_violations(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        .agg(F.count(F.lit(1)).alias("Violations"))
        .select(F.lit(name).alias("Constraint"), "Violations")
    )


def reference_violations(df: DataFrame, name: str, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    known = dimension.select(F.col(dimension_key).alias("_k")).distinct()
    return (
        df.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_k"), "left_anti")
        .agg(F.count(F.lit(1)).alias("Violations"))
        .select(F.lit(name).alias("Constraint"), "Violations")
    )


def validity_columns(df: DataFrame, since: Column) -> DataFrame:
    """ValidFrom, ValidTo and IsCurrent as they are set at insert."""
    return df.withColumns({
        "ValidFrom": since, "ValidTo": F.lit(None).cast("timestamp_ntz"), "IsCurrent": F.lit(True),
    })
