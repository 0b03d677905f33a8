"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """First (or last) row per key.

    An aggregate with a map-side combine instead of a window: a key that holds a third
    of the table is reduced before the shuffle and never sorted in one task.
    """
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*others), F.struct(*order, *[c for c in others if c not in order]))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def with_group_size(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Rows per key mapped back to every row, by aggregate and join, not by window."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    renamed = sizes.select(*[F.col(k).alias(f"_g_{k}") for k in keys], out)
    same = None
    for k in keys:
        match = df[k].eqNullSafe(renamed[f"_g_{k}"])
        same = match if same is None else same & match
    return df.join(renamed, same, "left").drop(*[f"_g_{k}" for k in keys])


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every member of a group that occurs more than once; without keys, of rows equal in all columns."""
    if keys:
        return with_group_size(df, keys, "_copies").where("_copies > 1").drop("_copies")
    return with_group_size(same_digest(df), df.columns, "_copies").where("_copies > 1").drop("_copies")


def same_digest(df: DataFrame) -> DataFrame:
    """The rows whose digest over all columns occurs more than once: all repeated rows, and next to no other.

    Digests are counted instead of rows, and are short; whoever wants equal rows compares columns of what is left.
    """
    digest = F.xxhash64(*[F.col(c) for c in df.columns])
    repeated = df.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest")
    return df.withColumn("_own", digest).join(repeated, F.col("_own") == F.col("_digest"), "left_semi").drop("_own")
