"""Column-level operators: pick, check, rename, order, fill with provenance."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def drop_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def require(df: DataFrame, columns: list[str], what: str = "table") -> DataFrame:
    """Fail at plan time, naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])


def tag_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_name"))


def first_of_each_name(left: DataFrame, *others: DataFrame) -> list[str]:
    """Column names of a wide join, each once; the leftmost table wins."""
    seen: dict[str, None] = {}
    for frame in (left, *others):
        for name in frame.columns:
            seen.setdefault(name)
    return list(seen)


def join_first_wins(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join that leaves out right-hand columns whose name the left side has already."""
    fresh = [c for c in right.columns if c in on or c not in left.columns]
    return left.join(right.select(*fresh), on, how)


def reorder(df: DataFrame, preferred: list[str]) -> DataFrame:
    head = [c for c in preferred if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def typed_nulls(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})


def patch(df: DataFrame, key: str, key_value, column: str, value) -> DataFrame:
    """Set one column of the row with the given key."""
    return df.withColumn(column, F.when(F.col(key) == F.lit(key_value), F.lit(value)).otherwise(F.col(column)))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def to_number(df: DataFrame, columns: list[str], kind: str = "bigint") -> DataFrame:
    """Numbers from text, unreadable values null.

    Whole numbers go through a decimal so that ``12.0`` reads as 12 and big ids keep
    every digit.
    """

    def number(c: str) -> Column:
        text = F.trim(F.col(c).cast("string"))
        if kind in ("int", "bigint", "long"):
            return text.try_cast("decimal(38,6)").try_cast(kind)
        return text.try_cast(kind)

    return df.withColumns({c: number(c) for c in columns})


def blank_to_null(df: DataFrame, columns: list[str], tokens: list[str]) -> DataFrame:
    return df.withColumns(
        {c: F.when(F.trim(F.col(c)).isin(tokens), None).otherwise(F.col(c)) for c in columns}
    )


def find_column(df: DataFrame, aliases: list[str], required: bool = True) -> str | None:
    """The column whose letters and digits equal one of the aliases, case ignored."""

    def plain(name: str) -> str:
        return re.sub(r"[^a-z0-9]", "", name.lower())

    by_name = {plain(c): c for c in df.columns}
    for alias in aliases:
        if plain(alias) in by_name:
            return by_name[plain(alias)]
    if required:
        raise KeyError(f"none of {aliases} among {df.columns}")
    return None


def fill_with_source(
    df: DataFrame,
    column: str,
    candidate: Column,
    source_column: str,
    source: str,
    extras: dict[str, Column] | None = None,
    overwrite_when: Column | None = None,
) -> DataFrame:
    """Fill nulls of ``column`` from ``candidate`` and record where the value came from.

    ``extras`` are columns set on the filled rows only.  ``overwrite_when`` widens the
    rows that take the candidate.
    """
    take = F.col(column).isNull() & candidate.isNotNull()
    if overwrite_when is not None:
        take = take | F.coalesce(overwrite_when, F.lit(False))
    changed = {
        column: F.when(take, candidate).otherwise(F.col(column)),
        source_column: F.when(take, F.lit(source)).otherwise(F.col(source_column)),
    }
    for name, value in (extras or {}).items():
        changed[name] = F.when(take, value).otherwise(F.col(name))
    return df.withColumns(changed)
