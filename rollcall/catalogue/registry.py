"""Registration of queries together with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.catalogue.views import Views, with_views


@dataclass(frozen=True)
class Query:
    run: Callable[[Views], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(views)``; ``sql`` may name the shared views."""

    def add(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(fn, with_views(sql) if sql else None)
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at nine decimals, dates and times as text: the same value in any engine."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), 9)
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(QUERIES[name].run(Views(spark, sf_dir)))

    run.__name__ = name
    return run
