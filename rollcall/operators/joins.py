"""Joins with a stated cardinality, lookups and interval joins.

No join here carries a broadcast hint: Spark broadcasts a side only after it has seen
its size (file statistics at planning, shuffle statistics at run time) and otherwise
shuffles both sides, splitting skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.clock import whole
from rollcall.operators.dedupe import keep_one


def unique_on(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The same rows; the query fails when a key occurs twice.

    One aggregation with a map-side combine, checked inside the running job, so nothing
    is counted ahead of time.  Columns pass one by one, so those that nobody reads aren't shuffled.
    """
    others = [F.any_value(c).alias(c) for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(*others, F.count(F.lit(1)).alias("_n"))
    checked = grouped.where(
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{what}: key {keys} is not unique")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return checked.select(*df.columns)


def validated_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", validate: str = "m:1"
) -> DataFrame:
    """Join that fails at run time when a side breaks the stated cardinality."""
    one_left, one_right = (side == "1" for side in validate.split(":"))
    if one_left:
        left = unique_on(left, on, "left side")
    if one_right:
        right = unique_on(right, on, "right side")
    return left.join(right, on, how)


def lookup(
    df: DataFrame, table: DataFrame, on: dict[str, str], order: list[str], take: list[str]
) -> DataFrame:
    """Left lookup; of several table rows with one key the first by ``order`` counts."""
    keys = list(on.values())
    single = keep_one(table.select(*dict.fromkeys([*keys, *take, *order])), keys, order)
    renamed = single.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c) for c in take]
    )
    condition = reduce(
        lambda a, b: a & b, [df[c] == renamed[f"_k{i}"] for i, c in enumerate(on)]
    )
    return df.join(renamed, condition, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def first_filled_lookup(
    df: DataFrame, table: DataFrame, columns: list[str], value: str, default: Column, out: str
) -> DataFrame:
    """Key of the first column whose (column, value) pair is in the table, else default.

    A filled value the table does not know falls through to the next column.  One join
    answers all columns: the candidates are unpivoted, looked up together, and the
    lowest position that matched is kept per distinct combination of values.
    """
    combos = df.select(*columns).distinct()
    ranked = combos.withColumn("_combo", F.struct(*columns)).select(
        "_combo",
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("rank"), F.lit(c).alias("column"), F.trim(F.col(c)).alias("value"))
                for i, c in enumerate(columns)
            ])
        ).alias("_try"),
    ).where(F.col("_try.value") != "")
    known = table.where(F.col("SourceValue") != "").select(
        F.col("SourceColumn").alias("_c"), F.col("SourceValue").alias("_v"), F.col(value).alias("_key")
    )
    hits = ranked.join(
        known, (F.col("_try.column") == F.col("_c")) & (F.col("_try.value") == F.col("_v"))
    )
    best = hits.groupBy("_combo").agg(F.min_by("_key", "_try.rank").alias("_best"))
    best = best.select(*[F.col(f"_combo.{c}").alias(f"_x_{c}") for c in columns], "_best")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(best[f"_x_{c}"]) for c in columns])
    return (
        df.join(best, same, "left")
        .withColumn(out, F.coalesce(F.col("_best"), default))
        .drop("_best", *[f"_x_{c}" for c in columns])
    )


def code_lookup(df: DataFrame, table: DataFrame, code: str, table_code: str, take: str) -> DataFrame:
    """Exact code, else the code without dots; the lowest key of equal codes counts."""
    exact = table.groupBy(F.col(table_code).alias("_exact")).agg(F.min(take).alias("_by_exact"))
    loose = table.groupBy(F.replace(F.col(table_code), F.lit("."), F.lit("")).alias("_loose")).agg(
        F.min(take).alias("_by_loose")
    )
    return (
        df.join(exact, df[code] == exact["_exact"], "left")
        .join(loose, F.replace(F.col(code), F.lit("."), F.lit("")) == loose["_loose"], "left")
        .withColumn(take, F.coalesce("_by_exact", "_by_loose"))
        .drop("_exact", "_by_exact", "_loose", "_by_loose")
    )


def only_new(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return df.join(known.select(*on), on, "left_anti")


def only_known(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return df.join(known.select(*on), on, "left_semi")


def outer_compare(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join with the side each row came from: both, left_only, right_only."""
    a = left.withColumn("_in_left", F.lit(True))
    b = right.withColumn("_in_right", F.lit(True))
    side = (
        F.when(F.col("_in_left") & F.col("_in_right"), "both")
        .when(F.col("_in_left"), "left_only")
        .otherwise("right_only")
    )
    return a.join(b, on, "full").withColumn("Side", side).drop("_in_left", "_in_right")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: list[str],
    at: str,
    start: str,
    end: str,
    bucket: int = 3600,
) -> DataFrame:
    """Pairs with ``start <= at <= end`` among rows that agree on ``on``.

    The time axis is cut into buckets and the bucket joins the equality keys: a point
    has one bucket, an interval one row per bucket it touches, so each pair is found
    once.  The join stays a hash or merge join, its keys split a busy day or group by
    hour, and candidates are limited to one bucket.
    """
    p = points.withColumn("_bucket", whole(F.col(at), bucket))
    i = intervals.where(F.col(start) <= F.col(end)).withColumn(
        "_bucket",
        F.explode(F.sequence(whole(F.col(start), bucket), whole(F.col(end), bucket))),
    )
    return p.join(i, [*on, "_bucket"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_bucket")


def align_to(spine: DataFrame, df: DataFrame, on: list[str], drop_empty: list[str] | None = None) -> DataFrame:
    """Rows in the given key list; keys whose listed columns are all null are dropped."""
    out = spine.join(df, on, "left")
    return out.dropna(how="all", subset=drop_empty) if drop_empty else out
