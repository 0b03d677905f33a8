"""What the operators share: word patterns, input columns and ordered ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.session import stored

#: white space that separates words: space and the controls 9 to 13
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def texts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns in ``keep`` and the text, null as empty.  Other columns go, so no name can clash."""
    return docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias(text))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """All runs of characters that are not white space, in order; an empty array without any."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def word_count(text: Column) -> Column:
    inner = trimmed(text)
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE + "+"))).cast("long")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def in_ranges(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows, written once, with ``__range``: ranges follow each other in ``order``.

    Sampled split points differ between evaluations, so the number of a row's range is
    stored with it.  Ranges are as many as Spark's shuffle partitions make them.
    """
    return stored(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)


def running_before(rows: DataFrame, group: str, order: list[Column], amount: str, name: str) -> DataFrame:
    """Adds ``__before``: the sum of ``amount`` over the earlier rows of the same group.

    ``group`` may be null and may hold any share of all rows: sums run inside sorted
    ranges, and only one total for each (group, range) passes on to later ranges.
    """
    ranged = in_ranges(rows, [F.col(group).asc_nulls_last(), *order], name)
    totals = ranged.groupBy(group, "__range").agg(F.sum(amount).alias("__sum"))
    earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(group).alias("__g"), F.col("__range").alias("__r"),
                            F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = local.join(offsets, local[group].eqNullSafe(offsets["__g"]) & (local["__range"] == offsets["__r"]))
    return joined.withColumn("__before", F.col("__offset") + F.col("__inside")).drop("__g", "__r", "__range", "__offset", "__inside")
