"""Records of delimited text: where quoted line breaks are, found in parallel.

A line leaves the state "inside a quoted cell" or "outside" behind, depending on the state it
begins in.  So each line is one of four functions of that state, and functions can be put together in any
grouping: first over the lines of a split, then over the splits of a file, at last over the lines of
those splits that have a quoted line break at all.  No task reads a file from its beginning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and split; ``at`` grows in reading order inside a split."""
    return spark.read.text(path).select(
        F.regexp_replace("value", "^\\ufeff|\\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )


def _quoted(sep: str) -> tuple[str, str]:
    """Patterns of a quoted cell's inside up to its closing quote, and of all closed cells of a line from its beginning on."""
    inside = r'[^"]*+(?:""[^"]*+)*+"'
    other = f"[^{sep}]"
    return inside, f'(?:"{inside}{other}*+{sep}|[^"{sep}]{other}*+{sep}|{sep})*+'


def ends_inside(line: Column, sep: str, begins_inside: bool) -> Column:
    """Whether a quoted cell is open at the end of the line; a quote opens a cell only where the cell begins."""
    inside, closed = _quoted(sep)
    opened = r'"[^"]*+(?:""[^"]*+)*+$'
    if not begins_inside:
        return line.rlike(f"^{closed}{opened}")
    # the cell goes on to the end, or is closed and another one is open there
    return ~line.rlike(f"^{inside}") | line.rlike(f"^{inside}[^{sep}]*+{sep}{closed}{opened}")


def _by_separator(seps: str, make) -> Column:
    """Patterns take the separator as a constant: one expression for each."""
    return F.coalesce(*[F.when(F.col("sep") == c, make(c)) for c in seps])


def count_fields(line: Column, sep: str) -> Column:
    bare = F.regexp_replace(line, f'(^|{sep})"{_quoted(sep)[0]}', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _after(state: Column, line: Column) -> Column:
    """The state that a line leaves behind: 1 inside a quoted cell, 0 outside."""
    return F.when(state == 1, line["inside"]).otherwise(line["outside"])


def open_splits(typed: DataFrame) -> DataFrame:
    """``file, split, begins`` of the splits in which a cell is open at some line's end or beginning.

    The lines with quotes of a split are put together to one function, and those of the splits before it give
    the state that it begins in.
    """
    quoted = F.when(F.col("line").contains('"'), F.struct("at", F.col("f.outside").alias("outside"), F.col("f.inside").alias("inside")))
    unchanged = F.struct(F.lit(0).alias("outside"), F.lit(1).alias("inside"))
    put_together = lambda s, x: F.struct(_after(s["outside"], x).alias("outside"), _after(s["inside"], x).alias("inside"))
    splits = typed.groupBy("file", "split").agg(F.array_sort(F.collect_list(quoted)).alias("_lines"), F.max("f.outside").alias("opens"))
    splits = splits.select("file", "split", "opens", F.aggregate("_lines", unchanged, put_together).alias("f"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.aggregate(F.collect_list("f").over(earlier), F.lit(0), _after)
    return splits.withColumn("begins", begins).where("opens = 1 OR begins = 1").select("file", "split", "begins")


def records(lines: DataFrame, seps: str) -> DataFrame:
    """``file, source_file, split, at, record``: lines (``lines_of`` with ``sep``) put together where a line break is quoted.

    Splits without an open cell pass on their lines as they are; only lines of the others are
    sorted, and only records of several lines are grouped.  ``split`` and ``at`` are those of the first line.  A
    cell that is open over a whole split is taken as a quote that is never closed, and the query fails.
    """
    outside, inside = (_by_separator(seps, lambda c, b=b: ends_inside(F.col("line"), c, b).cast("int")) for b in (False, True))
    has_quote = F.col("line").contains('"')
    function = F.struct(F.when(has_quote, outside).otherwise(0).alias("outside"), F.when(has_quote, inside).otherwise(1).alias("inside"))
    typed = lines.withColumn("f", function)
    marked = typed.join(open_splits(typed), ["file", "split"], "left")
    place = ["file", "source_file", "split", "at"]
    plain = marked.where("begins IS NULL").select(*place, F.col("line").alias("record"))

    # a line either ends in one state whatever it begins in, or keeps the state, or swaps it
    constant = F.col("f.outside") == F.col("f.inside")
    swaps = ((F.col("f.outside") == 1) & (F.col("f.inside") == 0)).cast("int")
    ordered = Window.partitionBy("file", "split").orderBy("at")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rest = marked.where("begins IS NOT NULL").withColumns({
        "_known": F.coalesce(F.last(F.when(constant, F.col("f.outside")), ignorenulls=True).over(before), F.col("begins")),
        "_stretch": F.coalesce(F.count(F.when(constant, 1)).over(before), F.lit(0)),
        "_swaps": swaps,
    })
    since = Window.partitionBy("file", "split", "_stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    goes_on = (F.col("_known") + F.coalesce(F.sum("_swaps").over(since), F.lit(0))) % 2 == 1
    rest = rest.withColumn("_goes_on", goes_on)
    rest = rest.withColumn("_begun", F.last(F.when(~F.col("_goes_on"), F.struct("split", "at")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    # what a split begins with may belong to the last record of the one before it
    tails = rest.groupBy("file", "split").agg(F.max("_begun").alias("_tail")).withColumn("_tail", F.lag("_tail").over(Window.partitionBy("file").orderBy("split")))
    never = F.raise_error(F.concat(F.lit("a quoted cell is never closed in "), F.col("file"))).cast("struct<split:bigint,at:bigint>")
    rest = rest.join(tails, ["file", "split"]).withColumn("_begun", F.coalesce("_begun", "_tail", never))
    whole = rest.groupBy("file", "source_file", "_begun").agg(F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("_lines"))
    joined = whole.select("file", "source_file", "_begun.split", "_begun.at", F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("record"))
    return plain.unionByName(joined)
