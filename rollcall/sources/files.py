"""Readers of timetable exports, delimited files, parquet folders and student documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollcall import schemas
from rollcall.operators.columns import trim_headers
from rollcall.sources.documents import find_rows
from rollcall.sources.records import count_fields, lines_of, records


def _headers(lines: DataFrame, candidates: str, fallback: str) -> DataFrame:
    """Per file its header line, its separator (the most frequent candidate of the whole line) and its names."""
    heads = lines.where("split = 0").groupBy("file").agg(F.min_by("line", "at").alias("header"), F.min("at").alias("header_at"))
    count = lambda c: F.length("header") - F.length(F.replace(F.col("header"), F.lit(c), F.lit("")))
    # equal counts: the earlier candidate
    best = F.array_max(F.array(*[F.struct(count(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(candidates)]))
    heads = heads.withColumn("sep", F.when(best["n"] > 0, best["c"]).otherwise(F.lit(fallback)))
    return heads.withColumn(
        "names", F.transform(F.split("header", F.col("sep")), lambda n: F.trim(F.replace(F.trim(n), F.lit('"'), F.lit(""))))
    )


def _all_names(headers: DataFrame) -> list[str]:
    """The columns of all files: of the distinct headers, a handful, the longest first."""
    shapes = [r.names for r in headers.select("names").distinct().collect()]
    return list(dict.fromkeys(n for shape in sorted(shapes, key=lambda s: (-len(s), s)) for n in shape if n))


def _below_header(split: str):
    """Of the first split all lines but the first one; a later line that equals the header is a row."""
    return (F.col(split) != 0) | (F.col("at") != F.col("header_at"))


def _field(name: str, empty_is_null: bool):
    at = F.array_position("names", F.lit(name)).cast("int") - 1
    value = F.when(at >= 0, F.get("fields", at))
    return (F.when(value != "", value) if empty_is_null else value).alias(name)


def schedule_exports(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All timetable exports below a path as text columns, with the file of each row.

    Lines are split on the separator of their own file (``;``, or ``,`` where the header
    holds no ``;``), without quoting.  Lines with too many fields are dropped, short
    lines are filled with nulls, empty fields are null.  Columns go by the header of the
    file, so files may order or omit them.  Without ``columns`` all columns of all headers
    are read; only the distinct headers, a handful, come to the driver for that.
    """
    lines = lines_of(spark, path)
    headers = _headers(lines, ";", ",")
    names = columns or _all_names(headers)
    rows = lines.where(F.col("line") != "").join(headers, "file").where(_below_header("split"))
    rows = rows.withColumn("fields", F.split("line", F.col("sep"))).where(F.size("fields") <= F.size("names"))
    return rows.select(*[_field(n, True) for n in names], "source_file")


def delimited(spark: SparkSession, path: str, candidates: str = ";,\t", fallback: str = ";") -> DataFrame:
    """Delimited text with quoting; text columns, trimmed headers, no BOM.

    Each file is read by its own header line and separator, so the files of a folder may
    order or omit columns.  Quoted cells may hold separators, doubled quotes and line breaks (``records``).
    Records with too many fields go, short ones are filled with nulls, empty fields are null.
    """
    lines = lines_of(spark, path)
    headers = _headers(lines, candidates, fallback)
    names = _all_names(headers)
    if not names:
        raise ValueError(f"no header line under {path}")
    seps = "".join(dict.fromkeys([*candidates, fallback]))
    rows = records(lines.join(headers, "file").where(_below_header("split")).select(*lines.columns, "sep"), seps)
    rows = rows.where(F.col("record") != "").join(headers, "file")
    width = headers.agg(F.max(F.size("names"))).first()[0]
    schema = ", ".join(f"_{i} string" for i in range(width))
    # the parser takes its separator as a constant: one expression for each candidate
    of_sep = lambda make: F.coalesce(*[F.when(F.col("sep") == c, make(c)) for c in seps])
    rows = rows.where(of_sep(lambda c: count_fields(F.col("record"), c)) <= F.size("names"))
    parsed = of_sep(lambda c: F.from_csv("record", schema, {"sep": c, "escape": '"', "multiLine": "true"}))
    rows = rows.withColumn("parsed", parsed).withColumn("fields", F.array(*[F.col(f"parsed._{i}") for i in range(width)]))
    return rows.select(*[_field(n, False) for n in names])


def delimited_with_nulls(spark: SparkSession, path: str, sep: str, schema: T.StructType, tokens: list[str]) -> DataFrame:
    """Text columns whose cells equal to a token are null."""
    raw = trim_headers(spark.read.csv(path, sep=sep, header=True, schema=schema))
    return raw.select(*[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) for c in raw.columns])


def parquet_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def parquet_folder(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def student_documents(spark: SparkSession, path: str) -> DataFrame:
    """Student rows of all documents below a path, duplicates kept.

    The list of students is looked for in any wrapper (``find_rows``); files that aren't JSON or hold none are skipped.
    """
    docs = spark.read.text(path, wholetext=True).select(
        F.regexp_replace("value", "^\\ufeff", "").alias("doc"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file")
    )
    rows = find_rows(docs, ["file", "source_file"], "doc", "students", "EMAIL", f"struct<{schemas.STUDENT}>")
    return rows.select("row.*", "source_file").where("EMAIL is not null")


def lookup_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct non-null values of one column of a small CSV."""
    return delimited(spark, path, candidates=",;\t", fallback=",").select(column).dropna().distinct()


def table_query(spark: SparkSession, sql: str, args: dict, **tables: DataFrame) -> DataFrame:
    """A parametrised query over given frames; values are bound, never pasted in."""
    return spark.sql(sql, args=args, **tables)
