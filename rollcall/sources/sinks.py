"""Writers.  Each writes from the executors and returns the paths it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall.operators.joins import only_new


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "error") -> str:
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)
    return path


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    if partition_by:
        clustered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)
    return path


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a partition value side by side, so a task writes few files.

    A rebalance, not a repartition: Spark merges small values and splits large ones.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> str:
    """Overwrite the partitions that occur in ``df`` and no other."""
    writer = clustered(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _folder(spark, path)
    return store.exists(place)


def drop_partitions(spark: SparkSession, path: str, key: str, values: list) -> None:
    """Remove whole partitions of a table; those that aren't there are none the worse."""
    for value in values:
        place, store = _folder(spark, f"{path}/{key}={value}")
        store.delete(place, True)


def reload(df: DataFrame, path: str) -> str:
    """Replace the whole table.  ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)
    return path


def append_new(df: DataFrame, known: DataFrame, on: list[str], path: str) -> str:
    """Append the rows whose key is not known yet."""
    return append(only_new(df.dropDuplicates(on), known, on), path)


def split_write(df: DataFrame, keep: Column, good_path: str, bad_path: str) -> tuple[str, str]:
    """Rows that meet the condition, and all others; an unknown condition is no."""
    flag = F.coalesce(keep, F.lit(False))
    write_csv(df.where(flag), good_path)
    write_csv(df.where(~flag), bad_path)
    return good_path, bad_path


def snapshot(df: DataFrame, path: str, batch_time: str) -> str:
    """One folder per poll; a repeated batch replaces its own folder only."""
    target = f"{path}/batch={batch_time}"
    df.write.mode("overwrite").parquet(target)
    return target


# columns that identify a person
PRIVATE_COLUMNS = {"UserKey", "UserName", "EMAIL", "NAAM", "username", "email"}


def export_aggregates(df: DataFrame, columns: list[str], path: str, allow_private: bool = False) -> str:
    """Write the listed columns; columns that identify a person need the flag."""
    private = sorted(PRIVATE_COLUMNS & set(columns))
    if private and not allow_private:
        raise ValueError(f"{', '.join(private)} may not leave without allow_private=True")
    return write_csv(df.select(*columns), path, sep=",")


def merge_documents(students: DataFrame, path: str) -> str:
    """All student rows as JSON lines, duplicates kept."""
    students.write.json(path, ignoreNullFields=False)
    return path
