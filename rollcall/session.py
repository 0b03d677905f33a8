"""Session settings and the scratch folder shared by all executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # joins and aggregates on a hot key are cut into several tasks at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

_LOCAL_SCRATCH: dict[str, str] = {}
_SHARED: set[tuple[str, str]] = set()


def build_session(app: str = "rollcall", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``, or by ``setCheckpointDir``; without either it is the
    warehouse, which Spark's own tables need all executors to share.  A path of the file system may be a mounted
    share, so a cluster tries it once (``_check_shared``) and is refused a folder of one machine.  Only a
    master of one process (``local``, ``local[n]``) gets a temporary folder.
    """
    master, app = spark.conf.get("spark.master"), spark.conf.get("spark.app.id")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", master):
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="rollcall-")
        return _LOCAL_SCRATCH[app]
    root = (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    on_disk = root.startswith("file:") or "://" not in root and _default_store(spark).startswith("file:")
    if on_disk and not master.startswith("local") and (app, root) not in _SHARED:
        _check_shared(spark, f"{root}/rollcall/{app}/shared-{uuid.uuid4().hex}")
        _SHARED.add((app, root))
    return root


def _check_shared(spark: SparkSession, path: str) -> None:
    """Fails unless every row that tasks write to ``path`` is read back by others."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        seen = spark.read.schema("id long").parquet(path).count()
    except Exception as e:
        raise RuntimeError(f"{path} can't be written and read by all executors") from e
    if seen != tasks:
        raise RuntimeError(f"executors don't share {path}; set spark.checkpoint.dir to a folder that they do")


def _default_store(spark: SparkSession) -> str:
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")


def run_folder(spark: SparkSession) -> str:
    """The part of the scratch folder that belongs to this application."""
    return f"{scratch_root(spark)}/rollcall/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the application's scratch folder; never handed out twice."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Removes what this application stored; call it before the session stops."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a table in the scratch folder.

    Cuts the lineage of rows that several jobs read, in a place that outlives executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
