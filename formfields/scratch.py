"""Tables written on the way: they cut a plan in two, survive lost executors, and are deleted when nobody reads them any more."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders of written tables that are still there, by application.
_written: dict[str, dict[str, None]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a session in one process (local[...]) makes its own; others have no folder that executors elsewhere can read, and must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.formfields.shared.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.formfields.shared.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table into the shared folder and read it again. Survives lost executors.

    Whoever has no more use for it passes it to `dropped`; what a returned DataFrame still reads stays until `clear_written`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, {})[path] = None
    held = spark.read.schema(df.schema).parquet(path)
    held.written_at = path
    return held


def dropped(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more. Spark's own file system does it, so the folder may be in any store."""
    for df in tables:
        _delete(df.sparkSession, df.written_at)


def clear_written(spark: SparkSession) -> int:
    """Delete all tables that this application has written: for when its results are used up. How many there were."""
    paths = list(_written.get(spark.sparkContext.applicationId, {}))
    for path in paths:
        _delete(spark, path)
    return len(paths)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that are written within: for results that are used up there."""
    before = set(_written.get(spark.sparkContext.applicationId, {}))
    try:
        yield
    finally:
        for path in [p for p in _written.get(spark.sparkContext.applicationId, {}) if p not in before]:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _written.get(spark.sparkContext.applicationId, {}).pop(path, None)
