"""Session settings and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open_scopes: list[list[str]] = []
#: Files of partitions that a task writes side by side, without sorting its rows; with more it sorts the rest.
OPEN_FILES = 32


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: naive UTC time, adaptive, skew-aware execution and writes by partition that need
    no sort."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    return spark


def hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, one per application: below spark.checkpoint.dir, else below the
    checkpoint folder of the context, else below the warehouse, where it goes when the application ends.
    """
    app = spark.conf.get("spark.app.id", "local")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        of_context = spark._jsc.sc().getCheckpointDir()
        base = of_context.get() if of_context.isDefined() else None
    if base:
        return f"{base.rstrip('/')}/batchlens-{app}"
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch/batchlens-{app}"
    system, folder = hadoop_path(spark, path)
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _open_scopes[-1:]:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables that were made within it; what leaves it must be written by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            system, folder = hadoop_path(spark, path)
            system.delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once no DataFrame needs them any more."""
    system, folder = hadoop_path(spark, scratch_dir(spark))
    system.delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the scratch folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives the optimizer the true size
    of the table, so that a join with it is broadcast only when it is below
    spark.sql.autoBroadcastJoinThreshold and shuffles (with skew handling) otherwise.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
