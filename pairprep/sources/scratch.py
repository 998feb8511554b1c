"""Intermediate tables, in the shared folder that the cluster names."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The configured shared folder; a temporary one only on a local master without a setting."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"pairprep-{application}-")


_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [x.getPath().getName() for x in found]


def clean_up(spark: SparkSession) -> None:
    """Remove all intermediate tables of this driver; for the end of a job, when its results are
    written and nothing that was read from them is used any more."""
    while _made:
        remove(spark, _made.pop())


def made() -> int:
    """Intermediate tables that are there, for `forget`."""
    return len(_made)


def forget(spark: SparkSession, before: int, but: tuple[str, ...] = ()) -> None:
    """Remove the tables made since `before`, except those with the names in `but`: for the end of an
    operator whose result no longer reads them."""
    gone = [p for p in _made[before:] if p.rpartition("/")[2].rpartition("-")[0] not in but]
    for path in gone:
        _made.remove(path)
        remove(spark, path)


def write_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    path = fresh_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executor
    loss, and lets later passes read only the columns they need."""
    path = write_table(df, name, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
