"""Looking at folders through Spark's own file systems, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, sorted; none if it does not exist."""
    system, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all that is in it."""
    system, where = _at(spark, path)
    system.delete(where, True)
