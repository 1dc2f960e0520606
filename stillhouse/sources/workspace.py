"""Where jobs keep intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_fallback: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (a ``local`` master, as in tests) gets a temporary folder of this
    process; any other raises, as its executors would each write to a disk of their own.
    """
    named = spark.sparkContext.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="stillhouse-")
    return _fallback[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the workspace and read back: computed once, with a size Spark knows when it plans joins."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
