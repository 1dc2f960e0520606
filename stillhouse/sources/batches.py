"""Batches of rows for Python whose bytes are bounded, as texts may be of any length."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

SLICE = 1000
# Spark fills a batch for Python with up to 10,000 rows, whatever their length; this bounds its bytes as well.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand batches of ``BATCH_BYTES`` at most to Python."""
    usual = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, usual)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what a task's Python holds of long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
