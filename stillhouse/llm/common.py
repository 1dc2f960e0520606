"""What the corpus operators share: tables kept in the shared folder, row keys, distributed numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stillhouse.sources.batches import BATCH_BYTES, BATCH_SETTING, SLICE, bounded_batches, sliced  # noqa: F401
from stillhouse.sources.workspace import new_folder

# Words are runs of anything but ASCII white space, as bytes.split() cuts them.
WORD = r"[^\x20\x09-\x0D]+"
ROW_BITS = 33


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage is cut, and values that depend on
    the order of evaluation stay fixed if an executor is lost. Meanwhile batches for Python have ``BATCH_BYTES`` at most."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row's whole content. Identical rows share them, so they share decisions."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*columns).alias("__k1"), F.xxhash64(F.lit(1), *reversed(columns)).alias("__k2")]


def numbered(df: DataFrame, order: list[Column], out: str, name: str = "numbered") -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... in the given order over the whole table.

    Range partitions are sorted and written with their row ids; a running sum over the number of
    rows per partition (one row for each) turns these into global numbers. No task sees all rows.
    """
    rows = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("__place", ROW_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    return (
        rows.withColumn("__part", part).join(parts, "__part")
        .withColumn(out, F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("__part", "__before", "__place")
    )
