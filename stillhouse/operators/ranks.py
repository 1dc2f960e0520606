"""Exact order statistics per group by radix selection: counting, no sorting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillhouse.operators.lookup import matched
from stillhouse.sources.workspace import written

DIGIT = 16
BITS = 64
ALL_BUT_SIGN = (1 << 63) - 1


def _flipped(bits: Column) -> Column:
    """From the bits of doubles to longs that sort alike, and back."""
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(ALL_BUT_SIGN))).otherwise(bits)


def with_ordered_bits(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds a long that sorts as the double does: -0.0 as 0.0, NaN above all numbers."""
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col(value) + F.lit(0.0)).cast("bigint")
    return df.withColumn(out, bits).withColumn(out, _flipped(F.col(out)))


def from_ordered_bits(key: Column) -> Column:
    return F.call_function("reflect", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), _flipped(key)).cast("double")


def _digit_of_rank(counts: DataFrame, groups: list[str]) -> DataFrame:
    """For each (groups, name) the bucket that holds ``rank``, and the rank within it. 65,536 buckets at most."""
    upto = Window.partitionBy(*groups, "name").orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = counts.withColumn("upto", F.sum("c").over(upto))
    return table.filter((F.col("rank") > F.col("upto") - F.col("c")) & (F.col("rank") <= F.col("upto"))).select(
        *groups, "name", "n", "mean", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), F.col("next").alias("bucket")
    )


def exact_ranks(df: DataFrame, groups: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Per group: ``n``, ``mean`` and, per name in ``ranks``, the value at a 1-based rank of ``n``.

    The values are written once in a form whose bits sort as the doubles do. Each round counts them by ``DIGIT`` more
    bits, map-side first and only within the buckets that hold a wanted rank; after four rounds the bucket is the
    value. No task orders or holds values, whatever the size of a group or the number of its distinct values.
    Nulls are left out; NaN counts as larger than any number, and -0.0 as 0.0.
    """
    v = F.col(value).cast("double")
    data = written(with_ordered_bits(df.filter(v.isNotNull()).select(*groups, v.alias("v")), "v", "key"), "values")
    first = data.groupBy(*groups, F.shiftright("key", BITS - DIGIT).alias("next")).agg(F.count("*").alias("c"), F.sum("v").alias("s"))
    whole = Window.partitionBy(*groups)
    first = first.withColumns({"n": F.sum("c").over(whole), "mean": F.sum("s").over(whole) / F.sum("c").over(whole)})
    targets = F.array(*[F.struct(F.lit(k).alias("name"), rank(F.col("n")).alias("rank")) for k, rank in ranks.items()])
    wanted = written(_digit_of_rank(first.withColumn("t", F.explode(targets)).select(*groups, "next", "c", "n", "mean", "t.*"), groups), "ranks")
    for known in range(DIGIT, BITS, DIGIT):
        rows = data.select(*groups, F.shiftright("key", BITS - known).alias("bucket"), F.shiftright("key", BITS - known - DIGIT).alias("next"))
        inside = matched(rows, wanted.select(*groups, "bucket").distinct(), [*groups, "bucket"], "inner")
        counts = inside.groupBy(*groups, "bucket", "next").agg(F.count("*").alias("c"))
        wanted = written(_digit_of_rank(matched(counts, wanted, [*groups, "bucket"], "inner"), groups), "ranks")
    found = wanted.groupBy(*groups, "n", "mean").agg(*[F.max(F.when(F.col("name") == k, F.col("bucket"))).alias(k) for k in ranks])
    return found.select(*groups, "n", "mean", *[F.when(F.col(k).isNotNull(), from_ordered_bits(F.col(k))).alias(k) for k in ranks])
