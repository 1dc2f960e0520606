"""Exact, reproducible train/test splits and heads, without sorting the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillhouse.operators.lookup import lookup

SEED = 42
# The split-size rule.
DEFAULT_TEST_SIZE = 0.2
MAX_TEST_SIZE = 0.5

DIGITS = 3


def test_size(total: Column, eval_samples: Column | int | None, default: float = DEFAULT_TEST_SIZE,
              largest: float = MAX_TEST_SIZE) -> Column:
    """Share of the test split: enough for ``eval_samples``, between ``default`` and ``largest``."""
    wanted = (F.lit(eval_samples) if not isinstance(eval_samples, Column) else eval_samples).cast("double")
    share = F.least(F.lit(largest), F.greatest(F.lit(default), wanted / F.nullif(total, F.lit(0)).cast("double")))
    return F.when((total > 0) & (wanted > 0), share).otherwise(F.lit(default))


def train_rows(size: Column | float) -> Callable[[Column], Column]:
    """int(n * (1 - test_size)), in double arithmetic."""
    keep = F.lit(1.0) - size if isinstance(size, Column) else F.lit(1 - size)
    return lambda total: (total.cast("double") * keep).cast("bigint")


def split_key(record: Column, seed: int = SEED) -> Column:
    """Position of a record in the shuffled order: depends on the seed and the record only. Nulls share one."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(record.cast("string"), F.lit("\0"))))


def _bucket_of_rank(counts: DataFrame, groups: list[str], rank: Column) -> DataFrame:
    """The bucket that holds a rank, and the rank within it. At most 4,096 buckets per group."""
    upto = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups)
    table = counts.withColumn("upto", F.sum("n").over(upto))
    if "total" not in counts.columns:
        table = table.withColumn("total", F.sum("n").over(whole))
    return (
        table.withColumn("rank", rank)
        .filter((F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")))
        .select(*groups, "bucket", "total", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    )


def cut_points(df: DataFrame, record: str, groups: list[str], take: Callable[[Column], Column],
               seed: int = SEED) -> DataFrame:
    """(groups, cut_key, cut_record): the last record of the first ``take(total)`` in shuffled order.

    Two rounds of counting by three hex digits of the key narrow each group to one bucket of
    about n / 16.7 million rows, and only those rows are ranked. Groups of which nothing is taken
    have no row here. Records are unique within a group.
    """
    keyed = df.select(*groups, F.col(record).alias("record"), split_key(F.col(record), seed).alias("key"))

    first = keyed.groupBy(*groups, F.substring("key", 1, DIGITS).alias("bucket")).agg(F.count("*").alias("n"))
    coarse = _bucket_of_rank(first, groups, take(F.col("total")))
    inside = lookup(keyed.withColumn("bucket", F.substring("key", 1, DIGITS)), coarse, [*groups, "bucket"], "inner")

    second = inside.groupBy(*groups, "total", "rank", F.substring("key", 1, 2 * DIGITS).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    second = second.withColumnRenamed("rank", "wanted")
    fine = _bucket_of_rank(second, groups, F.col("wanted"))
    rows = lookup(
        keyed.withColumn("bucket", F.substring("key", 1, 2 * DIGITS)), fine, [*groups, "bucket"], "inner"
    )
    order = Window.partitionBy(*groups).orderBy("key", "record")
    return (
        rows.withColumn("at", F.row_number().over(order))
        .filter(F.col("at") == F.col("rank"))
        .select(*groups, F.col("key").alias("cut_key"), F.col("record").alias("cut_record"))
    )


def _before_cut(df: DataFrame, record: str, groups: list[str], take: Callable[[Column], Column],
                seed: int) -> DataFrame:
    """Adds boolean ``__before``: the record is among the first ``take(total)`` of its group."""
    spread = groups or ["__all"]
    rows = df if groups else df.withColumn("__all", F.lit(0))
    cuts = cut_points(rows, record, spread, take, seed)
    joined = lookup(rows, cuts, spread)
    key = split_key(F.col(record), seed)
    upto = F.coalesce(F.col(record) <= F.col("cut_record"), F.col(record).isNull() & F.col("cut_record").isNull())
    before = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & upto)
    marked = joined.withColumn("__before", F.coalesce(before, F.lit(False))).drop("cut_key", "cut_record")
    return marked if groups else marked.drop("__all")


def split_exactly(df: DataFrame, record: str, groups: list[str] | None = None,
                  size: float | None = None, eval_samples: int | None = None, seed: int = SEED) -> DataFrame:
    """Adds ``split``: 'train' for the first int(n * (1 - size)) records of each group, else 'test'.

    Without ``size`` the size rule applies to each group's total. The rows are not shuffled: the
    final step compares each key with its group's cut. Rows that share a record id, or have none, share a side.
    """
    def take(total: Column) -> Column:
        share = size if size is not None else test_size(total, eval_samples)
        return train_rows(share)(total)

    marked = _before_cut(df, record, groups or [], take, seed)
    return marked.withColumn("split", F.when(F.col("__before"), "train").otherwise("test")).drop("__before")


def head(df: DataFrame, record: str, n: int | None, groups: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """The first ``n`` records of each group in shuffled order; 0 or None keeps all.

    Files have no order in Spark, so the split order stands in for it. Rows that share a record id (or have none)
    share a place, so they are taken together: ``n`` can then be passed by the last id's repeats.
    """
    if not n:
        return df
    marked = _before_cut(df, record, groups or [], lambda total: F.least(total, F.lit(n)), seed)
    return marked.filter("__before").drop("__before")


def spot_check(df: DataFrame, record: str, groups: list[str], n: int = 50, seed: int = SEED) -> DataFrame:
    """A reproducible review sample of ``n`` records per group."""
    return head(df, record, n, groups, seed)


def check_split(df: DataFrame, record: str, groups: list[str]) -> DataFrame:
    """Per group: totals, sizes, and how many records are in both splits (must be 0)."""
    in_train, in_test = F.col("split") == "train", F.col("split") == "test"
    by_record = df.groupBy(*groups, record).agg(
        F.count("*").alias("n"),
        F.count_if(in_train).alias("train"),
        F.count_if(in_test).alias("test"),
    )
    return by_record.groupBy(*groups).agg(
        F.sum("n").alias("total"),
        F.sum("train").alias("train"),
        F.sum("test").alias("test"),
        F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("in_both"),
    )


# How many examples a kind of task needs.
SUFFICIENT = {"single_label": (200, 1000), "json": (500, 2000), "free_text": (1000, 5000)}


def sufficiency(df: DataFrame, output_format: Column, task: str = "task") -> DataFrame:
    """Per task: number of examples and whether it is below, within or above the usual range."""
    low = F.coalesce(*[F.when(F.col("output_format") == k, v[0]) for k, v in SUFFICIENT.items()])
    high = F.coalesce(*[F.when(F.col("output_format") == k, v[1]) for k, v in SUFFICIENT.items()])
    return (
        df.groupBy(F.col(task), output_format.alias("output_format"))
        .agg(F.count("*").alias("examples"))
        .withColumn(
            "verdict",
            F.when(F.col("examples") < low, "too few").when(F.col("examples") <= high, "enough").otherwise("plenty"),
        )
    )
