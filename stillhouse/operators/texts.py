"""Work by distinct text: splits that keep equal texts together, leakage between splits, one question per text.

Equal means equal in canonical form (case, outer and repeated white space aside) for splits and leakage, and equal as it
stands for questions to a model. Hashes carry texts through the shuffles; wherever two different texts with one hash
could change a result, the texts themselves are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillhouse.functions.text import collapse_space, strip
from stillhouse.operators.labeling import IN_FLIGHT, Labeler, label_to_table
from stillhouse.operators.lookup import lookup
from stillhouse.operators.splitting import DIGITS, SEED, split_key, test_size, train_rows
from stillhouse.sources.workspace import written

TRAIN, TEST = 1, 2
# A text with more than a HOT-th of all rows is joined in parts; there are fewer than HOT of them.
HOT = 1000


def canonical(text: Column) -> Column:
    """The text by which records count as the same input; null stays null."""
    return F.lower(strip(collapse_space(text)))


# --- splits by group ------------------------------------------------------------------------------


def _bucket_of_weight(counts: DataFrame, groups: list[str]) -> DataFrame:
    """The bucket in which the running weight reaches ``target``, with the weight ``before`` it. 4,096 buckets per group at most."""
    upto = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = counts.withColumn("upto", F.col("before") + F.sum("n").over(upto))
    reached = (F.col("target") > F.col("upto") - F.col("n")) & (F.col("target") <= F.col("upto"))
    return table.filter(reached).select(*groups, "bucket", "target", (F.col("upto") - F.col("n")).alias("before"), "upto")


def group_cuts(weights: DataFrame, groups: list[str], take: Callable[[Column], Column]) -> DataFrame:
    """(groups, cut_key, cut_in): where the key order of ``weights`` (groups, key, n) is cut so that the weight before the cut is as
    close to ``take(total)`` as whole keys allow; of two equally close cuts the lower. Nothing is taken where there is no row.

    Two rounds sum weights by three more hex digits of the key each, a third looks at the keys that share all six
    (one in 16.7 million), so no step orders more than 4,096 sums of a group or its last few keys.
    """
    totals = weights.groupBy(*groups).agg(F.sum("n").alias("total"))
    start = totals.select(*groups, take(F.col("total")).alias("target"), F.lit(0).cast("bigint").alias("before"))
    found, seen = start, []
    for digits in (DIGITS, 2 * DIGITS, None):
        key = F.substring("key", 1, digits) if digits else F.col("key")
        inside = lookup(weights.withColumn("within", F.substring("key", 1, digits - DIGITS if digits else 2 * DIGITS)), found, [*groups, *seen], "inner")
        summed = inside.groupBy(*groups, "target", "before", key.alias("bucket")).agg(F.sum("n").alias("n"))
        found, seen = _bucket_of_weight(summed, groups).withColumnRenamed("bucket", "within"), ["within"]
    over, under = F.col("upto") - F.col("target"), F.col("target") - F.col("before")
    return found.select(*groups, F.col("within").alias("cut_key"), (over < under).alias("cut_in"))


def split_by_group(df: DataFrame, member: Column, groups: list[str] | None = None, size: float | None = None,
                   eval_samples: int | None = None, seed: int = SEED) -> DataFrame:
    """Adds ``split``; rows with the same ``member`` value (nulls are one value) are never on both sides.

    Members are ordered by a keyed hash and train takes those up to the cut that brings its rows closest to int(n *
    (1 - size)). Rows are summed per member once, map-side first, and written; the cut is found in these sums, and
    the rows themselves are only compared with it, so a member with a third of all rows costs no more than others.
    """
    names = groups or ["__all"]
    rows = df if groups else df.withColumn("__all", F.lit(0))
    weights = written(rows.groupBy(*names, split_key(member, seed).alias("key")).agg(F.count("*").alias("n")), "weights")

    def take(total: Column) -> Column:
        return train_rows(size if size is not None else test_size(total, eval_samples))(total)

    marked = lookup(rows, group_cuts(weights, names, take), names)
    key = split_key(member, seed)
    before = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & F.col("cut_in"))
    split = F.when(F.coalesce(before, F.lit(False)), "train").otherwise("test")
    return marked.withColumn("split", split).drop("cut_key", "cut_in", *([] if groups else names))


# --- leakage --------------------------------------------------------------------------------------


def leaked_texts(df: DataFrame, text: str, groups: list[str] | None = None, split: str = "split") -> DataFrame:
    """(groups, text, train, test): the texts in canonical form that are in both splits, and how often in each.

    One map-side aggregate of hashes with the or of their splits tells which texts may leak; only their rows are
    read again, and grouped by the text itself. Null and blank texts have nothing to leak.
    """
    groups = groups or []
    side = F.when(F.col(split) == "train", TRAIN).when(F.col(split) == "test", TEST).otherwise(0)
    rows = df.select(*groups, canonical(F.col(text)).alias("text"), side.alias("side")).filter("text <> ''")
    keyed = rows.withColumn("key", F.md5("text"))
    suspects = keyed.groupBy(*groups, "key").agg(F.bit_or("side").alias("sides")).filter(F.col("sides") == (TRAIN | TEST))
    found = lookup(keyed, suspects.select(*groups, "key"), [*groups, "key"], "left_semi").groupBy(*groups, "text").agg(
        F.count_if(F.col("side") == TRAIN).alias("train"), F.count_if(F.col("side") == TEST).alias("test"),
    )
    return found.filter("train > 0 AND test > 0")


def leakage(df: DataFrame, text: str, groups: list[str], split: str = "split") -> DataFrame:
    """(groups, train, test, leaked_texts, leaked_rows, share) per group: how many test rows have a text that train has too."""
    totals = df.groupBy(*groups).agg(
        F.count_if(F.col(split) == "train").alias("train"), F.count_if(F.col(split) == "test").alias("test"),
    )
    leaked = leaked_texts(df, text, groups, split).groupBy(*groups).agg(F.count("*").alias("leaked_texts"), F.sum("test").alias("leaked_rows"))
    rows = F.coalesce("leaked_rows", F.lit(0))
    return lookup(totals, leaked, groups).select(
        *groups, "train", "test", F.coalesce("leaked_texts", F.lit(0)).alias("leaked_texts"), rows.alias("leaked_rows"),
        F.when(F.col("test") > 0, rows / F.col("test")).otherwise(0.0).alias("share"),
    )


# --- one question per text ------------------------------------------------------------------------


def _text_key(*parts: str) -> Column:
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def distinct_inputs(rows: DataFrame, keep: Sequence[str] = ("prompt",), task: str = "task", text: str = "input") -> DataFrame:
    """(record_id, task, input, keep, copies): one row per distinct text of a task, its record id a hash of both.

    The texts are grouped as they are; ``keep`` are columns that depend on the text only. Null texts are one text.
    """
    return rows.groupBy(F.col(task).alias("task"), F.col(text).alias("input")).agg(
        *[F.first(c).alias(c) for c in keep], F.count("*").alias("copies"),
    ).withColumn("record_id", _text_key("task", "input"))


def returned(rows: DataFrame, answers: DataFrame, copies: DataFrame, task: str = "task", text: str = "input", record: str = "record_id") -> DataFrame:
    """The rows with ``response``: each gets the answer that its text got; null if there is none.

    ``answers`` has (task, input, response), once per text; ``copies`` (record_id, copies) tells how many rows a text has. The rows
    of texts with more than a ``HOT``-th of all rows are dealt to as many parts, and so are their answers: the table of
    these texts has fewer than ``HOT`` rows, and only it is broadcast. Keys are hashes; the texts are compared as well.
    """
    total = copies.agg(F.sum("copies")).first()[0] or 1
    hot = copies.filter(F.col("copies") * HOT > total).select(
        F.col("record_id").alias("__hot"), F.ceil(F.col("copies") * HOT / total).cast("int").alias("__parts"),
    )
    hot = F.broadcast(written(hot, "hot"))

    def parted(df: DataFrame, key: Column) -> DataFrame:
        named = df.withColumn("__key", key)
        return named.join(hot, F.col("__key") == F.col("__hot"), "left").drop("__hot")

    parts = F.coalesce("__parts", F.lit(1))
    asked = parted(rows, _text_key(task, text)).withColumn("__part", F.pmod(F.xxhash64(record), parts).cast("int")).drop("__parts")
    given = answers.select(F.col("task").alias("__task"), F.col("input").alias("__input"), "response", _text_key("task", "input").alias("__id"))
    given = given.join(hot, F.col("__id") == F.col("__hot"), "left").withColumn("__of_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    same = (
        (F.col("__key") == F.col("__id")) & (F.col("__part") == F.col("__of_part"))
        & F.col(task).eqNullSafe(F.col("__task")) & F.col(text).eqNullSafe(F.col("__input"))
    )
    return asked.join(given, same, "left").select(*[F.col(f"`{c}`") for c in rows.columns], "response")


def label_distinct_to_table(prompts: DataFrame, make_labeler: Callable[[], Labeler], path: str, waves: int = 1,
                            in_flight: int = IN_FLIGHT) -> DataFrame:
    """(record_id, task, input, response): as ``label_to_table``, but every distinct text is asked once and its answer returned to all its rows.

    ``path`` keeps the answers by text, so rows that come later with a known text cost no call.
    """
    distinct = written(distinct_inputs(prompts), "distinct")
    answers = label_to_table(distinct.select("record_id", "task", "input", "prompt"), make_labeler, path, waves, in_flight)
    rows = prompts.select(F.col("record_id").cast("string").alias("record_id"), "task", "input")
    return returned(rows, answers, distinct.select("record_id", "copies"))
