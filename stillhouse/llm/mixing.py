"""Mixing sources to target weights by repeating and sampling whole documents.

A document is taken floor(rate) times plus once more with probability equal to the fraction, where
rate = target of its source / size of its source. The extra copy is decided by a hash of the seed
and the document id, so reruns agree and no state is kept.

Defined results: null text has size 0; a null source is a source of its own, last in order; a source
without words has target and rate 0 and none of its documents is taken; rows that repeat an id share
its draw (a null id has one draw too); an empty table stays empty. Columns of ``docs`` whose
names clash with added ones are replaced in ``planned`` and untouched in ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.llm.common import numbered, stored

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 17
HEX_DIGITS = 13


def words(text: Column) -> Column:
    """Number of words: tokens for the purpose of the mix. Counted by their ends, without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]|\z)")), F.lit(0)).cast("bigint")


def draw(record: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the record only."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(record.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / float(16**HEX_DIGITS)


def targets(sizes: DataFrame, source: str, size: str, weights: Sequence[float] = WEIGHTS,
            most: float = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, rate) from one (source, size) row per document.

    Sources in code point order, null last, get the weights in turn, repeating. All sizes together are
    shared by weight; a target stops at ``most`` times its source's size and the excess is shared
    again by weight until no target is above. Only sums over the sources reach the driver.
    """
    if most < 1 or not weights or min(weights) <= 0:
        raise ValueError("most must be 1 or more and weights positive")
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    ordered = numbered(totals, [F.col("source").asc_nulls_last()], "at", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    listed = stored(ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most))), "sources")

    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * level
        total, fixed, open_weight = listed.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        now = ((total or 0) - (fixed or 0.0)) / open_weight if open_weight else level
        if now <= level:
            break
        level = now
    target = F.least(F.col("most"), F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return listed.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def planned(docs: DataFrame, record: str = "doc_id", text: str = "text", source: str = "source",
            weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS, seed: int = SEED,
            size: Column | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, rate and ``copies``, the number of times the mix takes a document.

    One shuffle of per-task partial sums; the targets come back as one row per source, which Spark
    broadcasts if their bytes allow and otherwise joins with hot sources split.
    """
    counted = words(F.col(text)) if size is None else F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))
    by_source = targets(docs.select(F.col(source).alias("source"), counted.alias("size")), "source", "size", weights, most)
    kept = docs.withColumn("size", counted).drop("source_size", "target", "rate", "copies")
    whole = by_source.withColumnRenamed("source", "__source")
    return (
        kept.join(whole, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")
        .withColumn("copies", F.floor("rate") + (draw(F.col(record), seed) < F.col("rate") - F.floor("rate")).cast("bigint"))
    )


def mix(docs: DataFrame, record: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as planned, with its own columns."""
    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(record).alias("__record"),
        F.col(source).alias("__from"), words(F.col(text)).alias("__size"),
    )
    plan = planned(inner, "__record", "__size", "__from", weights, most, seed, size=F.col("__size"))
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    taken = plan.filter("copies > 0").withColumn("__copy", F.explode(copies))
    return taken.select("__doc.*")
