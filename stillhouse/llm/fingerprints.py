"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

Each word shingle is hashed once; the top bits of the hash name its bin and the smallest hash of a bin stays. An
empty bin takes the value of the non-empty bin that comes first in a random order of the bins of its own, the
same for all documents, which is what probing bins until one is filled gives. ``LOW_BITS`` bits of every bin are
kept as hex digits. Two unrelated bins agree by chance with probability 2^-LOW_BITS, so likeness corrects for it.

Column functions only. Defined results: null is like the empty text; a text without words has the fingerprint '',
alike 1 to itself and 0 to all others; a text of fewer words than a shingle has one shingle of all its words;
letter case is ignored; equal texts, so repeated rows too, have equal fingerprints; an empty table stays empty; very
long texts cost their length (and the sort of their hashes). Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.once import with_once
from stillhouse.llm.common import numbered, stored

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 4
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def with_shingles(df: DataFrame, found: Column, out: str, width: int = SHINGLE) -> DataFrame:
    """Adds the 64-bit hash of every run of ``width`` words; of all words if there are fewer."""
    hashed = with_once(df, "__words", F.transform(found, lambda w: F.xxhash64(w)))
    each = F.transform(
        F.sequence(F.lit(0), F.size("__words") - width),
        lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(width)]),
    )
    whole = F.when(F.size("__words") >= width, each).when(F.size("__words") > 0, F.array(F.xxhash64("__words")))
    return with_once(hashed, out, F.coalesce(whole, F.array().cast("array<bigint>"))).drop("__words")


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS)


def with_fingerprint(df: DataFrame, text: Column, out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint: BINS hex digits."""
    sorted_once = with_once(with_shingles(df, words(text), "__shingles"), "__sorted", F.sort_array("__shingles"))
    first = F.filter("__sorted", lambda v, i: (i == 0) | (_bin(v) != _bin(F.get("__sorted", i - 1))))
    least = with_once(sorted_once.drop("__shingles"), "__least", first).drop("__sorted")
    named = with_once(least, "__bins", F.transform("__least", _bin))

    def donor(b: Column) -> Column:
        ranked = F.transform("__least", lambda v: F.struct(F.xxhash64(b, _bin(v)).alias("rank"), v.alias("value")))
        return F.array_min(ranked)["value"]

    def value(b: Column) -> Column:
        own = F.get("__least", F.array_position("__bins", b).cast("int") - 1)
        return F.coalesce(own, donor(b))

    digits = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(BINS - 1).cast("bigint")),
                         lambda b: F.lower(F.hex(value(b).bitwiseAND(F.lit((1 << LOW_BITS) - 1)))))
    packed = F.when(F.size("__least") > 0, F.array_join(digits, "")).otherwise("")
    return with_once(named, out, packed).drop("__least", "__bins")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingle sets, in [0, 1]."""
    chance = 1.0 / (1 << LOW_BITS)
    equal = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1.0 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


def edited(docs: DataFrame, record: str = "doc_id", text: str = "text") -> DataFrame:
    """(record, n_chars, fingerprint, edited_text, next_fingerprint), one row per row of ``docs``.

    The last half of a text is replaced by as much of the next document's beginning, in order of record id
    (nulls last, ties by content), the first one after the last. Identical rows are one document. Only ids and
    lengths are numbered; a text is moved once to learn its number, and its two halves once to meet their partners.
    """
    keys = [F.xxhash64(record, text).alias("__k1"), F.xxhash64(F.lit(1), text, record).alias("__k2")]
    size = F.coalesce(F.length(text), F.lit(0)).cast("bigint")
    narrow = docs.select(*keys, F.col(record).alias("__record"), size.alias("__n"))
    distinct = narrow.groupBy("__k1", "__k2").agg(F.first("__record").alias("__record"), F.first("__n").alias("__n"), F.count("*").alias("__times"))
    order = [F.col("__record").asc_nulls_last(), F.col("__k1").asc(), F.col("__k2").asc()]
    listed = stored(numbered(distinct, order, "__at", "order"), "order")
    total = F.lit(max(1, listed.count()))
    wanted = listed.select(F.pmod(F.col("__at") + 1, total).alias("__at"), F.floor(F.col("__n") / 2).alias("__need"))
    placed = listed.join(wanted, "__at").select("__k1", "__k2", "__at", "__times", "__need", F.pmod(F.col("__at") - 1, total).alias("__before"))

    whole = docs.select(*keys, F.col(record).alias("__record"), F.coalesce(text, F.lit("")).alias("__text")).join(placed, ["__k1", "__k2"])
    printed = with_fingerprint(whole, F.col("__text"), "__own")
    n = F.length("__text")
    half = F.floor(n / 2).cast("int")
    none = F.lit(None)
    halves = F.array(
        F.struct(F.col("__at").alias("at"), F.col("__record").alias("record"), n.cast("bigint").alias("n"), F.col("__times").alias("times"),
                 F.col("__own").alias("own"), F.substr("__text", F.lit(1), n - half).alias("head"), none.cast("string").alias("tail")),
        F.struct(F.col("__before").alias("at"), none.cast(docs.schema[record].dataType).alias("record"), none.cast("bigint").alias("n"),
                 none.cast("bigint").alias("times"), none.cast("string").alias("own"), none.cast("string").alias("head"),
                 F.substr("__text", F.lit(1), F.col("__need").cast("int")).alias("tail")),
    )
    met = printed.select(F.explode(halves).alias("h")).select("h.*").groupBy("at").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("record", "n", "times", "own", "head", "tail")]
    )
    # A document whose partner is empty, or that needs nothing, gets an empty tail.
    return met.select("at", "record", "n", "times", "own", F.concat("head", F.coalesce("tail", F.lit(""))).alias("edited_text"))
