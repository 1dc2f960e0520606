"""SimHash near-duplicates: covering locality-sensitive hashing, then distributed union-find.

A fingerprint holds, for each of 64 bits, what over half of the shingle hashes have. Texts link if
their fingerprints differ in ``radius`` bits or fewer; groups are connected components.

Defined results: a text without words, or null, has fingerprint zero and links like any other; a text
of fewer words than a shingle has one shingle; equal texts share a fingerprint, so repeated rows
share a group; the component id is the smallest non-null record id of the group, null if there
is none; an empty table gives an empty result. Very long texts are summed in blocks. Other columns of
``docs`` are ignored by ``groups`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.llm.common import row_key, stored
from stillhouse.llm.components import components

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK = 1 << 16


def shingle_hashes(text: str | None, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, A-Z lowered, joined by one space; repeats included."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    spans = zip(starts, ends[width - 1:]) if len(found) >= width else [(0, ends[-1])]
    return np.fromiter((digest(joined[a:b - 1], seed) for a, b in spans), np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        rows = hashes[at:at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text") + ", fp bigint"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = table.column("__text")
            values = np.fromiter((simhash(shingle_hashes(t.as_py())) for t in texts), np.int64, len(texts))
            out = table.drop_columns("__text").append_column("fp", pa.array(values))
            yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(each, schema)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of which at least one avoids any ``radius`` given bits.

    Bit i is named by a non-zero vector f(i) of radius + 1 coordinates; the mask of a non-zero v has the
    bits with f(i).v = 1 (mod 2). ``radius`` vectors cannot span the space, so some v is orthogonal to
    all of them, and two fingerprints that differ in these bits agree under its mask.
    """
    names = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if ((i % names + 1) & v).bit_count() % 2)
        for v in range(1, names + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect what is within ``radius``, from a table of distinct ``fp``.

    Every fingerprint goes to one bucket for each covering mask. Fingerprints that share a bucket are not
    paired: each is unfolded to itself and its neighbours within radius / 2 in the bits its buckets leave
    open. Two that are within ``radius`` meet in such a neighbour, and all that meet in one are within
    ``radius`` of each other, so linking them to the smallest is exact. A neighbour has at most as
    many members as there are ways to flip, whatever the size of a bucket.
    """
    if radius != 2:
        raise ValueError("links() unfolds one flipped bit on either side: the radius is 2")
    full = (1 << BITS) - 1
    tables = F.array(*[
        F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"), F.lit(_signed(full ^ m)).alias("open"))
        for n, m in enumerate(covering_masks(radius))
    ])
    placed = fps.select("fp", F.explode(tables).alias("t")).select("fp", "t.*")
    shared = placed.groupBy("n", "part").agg(F.count("*").alias("members")).filter("members > 1").drop("members")
    mates = placed.join(shared, ["n", "part"]).groupBy("fp").agg(F.bit_or("open").alias("open"))

    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    near = F.concat(
        F.array(F.col("fp")),
        F.transform(F.filter(flips, lambda f: F.col("open").bitwiseAND(f) != 0), lambda f: F.col("fp").bitwiseXOR(f)),
    )
    met = (
        mates.select("fp", F.explode(near).alias("near")).groupBy("near")
        .agg(F.min("fp").alias("a"), F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    )
    found = met.select("a", F.explode("members").alias("b")).filter("a <> b").distinct()
    return found.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def grouped(prints: DataFrame, lowest: Column, radius: int = RADIUS) -> DataFrame:
    """(fp, lowest): for each distinct fingerprint the smallest value of ``lowest`` over its group."""
    each = stored(prints.groupBy("fp").agg(F.min(lowest).alias("lowest")), "fingerprints")
    roots = stored(components(links(each.select("fp"), radius), "a", "b"), "roots")
    linked = each.join(roots.withColumnRenamed("node", "fp"), "fp")
    of_root = linked.groupBy("root").agg(F.min("lowest").alias("of_root"))
    of_linked = roots.join(of_root, "root").select(F.col("node").alias("fp"), "of_root", F.lit(True).alias("in_group"))
    return each.join(of_linked, "fp", "left").select(
        "fp", F.when(F.col("in_group"), F.col("of_root")).otherwise(F.col("lowest")).alias("lowest")
    )


def groups(docs: DataFrame, record: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(record, fp, component_id), one row per row of ``docs``."""
    prints = stored(fingerprints(docs, [F.col(record).alias("__record")], text), "simhash")
    found = grouped(prints, F.col("__record"), radius).withColumnRenamed("lowest", "component_id")
    return prints.join(found, "fp").select(F.col("__record").alias(record), "fp", "component_id")


def one_of_each(docs: DataFrame, record: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The documents with the smallest record id of each group (null ids last), with their own columns.
    Ties go to the smaller hash of the row; identical rows are one document."""
    prints = stored(fingerprints(docs, [F.col(record).alias("__record"), *row_key(docs)], text), "simhash")
    place = F.struct(F.col("__record").isNull().alias("last"), "__record", "__k1", "__k2")
    kept = grouped(prints, place, radius).select("lowest.__k1", "lowest.__k2").distinct()
    return docs.select("*", *row_key(docs)).join(kept, ["__k1", "__k2"]).dropDuplicates(["__k1", "__k2"]).drop("__k1", "__k2")
