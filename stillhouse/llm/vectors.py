"""Near-duplicate vectors: randomised-rotation binary codes with correction factors, exact cosines where they leave doubt.

A vector's code holds the signs of its coordinates after random rotations (sign flips and Hadamard transforms of the
zero-padded vector). Read as a unit vector x, the first rotation's code lies near the vector o itself; the factor
f = <x, o> is stored with it, and <x, q> / f estimates the inner product <o, q> of any q without bias: its error is
sqrt(1 - <o, q>^2) * sqrt(1 - f^2) / f times the cosine of q's and the code's remainders, whose expectation over rotations is 0.
That cosine is at most 1, so a pair at ``COSINE`` or more never has an estimate below COSINE - sqrt(1 - COSINE^2) *
sqrt(1 - f^2) / f: this bound holds with certainty, and only pairs above it are recomputed in double precision.

Pairs are looked for in buckets: the code is read as ``tables`` keys of ``width`` bits. Keys get longer by a bit whenever the rows
double, which keeps chance meetings per row constant, and there are as many tables as bring the probability that a pair
exactly at ``COSINE`` meets in none of them to ``MISS`` (closer pairs are missed more rarely still). A pair that
shares several buckets is judged in the first. Buckets are dealt to blocks of about ``BLOCK`` vectors, and a task holds two
blocks; of a block pair go out one count per vector and a spanning forest of its links, never the pairs.

Equal vectors of a label are one class with a count from the start, so copies cost nothing however many they are. A
bucket of m different vectors that are all alike costs m^2 comparisons, as their links have to be counted.

Defined results: rows whose label or vector is null, or whose vector is empty, zero or has a null or non-finite component,
link with nothing and are their own component; vectors of different length never link; repeated rows and rows with
the same id are vectors of their own; a component is named by its smallest non-null id, null if it has none; an empty
table gives an empty result; vectors of any length and size are taken (they are scaled by their largest
component first). Columns other than the three named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.llm.common import stored
from stillhouse.llm.components import components

COSINE = 0.98
MISS = 1e-5
BLOCK = 1024
LEAST_DIMENSION = 64
FLIPS = 3
SEED = 130
PAIRS_AT_ONCE = 1 << 21
ROUNDING = 1e-9


def usable(vector: Column) -> Column:
    """Finite numbers only, and not all of them zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan_of(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(width, tables) of the keys for a number of rows."""
    width = max(4, math.ceil(math.log2(max(2, rows))) - 3)
    meet = (1 - math.acos(cosine) / math.pi) ** width
    return width, max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


@lru_cache(maxsize=64)
def _signs(size: int, turn: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, turn]).choice([-1.0, 1.0], (FLIPS, size))


def padded(dimension: int) -> int:
    return max(LEAST_DIMENSION, 1 << (dimension - 1).bit_length())


def rotated(units: np.ndarray, turn: int = 0) -> np.ndarray:
    """The zero-padded rows after random rotation number ``turn``; lengths and angles stay."""
    rows, size = len(units), padded(units.shape[1])
    out = np.zeros((rows, size))
    out[:, :units.shape[1]] = units
    for flips in _signs(size, turn):
        out *= flips
        step = 1
        while step < size:
            halves = out.reshape(rows, -1, 2, step)
            out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(rows, size)
            step *= 2
        out /= math.sqrt(size)
    return out


def unit_rows(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def coded(units: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bits as 0 and 1, one row per vector; correction factors of the first rotation)."""
    first = rotated(units)
    turns = [first, *(rotated(units, t) for t in range(1, math.ceil(bits / first.shape[1])))]
    return np.concatenate([t > 0 for t in turns], axis=1)[:, :max(bits, first.shape[1])], np.abs(first).sum(axis=1) / math.sqrt(first.shape[1])


def keys_of(code: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The code's leading bits as ``tables`` numbers of ``width`` bits."""
    return code[:, :width * tables].reshape(len(code), tables, width) @ (1 << np.arange(width, dtype=np.int64))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each dimension in a column of vectors."""
    ends = column.offsets.to_numpy()
    values, sizes = column.values.to_numpy(zero_copy_only=False).astype(np.float64), np.diff(ends)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, values[ends[at][:, None] + np.arange(size)]


def _codes(classes: DataFrame, width: int, tables: int) -> DataFrame:
    """(node, side1, side2, size, copies, vector, code, factor, keys): one row per class."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _matrices(batch.column("vector")):
                code, factor = coded(unit_rows(vectors), width * tables)
                keys = keys_of(code, width, tables)
                ends = np.arange(0, keys.size + 1, tables, dtype=np.int32)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([r.tobytes() for r in np.packbits(code, axis=1)], pa.binary()), pa.array(factor),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1)))],
                    names=[*part.schema.names, "code", "factor", "keys"],
                )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(each, f"{kept}, code binary, factor double, keys array<bigint>")


def _linked(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of ``size`` items reaches over the links (a, b)."""
    low = np.arange(size)
    while True:
        least, now = np.minimum(low[a], low[b]), low.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if np.array_equal(now, low):
            return low
        low = now


def doubtful(code: np.ndarray, factor: np.ndarray, queries: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Which pairs (row of codes, row of rotated queries) an estimate does not show to be below ``cosine``."""
    size = queries.shape[1]
    estimate = np.where(code[:, :size], 1.0, -1.0) @ queries.T / (math.sqrt(size) * factor[:, None])
    bound = math.sqrt(1 - cosine * cosine) * np.sqrt(np.maximum(0, 1 - factor * factor)) / factor
    return estimate >= (cosine - bound)[:, None] - ROUNDING


def _bucket_links(rows: DataFrame, width: int, tables: int, cosine: float) -> DataFrame:
    """(node, links, other): each vector's links found in a pair of blocks, and a node of its component there."""
    heads = ["side1", "side2", "size", "number", "key", "low", "high"]

    def judged(units, turned, code, factor, keys, node, copies, own, low, high, number):
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        a, b = np.nonzero(doubtful(code[left], factor[left], turned[right], cosine))
        a, b = left[a], right[b]
        once = a < b if low == high else slice(None)
        a, b = a[once], b[once]
        sure = np.zeros(len(a), bool)
        step = max(1, PAIRS_AT_ONCE // max(units.shape[1], tables))
        for at in range(0, len(a), step):
            x, y = a[at:at + step], b[at:at + step]
            new = np.flatnonzero(~(keys[x, :number] == keys[y, :number]).any(axis=1))
            sure[at + new] = (units[x[new]] * units[y[new]]).sum(axis=1) >= cosine
        a, b = a[sure], b[sure]
        if not len(a):
            return None
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        root, some = _linked(len(node), a, b), np.flatnonzero(links)
        return node[some], links[some].astype(np.int64), node[root[some]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(table: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            out = []
            for at, vectors in _matrices(table.column("vector")):
                part = table.take(pa.array(at))
                head = np.stack([part.column(c).to_numpy().astype(np.int64) for c in heads], axis=1)
                node, copies, own, factor = (part.column(c).to_numpy() for c in ("node", "copies", "own", "factor"))
                units = unit_rows(vectors)
                turned = rotated(units)
                bits = max(width * tables, turned.shape[1])
                packed = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(at), -1)
                code = np.unpackbits(packed, axis=1, count=bits).astype(bool)
                keys = keys_of(code, width, tables)
                cuts = np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1
                for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                    if high - low > 1:
                        s, h = slice(low, high), head[low]
                        found = judged(units[s], turned[s], code[s], factor[s], keys[s], node[s], copies[s], own[s], h[5], h[6], h[3])
                        if found:
                            out.append(found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["node", "links", "other"])

        rest = None
        for batch in batches:
            table = batch if rest is None else pa.concat_batches([rest, batch])
            head = np.stack([table.column(c).to_numpy().astype(np.int64) for c in heads], axis=1)
            changes = np.flatnonzero((head[1:] != head[:-1]).any(axis=1))
            whole = int(changes[-1]) + 1 if len(changes) else 0  # the last block pair may go on in the next batch
            if whole:
                yield from blocks(table.slice(0, whole))
            rest = table.slice(whole)
        if rest is not None and rest.num_rows:
            yield from blocks(rest)

    return rows.repartition(*heads).sortWithinPartitions(*heads).mapInArrow(each, "node bigint, links bigint, other bigint")


def near_vectors(rows: DataFrame, record: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(record, n_links, component_id, kept), one row per row of ``rows``."""
    good = F.col(label).isNotNull() & usable(F.col(vector))
    key = [F.xxhash64(label, vector), F.xxhash64(F.lit(1), vector, label)]
    named = rows.select(F.col(record).alias("record"), F.col(label).alias("label"), F.col(vector).alias("vector"), good.alias("good"),
                        *[F.when(good, k).alias(f"k{i}") for i, k in enumerate(key, 1)])
    classes = stored(
        named.filter("good").groupBy("k1", "k2").agg(
            F.count("*").alias("copies"), F.min("record").alias("lowest"), F.first("label").alias("label"), F.first("vector").alias("vector"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    width, tables = plan_of(classes.count(), cosine)
    sides = [F.xxhash64("label").alias("side1"), F.xxhash64(F.lit(1), "label").alias("side2")]
    codes = stored(_codes(classes.select("node", *sides, F.size("vector").alias("size"), "copies", "vector"), width, tables), "codes")

    bucket = ["side1", "side2", "size", "number", "key"]
    placed = codes.select("node", "side1", "side2", "size", F.posexplode("keys").alias("number", "key"))
    shared = placed.groupBy(*bucket).agg(F.count("*").alias("members")).filter("members > 1")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = placed.join(shared, bucket).select("node", "number", "key", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("own"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("node", "number", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    found = stored(_bucket_links(dealt.join(codes.drop("keys"), "node"), width, tables, cosine), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = stored(components(found.filter("node <> other").select("node", "other"), "node", "other"), "roots")
    lowest = roots.join(classes.select("node", "lowest"), "node").groupBy("root").agg(F.min("lowest").alias("of_root"))
    of_node = roots.join(lowest, "root").select("node", "of_root", F.lit(True).alias("linked"))
    result = classes.join(links, "node", "left").join(of_node, "node", "left").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("linked"), F.col("of_root")).otherwise(F.col("lowest")).alias("component"),
    )
    joined = named.select("record", "good", "k1", "k2").join(result, ["k1", "k2"], "left")
    component = F.when(F.col("good"), F.col("component")).otherwise(F.col("record"))
    return joined.select(
        F.col("record").alias(record), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("record") == component, F.lit(False)).alias("kept"),
    )
