"""Fuzzy line dedup: MinHash on character shingles, banding, exact Jaccard verification, distributed union-find.

Lines are normalised (A-Z lowered, white space runs to one blank). Two lines are alike if the Jaccard
similarity of their sets of ``WIDTH``-character shingles is ``SIMILARITY`` or more. ``BANDS`` bands of ``ROWS`` hashes
find a pair of similarity s with probability 1 - (1 - s^ROWS)^BANDS: 98.5 % at 0.8, over 99.9 % from 0.87 on. Of each
component of alike lines one occurrence is kept, the first by record id and position.

Equal lines are one line from the start. In a bucket every line is verified against the bucket's most
frequent line; only lines that this leaves unlinked are compared with all others of the bucket, in blocks of
bounded size, so that a bucket of thousands of variants costs its size, and no link is lost to a cap.
Which texts a task must send for verification is told by a bit map of fixed size; exact joins follow.

Defined results: null text stays null; every line with a word is compared, whatever its language and number of
words; lines of fewer than ``WIDTH`` characters have no shingles and are alike if they are equal; blank lines
are never removed; identical rows are one document, so they keep the same lines; null ids come last; an empty table stays
empty; all lines of a very long text are compared. Line ids are 64-bit hashes. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from stillhouse.llm.common import row_key, sliced, stored
from stillhouse.llm.components import components

WIDTH = 8
ROWS = 4
BANDS = 8
SIMILARITY = 0.8
BLOCK = 256
TOGETHER = 32  # lines that one is compared with at a time
CHARS_AT_ONCE = 1 << 18
SLOT_BITS = 24
TURN = np.random.default_rng(20).integers(0, 1 << 32, ROWS * BANDS, np.uint32)
TIMES = np.random.default_rng(21).integers(0, 1 << 32, ROWS * BANDS, np.uint32) | np.uint32(1)
# How lines are read as arrays of shingles: encoding, type of a shingle, bytes of a character. A Latin-1 shingle is one number.
NARROW, WIDE = ("latin-1", f"<u{WIDTH}", 1), ("utf-32-le", f"<U{WIDTH}", 4)
PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def normal(line: str) -> bytes | None:
    """The normalised line, or None for a blank one."""
    return b" ".join(line.encode().lower().split()) or None


def mark(line: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(line)).view(np.int64))


def _block_keys(lines: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    span, step, p = points, 1, PRIMES[:1].copy()
    while step < WIDTH:  # spans of 2, 4, 8 characters
        span = span[:-step] * p + span[step:]
        p, step = p * p, step * 2
    inside = np.ones(len(points), bool)
    ends = np.cumsum(lengths)
    for back in range(1, WIDTH):
        inside[ends - back] = False
    span = span[inside[:len(span)]]
    span = (span ^ (span >> np.uint64(32))) * PRIMES[1]
    shingles = (span >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths - WIDTH + 1)[:-1]])
    keys = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat((shingles ^ TURN[row]) * TIMES[row], starts)
            key = (key ^ least) * PRIMES[2]
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys.view(np.int64)


def band_keys(lines: list[str]) -> np.ndarray:
    """One 64-bit key per line and band; lines agree in a key if the band's minima agree."""
    out, at, size = [], 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= CHARS_AT_ONCE or i == len(lines) - 1:
            out.append(_block_keys(lines[at:i + 1]))
            at, size = i + 1, 0
    return np.concatenate(out) if out else np.empty((0, BANDS), np.int64)


def form_of(lines: Iterable[str]) -> tuple[str, str, int]:
    """The form in which the shingles of all these lines can be read."""
    try:
        "".join(lines).encode(NARROW[0])
    except UnicodeEncodeError:
        return WIDE
    return NARROW


def shingles(line: str, form: tuple[str, str, int] = WIDE) -> np.ndarray:
    """The different shingles of a line of ``WIDTH`` characters or more, sorted."""
    encoding, kind, step = form
    raw = line.encode(encoding)
    every = np.sort(np.ndarray(len(raw) // step - WIDTH + 1, kind, raw, strides=(step,)))
    first = np.ones(len(every), bool)
    first[1:] = every[1:] != every[:-1]
    return every[first]


def alike_to(one: np.ndarray, many: Sequence[np.ndarray], least: float = SIMILARITY) -> np.ndarray:
    """Which of many lines' shingles are alike to those of one."""
    n, sizes = len(one), np.fromiter(map(len, many), np.int64, len(many))
    fit = np.minimum(n, sizes) >= least * np.maximum(n, sizes)
    if fit.any():
        compared = np.concatenate([s for s, f in zip(many, fit) if f])
        sizes = sizes[fit]
        at = np.searchsorted(one, compared)
        at[at == n] = 0
        both = np.add.reduceat(one[at] == compared, np.cumsum(sizes) - sizes, dtype=np.int64)
        fit[fit] = both >= least * (n + sizes - both)
    return fit


def alike(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    return bool(alike_to(a, [b], least)[0])


def links(left: dict[int, str], right: dict[int, str]) -> list[dict[str, int]]:
    """Links that connect the left lines with all that are alike to them on either side; two lines are compared once."""
    lines = {**left, **right}
    form = form_of(lines.values())
    sets = {m: shingles(line, form) for m, line in lines.items()}
    root, found = {m: m for m in lines}, []

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for a in left:
        others = [b for b in right if b > a or b not in left]
        for at in range(0, len(others), TOGETHER):
            mine = top(a)
            apart = [b for b in others[at:at + TOGETHER] if top(b) != mine]
            for b, ok in zip(apart, alike_to(sets[a], [sets[b] for b in apart])):
                if ok and top(a) != top(b):
                    root[top(a)] = top(b)
                    found.append({"a": a, "b": b})
    return found


def _occurrences(docs: DataFrame, record: str, text: str) -> DataFrame:
    """(record, k1, k2, pos, mark, n, keys): one row per line. A batch gives a line's keys once, with its
    number of occurrences there; otherwise, and for lines too short for shingles, they are null."""
    rows = docs.select(F.col(record).alias("record"), *row_key(docs), F.col(text).alias("text"))
    kind = rows.schema["record"].dataType.simpleString()
    schema = f"record {kind}, __k1 bigint, __k2 bigint, pos int, mark bigint, n int, keys array<bigint>"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            at, positions, marks, first, times, lines = [], [], [], {}, [], []
            for row, value in enumerate(batch.column(3)):
                for pos, line in enumerate((value.as_py() or "").split("\n")):
                    whole = normal(line)
                    if whole is None:
                        continue
                    found = mark(whole)
                    here = first.get(found)
                    if here is None and len(chars := whole.decode()) < WIDTH:
                        times.append(None)
                    elif here is None:
                        first[found] = len(marks)
                        lines.append(chars)
                        times.append(1)
                    else:
                        times[here] += 1
                        times.append(None)
                    at.append(row)
                    positions.append(pos)
                    marks.append(found)
            keys, new = band_keys(lines), np.fromiter((t is not None for t in times), bool, len(times))
            offsets = np.concatenate([[0], np.cumsum(new * BANDS)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)), mask=pa.array(~new))
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(taken) for i in range(3)], pa.array(positions, pa.int32()), pa.array(marks, pa.int64()),
                 pa.array(times, pa.int32()), listed],
                names=["record", "__k1", "__k2", "pos", "mark", "n", "keys"],
            )

    return stored(rows.mapInArrow(each, schema), "lines")


def _texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(mark, line) for the wanted marks: one row each."""
    slot = F.shiftrightunsigned("mark", 64 - SLOT_BITS)
    words = wanted.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    bits = np.zeros(1 << (SLOT_BITS - 6), np.int64)
    for row in words.collect():  # as many rows as the map has words at most
        bits[row["word"]] = row["bits"]
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        admitted = sent.value.view(np.uint64)
        for batch in sliced(batches):
            found = {}
            for value in batch.column(0):
                for line in (value.as_py() or "").split("\n"):
                    whole = normal(line)
                    if whole is not None:
                        slot = xxhash.xxh3_64_intdigest(whole) >> (64 - SLOT_BITS)
                        if int(admitted[slot >> 6]) >> (slot & 63) & 1:
                            found[mark(whole)] = whole.decode()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], names=["mark", "line"])

    sent_lines = docs.select(text).mapInArrow(each, "mark bigint, line string")
    return stored(sent_lines.join(wanted, "mark").groupBy("mark").agg(F.first("line").alias("line")), "texts")


def _rest_of_buckets(members: DataFrame, unlinked: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): verified links between a bucket's unlinked lines and its other lines.

    Both are dealt to blocks of about ``BLOCK`` lines by hash; a row holds one pair of blocks. A line that is alone
    in its bucket has no other to be compared with.
    """
    def parts(rows: DataFrame, n: str, at_least: int = 1) -> DataFrame:
        counted = rows.groupBy("key").agg(F.count("*").alias("lines")).filter(F.col("lines") >= at_least)
        return counted.select("key", F.ceil(F.col("lines") / BLOCK).cast("int").alias(n))

    open_keys = parts(unlinked, "n_left").join(parts(members, "n_right", at_least=2), "key")
    block = F.pmod(F.xxhash64("mark", F.lit(3)), F.col("size")).cast("int")

    def blocks(rows: DataFrame, own: str, other: str, out: str) -> DataFrame:
        dealt = rows.join(open_keys, "key").join(texts, "mark").withColumn("size", F.col(own)).withColumn(own, block)
        dealt = dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return dealt.groupBy("key", "n_left", "n_right").agg(F.collect_list(F.struct("mark", "line")).alias(out))

    pairs = blocks(unlinked, "n_left", "n_right", "left").join(blocks(members, "n_right", "n_left", "right"), ["key", "n_left", "n_right"])

    @F.arrow_udf("array<struct<a bigint, b bigint>>")
    def linked(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        def blocks_of(lists: pa.ListArray) -> Iterator[dict[int, str]]:
            ends, rows = np.cumsum(lists.value_lengths().to_numpy()).tolist(), lists.flatten()
            for at, end in zip([0, *ends], ends):
                block = rows.slice(at, end - at)
                yield dict(zip(*[pc.struct_field(block, name).to_pylist() for name in ("mark", "line")]))

        found = [links(a, b) for a, b in zip(blocks_of(lefts), blocks_of(rights))]
        return pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return pairs.select(F.explode(linked("left", "right")).alias("e")).select("e.a", "e.b")


def groups(docs: DataFrame, occurrences: DataFrame, text: str) -> DataFrame:
    """(mark, root) for every line that is alike to another one."""
    rows = occurrences.filter("keys IS NOT NULL").select("mark", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.max("n").alias("most"))
    shared = shared.filter("low < high").select("key", "most")
    together = rows.join(shared, "key").groupBy("key", "mark").agg(F.max((F.col("n") == F.col("most")).cast("int")).alias("frequent"))
    members = stored(together, "buckets")
    pivots = members.filter("frequent = 1").groupBy("key").agg(F.min("mark").alias("pivot"))
    placed = stored(members.join(pivots, "key").filter("mark <> pivot").select("key", "mark", "pivot"), "buckets")
    texts = _texts(docs, text, members.select("mark").distinct())

    @F.arrow_udf("boolean")
    def verified(lines: pa.Array, others: pa.Array) -> pa.Array:
        out = []
        for other, run in groupby(zip(others.to_pylist(), lines.to_pylist()), itemgetter(0)):
            run = [line for _, line in run]
            for at in range(0, len(run), TOGETHER):
                some = run[at:at + TOGETHER]
                form = form_of([other, *some])
                out.extend(alike_to(shingles(other, form), [shingles(line, form) for line in some]))
        return pa.array(out, pa.bool_())

    pairs = placed.select("mark", "pivot").distinct().join(texts, "mark")
    pairs = pairs.join(texts.select(F.col("mark").alias("pivot"), F.col("line").alias("other")), "pivot")
    judged = stored(pairs.select("mark", "pivot", verified("line", "other").alias("ok")), "pairs")
    unlinked = stored(placed.join(judged.filter("NOT ok"), ["mark", "pivot"]).select("key", "mark"), "unlinked")
    rest = _rest_of_buckets(placed.select("key", "mark"), unlinked, texts)
    links = judged.filter("ok").select(F.col("mark").alias("a"), F.col("pivot").alias("b")).unionByName(rest)
    return stored(components(links, "a", "b").select(F.col("node").alias("mark"), "root"), "groups")


def removals(docs: DataFrame, record: str = "doc_id", text: str = "text") -> DataFrame:
    """(__k1, __k2, removed): the positions removed from a document, by the hashes of its row."""
    lines = _occurrences(docs, record, text)
    alike_lines = groups(docs, lines, text)
    repeated = lines.groupBy("mark").agg(F.count("*").alias("times")).filter("times > 1").select("mark")
    named = repeated.join(alike_lines, "mark", "full").select("mark", F.coalesce("root", "mark").alias("root"))
    place = F.struct(F.col("record").isNull().alias("last"), "record", "__k1", "__k2", "pos")
    held = stored(lines.join(named, "mark").select("root", place.alias("place")), "held")
    kept = held.groupBy("root").agg(F.min("place").alias("kept"))
    gone = held.join(kept, "root").filter("place <> kept").select("place.__k1", "place.__k2", "place.pos")
    return gone.groupBy("__k1", "__k2").agg(F.collect_set("pos").alias("removed"))


@F.pandas_udf(StringType())
def _without(texts: pd.Series, removed: pd.Series) -> pd.Series:
    def rest(text, gone):
        if text is None or gone is None:
            return text
        drop = set(gone)
        return "\n".join(line for pos, line in enumerate(text.split("\n")) if pos not in drop)

    return pd.Series([rest(t, g) for t, g in zip(texts, removed)], dtype=object)


def dedup_lines(docs: DataFrame, record: str = "doc_id", text: str = "text", length: str | None = "n_chars",
                keep_removed: bool = False) -> DataFrame:
    """The documents with repeated lines taken out, in their own columns; ``length`` names a column that holds
    the text's length and follows it. With ``keep_removed`` also ``removed_lines``, the positions taken out."""
    gone = removals(docs, record, text).withColumnRenamed("removed", "__removed")
    joined = docs.select("*", *row_key(docs)).join(gone, ["__k1", "__k2"], "left")
    rest = joined.withColumn(text, _without(F.col(text), F.col("__removed")))
    if length and length in docs.columns:
        rest = rest.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if keep_removed:
        columns.append(F.coalesce(F.array_sort("__removed"), F.array().cast("array<int>")).alias("removed_lines"))
    return rest.select(*columns)
