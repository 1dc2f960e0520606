"""Best-fit packing planned on a histogram of lengths.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. Only the number of pieces per
length (``capacity`` rows at most) reaches the driver, which runs best-fit decreasing over counts: whole
ranges of sequences with the same room take as many pieces of a length as fit. The plan's segments say
which ranks of a length go to which range of sequences. Pieces are numbered per length within their task, a sum
over tasks turns this into ranks, and each piece finds its segment by binary search.

A segment halves the room of its sequences at least, and each length splits at most one range, so a plan has
at most 3 * capacity * log2(capacity) segments, whatever the number of pieces; that bounds what is sent to tasks.

Defined results: null text is empty and has the final id only; equal lengths are interchangeable, so ties take the
order in which the written table holds them; repeated rows are packed once each; an empty table has no
sequences. Very long texts are cut into pieces, none is dropped. Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stillhouse.llm.common import sliced, stored

CAPACITY = 2048
END = b"\0\0\0\0"
CACHED_WORDS = 1 << 19
ID_BYTES = 4
TOGETHER = 1000
STRETCH = 1 << 22
SIGNS = ".,;:!?#*$%&"  # none that ends a special token
DIGITS = tuple("0123456789")
JOINT = "|"
LATIN = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _is_word(text: str) -> bool:
    return text.isalpha() if text.isascii() else LATIN.fullmatch(text) is not None


class WordEncoder:
    """Token ids of whole texts as little-endian bytes, for tokenizers that fold case, cut at ASCII white space and between
    letters and other signs, and mark the last token of a run of letters with ``</w>``.

    Words are encoded once and remembered, up to a bound. A new word goes to the tokenizer in lower case and without
    final signs, whose ids follow. Words go many at a time in one text: for runs of Latin letters the marks
    tell where they end, for others a sign between them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        joint = np.frombuffer(self._one(JOINT), "<u4")
        self.joint_id = int(joint[0]) if len(joint) == 1 else None

    def _one(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str], joint: str, ends_of: Callable[[np.ndarray], np.ndarray], left_out: int) -> dict[str, bytes]:
        """Ids of words that go many at a time in one text, ``joint`` between them. ``ends_of`` tells where the words end among
        the ids, whose last ``left_out`` are then the joint's."""
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts, out = [joint.join(g) + joint for g in groups], {}
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = ends_of(ids)
            if len(ends) != len(group) or ends[-1] != len(ids):
                out.update((w, self._one(w)) for w in group)
                continue
            whole, bounds = ids.tobytes(), [0, *(ends * ID_BYTES).tolist()]
            out.update(zip(group, [whole[x:y - left_out * ID_BYTES] for x, y in zip(bounds, bounds[1:])]))
        return out

    def learn(self, words: list[str]) -> None:
        """Remember the ids of different words in lower case."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + 2 * len(new) > CACHED_WORDS:
            known.clear()
            known[""], new = b"", [w for w in words if w]
        bodies = [w.rstrip(SIGNS) for w in new]
        bodies = [b if b == w or _is_word(b[-1:]) or b[-1:] in DIGITS else w for w, b in zip(new, bodies)]
        tails = [w[len(b):] for w, b in zip(new, bodies)]
        open_words = list({*bodies, *tails}.difference(known))
        plain = [_is_word(w) for w in open_words]
        runs, others = [w for w, p in zip(open_words, plain) if p], [w for w, p in zip(open_words, plain) if not p]
        known.update(self._together(runs, " ", lambda ids: np.flatnonzero(self.last[ids]) + 1, 0))
        if self.joint_id is None:
            known.update((w, self._one(w)) for w in others)
        else:
            # The joint has one id of its own; where a word gives it too, there are too many ends.
            known.update(self._together(others, f" {JOINT} ", lambda ids: np.flatnonzero(ids == self.joint_id) + 1, 1))
        known.update({w: known[b] + known[t] for w, b, t in zip(new, bodies, tails) if t})

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids and the final id of each text; a stretch of texts is looked up by its different words."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            stop = min(len(texts), int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STRETCH)) + 1)
            yield from self._stretch(pc.fill_null(texts.slice(at, stop - at), ""))
            at = stop

    def _stretch(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(texts)
        coded = pc.ascii_lower(split.flatten()).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        self.learn(words)
        made = pa.array([self.known[w] for w in words], pa.large_binary()).take(coded.indices)
        _, bounds, data = made.buffers()
        ends = np.frombuffer(bounds, np.int64, len(made) + 1) if len(made) else np.zeros(1, np.int64)
        rows = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])].tolist()
        whole = memoryview(data if data is not None else b"")
        for start, stop in zip(rows, rows[1:]):
            yield whole[start:stop].tobytes() + END

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))[:-len(END)]


def pieces(docs: DataFrame, record: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(record, piece, start, length, ids_crc32, part, nth[, ids]): the pieces of every document.

    ``nth`` numbers the pieces of a length within their task ``part``. ``ids`` are little-endian 32-bit.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(record).alias("__record"), F.col(text).alias("__text"))
    kind = rows.schema["__record"].dataType.simpleString()
    schema = (f"`{record}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
              + ", ids binary" * with_ids)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Gone with its words when the task ends: a Python worker that kept them would hold them beside other stages' rows.
        encoder, seen, part = WordEncoder(path), defaultdict(int), TaskContext.get().partitionId()
        step = capacity * ID_BYTES
        for batch in sliced(batches):
            at, out = [], [[] for _ in range(7 + with_ids)]
            for row, ids in enumerate(encoder.encode_all(batch.column(1))):
                for piece, start in enumerate(range(0, len(ids), step)):
                    cut = ids[start:start + step]
                    length = len(cut) // ID_BYTES
                    made = (piece, start // ID_BYTES, length, zlib.crc32(cut), part, seen[length], *[cut] * with_ids)
                    at.append(row)
                    for values, v in zip(out[1:], made):
                        values.append(v)
                    seen[length] += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * with_ids
            names = [record, "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids
            columns = [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(v, k) for v, k in zip(out[1:], kinds)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(each, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit decreasing over counts: ([(length, first rank, first sequence, pieces in each, offset)], sequences).

    The pieces of a segment fill its sequences one after the other, ``pieces in each`` at a time.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    segments, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def place(first: int, n: int, free: int) -> None:
            """Fill a range of sequences; what is not needed stays."""
            nonlocal left, rank
            each = free // length
            whole = min(n, left // each)
            for at, many, k in ((first, whole, each), (first + whole, int(whole < n and left > whole * each), left - whole * each)):
                if many:
                    segments.append((length, rank, at, k, capacity - free))
                    room[free - k * length].append((at, many))
                    rank, left = rank + many * k, left - many * k
                    whole = many + (at - first)
            if whole < n:
                room[free].append((first + whole, n - whole))

        for free in sorted(f for f in room if f >= length):
            for first, n in room.pop(free):
                if left:
                    place(first, n, free)
                else:
                    room[free].append((first, n))
            if not left:
                break
        if left:
            need = -(-left // (capacity // length))
            place(opened, need, capacity)
            opened += need
    return segments, opened


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces with length, part and nth."""
    spark: SparkSession = cut.sparkSession
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = stored(counts, "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = plan(histogram, capacity)
    sent = spark.sparkContext.broadcast(np.array(sorted(segments), np.int64).reshape(-1, 5))

    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__before"))
    ranked = cut.join(before, ["length", "part"]).withColumn("__rank", F.col("__before") + F.col("nth")).drop("__before")
    names = [c for c in ranked.columns if c not in ("__rank", "part", "nth")]
    kinds = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        starts = {n: rows for n, rows in ((n, table[table[:, 0] == n]) for n in np.unique(table[:, 0]))}
        for batch in sliced(batches):
            lengths, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for n in np.unique(lengths):
                rows, mine = starts[n], lengths == n
                hit = rows[np.searchsorted(rows[:, 1], ranks[mine], "right") - 1]
                inside = ranks[mine] - hit[:, 1]
                sequence[mine], offset[mine] = hit[:, 2] + inside // hit[:, 3], hit[:, 4] + inside % hit[:, 3] * n
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(each, f"{kinds}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, record: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(record, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one row per piece."""
    return placed(stored(pieces(docs, record, text, tokenizer, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves, from pieces with ids. A group has at
    most ``capacity`` ids, as a sequence holds no more."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")
    )
