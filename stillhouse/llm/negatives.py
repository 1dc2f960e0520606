"""Hard negatives for anchors: bounds along a spanning tree of anchors, exact scores only where a window is met.

A row's score for an anchor is the inner product of their integer vectors. The anchors are taken in chunks of
``ANCHORS``, near ones together, and each chunk gets a minimum spanning tree by Euclidean distance. Every task walks the
tree for a block of rows: the exact score at the tree's root is a product; at a child, a row's score lies within (distance
of child and parent) x (length of the row's vector) of what is known at the parent. Only rows whose interval
overlaps the window of scores that still count at the child are scored there, and these get an interval of width 0.

There are two passes over the rows for a chunk. In the first the window of an anchor begins at the task's ``TOP``-th best score
so far of its own label; of all tasks' best rows the first ``TOP`` are the positives. In the second there is a window for each
positive, from ``LOW`` % of its score to its score, which narrows to what the task's best rows of other labels
leave. A task sends ``TOP`` rows per anchor or positive at most, whatever it reads; the rows themselves are never shuffled, and
what goes to the driver and to every task is one chunk of anchors with its positives.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part; vectors of
different length never meet; an empty vector scores 0; repeated rows, and rows with the same id, are rows of their own, so an
anchor that is there twice is mined twice; a null id is no anchor and comes last among ties; positives with a negative
score have no negatives, as their window is empty; scores beyond the range of a long stay at its end; an empty table gives
an empty result. Labels are told apart by a 64-bit hash. Columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stillhouse.llm.common import numbered, stored
from stillhouse.sources.workspace import new_folder

TOP = 5
LOW = 80
EVERY = 100
SCALE = 256
ANCHORS = 1024
ROWS = 4096
VALUES = 1 << 20
EXACT = 1 << 53
LONG = np.iinfo(np.int64)
LOOSE = 1e-9
FOUND = "anchor bigint, positive int, score bigint, id bigint, row bigint"


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): whole numbers, as doubles."""
    return np.floor(SCALE * vectors)


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; those beyond the range of a long are cut to it."""
    largest = np.abs(rows).max(initial=0) * np.abs(anchor).max(initial=0) * max(1, len(anchor))
    if largest < EXACT:
        return (rows @ anchor).astype(np.int64)
    other = [int(v) for v in anchor]
    sums = [sum(int(v) * o for v, o in zip(row, other)) for row in rows]
    return np.array([min(LONG.max, max(LONG.min, s)) for s in sums], np.int64)


def spanning_tree(points: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, distance) of a minimum spanning tree, parents first in the order of a walk; the root's parent is -1."""
    n = len(points)
    if not n:
        return []
    near, parent, left, children = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool), [[] for _ in range(n)]
    parent[0] = -1
    node = 0
    for _ in range(n):
        left[node] = False
        if node:
            children[parent[node]].append(node)  # one that no finite distance reaches hangs on the root
        gap = np.sqrt(((points - points[node]) ** 2).sum(axis=1))
        closer = left & (gap < near)
        near[closer], parent[closer] = gap[closer], node
        open_ones = np.flatnonzero(left)
        if len(open_ones):
            node = int(open_ones[near[open_ones].argmin()])
    out, stack = [], [0]
    while stack:
        node = stack.pop()
        out.append((node, int(parent[node]), float(near[node])))
        stack.extend(reversed(children[node]))
    return out


class Best:
    """The best ``TOP`` (score, id, row) seen so far: higher scores first, ties by smaller id, then row."""

    def __init__(self, top: int):
        self.top, self.score, self.id, self.row = top, *(np.empty(0, np.int64) for _ in range(3))

    def least(self) -> int:
        """The score that a row needs to count."""
        return int(self.score[-1]) if len(self.score) == self.top else LONG.min

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        good = score >= self.least()
        score, ids, rows = (np.concatenate([old, new[good]]) for old, new in ((self.score, score), (self.id, ids), (self.row, rows)))
        if len(score) > 4 * self.top:  # a cheap cut before the sort; ties at the cut stay
            cut = np.partition(score, -self.top)[-self.top]
            score, ids, rows = score[score >= cut], ids[score >= cut], rows[score >= cut]
        order = np.lexsort((rows, ids, ~score))[:self.top]
        self.score, self.id, self.row = score[order], ids[order], rows[order]


class Chunk:
    """Anchors of one length with their tree; ``windows`` has the scores of each anchor's positives, for the second pass."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.id, self.row, self.label, self.vector = ids, rows, labels, vectors
        self.tree = spanning_tree(vectors)
        self.windows: dict[int, list[int]] | None = None

    def states(self, top: int) -> list[list[Best]]:
        return [[Best(top) for _ in ([0] if self.windows is None else self.windows.get(int(r), []))] for r in self.row]

    def walk(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray, states: list[list[Best]], low: int) -> int:
        """Takes a block of rows into ``states``; returns how many exact scores it took."""
        norm = np.sqrt((vectors * vectors).sum(axis=1))
        near: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        users = {}
        for _, parent, _ in self.tree:
            users[parent] = users.get(parent, 0) + 1
        taken = 0
        for node, parent, length in self.tree:
            if parent < 0:
                middle, reach = np.zeros(len(norm)), np.full(len(norm), np.inf)
            else:
                middle, reach = near[parent]
                widened = length * norm * (1 + LOOSE)
                reach = reach + np.where(np.isnan(widened), np.inf, widened)
                users[parent] -= 1
                if users[parent]:
                    middle = middle.copy()
                else:
                    del near[parent]
            own = labels == self.label[node]
            loose = reach + LOOSE * (np.abs(middle) + 1)
            if self.windows is None:
                counts = own & (rows != self.row[node]) & (middle + loose >= states[node][0].least())
            else:
                wanted = self.windows.get(int(self.row[node]), [])
                if wanted:
                    floors = [max(-(-low * p // 100), s.least()) for p, s in zip(wanted, states[node])]
                    counts = ~own & (middle + loose >= min(floors)) & (middle - loose <= max(wanted))
                else:
                    counts = np.zeros(len(norm), bool)
            if parent < 0:
                counts[:] = True  # the root is scored for all
            at = np.flatnonzero(counts)
            if len(at):
                taken += len(at)
                score = scores(vectors if len(at) == len(norm) else vectors[at], self.vector[node])
                middle[at], reach[at] = score, np.where((score == LONG.max) | (score == LONG.min), np.inf, 0.0)
                if self.windows is None:
                    mine = own[at] & (rows[at] != self.row[node])
                    states[node][0].add(score[mine], ids[at[mine]], rows[at[mine]])
                else:
                    for p, best in zip(self.windows.get(int(self.row[node]), []), states[node]):
                        inside = ~own[at] & (score <= p) & (score >= -(-low * p // 100))
                        best.add(score[inside], ids[at[inside]], rows[at[inside]])
            if users.get(node):
                near[node] = (middle, reach)
        return taken


def _passed(rows: DataFrame, chunks: dict[int, Chunk], top: int, low: int) -> DataFrame:
    """``FOUND`` rows: each task's best for every anchor of the chunk (and positive, in the second pass)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = {size: chunk.states(top) for size, chunk in chunks.items()}
        for batch in batches:
            ends = batch.column("vector").offsets.to_numpy()
            values, sizes = batch.column("vector").values.to_numpy(zero_copy_only=False), np.diff(ends)
            ids = batch.column("id").fill_null(LONG.max).to_numpy()
            labels, numbers = batch.column("side").to_numpy(), batch.column("row").to_numpy()
            for size, chunk in chunks.items():
                of_size = np.flatnonzero(sizes == size)
                step = max(1, min(ROWS, VALUES // max(1, size)))
                for first in range(0, len(of_size), step):
                    at = of_size[first:first + step]
                    vectors = whole(values[ends[at][:, None] + np.arange(size)].astype(np.float64))
                    chunk.walk(vectors, labels[at], ids[at], numbers[at], states[size], low)
        for size, chunk in chunks.items():
            out = [
                (int(chunk.row[i]), n, best.score, best.id, best.row)
                for i, state in enumerate(states[size]) for n, best in enumerate(state) if len(best.score)
            ]
            if out:
                times = [len(o[2]) for o in out]
                ids = np.concatenate([o[3] for o in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([o[0] for o in out], times)), pa.array(np.repeat([o[1] for o in out], times).astype(np.int32)),
                     pa.array(np.concatenate([o[2] for o in out])), pa.array(ids, mask=ids == LONG.max), pa.array(np.concatenate([o[4] for o in out]))],
                    names=["anchor", "positive", "score", "id", "row"],
                )

    return rows.mapInArrow(each, FOUND)


def _first(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The first ``top`` rows of each key: a key has ``top`` rows per task at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _similar(vector: Column, bits: int = 16) -> Column:
    """Signs of a few sums of coordinates: rows that agree in them tend to be near."""
    def sign(bit: int) -> Column:
        turned = F.transform(vector, lambda x, i: F.when(F.xxhash64(i, F.lit(bit)) % 2 == 0, x).otherwise(-x).cast("double"))
        return (F.aggregate(turned, F.lit(0.0), lambda a, x: a + x) > 0).cast("int") * (1 << bit)

    return sum((sign(b) for b in range(1, bits)), sign(0))


def _chunks_of(anchors: list) -> dict[int, Chunk]:
    out = {}
    for size in sorted({len(a["vector"]) for a in anchors}):
        own = [a for a in anchors if len(a["vector"]) == size]
        ids, rows, labels = (np.array([a[c] for a in own], np.int64) for c in ("id", "row", "side"))
        out[size] = Chunk(ids, rows, labels, whole(np.array([a["vector"] for a in own], np.float64).reshape(len(own), size)))
    return out


def hard_negatives(rows: DataFrame, record: str = "vec_id", vector: str = "embedding", label: str = "label",
                   every: int = EVERY, top: int = TOP, low: int = LOW, anchors_at_once: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (id divisible by
    ``every``) and each of its ``top`` best rows of the same label, the ``top`` best rows of other labels that score ``low`` to 100 % of it."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    spark = rows.sparkSession
    part = rows.filter(F.col(label).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False)))
    kept = stored(
        part.select(F.col(record).cast("bigint").alias("id"), F.xxhash64(label).alias("side"), F.col(vector).alias("vector"))
        .withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    chosen = kept.filter(F.col("id") % every == 0).withColumn("near", _similar(F.col("vector")))
    places = stored(numbered(chosen, [F.size("vector"), F.col("side"), F.col("near"), F.col("id"), F.col("row")], "place", "anchors"), "anchors")
    total, folder = places.count(), new_folder(spark, "negatives")
    positives, negatives = f"{folder}/positives", f"{folder}/negatives"
    _empty(spark, positives, f"{FOUND}, rank int")
    _empty(spark, negatives, FOUND)
    for first in range(0, total, anchors_at_once):
        # One chunk: a bounded number of anchors on the driver and in each task.
        chunks = _chunks_of(places.filter(F.col("place").between(first, first + anchors_at_once - 1)).orderBy("place").collect())
        best = _first(stored(_passed(kept, chunks, top, low), "best"), ["anchor"], top)
        best = stored(best, "positives")
        best.write.mode("append").parquet(positives)
        windows: dict[int, list[int]] = {}
        for r in best.orderBy("anchor", "rank").collect():
            windows.setdefault(r["anchor"], []).append(r["score"])
        for chunk in chunks.values():
            chunk.windows = windows
        stored(_passed(kept, chunks, top, low), "best").write.mode("append").parquet(negatives)
    of_anchor = places.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = spark.read.schema(f"{FOUND}, rank int").parquet(positives).select(
        "anchor", (F.col("rank") - 1).alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    found = _first(spark.read.schema(FOUND).parquet(negatives), ["anchor", "positive"], top)
    found = found.select("anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(pairs, ["anchor", "positive"]).join(of_anchor, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _empty(spark: SparkSession, path: str, schema: str) -> None:
    spark.createDataFrame([], schema).write.parquet(path)
