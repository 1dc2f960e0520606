"""Periodic runs of words: Lyndon arrays by Baier's grouping, their roots extended through LCE into runs.

A run is a stretch of consecutive words with smallest period q, of ``LEAST`` words and ``TIMES`` periods or more, which
no neighbouring word extends. Every run holds a Lyndon root: a longest Lyndon word of an order of the words, or of
the reverse order, that starts where the root starts. The first phase of Baier's suffix sorter leaves each
suffix in a group whose context is its longest Lyndon prefix, so it is run once for either order and the
lengths of contexts are the two Lyndon arrays; no suffix array is made. Each root is extended to both sides by
its longest common extensions, once per run.

Only parts of a text that may hold a run are grouped, and none is left out: behind its first period, every
word of a run has its last occurrence at most a period back, so a run of period q lies in a stretch of 3q or more such
words, with the period before it. These stretches are found for q up to 1, 2, 4, ... by array operations.

Defined results: a null, empty or blank text has no run and collapses to empty text; words are compared as bytes; the
words of any text are all looked at, however long it is; one text is handled by one task, repeated rows each give
their row; an empty table gives an empty result. Columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.once import let
from stillhouse.llm.common import WORD

LEAST = 6
TIMES = 4
WORDS_AT_ONCE = 1 << 18
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

Run = tuple[int, int, int]


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there: the contexts of phase one.

    Groups are intervals of ``order``, named by their first place. They are taken from the highest down. Every member
    points to the nearest place before it that is in a lower group; places that got pointers leave their group for
    a new one right above it, those with more pointers further up, with the context of the pointing group appended
    as often. The end of the text counts as the smallest word.
    """
    n = len(ranks)
    keys = [*ranks, -1]
    order = sorted(range(n + 1), key=keys.__getitem__)
    place = [0] * (n + 1)
    group, end, context = [0] * (n + 1), [0] * (n + 1), [1] * (n + 1)
    first = 0
    for at, i in enumerate(order):
        place[i] = at
        if keys[i] != keys[order[first]]:
            end[first], first = at, at
        group[i] = first
    end[first] = n + 1
    before, lengths = [-1] * (n + 1), [0] * (n + 1)
    top = n + 1
    while top > 0:
        now = group[order[top - 1]]
        members = order[now:top]
        members.sort()
        own, pointed = context[now], {}
        for i in members:
            lengths[i] = own
            p = i - 1
            while p >= 0 and group[p] >= now:
                far = before[p]
                if far >= 0 and group[far] >= now:
                    before[p] = far = before[far]  # shortens the way for those who come later
                p = far
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for p, times in pointed.items():
            parts.setdefault((times, group[p]), []).append(p)
        for times, old in sorted(parts, reverse=True):
            moved = parts[times, old]
            to = end[old]
            new = to - len(moved)
            for p in moved:
                to -= 1
                other, at = order[to], place[p]
                order[at], place[other] = other, at
                order[to], place[p] = p, to
                group[p] = new
            end[new], context[new] = end[old], context[old] + times * own
            if new != old:
                end[old] = new
        top = now
    return lengths[:n]


def _same(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading items of two arrays agree."""
    at, step, n = 0, 32, min(len(x), len(y))
    while at < n:
        upto = min(n, at + step)
        unlike = np.flatnonzero(x[at:upto] != y[at:upto])
        if len(unlike):
            return at + int(unlike[0])
        at, step = at + step, step * 2
    return n


def runs_of(words: np.ndarray, parts: list[tuple[int, int]] | None = None, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """(start, length, period) of each run, by start, then period. ``parts`` are stretches that hold all runs."""
    found: set[Run] = set()
    back = words[::-1]
    n = len(words)
    for low, high in [(0, n)] if parts is None else parts:
        part = words[low:high]
        ranks = np.unique(part, return_inverse=True)[1]
        seen: dict[int, int] = {}
        starts, spans = [], []
        for turned in (ranks, ranks.max(initial=0) - ranks):
            spans.append(np.asarray(lyndon_lengths(turned.tolist()), np.int64))
            starts.append(np.arange(low, high))
        start, span = np.concatenate(starts), np.concatenate(spans)
        order = np.lexsort((span, start))
        start, span = start[order], span[order]
        fits = start + 2 * span <= n
        start, span = start[fits], span[fits]
        squares = (words[start] == words[start + span]) & (words[start + span - 1] == words[start + 2 * span - 1])
        for i, q in zip(start[squares].tolist(), span[squares].tolist()):
            if i + q <= seen.get(q, 0):
                continue  # a root inside the run found last
            right = i + q + _same(words[i:], words[i + q:])
            left = i - _same(back[n - i:], back[n - i - q:])
            seen[q] = right
            if right - left >= max(least, times * q):
                found.add((left, right - left, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def candidate_parts(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int]]]:
    """For each text (``bounds`` has where each starts, and the end) the stretches that may hold a run.

    No two texts share a number in ``words``, so no stretch crosses from one to the next.
    """
    order = np.argsort(words, kind="stable")
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    gaps = np.full(len(words), np.iinfo(np.int64).max)
    gaps[order[again + 1]] = order[again + 1] - order[again]
    longest = int(np.diff(bounds).max(initial=0))
    lows, highs, width = [], [], 1
    while times * (width // 2 + 1) <= longest:
        smallest = width // 2 + 1  # the periods of this round end at width
        tried = range(smallest, max(smallest, min(width, least)) + 1)
        need = min(max(least - q, (times - 1) * q) for q in tried)
        near = np.concatenate([[False], gaps <= width, [False]])
        edges = np.flatnonzero(near[1:] != near[:-1])
        low, high = edges[::2], edges[1::2]
        enough = high - low >= need
        low, high = low[enough], high[enough]
        text = np.searchsorted(bounds, low, side="right") - 1
        lows.append(np.maximum(low - width, bounds[text]))
        highs.append(high)
        width *= 2
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(bounds) - 1)]
    if not lows:
        return out
    low, high = np.concatenate(lows), np.concatenate(highs)
    order = np.argsort(low, kind="stable")
    for a, b in zip(low[order].tolist(), high[order].tolist()):
        text = int(np.searchsorted(bounds, a, side="right")) - 1
        a, b = a - int(bounds[text]), b - int(bounds[text])
        if out[text] and a <= out[text][-1][1]:
            out[text][-1] = (out[text][-1][0], max(b, out[text][-1][1]))
        else:
            out[text].append((a, b))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that repeat a run's first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join(w for w, kept in zip(words, keep.tolist()) if kept)


def _judged(texts: list[list[bytes]]) -> Iterator[tuple[list[Run], bytes]]:
    numbers, bounds = [], [0]
    for found in texts:
        index = {w: i for i, w in enumerate(dict.fromkeys(found), bounds[-1])}  # no more words than places
        numbers.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
        bounds.append(bounds[-1] + len(found))
    places = candidate_parts(np.concatenate([np.empty(0, np.int64), *numbers]), np.asarray(bounds))
    for found, own, parts in zip(texts, numbers, places):
        runs = runs_of(own, parts) if parts else []
        yield runs, collapsed(found, runs)


def with_runs(docs: DataFrame, record: str = "doc_id", text: str = "text") -> DataFrame:
    """(record, runs, collapsed): the runs of each row's text by start, then period, and the text without repeats."""
    rows = docs.select(F.col(record).alias("record"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["record"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(batch, at, texts):
            judged = list(_judged(texts))
            flat = np.array([r for runs, _ in judged for r in runs], np.int64).reshape(-1, 3)
            ends = np.cumsum([0, *(len(runs) for runs, _ in judged)]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
            return pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(ends), structs), pa.array([c for _, c in judged], pa.binary())],
                names=["record", "runs", "collapsed"],
            )

        for batch in batches:
            first, texts, size = 0, [], 0
            for value in batch.column(1):
                texts.append((value.as_py() or b"").split())
                size += len(texts[-1])
                if size >= WORDS_AT_ONCE:
                    yield flush(batch, first, texts)
                    first, texts, size = first + len(texts), [], 0
            if texts:
                yield flush(batch, first, texts)

    found = rows.mapInArrow(each, f"record {kind}, runs {RUNS}, collapsed binary")
    return found.select(F.col("record").alias(record), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def steepest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties go to the smallest start, then period."""
    def first(best: Column, run: Column) -> Column:
        mine, other = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (mine > other), run).otherwise(best)

    # Runs come by start, then period, so an equal one that comes later never wins.
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), first)


def made_periodic(record: Column, text: Column) -> Column:
    """The text, made periodic from some word on where the record's hash ends in 0; see ``op12_periodic_runs``."""
    h = F.crc32(record.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        rest = n - a
        p = (1 + F.floor(rest / (3 + F.pmod(g, F.lit(8))))).cast("int")
        cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil(rest / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), rest)), " ")).otherwise("")

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), changed)).otherwise(text)
