"""Quality rules: base rules on each text, then cross-document line frequency per host.

Lines are normalised (A-Z lowered, white space runs to one blank) and hashed; a line's count is the number
of distinct texts of its host that hold it, so exact copies count once. A line is above the limit
if more than ``min_docs`` of them hold it, however large the host is. Such lines are removed from every text but
the first that holds them (smallest record id), so that what many documents share stays in one of them. A document
is depleted, and rejected, if fewer than ``min_words`` words or less than ``min_left`` of its words are left.

Defined results: null text has no words and fails the base rules; a null host is a host of its own; lines without
words are never counted or removed; rows that repeat a text within a host share its verdict, and all of
them count as the first holder if one does; null ids come last in the choice of the first holder; an
empty table stays empty. Other columns are kept as they are; ``verdicts`` has its own names only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from stillhouse.llm.common import sliced, stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30  # percent of the words
MIN_DOCS = 10
MIN_LEFT = 1 / 3
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[bytes]) -> int:
    """Words inside a window of ``WINDOW`` words that occurs twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for at in range(WINDOW):
        windows = windows * MIX + marks[at:at + n]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += repeated
    edges[WINDOW:] -= repeated
    return int((np.cumsum(edges) > 0).sum())


def line_hash(line: str) -> tuple[int, int]:
    """(hash of the normalised line as a signed long, number of words)."""
    words = line.encode().lower().split()
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).view(np.int64)), len(words)


def features(text: str | None) -> tuple:
    """The base counts, and each line with a word: its hash and its words in all."""
    text = text or ""
    words = text.encode().split()
    seen, duplicates, lines = set(), 0, {}
    for line in text.split("\n"):
        mark, n = line_hash(line)
        if n:
            duplicates += line in seen
            seen.add(line)
            lines[mark] = lines.get(mark, 0) + n
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicates, repeat_words(words),
        list(lines), list(lines.values()),
    )


def _measured(docs: DataFrame, record: str, text: str, host: str) -> DataFrame:
    """Record, host key, two hashes of the text, base counts and lines; written, as it is read thrice."""
    rows = docs.select(
        F.col(record).alias("record"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
        F.xxhash64(F.col(text)).alias("t1"), F.xxhash64(F.lit(1), F.col(text)).alias("t2"), F.col(text).alias("text"),
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    schema = f"{kinds}, {', '.join(f'{c} bigint' for c in BASE)}, marks array<bigint>, sizes array<bigint>"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            table = pa.Table.from_batches([batch])
            found = list(zip(*[features(t.as_py()) for t in table.column("text")])) or [[]] * (len(BASE) + 2)
            table = table.drop_columns("text")
            for name, values in zip([*BASE, "marks", "sizes"], found):
                kind = pa.list_(pa.int64()) if name in ("marks", "sizes") else pa.int64()
                table = table.append_column(name, pa.array(values, kind))
            yield from table.combine_chunks().to_batches()

    return stored(rows.mapInArrow(each, schema), "quality")


def _removals(measured: DataFrame, min_docs: int) -> DataFrame:
    """(host, t1, t2, mark, words): every line above the limit in every text but its first holder."""
    place = F.struct(F.col("record").isNull().alias("last"), "record", "t1", "t2")
    texts = stored(
        measured.groupBy("host", "t1", "t2")
        .agg(F.min(place).alias("place"), F.first(F.arrays_zip("marks", "sizes")).alias("lines")), "texts",
    )
    held = texts.select("host", "t1", "t2", "place", F.explode("lines").alias("line")).select(
        "host", "t1", "t2", "place", F.col("line.marks").alias("mark"), F.col("line.sizes").alias("words")
    )
    counted = held.groupBy("host", "mark").agg(F.count("*").alias("docs"), F.min("place").alias("first"))
    common = counted.filter(F.col("docs") > min_docs).select("host", "mark", F.col("first.t1").alias("f1"), F.col("first.t2").alias("f2"))
    return (
        held.drop("place").join(common, ["host", "mark"])
        .filter("t1 <> f1 OR t2 <> f2").select("host", "t1", "t2", "mark", "words")
    )


def verdicts(docs: DataFrame, record: str = "doc_id", text: str = "text", host: str = "source", min_words: int = MIN_WORDS,
             min_docs: int = MIN_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per document: record, host, t1, t2, base counts, base_failed, words_removed, marks_removed, kept."""
    measured = _measured(docs, record, text, host)
    gone = _removals(measured, min_docs).groupBy("host", "t1", "t2").agg(
        F.sum("words").alias("words_removed"), F.collect_list("mark").alias("marks_removed")
    )
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED) * F.col("n_words"))
    left = F.col("n_words") - F.col("words_removed")
    return (
        measured.drop("marks", "sizes").join(gone, ["host", "t1", "t2"], "left")
        .withColumn("words_removed", F.coalesce("words_removed", F.lit(0).cast("bigint")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ((F.col("words_removed") == 0) | ((left >= min_words) & (left >= F.col("n_words") * F.lit(min_left)))))
    )


@F.pandas_udf(StringType())
def _without_lines(texts: pd.Series, marks: pd.Series) -> pd.Series:
    def rest(text, gone):
        if gone is None:
            return text
        drop = set(gone)
        return "\n".join(line for line in text.split("\n") if line_hash(line)[0] not in drop)

    return pd.Series([rest(t, m) for t, m in zip(texts, marks)], dtype=object)


def clean(docs: DataFrame, record: str = "doc_id", text: str = "text", host: str = "source", length: str | None = "n_chars",
          **rules) -> DataFrame:
    """The documents that pass, without their lines above the limits, in their own columns. ``length`` names a
    column that holds the text's length and follows it."""
    judged = verdicts(docs, record, text, host, **rules).filter("kept")
    judged = judged.select("host", "t1", "t2", "marks_removed").dropDuplicates(["host", "t1", "t2"])
    judged = judged.withColumnsRenamed({c: f"__{c}" for c in judged.columns})
    keys: dict[str, Column] = {
        "__host": F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")),
        "__t1": F.xxhash64(F.col(text)), "__t2": F.xxhash64(F.lit(1), F.col(text)),
    }
    joined = docs.withColumns(keys).join(judged, list(keys))
    rest = joined.withColumn(text, _without_lines(F.col(text), F.col("__marks_removed")))
    if length and length in docs.columns:
        rest = rest.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return rest.select(*[F.col(f"`{c}`") for c in docs.columns])
