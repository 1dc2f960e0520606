"""Language identification with word-first backoff.

A word seen in training scores its log frequency per language; an unseen word falls back to character
n-grams, 4 down to 1: at each position the longest n-gram seen in training scores, and the
word's score is their mean. A text's score is the sum over its words; the prediction is the best language,
the score its posterior probability under equal priors.

Training counts come from a bounded sample of labelled rows: at most about ``per_language`` rows for each
label, chosen by hash (a row's chance is per_language / rows of its label, so the sample has that size
on average at any table size). The model keeps the ``max_words`` and ``max_grams`` most frequent entries, which
bounds what is sent to the tasks.

Defined results: null text and text without a letter give ``und`` with score 0, as does every text if there is
no labelled row; equal scores go to the language first in code point order; null labels are not learned from;
repeated rows get equal predictions; whole texts are read, very long ones in blocks of words. Of ``docs``
only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "und"
ORDERS = (4, 3, 2, 1)
EDGE = "\x02"
PER_LANGUAGE = 2000
MAX_WORDS = 200_000
MAX_GRAMS = 100_000
SMOOTHING = 0.5
CACHED = 1 << 18
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return LETTERS.findall((text or "").lower())


def grams_of(word: str, order: int) -> list[str]:
    marked = f"{EDGE}{word}{EDGE}" if order > 1 else word
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


def _counted(sample: DataFrame, label: str, text: str) -> DataFrame:
    """(order, term, label, n): words have order 0. Counted per task, then summed."""
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: dict[str, Counter] = defaultdict(Counter)
            for language, value in zip(frame["label"], frame["text"]):
                counts[language].update(words_of(value))
            rows: Counter = Counter()
            for language, found in counts.items():
                for word, n in found.items():
                    rows[0, word, language] += n
                    for order in ORDERS:
                        for gram in grams_of(word, order):
                            rows[order, gram, language] += n
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["order", "term", "label", "n"])

    rows = sample.select(F.col(label).alias("label"), F.col(text).alias("text"))
    partial = rows.mapInPandas(each, "order int, term string, label string, n bigint")
    return partial.groupBy("order", "term", "label").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies per language of words (order 0) and n-grams: a row number per term, and the rows."""

    def __init__(self, labels: list[str], terms: dict[int, list[str]], logs: dict[int, np.ndarray]):
        self.labels, self.terms, self.logs = labels, terms, logs
        self.at = {order: {t: i for i, t in enumerate(found)} for order, found in terms.items()}
        self.cache: dict[str, np.ndarray] = {}

    @classmethod
    def of_counts(cls, labels: list[str], counts: list[tuple[int, str, str, int]]) -> Model:
        column = {name: i for i, name in enumerate(labels)}
        rows: dict[int, dict[str, int]] = defaultdict(dict)
        for order, term, _, _ in counts:
            rows[order].setdefault(term, len(rows[order]))
        tables = {order: np.full((len(found), len(labels)), SMOOTHING) for order, found in rows.items()}
        for order, term, label, n in counts:
            tables[order][rows[order][term], column[label]] += n
        logs = {order: np.log(t / t.sum(axis=0)).astype(np.float32) for order, t in tables.items()}
        return cls(labels, {order: list(found) for order, found in rows.items()}, logs)

    def backoff(self, word: str) -> np.ndarray:
        """Mean over positions of the longest known n-gram's log frequencies; zero if none is known."""
        marked, total, known = f"{EDGE}{word}{EDGE}", np.zeros(len(self.labels)), 0
        for at in range(len(marked)):
            for order in ORDERS:
                gram = marked[at:at + order]
                row = self.at.get(order, {}).get(gram) if len(gram) == order else None
                if row is not None:
                    total += self.logs[order][row]
                    known += 1
                    break
        return total / known if known else total

    def score(self, text: str | None) -> tuple[str, float]:
        found = Counter(words_of(text))
        if not found or not self.labels:
            return UNKNOWN, 0.0
        seen, total = self.at.get(0, {}), np.zeros(len(self.labels))
        rows, times = [], []
        for word, n in found.items():
            row = seen.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
                continue
            vector = self.cache.get(word)
            if vector is None:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                vector = self.cache[word] = self.backoff(word)
            total += n * vector
        if rows:
            total += np.array(times, float) @ self.logs[0][rows]
        best = int(np.argmax(total))
        return self.labels[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def train(labelled: DataFrame, record: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE,
          max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Learn from the rows of ``labelled`` that have a label and a text.

    The driver gets one count per label and the bounded model. The record id only picks the sample.
    """
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect()}
    if not sizes:
        return Model([], {}, {})
    share: Column = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    chance = F.pmod(F.xxhash64(F.col(record).cast("string"), F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    counts = _counted(rows.filter(chance < F.element_at(share, F.col(label))), label, text).persist()

    def top(kept: Column, most: int) -> DataFrame:
        terms = counts.filter(kept).groupBy("order", "term").agg(F.sum("n").alias("all"))
        return terms.orderBy(F.col("all").desc(), "order", "term").limit(most)

    wanted = top(F.col("order") == 0, max_words).unionByName(top(F.col("order") > 0, max_grams))
    entries = counts.join(wanted.select("order", "term"), ["order", "term"]).select("order", "term", "label", "n").collect()
    counts.unpersist()
    return Model.of_counts(sorted(sizes), [tuple(r) for r in entries])


def predicted(docs: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with a prediction and its score. One pass; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast((model.labels, model.terms, model.logs))

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*sent.value)
        for batch in batches:
            yield pd.DataFrame([own.score(t) for t in batch], columns=["lang", "score"])

    found = docs.withColumn("__guess", guess(F.col(text)))
    return found.withColumns({out: F.col("__guess.lang"), score: F.col("__guess.score")}).drop("__guess")
