"""Personal data: spans of fixed form, and terms that give them away.

Emails, IP addresses, cards and phone numbers are protected entities, found by form. How strongly a term t
reveals an entity c is estimated from corpus co-occurrence: PMI(c; t) / IC(c), where
PMI = log(p(c, t) / (p(c) p(t))) and IC = -log p(c), over documents. It is 1 if t only occurs with c, 0 if they are
independent. Terms at or above ``remove_at`` are removed and those at or above ``generalise_at`` are
replaced by a general word, wherever they occur.

A term is a word of any length, anywhere in the text: all counts are of whole documents. Candidates are the terms
that share at least ``support`` distinct texts with one entity, outside spans of fixed form; entities in fewer texts
make no candidates. Pairs are summed up within tasks, over the words of texts that hold entities. The frequencies of candidates
are counted over all documents in a second pass, and a third one finds the disclosing terms. For these, tasks get a bit
map of fixed size (``SLOTS`` bits, two for a term) that admits all that is wanted; exact joins follow. A term that occurs in more
documents than any that could disclose even the most frequent entity (``_most_documents``) is no candidate, and makes no pairs.

Defined results: null text is empty; copies of a text count as documents but as one text for the
support; a row that repeats another one gets equal spans; ties cannot arise, as thresholds are inclusive; an
empty table gives an empty result. Spans are code point offsets, end exclusive, of the whole text. Forms are
searched in linear time. Other columns are not read by ``found`` and kept by ``sanitised``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from stillhouse.llm.common import row_key, sliced, stored

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits matches what its first digit does, so only first digits are tried.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]+")
SUPPORT = 3
REMOVE_AT = 0.9
GENERALISE_AT = 0.7
SLOTS = 1 << 24
SEED = 42  # of Spark's xxhash64
REMEMBERED = 1 << 18
PAIRS_REMEMBERED = 1 << 17
SPAN = "struct<kind string, start int, stop int, value string>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        match = DOMAIN.match(text, at) if start < at else None
        done = match.end() if match else done
        if match:
            yield start, match.end()
        following = text.find("@", max(at + 1, done))
        # What is left of a failed sign cannot belong to a later one: the sign is no local character.
        done = max(done, at + 1) if following >= 0 and not match else done
        at = following


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if text.count(".") >= 3:
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text)
                  if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def entity(kind: str, value: str) -> str:
    """The protected entity that a span names: addresses in lower case, numbers by their digits."""
    return f"{kind}:" + (value.lower() if kind == "email" else re.sub(r"[^0-9.]" if kind == "ip" else r"[^0-9]", "", value))


def document_terms(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[str], list[str]]:
    """The distinct terms of a text: those that start outside of all spans somewhere, and the others."""
    taken = np.zeros(len(text) + 1, bool)
    for _, a, b in spans:
        taken[a:b] = True
    every, outside = set(), set()
    for m in TERM.finditer(text):
        term = m[0].lower()
        every.add(term)
        if not taken[m.start()]:
            outside.add(term)
    return sorted(outside), sorted(every - outside)


def slots(term: str) -> tuple[int, int]:
    mark = xxhash.xxh64_intdigest(term, SEED)
    return mark % SLOTS, (mark >> 32) % SLOTS


def _based(docs: DataFrame, keep: list[Column], text: str) -> DataFrame:
    """The kept columns, two hashes of the text, base spans, and the terms of texts that have any."""
    rows = docs.select(*keep, F.xxhash64(F.col(text)).alias("t1"), F.xxhash64(F.lit(1), F.col(text)).alias("t2"), F.col(text).alias("__text"))

    names = [c for c in rows.columns if c != "__text"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            base, entities, outside, inside = [], [], [], []
            for value in batch.column(len(names)):
                text = value.as_py()
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "stop": b, "value": text[a:b]} for k, a, b in spans])
                entities.append(sorted({entity(k, text[a:b]) for k, a, b in spans}))
                out, rest = document_terms(text, spans) if spans else ([], [])
                outside.append(out)
                inside.append(rest)
            made = [pa.array(base, pa.list_(span)), *[pa.array(x, pa.list_(pa.string())) for x in (entities, outside, inside)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*names, "base", "entities", "outside", "inside"])

    schema = f"{kinds}, base array<{SPAN}>, entities array<string>, outside array<string>, inside array<string>"
    return stored(rows.mapInArrow(find, schema), "spans")


def _admitted(wanted: DataFrame, name: str = "term") -> np.ndarray:
    """The bit map that admits all of the values of a column and whatever shares both slots with some."""
    mark = F.xxhash64(F.col(name))
    both = [m.bitwiseAND(F.lit(SLOTS - 1)) for m in (mark, F.shiftrightunsigned(mark, 32))]
    slot = wanted.select(F.explode(F.array(*both)).alias("slot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found, bits = words.toArrow(), np.zeros(SLOTS // 64, np.int64)  # as many rows as the map has words at most
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits


def _admits(words: np.ndarray) -> Callable[[str], bool]:
    bits = np.unpackbits(words.astype("<i8").view(np.uint8), bitorder="little").view(bool)

    def admits(term: str) -> bool:
        a, b = slots(term)
        return bool(bits[a] and bits[b])

    return admits


def _counts(rows: DataFrame, admitted: np.ndarray, read: Callable[[pa.RecordBatch], Iterable[tuple[int, Iterable[str]]]]) -> DataFrame:
    """(term, n): in how many documents each admitted term occurs, summed up within tasks. ``read`` gives the
    rows of a batch: how many documents each stands for and its different terms."""
    sent = rows.sparkSession.sparkContext.broadcast(admitted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        admits = _admits(sent.value)
        counts: dict[str, int] = {}  # 0 for a term that is not admitted

        def summed() -> pa.RecordBatch:
            found = [(t, n) for t, n in counts.items() if n]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["term", "n"])

        for batch in sliced(batches):
            for times, terms in read(batch):
                for term in terms:
                    n = counts.get(term)
                    if n is None:
                        counts[term] = times * admits(term)
                    elif n:
                        counts[term] = n + times
                if len(counts) >= REMEMBERED:
                    yield summed()
        yield summed()

    return rows.mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _of_documents(batch: pa.RecordBatch) -> Iterator[tuple[int, set[str]]]:
    for value in batch.column(0):
        yield 1, {word.lower() for word in TERM.findall(value.as_py() or "")}


def _of_texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    for times, outside, inside in zip(*[(v.as_py() for v in column) for column in batch.columns]):
        yield times, outside + inside


def _hits(docs: DataFrame, keep: list[Column], text: str, admitted: np.ndarray) -> DataFrame:
    """(kept columns, term, start, stop): every occurrence of an admitted term."""
    sent = docs.sparkSession.sparkContext.broadcast(admitted)
    rows = docs.select(*keep, F.col(text).alias("__text"))

    names = [c for c in rows.columns if c != "__text"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_map = _admits(sent.value)
        known: dict[str, bool] = {}

        def admits(term: str) -> bool:
            if term not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[term] = in_map(term)
            return known[term]

        for batch in sliced(batches):
            at, terms, starts, stops = [], [], [], []
            for row, value in enumerate(batch.column(len(names))):
                for m in TERM.finditer(value.as_py() or ""):
                    if admits(term := m[0].lower()):
                        at.append(row)
                        terms.append(term)
                        starts.append(m.start())
                        stops.append(m.end())
            rest = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:-1]]
            made = [pa.array(terms, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*names, "term", "start", "stop"])

    return rows.mapInArrow(find, f"{kinds}, term string, start int, stop int")


def _texts(based: DataFrame) -> DataFrame:
    """One row per distinct text that holds entities: how many documents have it, its entities and its terms."""
    named = based.filter(F.size("entities") > 0).groupBy("t1", "t2")
    return stored(named.agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in ("entities", "outside", "inside")]), "texts")


def _together(texts: DataFrame, entities: np.ndarray | None = None, terms: np.ndarray | None = None) -> DataFrame:
    """(entity, term, both, texts): documents that hold both, and distinct texts with the term outside of spans,
    for admitted entities and terms, summed up within tasks first."""
    sent = texts.sparkSession.sparkContext.broadcast([entities, terms])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_entities, of_terms = [None if bits is None else _admits(bits) for bits in sent.value]
        sums: dict[tuple[str, str], list[int]] = {}

        def admitted(values, admits):
            return values if admits is None else [v for v in values if admits(v)]

        def summed() -> pa.RecordBatch:
            pairs, counts = list(sums), list(sums.values())
            sums.clear()
            made = [pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)] + [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(made, names=["entity", "term", "both", "texts"])

        for batch in sliced(batches):
            for times, names, *terms in zip(*[(v.as_py() for v in column) for column in batch.columns]):
                names = admitted(names, of_entities)
                for one, found in zip((1, 0), [admitted(t, of_terms) for t in terms] if names else []):
                    for name in names:
                        for term in found:
                            n = sums.setdefault((name, term), [0, 0])
                            n[0] += times
                            n[1] += one
                        if len(sums) >= PAIRS_REMEMBERED:
                            yield summed()
        yield summed()

    rows = texts.select("times", "entities", "outside", "inside").mapInArrow(count, "entity string, term string, both bigint, texts bigint")
    return rows.groupBy("entity", "term").agg(F.sum("both").alias("both"), F.sum("texts").alias("texts"))


def _documents_of_entities(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode("entities").alias("entity"), "times").groupBy("entity").agg(F.sum("times").alias("n_entity"))


def _most_documents(texts: DataFrame, total: int, at_least: float = GENERALISE_AT) -> float:
    """How many documents a term can occur in and still disclose some entity.

    No more documents hold both than hold the entity c, so PMI(c; t) / IC(c) >= x needs p(t) <= p(c) ** x, which
    grows with p(c) for x above 0.
    """
    if at_least <= 0:
        return math.inf
    most = _documents_of_entities(texts).filter(F.col("n_entity") < total).agg(F.max("n_entity")).first()[0]
    return total * (most / total) ** at_least * (1 + 1e-9) if most else 0.0


def disclosing(texts: DataFrame, counts: DataFrame, total: int, at_least: float = GENERALISE_AT) -> DataFrame:
    """(term, disclosure): the terms that reveal some entity, with the highest PMI / IC over entities."""
    counts = counts.filter(F.col("n") <= _most_documents(texts, total, at_least))
    together = _together(texts, terms=_admitted(counts))
    alone = _documents_of_entities(texts)
    pmi = F.log(F.col("both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n")))
    strength = pmi / F.log(F.lit(float(total)) / F.col("n_entity"))
    return (
        together.join(counts, "term").join(alone, "entity")
        .filter((F.col("n_entity") < total) & (F.col("texts") > 0)).groupBy("term").agg(F.max(strength).alias("disclosure"))
        .filter(F.col("disclosure") >= at_least)
    )


def candidates(texts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Terms that share at least ``support`` distinct texts with one entity."""
    names = texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("texts"))
    often = _admitted(names.filter(F.col("texts") >= support), "entity")
    return _together(texts, entities=often).filter(F.col("texts") >= support).select("term").distinct()


def found(docs: DataFrame, keep: list[Column], text: str = "text", support: int = SUPPORT, remove_at: float = REMOVE_AT,
          generalise_at: float = GENERALISE_AT) -> DataFrame:
    """The kept columns and ``base`` and ``terms``: spans of fixed form, and (kind, start, stop, value) of disclosing
    terms, kind ``term_removed`` or ``term_general``. Three passes over the texts: entities and the terms beside them, document counts of the
    candidates, and where disclosing terms occur; candidates' occurrences are never kept. No text is shuffled."""
    based = _based(docs, [*keep, *row_key(docs)], text)
    texts = _texts(based)
    total, named = docs.count(), stored(candidates(texts, support), "terms")
    # Their documents among those with entities are no more than all of theirs: what does not disclose by these counts does not at all.
    beside = _counts(texts.select("times", "outside", "inside"), _admitted(named), _of_texts).join(named, "term")
    rare = stored(disclosing(texts, stored(beside, "counts"), total, generalise_at).select("term"), "terms")
    counts = _counts(docs.select(F.col(text).alias("__text")), _admitted(rare), _of_documents).join(rare, "term")
    strong = stored(disclosing(texts, stored(counts, "counts"), total, generalise_at), "terms")
    hits = stored(_hits(docs, row_key(docs), text, _admitted(strong)).join(strong, "term"), "hits")

    kind = F.when(F.col("disclosure") >= remove_at, "term_removed").otherwise("term_general")
    spans = hits.select("__k1", "__k2", F.struct(kind.alias("kind"), "start", "stop", F.col("term").alias("value")).alias("span"))
    by_row = spans.distinct().groupBy("__k1", "__k2").agg(F.array_sort(F.collect_list("span")).alias("terms"))
    joined = based.join(by_row, ["__k1", "__k2"], "left")
    empty = F.array().cast(f"array<{SPAN}>")
    return joined.withColumn("terms", F.coalesce("terms", empty)).drop("t1", "t2", "entities", "outside", "inside")


@F.pandas_udf(StringType())
def _masked(texts: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
    def masked(text, spans):
        out, at = [], 0
        for start, stop, word in sorted(spans):
            if start >= at:
                out += [text[at:start], word]
                at = stop
        return "".join([*out, text[at:]])

    def words(base, terms):
        yield from ((s["start"], s["stop"], f"[{s['kind'].upper()}]") for s in base)
        yield from ((s["start"], s["stop"], "" if s["kind"] == "term_removed" else "[TERM]") for s in terms)

    return pd.Series([t if t is None else masked(t, words(b, s)) for t, b, s in zip(texts, base, terms)], dtype=object)


def sanitised(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents with entities replaced by their kind and disclosing terms generalised or removed, in their own columns."""
    spans = found(docs, [], text, **limits).dropDuplicates(["__k1", "__k2"]).withColumnsRenamed({"base": "__base", "terms": "__terms"})
    joined = docs.select("*", *row_key(docs)).join(spans, ["__k1", "__k2"])
    return joined.withColumn(text, _masked(F.col(text), F.col("__base"), F.col("__terms"))).select(*[F.col(f"`{c}`") for c in docs.columns])
