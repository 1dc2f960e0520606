"""JSON inside model answers.

Answers that are one well-formed JSON document are decoded in the JVM. ``try_parse_json`` stops
reading after the first value, so the text is parsed as an element of an array that also holds a
hash of the text: the hash can only come last, with exactly two elements, if the whole text was
consumed. Everything else that could still hold JSON (fences, prose, duplicate keys, NaN) goes
through one Arrow function around Python's own ``json``.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stillhouse.functions.once import with_once

FENCE = "```"


def strict_json(text: Column) -> Column:
    """Variant of a text that is one JSON document and nothing else; null otherwise."""
    mark = F.xxhash64(text).cast("string")
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    consumed = (F.try_variant_get(pair, "$[1]", "string") == mark) & F.isnull(
        F.try_variant_get(pair, "$[2]", "variant")
    )
    return F.when(consumed, F.try_variant_get(pair, "$[0]", "variant"))


def with_strict_json(df: DataFrame, first: Column, second: Column, names: tuple[str, str]) -> DataFrame:
    """Adds ``strict_json`` of two texts; they are read in one go where both are JSON, each with its hash behind it."""
    marks, pair = [F.xxhash64(c).cast("string") for c in (first, second)], F.col("__pair")

    def at(i: int, kind: str) -> Column:
        return F.try_variant_get(pair, f"$[{i}]", kind)

    read = (at(1, "string") == marks[0]) & (at(3, "string") == marks[1]) & F.isnull(at(4, "variant"))
    texts = [F.concat(c, F.lit(',"'), mark, F.lit('"')) for c, mark in zip((first, second), marks)]
    return (
        df.withColumn("__pair", F.try_parse_json(F.concat(F.lit("["), texts[0], F.lit(","), texts[1], F.lit("]"))))
        .withColumns({n: F.when(read, at(i, "variant")).otherwise(strict_json(c)) for n, c, i in zip(names, (first, second), (0, 2))})
        .drop("__pair")
    )


# The whole of such a text is no JSON for any parser: it starts with a word that JSON does not have.
PROSE = r"^\s*+(?!true|false|null|NaN|Infinity)[A-Za-z]"


def likely_json(text: Column, outermost_first: bool = False) -> Column:
    """struct<path, text>: where ``find_json`` looks first, so that plain prose is decided in the JVM as well.

    The text itself, or in prose without fences its array, or its object if there is no array; a null
    text where prose has neither. If this is no JSON, Python has to look at the other places.
    """
    def place(path: str, pattern: str) -> Column:
        span = F.regexp_extract(text, pattern, 1)  # anchored, so that time is linear
        return F.when(span != "", F.struct(F.lit(path).alias("path"), span.alias("text")))

    array, obj = place("array", r"(?s)^[^\[]*+(\[.*\])"), place("object", r"(?s)^[^{]*+(\{.*\})")
    in_prose = F.coalesce(array, obj)
    if outermost_first:
        in_prose = F.when(F.instr(text, "{") < F.instr(text, "["), F.coalesce(obj, array)).otherwise(in_prose)
    nothing = F.struct(F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("text"))
    prose = text.rlike(PROSE) & ~F.contains(text, F.lit(FENCE))
    return F.when(prose, F.coalesce(in_prose, nothing)).otherwise(F.struct(F.lit("whole").alias("path"), text.alias("text")))


def _between(text: str, first: str, last: str) -> tuple[int, str] | None:
    """Where the first opening bracket stands, and the text from it to the last closing one."""
    start, stop = text.find(first), text.rfind(last)
    return (start, text[start:stop + 1]) if 0 <= start < stop else None


def _fenced(text: str) -> str | None:
    """What the first fence encloses, without its ``json`` tag. One look for each fence, so time is linear."""
    start = text.find(FENCE)
    stop = text.find(FENCE, start + len(FENCE)) if start >= 0 else -1
    return text[start + len(FENCE):stop].removeprefix("json").strip() if stop >= 0 else None


def _candidates(text: str, outermost_first: bool):
    """Fixed order of the places to look: the whole answer, its first fence, an array, an object."""
    yield "whole", text.strip()
    fenced = _fenced(text)
    if fenced is not None:
        yield "fenced", fenced
    spans = {"array": _between(text, "[", "]"), "object": _between(text, "{", "}")}
    found = [(name, span) for name, span in spans.items() if span]
    if outermost_first:
        found.sort(key=lambda pair: pair[1][0])
    for name, (_, span) in found:
        yield name, span


def find_json(text: str | None, outermost_first: bool = False):
    """(value, path) of the JSON in one answer, or (None, None)."""
    if text is None:
        return None, None
    for path, candidate in _candidates(text, outermost_first):
        try:
            return json.loads(candidate), path
        except (ValueError, RecursionError):  # brackets nested beyond Python's depth count as no JSON
            continue
    return None, None


def _finite(value):
    """Non-finite numbers as 1e999, the only spelling of them that strict JSON has."""
    if isinstance(value, float) and not math.isfinite(value):
        return "\x00inf"
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_finite(v) for v in value]
    return value


def _portable(value) -> str:
    text = json.dumps(value)
    if "NaN" in text or "Infinity" in text:
        text = json.dumps(_finite(value)).replace('"\\u0000inf"', "1e999")
    return text


_FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("path", T.StringType())])
_FOUND_ARROW = pa.struct([("text", pa.string()), ("path", pa.string())])


def _find_many(outermost_first: bool):
    def one(text):
        value, path = find_json(text, outermost_first)
        try:
            return None if value is None else {"text": _portable(value), "path": path}
        except RecursionError:
            return None

    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in texts.to_pylist()], type=_FOUND_ARROW)

    return find


def with_payload(df: DataFrame, response: str, out: str = "payload", outermost_first: bool = False) -> DataFrame:
    """Add ``out``: struct<doc variant, path string>, the JSON in an answer; nulls where there is none.

    ``path`` says where it was found: whole, fenced, array or object. A JSON ``null`` counts as
    none. Prose around an object holding an array yields the inner array, as the patterns are
    tried in that order; ``outermost_first`` takes the one that opens first instead.

    The steps are separate projections so that Spark parses once, not once per use, and only
    answers that are not plain well-formed JSON travel to Python.
    """
    text, native, found, likely = F.col(response), F.col(f"__{out}_native"), F.col(f"__{out}_found"), F.col(f"__{out}_likely")
    worth_a_look = native.isNull() & likely["text"].rlike(r"[{\[]|NaN|Infinity|```")
    doc = F.coalesce(native, F.try_parse_json(found["text"]))
    doc = F.when(~F.is_variant_null(doc), doc)
    path = F.when(native.isNotNull(), likely["path"]).otherwise(found["path"])
    step = (
        with_once(df, f"__{out}_likely", likely_json(text, outermost_first))
        .withColumn(f"__{out}_native", strict_json(likely["text"]))
        .withColumn(f"__{out}_found", _find_many(outermost_first)(F.when(worth_a_look, text)))
        .withColumn(f"__{out}_doc", doc)
    )
    resolved = F.col(f"__{out}_doc")
    both = F.struct(resolved.alias("doc"), F.when(resolved.isNotNull(), path).alias("path"))
    return with_once(step, out, both).drop(f"__{out}_likely", f"__{out}_native", f"__{out}_found", f"__{out}_doc")


@F.arrow_udf(T.StringType())
def json_text(responses: pa.Array) -> pa.Array:
    """The JSON of an answer re-serialised the way Python's ``json.dumps`` writes it."""
    values = (find_json(text)[0] for text in responses.to_pylist())
    return pa.array([None if v is None else json.dumps(v) for v in values], type=pa.string())


@F.arrow_udf(T.StringType())
def python_spelling(texts: pa.Array) -> pa.Array:
    """Compact JSON text respelled as ``json.dumps`` does: blanks after , and :, ASCII escapes."""
    return pa.array(
        [None if t is None else json.dumps(json.loads(t)) for t in texts.to_pylist()], type=pa.string()
    )


# --- type tests on variants: casts coerce, so the stored type is looked at ---------------------


def field(doc: Column, name: str) -> Column:
    """Member of an object, as a variant; null if the document is no object or lacks it."""
    return F.try_variant_get(doc, f"$['{name}']", "variant")


NUMBERS = ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID, or one of NUMBERS; SQL null for a missing value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def as_text(value: Column) -> Column:
    """String value of a variant that is a string, else null."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def as_number(value: Column) -> Column:
    """Double of a variant that is a number or, as in Python, a boolean; else null."""
    return F.when(kind(value).isin(*NUMBERS, "BOOLEAN"), F.try_variant_get(value, "$", "double"))


def items(value: Column) -> Column:
    """array<variant> of a variant that is an array, else null."""
    return F.when(kind(value) == "ARRAY", F.try_variant_get(value, "$", "array<variant>"))
