"""Finding and redacting personal data whose form tells it apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.once import let

# Order matters for redaction: longer forms go first. person and address have no fixed form and need a model.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    # A local part starts where no such character stands before it, or where the match before ended (\G), and is never
    # given back, so a run of letters is read once however long it is.
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "credit_card": r"\b(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}|3\d{3}[ -]\d{6}[ -]\d{5})\b",
    "ssn": r"\b(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{9})\b",
    "phone": r"(?:\+\d{1,3}[ -])?(?:\(\d{3}\) ?|\b\d{3}[-. ])\d{3}[-. ]\d{4}\b|\b\d{3}-\d{4}\b",
}
# A text without these cannot match, and the test is much cheaper than the pattern.
NEEDS = {"email": r"@", "credit_card": r"\d{4}[ -]?\d{4}|\d{4}[ -]\d{6}", "ssn": r"\d{3}[- ]\d{2}[- ]|\d{9}", "phone": r"\d{3}[-. ]\d{4}"}
ANY = "|".join(NEEDS.values())


def _without(text: Column, kind: str) -> Column:
    return F.when(text.rlike(NEEDS[kind]), F.regexp_replace(text, PATTERNS[kind], f"[{kind.upper()}]")).otherwise(text)


def redact(text: Column, only: list[str] | None = None) -> Column:
    """The text with every span replaced by its type in brackets."""
    out = text
    for kind in PATTERNS:
        if only is None or kind in only:
            out = let(out, lambda t: _without(t, kind))
    return out


def _spans(text: Column, kinds: list[str]) -> Column:
    kind, *others = kinds
    hits = F.when(
        text.rlike(NEEDS[kind]), F.array_distinct(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)))
    )
    typed = F.transform(
        F.coalesce(hits, F.array().cast("array<string>")), lambda e: F.struct(e.alias("entity"), F.lit(kind).alias("type"))
    )
    return F.concat(typed, let(_without(text, kind), lambda rest: _spans(rest, others))) if others else typed


def spans(text: Column) -> Column:
    """array<struct<entity, type>>: each distinct span once, grouped by type, in text order.

    Spans of one type are taken out before the next type is looked for.
    """
    return F.when(text.rlike(ANY), _spans(text, list(PATTERNS)))


def detect(df: DataFrame, record: str, text: str) -> DataFrame:
    """(record, position, entity, type): one row per span."""
    return df.select(record, F.posexplode(spans(F.col(text))).alias("position", "span")).select(
        record, "position", F.col("span.entity").alias("entity"), F.col("span.type").alias("type")
    )
