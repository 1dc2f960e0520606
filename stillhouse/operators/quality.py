"""Filters and normalisers over labelled records, with counted reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.answers import single_label, sql_statement, whole_word_label
from stillhouse.functions.degenerate import is_degenerate
from stillhouse.functions.once import let, with_once
from stillhouse.functions.payload import (
    NUMBERS, as_number, as_text, field, items, json_text, kind, python_spelling, with_payload,
)
from stillhouse.functions.text import collapse_space, strip
from stillhouse.sources.specs import JSON, SINGLE_LABEL, TaskSpec, dispatch

PII, SENTIMENT, RECEIPT, SQL = "pii_detection", "sentiment_aspect", "receipt_extraction", "sql_generation"
DEGENERATE = "degenerate"
NO_SPEC = "no_spec"


def pii_entities(doc: Column, labels: Sequence[str]) -> Column:
    """array<struct<entity, type>> of a decoded answer; null unless it is a list.

    {"entities": [...]} is unwrapped. Items that are no objects, have a blank entity or an unknown
    type are left out; order and duplicates stay.
    """
    known = [label.lower() for label in labels]

    def typed(x: Column) -> Column:
        return F.struct(
            strip(as_text(field(x, "entity"))).alias("entity"), F.lower(as_text(field(x, "type"))).alias("type")
        )

    listed = let(
        F.struct(doc.alias("doc"), field(doc, "entities").alias("wrapped")),
        lambda m: F.coalesce(items(m["wrapped"]), items(m["doc"])),
    )
    return F.filter(F.transform(listed, typed), lambda e: (e["entity"] != "") & e["type"].isin(known))


def sentiment(doc: Column, labels: Sequence[str]) -> Column:
    """struct<sentiment, aspect, confidence, reasoning>; null if any field is unfit."""
    known = [x.lower() for x in labels]
    members = F.struct(*[field(doc, k).alias(k) for k in ("sentiment", "aspect", "confidence", "reasoning")])

    def typed(m: Column) -> Column:
        return F.struct(
            F.lower(as_text(m["sentiment"])).alias("sentiment"),
            collapse_space(F.lower(strip(as_text(m["aspect"]))), "_").alias("aspect"),
            as_number(m["confidence"]).alias("confidence"),
            strip(as_text(m["reasoning"])).alias("reasoning"),
        )

    def checked(s: Column) -> Column:
        fit = s["sentiment"].isin(known) & (s["aspect"] != "") & (s["reasoning"] != "")
        return F.when(fit & (s["confidence"] >= 0.0) & (s["confidence"] <= 1.0), s)

    return let(let(members, typed), checked)


def receipt(doc: Column) -> Column:
    """struct<vendor, date, total, line_items>; null if a key is missing or has the wrong type.

    The total is a double. A price keeps its type: whole numbers and booleans stay, other numbers are doubles.
    """
    number_or_null = [*NUMBERS, "BOOLEAN", "VOID"]
    members = F.struct(*[field(doc, k).alias(k) for k in ("vendor", "date", "total", "line_items")])

    def item(x: Column) -> Column:
        price = field(x, "price")
        return F.struct(
            strip(as_text(field(x, "name"))).alias("name"),
            F.when(kind(price).isin("BIGINT", "BOOLEAN"), price).otherwise(as_number(price).cast("variant")).alias("price"),
            F.coalesce(kind(price), F.lit("VOID")).isin(number_or_null).alias("fit"),
        )

    def checked(m: Column) -> Column:
        kept = F.filter(F.transform(items(m["line_items"]), item), lambda i: (i["name"] != "") & i["fit"])
        fit = (
            kind(m["vendor"]).isin("STRING", "VOID")
            & kind(m["date"]).isin("STRING", "VOID")
            & kind(m["total"]).isin(number_or_null)
            & (kind(m["line_items"]) == "ARRAY")
        )
        return F.when(
            fit,
            F.struct(
                strip(as_text(m["vendor"])).alias("vendor"),
                strip(as_text(m["date"])).alias("date"),
                as_number(m["total"]).alias("total"),
                F.transform(kept, lambda i: F.struct(i["name"].alias("name"), i["price"].alias("price"))).alias("line_items"),
            ),
        )

    return let(members, checked)


def _as_json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _clean(spec: TaskSpec, output: Column, doc: Column, generic: Column, strict: bool) -> Column:
    if spec.output_format == SINGLE_LABEL:
        parse = whole_word_label if strict else single_label
        return parse(output, spec.labels, spec.output_regex)
    if spec.output_format == JSON:
        if spec.name == PII:
            return _as_json(pii_entities(doc, spec.labels))
        if spec.name == SENTIMENT:
            return _as_json(sentiment(doc, spec.labels))
        if spec.name == RECEIPT:
            return _as_json(receipt(doc))
        return generic
    if spec.name == SQL:
        return sql_statement(output, strict)
    return output


def reason_name(spec: TaskSpec) -> str | None:
    """Counter under which a task's second filter reports."""
    if spec.output_format == SINGLE_LABEL:
        return "single_label"
    if spec.output_format == JSON:
        return {PII: "pii_schema", SENTIMENT: "sentiment_schema", RECEIPT: "receipt_schema"}.get(spec.name, "json")
    return "sql" if spec.name == SQL else None


def judge(records: DataFrame, specs: Sequence[TaskSpec], output: str = "output", task: str = "task",
          strict: bool = False, python_text: bool = False) -> DataFrame:
    """Adds ``clean_output`` and ``reject_reason`` (null for records to keep), in one pass.

    The degenerate test comes first for every task, then the one filter of the task's output
    format. ``strict`` replaces the lenient label, JSON and SQL readings. ``python_text`` spells
    JSON outputs as ``json.dumps`` does. Rejects keep their row, so survivors and counters come
    from the same frame: write it once, then use ``survivors`` and ``removal_counts``.
    """
    json_tasks = [s.name for s in specs if s.output_format == JSON]
    generic_tasks = [n for n in json_tasks if n not in (PII, SENTIMENT, RECEIPT)]
    text = F.col(output)

    step = with_once(records, "__bad", is_degenerate(text))
    usable = F.when(~F.col("__bad"), text)
    doc, generic = F.lit(None).cast("variant"), F.lit(None).cast("string")
    if json_tasks:
        step = step.withColumn("__json", F.when(F.col(task).isin(json_tasks), usable))
        step = with_payload(step, "__json", "__payload", outermost_first=strict)
        doc = F.col("__payload.doc")
    if generic_tasks:
        step = step.withColumn("__generic", json_text(F.when(F.col(task).isin(generic_tasks), usable)))
        generic = F.when(doc.isNotNull(), F.col("__generic"))

    clean = dispatch(specs, F.col(task), lambda s: _clean(s, usable, doc, generic, strict))
    step = with_once(step, "clean_output", clean)
    if python_text and json_tasks:
        respelled = python_spelling(F.when(F.col(task).isin(json_tasks), F.col("clean_output")))
        step = step.withColumn("__respelled", respelled).withColumn(
            "clean_output", F.coalesce("__respelled", "clean_output")
        )
    failed = dispatch(specs, F.col(task), lambda s: F.lit(reason_name(s)))
    empty = F.col("clean_output").isNull() | (F.col("clean_output") == "")
    reason = F.when(F.col("__bad"), DEGENERATE).when(empty, F.coalesce(failed, F.lit(NO_SPEC)))
    return step.withColumn("reject_reason", reason).drop("__bad", "__json", "__payload", "__generic", "__respelled")


def survivors(judged: DataFrame, output: str = "output") -> DataFrame:
    """Records to keep, with their normalised output."""
    return judged.filter("reject_reason IS NULL").withColumn(output, F.col("clean_output")).drop(
        "clean_output", "reject_reason"
    )


def removal_counts(judged: DataFrame, task: str = "task") -> DataFrame:
    """(task, reason, removed); reasons that removed nothing have no row."""
    return (
        judged.filter("reject_reason IS NOT NULL")
        .groupBy(task, F.col("reject_reason").alias("reason"))
        .agg(F.count("*").alias("removed"))
    )


def removal_totals(judged: DataFrame, task: str = "task") -> DataFrame:
    """``removal_counts`` with totals per task and overall (null reason, null task)."""
    return removal_counts(judged, task).rollup(task, "reason").agg(F.sum("removed").alias("removed"))


def drop_degenerate(records: DataFrame, output: str = "output") -> DataFrame:
    """Records whose output is not degenerate."""
    return records.filter(~is_degenerate(F.col(output)))


def format_report(df: DataFrame, response: str = "response", task: str = "task") -> DataFrame:
    """Per task: how many JSON answers were plain, fenced, or inside prose, or had none."""
    found = with_payload(df.select(task, response), response)
    return found.groupBy(task, F.coalesce("payload.path", F.lit("none")).alias("parse_path")).agg(
        F.count("*").alias("answers")
    )
