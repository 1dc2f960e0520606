"""Synthetic inputs from templates, and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillhouse.sources.messages import message_record
from stillhouse.sources.specs import TaskSpec, dispatch

SEED = 42


def template_number(index: Column, templates: Column | int, seed: int = SEED) -> Column:
    """Which template row ``index`` uses: the first pass goes in order, later rows are drawn by hash."""
    k = F.lit(templates).cast("bigint") if isinstance(templates, int) else templates.cast("bigint")
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), index.cast("string"))), 1, 8)
    drawn = F.conv(digest, 16, 10).cast("bigint") % k
    return F.when(index < k, index).otherwise(drawn)


def fill_template(template: Column, index: Column) -> Column:
    """``template.format(idx=index)``: {idx} is replaced, {{ and }} become braces."""
    opened = F.replace(template, F.lit("{{"), F.lit("\x01"))
    closed = F.regexp_replace(opened, r"(?<!\{idx)\}\}", "\x02")
    filled = F.replace(closed, F.lit("{idx}"), index.cast("string"))
    return F.translate(filled, "\x01\x02", "{}")


def synthetic_inputs(spark: SparkSession, spec: TaskSpec, n: int | None = None, seed: int = SEED) -> DataFrame:
    """(record_id, task, input): ``n`` inputs of a task, row i from template i or a hashed choice.

    The templates travel as a literal array, so this is one map-only pass over a range.
    """
    if not spec.synthetic_input_templates:
        raise ValueError(f"no synthetic input templates for {spec.name}")
    templates = F.array(*[F.lit(t) for t in spec.synthetic_input_templates])
    number = template_number(F.col("id"), len(spec.synthetic_input_templates), seed)
    rows = spark.range(spec.synthetic_examples if n is None else n)
    return rows.select(
        F.col("id").alias("record_id"),
        F.lit(spec.name).alias("task"),
        fill_template(F.get(templates, number), F.col("id")).alias("input"),
    )


def inputs_from_table(rows: DataFrame, index: str, templates: DataFrame, seed: int = SEED) -> DataFrame:
    """(record_id, template_no, input) for every row, with templates from a table
    ``(template_no, template)`` numbered from 0 without gaps.

    The number of templates is counted first; the join is an equi-join on the number, which
    Spark turns into a broadcast if the table is small.
    """
    k = templates.count()
    if k == 0:
        raise ValueError("no synthetic input templates")
    numbered = rows.select(
        F.col(index).alias("record_id"), template_number(F.col(index), k, seed).alias("template_no")
    )
    return numbered.join(templates, "template_no").select(
        "record_id", "template_no", fill_template(F.col("template"), F.col("record_id")).alias("input")
    )


def teacher_prompts(df: DataFrame, specs: Sequence[TaskSpec], input: str = "input", task: str = "task") -> DataFrame:
    """Adds ``prompt``: the task's full rubric around the input."""
    return df.withColumn("prompt", dispatch(specs, F.col(task), lambda s: s.prompt(F.col(input))))


def student_prompts(df: DataFrame, input: str = "input") -> DataFrame:
    """Adds ``messages``: the bare input as the only, user, message."""
    return df.withColumn("messages", F.slice(message_record(F.col(input), F.lit("")), 1, 1))
