"""Task specifications: what is asked, how answers look, what a request costs."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, fields
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SINGLE_LABEL, JSON, FREE_TEXT = "single_label", "json", "free_text"


@dataclass(frozen=True)
class TaskSpec:
    """One task. Fields and defaults follow the task configuration users already have."""

    # The default settings of a task.
    name: str
    display_name: str
    labels: list[str]
    teacher_prompt: str
    output_format: str
    category: str = "text"
    output_regex: str | None = None
    teacher_model: str = "claude-sonnet-4-5-20250929"
    student_model: str = "Qwen/Qwen3-30B-A3B"
    renderer_name: str = "qwen3"
    learning_rate: float = 1e-4
    num_epochs: int = 4
    lora_rank: int = 32
    batch_size: int = 128
    max_length: int = 32768
    lr_schedule: str = "linear"
    teacher_input_tokens: int = 600
    student_input_tokens: int = 30
    teacher_output_tokens: int = 4
    student_output_tokens: int = 1
    teacher_latency_ms: float | None = None
    student_latency_ms: float | None = None
    synthetic_examples: int = 1000
    eval_samples: int = 200
    synthetic_input_templates: list[str] = field(default_factory=list)
    json_compare_keys: list[str] | None = None
    teacher_temperature: float = 0.15
    teacher_max_tokens: int = 1000

    def __post_init__(self):
        if self.output_format not in (SINGLE_LABEL, JSON, FREE_TEXT):
            raise ValueError(f"{self.name}: unknown output format {self.output_format!r}")

    def prompt(self, text: Column) -> Column:
        """The prompt around an input, as ``str.format(input=...)`` renders it.

        The prompt is taken apart once on the driver, so braces in the input stay as they are.
        """
        parts: list[Column] = []
        for literal, name, _, _ in Formatter().parse(self.teacher_prompt):
            if literal:
                parts.append(F.lit(literal))
            if name is not None:
                if name != "input":
                    raise KeyError(name)
                parts.append(text)
        return F.concat(*parts)


SPEC_SCHEMA = """name string, display_name string, labels array<string>, teacher_prompt string,
output_format string, category string, output_regex string, teacher_model string, student_model string,
renderer_name string, learning_rate double, num_epochs int, lora_rank int, batch_size int, max_length int,
lr_schedule string, teacher_input_tokens int, student_input_tokens int, teacher_output_tokens int,
student_output_tokens int, teacher_latency_ms double, student_latency_ms double, synthetic_examples int,
eval_samples int, synthetic_input_templates array<string>, json_compare_keys array<string>,
teacher_temperature double, teacher_max_tokens int"""


def spec_table(spark: SparkSession, specs: Iterable[TaskSpec]) -> DataFrame:
    """One row per task, in the given order (``ordinal``)."""
    rows = [asdict(s) for s in specs]
    names = [f.name for f in fields(TaskSpec)]
    data = [tuple(r[n] for n in names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SPEC_SCHEMA + ", ordinal int")


def load_specs(spark: SparkSession, path: str) -> list[TaskSpec]:
    """Specs kept as JSON documents, one file each or one folder of them. Absent keys take defaults.

    A registry of tasks is small by nature (one entry per prompt a team maintains), so it is read
    to the driver, where the dispatch expressions are built from it.
    """
    texts = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    return sorted((TaskSpec(**json.loads(t)) for t in texts), key=lambda s: s.name)


def dispatch(specs: Iterable[TaskSpec], task: Column, expression) -> Column:
    """``expression(spec)`` for the row's task; null for tasks without a spec.

    The patterns stay literals, so Spark compiles each once instead of once per row.
    """
    out: Column | None = None
    for spec in specs:
        value = expression(spec)
        out = F.when(task == spec.name, value) if out is None else out.when(task == spec.name, value)
    return F.lit(None) if out is None else out
