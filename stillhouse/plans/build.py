"""Building a training set: filter, normalise, split, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillhouse.operators.quality import judge, removal_counts, survivors
from stillhouse.operators.splitting import split_exactly
from stillhouse.sources.jsonl import write_split
from stillhouse.sources.specs import TaskSpec


def judged_table(pairs: DataFrame, specs: Sequence[TaskSpec], path: str, **options) -> DataFrame:
    """``judge`` written to ``path`` and read back, so survivors, counters and the passes of the
    split all read the verdicts instead of parsing again."""
    judge(pairs, specs, **options).write.mode("overwrite").parquet(path)
    return pairs.sparkSession.read.parquet(path)


def build_dataset(pairs: DataFrame, specs: Sequence[TaskSpec], path: str, size: float | None = None,
                  eval_samples: int | None = 200, seed: int = 42, **options) -> tuple[DataFrame, DataFrame]:
    """Writes train and test message files below ``path`` from (record_id, task, input, output).

    Returns the kept records with their split, and the removal counts. Reads the input once and
    shuffles rows once, when the files are written.
    """
    judged = judged_table(pairs, specs, f"{path}/judged", **options)
    kept = survivors(judged)
    rows = split_exactly(kept, "record_id", ["task"], size=size, eval_samples=eval_samples, seed=seed)
    write_split(rows, f"{path}/files")
    return rows, removal_counts(judged)


def written_records(spark: SparkSession, path: str) -> DataFrame:
    """The message records that ``build_dataset`` wrote, with task and split."""
    schema = "messages array<struct<role: string, content: string>>, task string, split string"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/files").withColumn(
        "input", F.get("messages", F.lit(0))["content"]
    ).withColumn("output", F.get("messages", F.lit(1))["content"])
