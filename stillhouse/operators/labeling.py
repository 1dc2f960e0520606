"""Labelling jobs with a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillhouse.functions.answers import single_label
from stillhouse.functions.payload import json_text
from stillhouse.functions.text import dotall, is_blank, strip
from stillhouse.sources.batches import bounded_batches, sliced
from stillhouse.sources.folders import children
from stillhouse.sources.specs import FREE_TEXT, JSON, SINGLE_LABEL, TaskSpec, dispatch
from stillhouse.sources.workspace import new_folder

# Fixed value: requests in flight per client.
IN_FLIGHT = 10
# Prompts that a task's Python holds as strings at a time.
IN_PYTHON = 200

Labeler = Callable[[str], str | None]

RESPONSES = "record_id string, task string, input string, response string"
PROMPTS = "record_id string, task string, input string, prompt string"


def label(prompts: DataFrame, make_labeler: Callable[[], Labeler], in_flight: int = IN_FLIGHT) -> DataFrame:
    """Responses to (record_id, task, input, prompt), in arrival order of the rows.

    ``make_labeler`` runs once per partition, on the executor, and returns the function that
    answers one prompt. At most ``in_flight`` requests of a partition run at a time. Texts stay in Arrow but for the
    prompts of one slice. Lazy: see ``label_to_table`` for real models; it bounds the batches' bytes, too.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = make_labeler()
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            for batch in sliced(batches, IN_PYTHON):
                prompts = batch.column("prompt")
                responses = pa.array(list(pool.map(ask, prompts.to_pylist())), type=prompts.type)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("record_id", "task", "input")], responses], ["record_id", "task", "input", "response"]
                )

    rows = prompts.select(F.col("record_id").cast("string").alias("record_id"), "task", "input", "prompt")
    return rows.mapInArrow(answer, RESPONSES)


def shares_of(spark: SparkSession, path: str) -> int:
    """How many shares a labelling table is parted into; 0 if there is none yet."""
    return max((int(c.split("=")[1]) for c in children(spark, path) if c.startswith("shares=")), default=0)


def of_wave(spark: SparkSession, path: str, schema: str, wave: int, waves: int) -> DataFrame:
    """The rows of one wave in a table that is parted by share: only the folders of its shares are opened."""
    shares = shares_of(spark, path)
    root, low, high = f"{path}/shares={shares}", wave * shares // waves, (wave + 1) * shares // waves
    own = [c for c in children(spark, root) if c.startswith("share=") and low <= int(c.split("=")[1]) < high]
    return spark.read.schema(schema).parquet(*[f"{root}/{c}" for c in own]) if own else spark.createDataFrame([], schema)


def label_to_table(prompts: DataFrame, make_labeler: Callable[[], Labeler], path: str, waves: int = 1,
                   in_flight: int = IN_FLIGHT) -> DataFrame:
    """Label what ``path`` does not hold yet, append the raw responses there, and read them back.

    The table is written before anything is parsed, so recomputing a later stage never asks the
    model again. Prompts are written once to a ledger by hash share of their records, answers to ``path`` by the same shares.
    Each wave is one committed job over its shares of both, so what it reads falls with the number of waves: a job
    that dies loses one wave, and calling this again resumes with the rest. The first call decides how many shares there
    are, one per wave; later calls may take fewer waves, of several shares each.
    """
    spark, ledger = prompts.sparkSession, new_folder(prompts.sparkSession, "prompts")
    shares = shares_of(spark, path) or waves
    share = F.pmod(F.xxhash64("record_id"), F.lit(shares)).cast("int")
    rows = prompts.select(F.col("record_id").cast("string").alias("record_id"), "task", "input", "prompt").withColumn("share", share)
    rows.hint("rebalance", "share").write.partitionBy("share").parquet(f"{ledger}/shares={shares}")
    for wave in range(min(waves, shares)):
        done = of_wave(spark, path, RESPONSES, wave, min(waves, shares)).select(F.col("record_id").alias("__id"), F.col("task").alias("__task"))
        same = F.col("record_id").eqNullSafe(F.col("__id")) & F.col("task").eqNullSafe(F.col("__task"))
        todo = of_wave(spark, ledger, PROMPTS, wave, min(waves, shares)).join(done, same, "left_anti")
        answered = label(todo, make_labeler, in_flight).withColumn("share", share)
        with bounded_batches(spark):
            answered.write.mode("append").partitionBy("share").parquet(f"{path}/shares={shares}")
    return spark.read.schema(RESPONSES).parquet(path).select("record_id", "task", "input", "response")


def parse_response(spec: TaskSpec, response: Column, generic_json: Column) -> Column:
    if spec.output_format == SINGLE_LABEL:
        return single_label(response, spec.labels, spec.output_regex)
    if spec.output_format == JSON:
        return generic_json
    plain = F.when(~is_blank(response), strip(response))
    if spec.output_format == FREE_TEXT and spec.output_regex:
        pattern = dotall(spec.output_regex)
        return F.when(response.rlike(pattern), strip(F.regexp_extract(response, pattern, 1))).otherwise(plain)
    return plain


def parse_labels(responses: DataFrame, specs: Sequence[TaskSpec], response: str = "response",
                 task: str = "task") -> DataFrame:
    """Adds ``output``: the parsed label, or null. Only JSON tasks' answers visit Python."""
    json_tasks = [s.name for s in specs if s.output_format == JSON]
    step, generic = responses, F.lit(None).cast("string")
    if json_tasks:
        step = step.withColumn("__json", json_text(F.when(F.col(task).isin(json_tasks), F.col(response))))
        generic = F.when(F.col("__json") != "null", F.col("__json"))
    parsed = dispatch(specs, F.col(task), lambda s: parse_response(s, F.col(response), generic))
    return step.withColumn("output", parsed).drop("__json")


def label_yield(parsed: DataFrame, task: str = "task") -> DataFrame:
    """(task, inputs, labelled): how many answers gave a label."""
    return parsed.groupBy(task).agg(F.count("*").alias("inputs"), F.count("output").alias("labelled"))
