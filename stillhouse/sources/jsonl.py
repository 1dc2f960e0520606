"""JSON Lines sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stillhouse.functions.payload import python_spelling, with_payload
from stillhouse.functions.text import strip
from stillhouse.sources.messages import message_record

MESSAGES = "array<struct<role: string, content: string>>"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """Rows of JSON Lines files as ``schema`` (a DDL string); blank lines are skipped.

    ``strict``: a line that is not exactly one JSON object raises. Spark's own JSON reader lets
    text after the object pass even in FAILFAST mode. Otherwise such lines come back in
    ``bad_line`` with null columns.
    """
    lines = spark.read.text(path).select(strip(F.col("value")).alias("line")).filter(F.col("line") != "")
    found = with_payload(lines, "line", "json")
    whole = F.when(F.col("json.path") == "whole", F.col("json.doc"))
    row = F.try_variant_get(whole, "$", f"struct<{schema}>")
    if strict:
        message = F.concat(F.lit("not one JSON object: "), F.col("line"))
        row = F.coalesce(row, F.raise_error(message).cast(f"struct<{schema}>"))
        return found.select(row.alias("row")).select("row.*")
    return found.select(row.alias("row"), F.when(row.isNull(), F.col("line")).alias("bad_line")).select(
        "row.*", "bad_line"
    )


def read_messages(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """Message records of training files."""
    return read_jsonl(spark, path, f"messages: {MESSAGES}", strict)


def write_jsonl(df: DataFrame, path: str, python_text: bool = False) -> None:
    """Overwrite a folder of JSON Lines part files.

    ``python_text`` spells every line as Python's ``json.dumps`` does, at the cost of one pass
    through Python.
    """
    if python_text:
        whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        df.select(python_spelling(whole).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_split(pairs: DataFrame, path: str, task: str = "task", split: str = "split") -> None:
    """Train and test message records under ``task=.../split=.../``.

    Rows are rebalanced by task and split first: without it every task of a wide stage would
    write a file per folder, and with a plain repartition one hot task would be a single file.
    """
    records = pairs.select(task, split, message_record(F.col("input"), F.col("output")).alias("messages"))
    records.hint("rebalance", task, split).write.mode("overwrite").partitionBy(task, split).json(path)


