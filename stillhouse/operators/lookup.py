"""Joining rows to an aggregate that is narrow and usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stillhouse.sources.workspace import written


def matched(rows: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on null-safe keys; the keys of ``side`` are dropped."""
    side = side.withColumnsRenamed({k: f"__on_{k}" for k in on})
    condition = [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in on]
    return rows.join(side, condition, how).drop(*[f"__on_{k}" for k in on])


def lookup(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """``matched`` with a table of one narrow row per key.

    The table is computed once and written, so its bytes are known: Spark broadcasts it below its own
    threshold and otherwise joins by sorting, where adaptive execution splits the partitions of hot keys.
    """
    return matched(rows, written(table, "lookup"), on, how)
