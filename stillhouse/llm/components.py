"""Connected components by distributed union-find: alternating star contractions over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stillhouse.llm.common import stored


def _hooked(edges: DataFrame, by: str, lowest: DataFrame) -> DataFrame:
    return edges.join(lowest.withColumnRenamed("node", by), by)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge to another one.

    Each round hooks every node's larger neighbours, then its smaller ones, to the smallest
    neighbour (about log n rounds; chains shrink as well as stars). A round is two aggregates of a
    minimum, which combine before the shuffle, and two joins, whose hot side Spark can split. It is
    written to the shared folder; only its row count and checksum reach the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    now = stored(pairs.filter("high <> low").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            )
        seen = mark
        both = now.unionByName(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        nearest = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("to"))
        large = _hooked(now, "low", nearest).select("high", F.least("low", "to").alias("low")).distinct()
        least = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("to"))
        small = _hooked(large, "high", least)
        hooked = small.select("high", F.col("to").alias("low")).unionByName(
            small.filter("low <> to").select(F.col("low").alias("high"), F.col("to").alias("low"))
        )
        now = stored(hooked.distinct(), "edges")
