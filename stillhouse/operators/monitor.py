"""Watching a served model in batch: drift, agreement, retraining, spend.

Works on a serving log (request_id, ts, task, model, label, expected, in_tokens, out_tokens,
latency_ms). Every step aggregates first, so windows run over small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stillhouse.operators.cost import Price, request_cost
from stillhouse.operators.lookup import lookup


def label_windows(log: DataFrame, width: str, slide: str | None = None, label: str = "label", ts: str = "ts") -> DataFrame:
    """(window_start, window_end, label, n): label counts per tumbling or sliding window.

    Also valid on a stream, where ``log`` carries a watermark.
    """
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (
        log.groupBy(window.alias("window"), F.col(label).alias("label"))
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "label", "n")
    )


def label_drift(counts: DataFrame, step: str, labels: Sequence[str] | None = None) -> DataFrame:
    """(window_start, window_end, label, n, share, change): one row for every window of the counted span and every label.

    ``step`` is the distance of window starts; ``labels`` are the labels to expect, those that occur if not given (others that occur
    are added). A label that a window lacks has n and share 0, and the change is that since the window just before, so a
    label that vanishes shows as a drop. The grid is unfolded from one row of the span, by windows and labels.
    """
    named = F.array(*[F.lit(x) for x in labels or []]).cast("array<string>")
    span = counts.agg(
        F.min("window_start").alias("low"), F.max("window_start").alias("high"), F.collect_set("label").alias("seen"),
        F.max(F.col("window_end").cast("timestamp") - F.col("window_start").cast("timestamp")).alias("width"),
    ).filter("low IS NOT NULL")
    grid = span.select(
        F.explode(F.sequence("low", "high", F.expr(f"INTERVAL {step}"))).alias("window_start"), "width", F.array_distinct(F.concat("seen", named)).alias("labels")
    ).select("window_start", (F.col("window_start") + F.col("width")).alias("window_end"), F.explode("labels").alias("label"))
    rows = grid.join(counts.select("window_start", "label", "n"), ["window_start", "label"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    total = F.sum("n").over(Window.partitionBy("window_start"))
    before = Window.partitionBy("label").orderBy("window_start")
    shared = rows.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(0.0))
    return shared.withColumn("change", F.col("share") - F.lag("share").over(before)).select("window_start", "window_end", "label", "n", "share", "change")


def shadow_sample(log: DataFrame, share: float, request: str = "request_id", seed: int = 42) -> DataFrame:
    """The requests also sent to the teacher: a fixed hash share, the same on every run."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(request).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return log.filter(bucket < int(share * 2**32))


def agreement(student: DataFrame, teacher: DataFrame, groups: Sequence[str], request: str = "request_id") -> DataFrame:
    """(groups, compared, agreed, agreement) of two sets of answers to the same requests."""
    both = student.join(teacher.select(request, F.col("label").alias("teacher_label")), request)
    same = F.col("label") == F.col("teacher_label")
    return both.groupBy(*groups).agg(
        F.count("*").alias("compared"), F.count_if(same).alias("agreed"), F.avg(same.cast("double")).alias("agreement")
    )


def retrain_windows(log: DataFrame, width: str, threshold: float, groups: Sequence[str] = ("model",), ts: str = "ts") -> DataFrame:
    """(window_start, groups, n, accuracy) of windows whose accuracy on spot-checks is below the threshold."""
    checked = log.filter(F.col("expected").isNotNull())
    right = (F.col("label") == F.col("expected")).cast("double")
    return (
        checked.groupBy(F.window(ts, width).alias("window"), *groups)
        .agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))
        .filter(F.col("accuracy") < threshold)
        .select(F.col("window.start").alias("window_start"), *groups, "n", "accuracy")
    )


def failure_cases(log: DataFrame, windows: DataFrame, width: str, groups: Sequence[str] = ("model",), ts: str = "ts") -> DataFrame:
    """The wrong answers inside the given windows, as material for retraining."""
    wrong = log.filter(F.col("label") != F.col("expected")).withColumn("window_start", F.window(ts, width)["start"])
    return lookup(wrong, windows.select("window_start", *groups), ["window_start", *groups], "left_semi")


def usage(log: DataFrame, prices: Sequence[Price], projected: Column, groups: Sequence[str] = ("model",),
          price_of: dict[str, str] | None = None, ts: str = "ts") -> DataFrame:
    """Per day and group: requests, tokens per request, actual and projected cost.

    ``price_of`` maps the log's model names to price rows; ``projected`` is the planned cost of a
    request.
    """
    daily = log.groupBy(F.to_date(ts).alias("day"), *groups).agg(
        F.count("*").alias("requests"), F.sum("in_tokens").alias("tokens_in"), F.sum("out_tokens").alias("tokens_out")
    )
    named = {p.model: p for p in prices}
    cost = F.lit(None).cast("double")
    for model, price in (price_of or {m: m for m in named}).items():
        p = named[price]
        paid = request_cost(F.col("tokens_in"), F.col("tokens_out"), F.lit(p.in_per_1m), F.lit(p.out_per_1m))
        cost = F.when(F.col("model") == model, paid).otherwise(cost)
    return daily.withColumns(
        {
            "in_per_request": F.col("tokens_in") / F.col("requests"),
            "out_per_request": F.col("tokens_out") / F.col("requests"),
            "cost": cost,
            "projected_cost": F.col("requests") * projected,
        }
    )
