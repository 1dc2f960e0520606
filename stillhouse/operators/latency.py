"""Latency summaries over recorded request timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.operators.ranks import exact_ranks

# Percentiles and the number of timed requests.
P95 = 0.95
BENCHMARK_REQUESTS = 20


def latency_summary(df: DataFrame, groups: list[str], latency: str = "latency_ms") -> DataFrame:
    """Per group: n, mean, p50 (mean of the middle two) and p95 (sorted[min(int(n * 0.95), n - 1)])."""
    ranks = {
        "low_mid": lambda n: F.floor((n + 1) / F.lit(2.0)).cast("bigint"),
        "high_mid": lambda n: F.floor(n / F.lit(2.0)).cast("bigint") + 1,
        "p95": lambda n: F.least((n.cast("double") * F.lit(P95)).cast("bigint") + 1, n),
    }
    stats = exact_ranks(df, groups, latency, ranks)
    return stats.select(
        *groups, "n", "mean", ((F.col("low_mid") + F.col("high_mid")) / 2).alias("p50"), "p95"
    )


def approximate_latency(df: DataFrame, groups: list[str], latency: str = "latency_ms") -> DataFrame:
    """One-pass sketch of the same figures, where an approximation will do."""
    return df.groupBy(*groups).agg(
        F.count(latency).alias("n"),
        F.avg(latency).alias("mean"),
        F.percentile_approx(latency, 0.5).alias("p50"),
        F.percentile_approx(latency, P95).alias("p95"),
    )


def speedup(teacher: Column, student: Column) -> Column:
    """teacher / student if both are there and not zero, else null."""
    return F.when((teacher != 0) & (student != 0), teacher / student)


def latency_table(summary: DataFrame, task: str, model: str = "model",
                  teacher: str = "teacher", student: str = "student") -> DataFrame:
    """One row per task: both p50s and the speedup; a missing side stays null."""
    wide = summary.groupBy(task).agg(
        F.max(F.when(F.col(model) == teacher, F.col("p50"))).alias("teacher_p50"),
        F.max(F.when(F.col(model) == student, F.col("p50"))).alias("student_p50"),
    )
    return wide.withColumn("speedup", speedup(F.col("teacher_p50"), F.col("student_p50")))
