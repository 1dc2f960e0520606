"""Token profiles and cost projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stillhouse.functions.tokens import CHAT_OVERHEAD, TokenCounter, estimated_tokens
from stillhouse.sources.specs import TaskSpec


@dataclass(frozen=True)
class Price:
    model: str
    in_per_1m: float
    out_per_1m: float
    is_distilled: bool = False


# USD per million tokens (February 2026), in report order.
PRICES = [
    Price("GPT-5.2 (frontier)", 1.75, 14.00),
    Price("GPT-5 (frontier)", 1.25, 10.00),
    Price("Claude Opus 4.6 (frontier)", 5.00, 25.00),
    Price("GPT-4.1-mini (small)", 0.40, 1.60),
    Price("Gemini 2.5 Flash (small)", 0.30, 2.50),
    Price("Claude Haiku 4.5 (small)", 1.00, 5.00),
    Price("Tuned adapter (self-hosted)", 0.10, 0.10, True),
]
VOLUME_TIERS = [1_000, 10_000, 100_000, 1_000_000]
DAYS_PER_MONTH = 30
SAVINGS_VOLUME = 100_000
TUNED = PRICES[-1].model
FRONTIER = PRICES[0].model


def price_table(spark: SparkSession, prices: Sequence[Price] = PRICES) -> DataFrame:
    rows = [(i, p.model, p.in_per_1m, p.out_per_1m, p.is_distilled) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "ordinal int, model string, in_per_1m double, out_per_1m double, is_distilled boolean")


def request_cost(tokens_in: Column, tokens_out: Column, in_per_1m: Column, out_per_1m: Column) -> Column:
    return (tokens_in * in_per_1m + tokens_out * out_per_1m) / F.lit(1_000_000.0)


def reduction(teacher: Column, student: Column) -> Column:
    """Input tokens saved as a factor; null if the student uses none."""
    return F.when(student > 0, teacher / student)


def token_counts(df: DataFrame, text: str, prompt: Column, counter: TokenCounter = estimated_tokens,
                 overhead: int = CHAT_OVERHEAD) -> DataFrame:
    """Adds ``teacher_in`` (the whole prompt) and ``student_in`` (the bare text and the chat template)."""
    return df.withColumn("teacher_in", counter(prompt)).withColumn("student_in", counter(F.col(text)) + overhead)


def token_profile(counted: DataFrame, groups: Sequence[str], teacher_out: int, student_out: int) -> DataFrame:
    """Per group: average, least and most input tokens of both approaches, fixed output tokens."""
    def three(c: str) -> list[Column]:
        return [F.avg(c).alias(f"{c}_avg"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]

    return counted.groupBy(*groups).agg(
        F.count("*").alias("requests"), *three("teacher_in"), *three("student_in")
    ).withColumns(
        {
            "teacher_out": F.lit(teacher_out),
            "student_out": F.lit(student_out),
            "input_reduction": reduction(F.col("teacher_in_avg"), F.col("student_in_avg")),
        }
    )


def spec_tokens(spark: SparkSession, specs: Sequence[TaskSpec]) -> DataFrame:
    """(task, teacher_in, teacher_out, student_in, student_out) from the specs' estimates."""
    rows = [
        (s.name, s.display_name, s.category, s.teacher_input_tokens, s.teacher_output_tokens,
         s.student_input_tokens, s.student_output_tokens)
        for s in specs
    ]
    return spark.createDataFrame(
        rows, "task string, display_name string, category string, teacher_in int, teacher_out int, student_in int, student_out int"
    )


def cost_by_model(tokens: DataFrame, prices: Sequence[Price] = PRICES) -> DataFrame:
    """One row per row of ``tokens`` and price: approach, tokens and cost per request.

    The prices are a short parameter list, unfolded in place; nothing is joined.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(p.model).alias("model"), F.lit(p.in_per_1m).alias("in_per_1m"),
                F.lit(p.out_per_1m).alias("out_per_1m"), F.lit(p.is_distilled).alias("is_distilled"),
            )
            for i, p in enumerate(prices)
        ]
    )
    kept = [c for c in tokens.columns if c not in ("teacher_in", "teacher_out", "student_in", "student_out")]
    rows = tokens.withColumn("p", F.explode(listed))
    tuned = F.col("p.is_distilled")
    tokens_in = F.when(tuned, F.col("student_in")).otherwise(F.col("teacher_in"))
    tokens_out = F.when(tuned, F.col("student_out")).otherwise(F.col("teacher_out"))
    return rows.select(
        *kept, F.col("p.ordinal").alias("ordinal"), F.col("p.model").alias("model"),
        tuned.alias("is_distilled"),
        F.when(tuned, "distilled").otherwise("teacher").alias("approach"),
        tokens_in.alias("tokens_in"), tokens_out.alias("tokens_out"),
        request_cost(tokens_in, tokens_out, F.col("p.in_per_1m"), F.col("p.out_per_1m")).alias("cost_per_request"),
    )


def cost_by_volume(costs: DataFrame, tiers: Sequence[int] = VOLUME_TIERS) -> DataFrame:
    """``costs`` times the volume tiers: daily and monthly cost."""
    rows = costs.withColumn("volume", F.explode(F.array(*[F.lit(v).cast("bigint") for v in tiers])))
    daily = F.col("cost_per_request") * F.col("volume")
    return rows.withColumns({"daily_cost": daily, "monthly_cost": daily * DAYS_PER_MONTH})


def daily_table(costs: DataFrame, keys: Sequence[str], tiers: Sequence[int] = VOLUME_TIERS) -> DataFrame:
    """One row per key and model, one column of daily cost per tier."""
    return costs.select(
        *keys, "model", *[(F.col("cost_per_request") * v).alias(f"per_day_{v}") for v in tiers]
    )


def _first_extreme(cost: Column, ordinal: Column, model: Column, wanted: Column, dearest: bool) -> Column:
    """(cost, model) of the dearest or cheapest wanted model; the first listed one on ties."""
    side = F.struct(cost.alias("cost"), (-ordinal if dearest else ordinal).alias("at"), model.alias("model"))
    best = F.max if dearest else F.min
    return best(F.when(wanted, side))


def savings(costs: DataFrame, keys: Sequence[str], volume: int = SAVINGS_VOLUME) -> DataFrame:
    """Per key: dearest against cheapest API model and against the tuned one."""
    cost, ordinal, model = F.col("cost_per_request"), F.col("ordinal"), F.col("model")
    api = ~F.col("is_distilled")
    ends = costs.groupBy(*keys).agg(
        _first_extreme(cost, ordinal, model, api, True).alias("top"),
        _first_extreme(cost, ordinal, model, api, False).alias("low"),
        F.max(F.when(~api, F.struct(ordinal.alias("at"), cost.alias("cost")))).alias("tuned"),
    )
    top, low, tuned = F.col("top.cost"), F.col("low.cost"), F.col("tuned.cost")
    return ends.select(
        *keys,
        F.col("top.model").alias("dearest_model"), top.alias("dearest_cost"),
        F.col("low.model").alias("cheapest_model"), low.alias("cheapest_cost"),
        F.when(low > 0, top / low).alias("cheapest_ratio"),
        ((top - low) * volume).alias("cheapest_saving_per_day"),
        tuned.alias("tuned_cost"),
        F.when(tuned > 0, top / tuned).alias("tuned_ratio"),
        ((top - tuned) * volume).alias("tuned_saving_per_day"),
    )


def savings_against(costs: DataFrame, keys: Sequence[str], baseline: str = FRONTIER, volume: int = SAVINGS_VOLUME) -> DataFrame:
    """Per key: the named baseline against the cheapest other API model and the tuned one."""
    cost, ordinal, model = F.col("cost_per_request"), F.col("ordinal"), F.col("model")
    other = ~F.col("is_distilled") & (model != baseline)
    ends = costs.groupBy(*keys).agg(
        F.max(F.when(model == baseline, cost)).alias("base"),
        _first_extreme(cost, ordinal, model, other, False).alias("small"),
        F.max(F.when(F.col("is_distilled"), F.struct(ordinal.alias("at"), cost.alias("cost")))).alias("tuned"),
    )
    base, small, tuned = F.col("base"), F.col("small.cost"), F.col("tuned.cost")
    return ends.select(
        *keys, base.alias("baseline_cost"), F.col("small.model").alias("small_model"), small.alias("small_cost"),
        (base / F.nullif(small, F.lit(0.0))).alias("small_ratio"), ((base - small) * volume).alias("small_saving_per_day"),
        (base / F.nullif(tuned, F.lit(0.0))).alias("tuned_ratio"), ((base - tuned) * volume).alias("tuned_saving_per_day"),
    )


def task_summary(tokens: DataFrame, frontier: Price = PRICES[0], tuned: Price = PRICES[-1], volume: int = SAVINGS_VOLUME) -> DataFrame:
    """Per row of ``tokens``: cost per request of both sides, the ratio, and cost and saving per month."""
    top = request_cost(F.col("teacher_in"), F.col("teacher_out"), F.lit(frontier.in_per_1m), F.lit(frontier.out_per_1m))
    low = request_cost(F.col("student_in"), F.col("student_out"), F.lit(tuned.in_per_1m), F.lit(tuned.out_per_1m))
    month = volume * DAYS_PER_MONTH
    return tokens.withColumns({"frontier_cost": top, "tuned_cost": low}).withColumns(
        {
            "savings_ratio": F.when(F.col("tuned_cost") > 0, F.col("frontier_cost") / F.col("tuned_cost")),
            "frontier_month": F.col("frontier_cost") * volume * DAYS_PER_MONTH,
            "tuned_month": F.col("tuned_cost") * volume * DAYS_PER_MONTH,
        }
    ).withColumn("month_saving", F.col("frontier_month") - F.col("tuned_month"))


def break_even(summary: DataFrame, training_cost: float) -> DataFrame:
    """Adds ``break_even_requests``: how many requests pay for the training; null if none do."""
    gain = F.col("frontier_cost") - F.col("tuned_cost")
    return summary.withColumn("break_even_requests", F.when(gain > 0, F.ceil(F.lit(float(training_cost)) / gain)))


def corpus_cost(counted: DataFrame, task: str, teacher_out: int, student_out: int, prices: Sequence[Price] = PRICES) -> DataFrame:
    """(task, model, requests, tokens_in, tokens_out, cost) of running real rows, with totals by rollup.

    Tokens are summed per task first, so only one row per task meets the prices.
    """
    sums = counted.groupBy(task).agg(
        F.count("*").alias("requests"), F.sum("teacher_in").alias("teacher_in"), F.sum("student_in").alias("student_in")
    ).withColumns({"teacher_out": F.col("requests") * teacher_out, "student_out": F.col("requests") * student_out})
    return cost_by_model(sums, prices).rollup(task, "model").agg(
        F.sum("requests").alias("requests"), F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"), F.sum("cost_per_request").alias("cost"),
    )


def training_manifest(pairs: DataFrame, tokens: Column, batch_size: int, epochs: int, max_length: int, task: str = "task") -> DataFrame:
    """Per task: records that fit ``max_length`` tokens, those that do not, and training steps."""
    fits = tokens <= max_length
    return pairs.groupBy(task).agg(
        F.count_if(fits).alias("records"), F.count_if(~fits).alias("too_long"), F.sum(F.when(fits, tokens)).alias("tokens")
    ).withColumn("steps", (F.ceil(F.col("records") / F.lit(float(batch_size))) * epochs).cast("bigint"))
