"""Registered queries: token profiles, costs and savings.

Every figure starts from tokens counted over the documents, one "task" per source. All computed
doubles are rounded in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stillhouse.operators.cost import (
    FRONTIER, PRICES, VOLUME_TIERS, break_even, corpus_cost, cost_by_model, cost_by_volume, daily_table, savings,
    savings_against, task_summary, token_counts, token_profile,
)
from stillhouse.plans.registry import registered
from stillhouse.sources.builtin_specs import LANGUAGE

PROMPT_CHARS = len(LANGUAGE.teacher_prompt) - len("{input}")
T_OUT, S_OUT = LANGUAGE.teacher_output_tokens, LANGUAGE.student_output_tokens


def counted(t):
    return token_counts(t.documents.select("source", "text"), "text", LANGUAGE.prompt(F.col("text"))).drop("text")


def profiles(t):
    return token_profile(counted(t), ["source"], T_OUT, S_OUT)


def tokens(t):
    """Average tokens per request of every source."""
    return profiles(t).select(
        "source", F.col("teacher_in_avg").alias("teacher_in"), F.lit(T_OUT).alias("teacher_out"),
        F.col("student_in_avg").alias("student_in"), F.lit(S_OUT).alias("student_out"),
    )


def rounded(df, places=9, **special):
    return df.select(
        *[
            F.round(c, special.get(c, places)).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


COUNTED = f"""counted AS (
  SELECT source, ceil((length(text) + {PROMPT_CHARS}) / 4.0::DOUBLE)::BIGINT AS teacher_in,
    ceil(length(text) / 4.0::DOUBLE)::BIGINT + 10 AS student_in FROM documents)"""
TOKENS = f"""{COUNTED}, tokens AS (
  SELECT source, avg(teacher_in) AS teacher_in, {T_OUT}::DOUBLE AS teacher_out, avg(student_in) AS student_in, {S_OUT}::DOUBLE AS student_out
  FROM counted GROUP BY source)"""
PRICE_ROWS = "prices AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p.model}', {p.in_per_1m}::DOUBLE, {p.out_per_1m}::DOUBLE, {str(p.is_distilled).lower()})" for i, p in enumerate(PRICES)
) + ") p(ordinal, model, p_in, p_out, is_distilled))"
COSTS = f"""{TOKENS}, {PRICE_ROWS}, costs AS (
  SELECT source, ordinal, model, is_distilled, CASE WHEN is_distilled THEN 'distilled' ELSE 'teacher' END AS approach,
    CASE WHEN is_distilled THEN student_in ELSE teacher_in END AS tokens_in,
    CASE WHEN is_distilled THEN student_out ELSE teacher_out END AS tokens_out,
    (CASE WHEN is_distilled THEN student_in * p_in + student_out * p_out ELSE teacher_in * p_in + teacher_out * p_out END) / 1000000 AS cost
  FROM tokens, prices)"""


@registered("token_profile", f"""
WITH {COUNTED}
SELECT source, count(*) AS requests, round(avg(teacher_in), 6) AS teacher_in_avg, min(teacher_in) AS teacher_in_min, max(teacher_in) AS teacher_in_max,
  round(avg(student_in), 6) AS student_in_avg, min(student_in) AS student_in_min, max(student_in) AS student_in_max,
  {T_OUT} AS teacher_out, {S_OUT} AS student_out, round(avg(teacher_in) / avg(student_in), 6) AS input_reduction
FROM counted GROUP BY source""")
def token_profile_by_source(t):
    return rounded(profiles(t), 6)


@registered("input_reduction", f"""
WITH {COUNTED} SELECT count(*) AS requests, round(avg(teacher_in) / avg(student_in), 6) AS input_reduction FROM counted""")
def input_reduction(t):
    return rounded(token_profile(counted(t), [], T_OUT, S_OUT).select("requests", "input_reduction"), 6)


@registered("cost_by_model", f"""
WITH {COSTS} SELECT source, model, ordinal, approach, is_distilled, round(tokens_in, 6) AS tokens_in, tokens_out, round(cost, 12) AS cost_per_request FROM costs""")
def cost_by_model_and_source(t):
    return rounded(cost_by_model(tokens(t)), 12, tokens_in=6)


@registered("cost_by_volume", f"""
WITH {COSTS}, tiers AS (SELECT unnest([1000, 10000, 100000, 1000000]) AS volume)
SELECT source, model, volume, round(cost * volume, 8) AS daily_cost, round(cost * volume * 30, 8) AS monthly_cost FROM costs, tiers""")
def cost_by_volume_and_source(t):
    return rounded(cost_by_volume(cost_by_model(tokens(t))).select("source", "model", "volume", "daily_cost", "monthly_cost"), 8)


@registered("daily_cost_table", f"""
WITH {COSTS} SELECT source, model, {", ".join(f"round(cost * {v}, 8) AS per_day_{v}" for v in VOLUME_TIERS)} FROM costs""")
def daily_cost_table(t):
    return rounded(daily_table(cost_by_model(tokens(t)), ["source"]), 8)


@registered("monthly_cost_totals", f"""
WITH {COSTS}, tiers AS (SELECT unnest([1000, 10000, 100000, 1000000]) AS volume)
SELECT model, volume, round(sum(cost * volume * 30), 6) AS monthly_cost FROM costs, tiers GROUP BY model, volume""")
def monthly_cost_totals(t):
    costs = cost_by_volume(cost_by_model(tokens(t)))
    return costs.groupBy("model", "volume").agg(F.round(F.sum("monthly_cost"), 6).alias("monthly_cost"))


@registered("savings", f"""
WITH {COSTS},
api AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cost DESC, ordinal) AS top,
  row_number() OVER (PARTITION BY source ORDER BY cost, ordinal) AS low FROM costs WHERE NOT is_distilled)
SELECT a.source, a.model AS dearest_model, round(a.cost, 12) AS dearest_cost, b.model AS cheapest_model, round(b.cost, 12) AS cheapest_cost,
  round(a.cost / b.cost, 6) AS cheapest_ratio, round((a.cost - b.cost) * 100000, 8) AS cheapest_saving_per_day,
  round(c.cost, 12) AS tuned_cost, round(a.cost / c.cost, 6) AS tuned_ratio, round((a.cost - c.cost) * 100000, 8) AS tuned_saving_per_day
FROM api a JOIN api b ON a.source = b.source AND b.low = 1 JOIN costs c ON c.source = a.source AND c.is_distilled WHERE a.top = 1""")
def savings_by_source(t):
    return rounded(savings(cost_by_model(tokens(t)), ["source"]), 8, dearest_cost=12, cheapest_cost=12, tuned_cost=12, cheapest_ratio=6, tuned_ratio=6)


@registered("savings_against_frontier", f"""
WITH {COSTS},
small AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cost, ordinal) AS low FROM costs WHERE NOT is_distilled AND model <> '{FRONTIER}')
SELECT a.source, round(a.cost, 12) AS baseline_cost, b.model AS small_model, round(b.cost, 12) AS small_cost, round(a.cost / b.cost, 6) AS small_ratio,
  round((a.cost - b.cost) * 100000, 8) AS small_saving_per_day, round(a.cost / c.cost, 6) AS tuned_ratio, round((a.cost - c.cost) * 100000, 8) AS tuned_saving_per_day
FROM costs a JOIN small b ON a.source = b.source AND b.low = 1 JOIN costs c ON c.source = a.source AND c.is_distilled WHERE a.model = '{FRONTIER}'""")
def savings_against_frontier(t):
    return rounded(savings_against(cost_by_model(tokens(t)), ["source"]), 8, baseline_cost=12, small_cost=12, small_ratio=6, tuned_ratio=6)


SUMMARY = f"""{TOKENS}, summary AS (
  SELECT source, (teacher_in * 1.75::DOUBLE + teacher_out * 14::DOUBLE) / 1000000 AS f, (student_in * 0.1::DOUBLE + student_out * 0.1::DOUBLE) / 1000000 AS s
  FROM tokens)"""


@registered("task_summary", f"""
WITH {SUMMARY} SELECT source, round(f, 12) AS frontier_cost, round(s, 12) AS tuned_cost, round(f / s, 6) AS savings_ratio FROM summary""")
def task_summary_by_source(t):
    return rounded(task_summary(tokens(t)).select("source", "frontier_cost", "tuned_cost", "savings_ratio"), 12, savings_ratio=6)


@registered("monthly_saving", f"""
WITH {SUMMARY} SELECT source, round(f * 100000 * 30, 8) AS frontier_month, round(s * 100000 * 30, 8) AS tuned_month,
  round(f * 100000 * 30 - s * 100000 * 30, 8) AS month_saving FROM summary""")
def monthly_saving(t):
    return rounded(task_summary(tokens(t)).select("source", "frontier_month", "tuned_month", "month_saving"), 8)


@registered("break_even", f"WITH {SUMMARY} SELECT source, ceil(50::DOUBLE / (f - s))::BIGINT AS break_even_requests FROM summary")
def break_even_by_source(t):
    return break_even(task_summary(tokens(t)), 50.0).select("source", "break_even_requests")


@registered("corpus_cost", f"""
WITH {COUNTED}, {PRICE_ROWS},
sums AS (SELECT source, count(*) AS requests, sum(teacher_in) AS t_in, sum(student_in) AS s_in FROM counted GROUP BY source),
rows AS (SELECT source, model, requests, CASE WHEN is_distilled THEN s_in ELSE t_in END AS tokens_in,
  requests * CASE WHEN is_distilled THEN {S_OUT} ELSE {T_OUT} END AS tokens_out, p_in, p_out FROM sums, prices)
SELECT source, model, sum(requests)::BIGINT AS requests, sum(tokens_in)::BIGINT AS tokens_in, sum(tokens_out)::BIGINT AS tokens_out,
  round(sum((tokens_in * p_in + tokens_out * p_out) / 1000000), 8) AS cost
FROM rows GROUP BY ROLLUP (source, model)""")
def corpus_cost_by_source(t):
    return rounded(corpus_cost(counted(t), "source", T_OUT, S_OUT), 8)
