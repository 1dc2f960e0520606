"""Keyword-scored labels, row by row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

Lexicon = dict[str, dict[str, int]]

# The vocabulary of the routing and sentiment rubrics, with weights. Money words
# outweigh account words, and words for broken things outweigh general ones.
ROUTING: Lexicon = {
    "billing": {"payment": 2, "invoice": 2, "charge": 2, "refund": 2, "subscription": 2, "pricing": 2},
    "technical": {"bug": 2, "error": 2, "performance": 2, "api": 2, "integration": 2, "broken": 2},
    "account": {"login": 1, "password": 1, "settings": 1, "permissions": 1, "profile": 1, "deletion": 1},
    "general": {"feature": 1, "feedback": 1, "question": 1, "onboarding": 1, "documentation": 1},
}
SENTIMENT: Lexicon = {
    "positive": {"great": 1, "love": 1, "excellent": 1, "perfect": 1, "satisfied": 1, "happy": 1},
    "negative": {"terrible": 1, "broken": 1, "disappointed": 1, "frustrated": 1, "bad": 1, "poor": 1},
    "neutral": {"okay": 1, "fine": 1, "average": 1},
}


def score(text: Column, terms: dict[str, int]) -> Column:
    """Sum of weights of the terms in a lower-case text, as whole words, each as often as it occurs."""
    weights: dict[int, list[str]] = {}
    for term, weight in terms.items():
        weights.setdefault(weight, []).append(re.escape(term.lower()))
    parts = [
        F.regexp_count(text, F.lit(rf"\b(?:{'|'.join(words)})\b")) * weight for weight, words in weights.items()
    ]
    return sum(parts[1:], parts[0]).cast("bigint")


def with_keyword_label(df: DataFrame, text: str, lexicon: Lexicon, out: str = "response") -> DataFrame:
    """Adds ``out`` (the label with the highest score, ties to the first; null if all are 0) and
    ``<out>_score``.

    A lexicon is a parameter of a few hundred terms, so it sits in the expression: nothing is
    exploded, joined or shuffled.
    """
    labels = list(lexicon)
    step = df.withColumn("__low", F.lower(F.col(text))).withColumn(
        "__scores", F.array(*[score(F.col("__low"), lexicon[label]) for label in labels])
    )
    best = F.array_max("__scores")
    first = F.get(F.array(*[F.lit(x) for x in labels]), F.array_position("__scores", best).cast("int") - 1)
    return (
        step.withColumn(f"{out}_score", best)
        .withColumn(out, F.when(best > 0, first))
        .drop("__low", "__scores")
    )
