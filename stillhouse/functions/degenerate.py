"""Detecting degenerate (looping) answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stillhouse.functions.once import let
from stillhouse.functions.text import LINE_BREAK, normalised_lines, strip

# Thresholds of the heuristic.
MIN_REPEATS = 5
MIN_LINES_FOR_RATIO = 10
MIN_DISTINCT_RATIO = 0.2


def is_degenerate(text: Column, min_repeats: int = MIN_REPEATS) -> Column:
    """True for blank text, looping "Answer:" lines, runs of equal lines, or few distinct lines.

    Text with too few line breaks to loop, the usual case, is only tested for being blank. Runs
    are found by one possessive back-reference over the normalised text, so the check is linear
    in the text and needs no per-row state.
    """
    repeats = max(min_repeats - 1, 0)
    breaks = min(repeats, MIN_LINES_FOR_RATIO - 1)

    def loops(norm: Column) -> Column:
        answers = F.contains(norm, F.lit("answer")) & (
            F.regexp_count(norm, F.lit(r"(?:^|(?<=\n))answer:*(?![^\n])")) >= min_repeats
        )
        run = norm.rlike(rf"(?:^|\n)([^\n]*+)(?:\n\1(?![^\n])){{{repeats}}}")
        few = let(
            F.split(norm, "\n"),
            lambda lines: (F.size(lines) >= MIN_LINES_FOR_RATIO)
            & (F.size(F.array_distinct(lines)).cast("double") / F.size(lines) < F.lit(MIN_DISTINCT_RATIO)),
        )
        return (norm == "") | answers | run | few

    no_break = f"[^{LINE_BREAK[1:-1]}]"
    many_lines = text.rlike(rf"{LINE_BREAK}(?:{no_break}*+{LINE_BREAK}){{{breaks - 1}}}") if breaks > 1 else F.lit(True)
    return F.when(text.isNull(), True).when(many_lines, let(normalised_lines(text), loops)).otherwise(strip(text) == "")
