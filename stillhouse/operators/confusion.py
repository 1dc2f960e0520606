"""Per-label figures of labelling tasks: confusion cells, precision, recall, F1, and their micro and macro means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.functions.answers import single_label
from stillhouse.functions.text import strip
from stillhouse.sources.specs import SINGLE_LABEL, TaskSpec, dispatch

GROUPS = ("task", "model")


def confusion_cells(pairs: DataFrame, specs: Sequence[TaskSpec], groups: Sequence[str] = GROUPS, response: str = "response",
                    gold: str = "gold", task: str = "task") -> DataFrame:
    """(groups, gold, predicted, n): how often a gold label got a predicted one; null is an answer without a label.

    Only cells that occur have a row. One aggregate, combined before the shuffle: its size is that of the labels, not
    of the answers. Rows of tasks that have no labels, and rows without gold, are left out.
    """
    labelled = [s for s in specs if s.output_format == SINGLE_LABEL]
    named = dispatch(labelled, F.col(task), lambda s: single_label(F.col(response), s.labels, s.output_regex))
    rows = pairs.filter(F.col(task).isin([s.name for s in labelled]) & F.col(gold).isNotNull())
    cells = rows.select(*groups, F.lower(strip(F.col(gold))).alias("gold"), named.alias("predicted"))
    return cells.groupBy(*groups, "gold", "predicted").agg(F.count("*").alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def label_report(cells: DataFrame, specs: Sequence[TaskSpec], groups: Sequence[str] = GROUPS, task: str = "task") -> DataFrame:
    """(groups, label, support, predicted, correct, precision, recall, f1): one row per label that the task lists or that occurs.

    Both margins of the cells come from one pass with grouping sets. A label that is never gold, never predicted, or
    neither has zeros.
    """
    marked = cells.withColumn("hit", F.when(F.col("gold") == F.col("predicted"), F.col("n")).otherwise(0))
    margins = marked.groupingSets([[*groups, "gold"], [*groups, "predicted"]], *groups, "gold", "predicted").agg(
        F.sum("n").alias("n"), F.sum("hit").alias("hit"), F.grouping("predicted").alias("of_gold"),
    )
    of_gold = F.col("of_gold") == 1
    zero = F.lit(0).cast("bigint")
    sides = margins.select(
        *groups, F.when(of_gold, F.col("gold")).otherwise(F.col("predicted")).alias("label"), F.when(of_gold, F.col("n")).otherwise(zero).alias("support"),
        F.when(of_gold, zero).otherwise(F.col("n")).alias("predicted"), F.when(of_gold, F.col("hit")).otherwise(zero).alias("correct"),
    ).filter("label IS NOT NULL")
    listed = dispatch([s for s in specs if s.labels], F.col(task), lambda s: F.array(*[F.lit(x.lower()) for x in s.labels]))
    expected = cells.select(*groups).distinct().select(
        *groups, F.explode(F.array_distinct(listed)).alias("label"), zero.alias("support"), zero.alias("predicted"), zero.alias("correct"),
    )
    figures = sides.unionByName(expected).groupBy(*groups, "label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "correct")])
    return figures.withColumns({
        "precision": _ratio(F.col("correct"), F.col("predicted")), "recall": _ratio(F.col("correct"), F.col("support")),
        "f1": _ratio(2 * F.col("correct"), F.col("support") + F.col("predicted")),
    })


def report_means(report: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """(groups, n_examples, labels_seen, micro_*, macro_*) of a label report.

    Micro figures pool all labels, so the micro recall is the accuracy; macro figures are plain means over the labels
    that were gold or predicted at least once.
    """
    seen = (F.col("support") > 0) | (F.col("predicted") > 0)
    total = {c: F.sum(c) for c in ("support", "predicted", "correct")}
    return report.groupBy(*groups).agg(
        total["support"].alias("n_examples"), F.count_if(seen).alias("labels_seen"),
        _ratio(total["correct"], total["predicted"]).alias("micro_precision"), _ratio(total["correct"], total["support"]).alias("micro_recall"),
        _ratio(2 * total["correct"], total["support"] + total["predicted"]).alias("micro_f1"),
        *[F.coalesce(F.avg(F.when(seen, F.col(c))), F.lit(0.0)).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
    )
