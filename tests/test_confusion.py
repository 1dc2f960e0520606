"""Per-label figures against a plain count."""

import random

from stillhouse.operators.confusion import confusion_cells, label_report, report_means
from stillhouse.sources.specs import JSON, SINGLE_LABEL, TaskSpec

SPECS = [
    TaskSpec(name="t", display_name="T", labels=["Red", "green", "blue", "never"], teacher_prompt="{input}", output_format=SINGLE_LABEL),
    TaskSpec(name="j", display_name="J", labels=[], teacher_prompt="{input}", output_format=JSON),
]
SCHEMA = "task string, model string, response string, gold string"


def test_report_equals_plain_counts(spark):
    random.seed(1)
    rows = [("t", m, random.choice(["Red!", "it is GREEN", "blue", "no idea", None]), random.choice([" red ", "Green", "blue", "odd"])) for m in "ab" for _ in range(200)]
    rows += [("j", "a", "{}", "{}"), ("t", "a", "red", None)]
    cells = confusion_cells(spark.createDataFrame(rows, SCHEMA).repartition(4), SPECS)
    said = {"Red!": "red", "it is GREEN": "green", "blue": "blue"}
    pairs = [(m, g.strip().lower(), said.get(r)) for t, m, r, g in rows if t == "t" and g]
    assert {(r.model, r.gold, r.predicted): r.n for r in cells.collect()} == {p: pairs.count(p) for p in pairs}
    report = label_report(cells, SPECS)
    got = {(r.model, r.label): tuple(r)[3:] for r in report.collect()}
    assert {x for _, x in got} == {"red", "green", "blue", "never", "odd"}
    for (model, label), (support, predicted, correct, precision, recall, f1) in got.items():
        mine = [p for p in pairs if p[0] == model]
        s, p, c = sum(g == label for _, g, _ in mine), sum(x == label for _, _, x in mine), sum(g == x == label for _, g, x in mine)
        assert (support, predicted, correct) == (s, p, c)
        assert (precision, recall, f1) == (c / p if p else 0.0, c / s if s else 0.0, 2 * c / (s + p) if s + p else 0.0)
    means = {r.model: r for r in report_means(report).collect()}
    for model, r in means.items():
        mine = [p for p in pairs if p[0] == model]
        assert r.n_examples == len(mine) and r.labels_seen == 4
        assert r.micro_recall == sum(g == x for _, g, x in mine) / len(mine)
        assert abs(r.macro_recall - sum(got[model, x][4] for x in ("red", "green", "blue", "odd")) / 4) < 1e-12


def test_nothing_to_report(spark):
    cells = confusion_cells(spark.createDataFrame([], SCHEMA), SPECS)
    assert label_report(cells, SPECS).collect() == [] and report_means(label_report(cells, SPECS)).collect() == []
