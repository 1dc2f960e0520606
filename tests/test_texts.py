"""Splits by text, leakage and one question per text, against plain versions."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stillhouse.operators import labeling, texts

SCHEMA = "id bigint, task string, text string"


def norm(text):
    return None if text is None else " ".join(text.split()).lower()


def rows_of(n, hot=0.0, task="a"):
    """Every third text twice, with other case and blanks; a share of all rows has one text."""
    out = []
    for i in range(n):
        text = "The  HOT one " if i < hot * n else f"Text {i - i % 3 if i % 3 == 1 else i}" + ("  \n" if i % 2 else "")
        out.append((i, task, text))
    return out


def plain_split(rows, size, seed=42):
    """{text: split} of one task: whole texts in hash order, cut where the rows are closest to the target."""
    weights = Counter(norm(t) for _, _, t in rows)
    order = sorted(weights, key=lambda t: hashlib.md5(f"{seed}|{chr(0) if t is None else t}".encode()).hexdigest())
    target = int(len(rows) * (1 - size))
    best, taken, cut = (target, 0, 0), 0, 0
    for i, text in enumerate(order, 1):
        taken += weights[text]
        best = min(best, (abs(target - taken), taken, i))
    cut = best[2]
    return {t: "train" if i < cut else "test" for i, t in enumerate(order)}


@pytest.mark.parametrize("n,size,hot", [(0, 0.2, 0), (1, 0.2, 0), (2, 0.5, 0), (500, 0.2, 0.34), (700, 0.5, 0), (90, 0.3, 0.9), (60, 1.0, 0), (60, 0.0, 0)])
def test_whole_texts_and_the_closest_cut(spark, n, size, hot):
    rows = rows_of(n, hot, "a") + rows_of(n // 2, 0, "b") + [(9000 + i, "a", None) for i in range(n // 20)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = texts.split_by_group(frame, texts.canonical(F.col("text")), ["task"], size=size)
    assert got.columns == ["id", "task", "text", "split"]
    for task in ("a", "b"):
        mine = [r for r in rows if r[1] == task]
        want = plain_split(mine, size)
        assert {r.id: r.split for r in got.filter(F.col("task") == task).collect()} == {i: want[norm(t)] for i, _, t in mine}


def test_split_without_groups_and_by_rule(spark):
    rows = rows_of(400)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r.split for r in texts.split_by_group(frame, texts.canonical(F.col("text")), eval_samples=120).collect()}
    want = plain_split(rows, 0.3)
    assert got == {i: want[norm(t)] for i, _, t in rows}


def test_leakage_is_found_and_gone_after_a_split_by_text(spark):
    rows = rows_of(300, 0.3) + [(1000, "a", None), (1001, "a", " "), (1002, "a", " \n"), (1003, "a", None)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    by_id = frame.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    sides = {}
    for r in by_id.collect():
        sides.setdefault(norm(r.text), Counter())[r.split] += 1
    want = {t: (c["train"], c["test"]) for t, c in sides.items() if t and c["train"] and c["test"]}
    assert {r.text: (r.train, r.test) for r in texts.leaked_texts(by_id, "text", ["task"]).collect()} == want and len(want) > 30
    report = texts.leakage(by_id, "text", ["task"]).first()
    assert (report.leaked_texts, report.leaked_rows) == (len(want), sum(b for _, b in want.values()))
    assert report.share == report.leaked_rows / report.test
    together = texts.split_by_group(frame, texts.canonical(F.col("text")), ["task"], size=0.25)
    assert texts.leaked_texts(together, "text").count() == 0
    assert [tuple(r) for r in texts.leakage(together, "text", ["task"]).select("leaked_texts", "leaked_rows", "share").collect()] == [(0, 0, 0.0)]
    assert texts.leakage(by_id.filter("false"), "text", ["task"]).collect() == []


def _make_counting(folder):
    def make():
        def ask(prompt):
            import os
            import uuid

            open(os.path.join(folder, uuid.uuid4().hex), "w").write(prompt)
            return f"<{prompt}>"

        return ask

    return make


def test_every_text_is_asked_once_and_every_row_answered(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = [(str(i), "language" if i % 5 else "other", "same" if i % 3 == 0 else f"t{i % 40}") for i in range(600)] + [("n1", "language", None), ("n2", "language", None)]
    frame = spark.createDataFrame(rows, "record_id string, task string, input string").repartition(6)
    prompts = frame.withColumn("prompt", F.concat_ws("|", "task", F.coalesce("input", F.lit("none"))))
    path = str(tmp_path / "answers")
    got = texts.label_distinct_to_table(prompts, _make_counting(str(calls)), path, waves=2)
    want = {(r, t, x): f"<{t}|{x or 'none'}>" for r, t, x in rows}
    assert {(r.record_id, r.task, r.input): r.response for r in got.collect()} == want and got.count() == len(rows)
    distinct = {(t, x) for _, t, x in rows}
    assert len(list(calls.iterdir())) == len(distinct) == spark.read.schema(labeling.RESPONSES).parquet(path).count()
    more = prompts.limit(50).withColumn("record_id", F.concat(F.lit("later-"), "record_id"))
    assert texts.label_distinct_to_table(more, _make_counting(str(calls)), path).filter("response IS NOT NULL").count() == 50
    assert len(list(calls.iterdir())) == len(distinct)


def test_a_hot_text_is_joined_in_parts(spark):
    rows = spark.range(6000).selectExpr("CAST(id AS STRING) AS record_id", "'a' AS task", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CONCAT('t', id) END AS input")
    distinct = texts.distinct_inputs(rows, keep=())
    answers = distinct.select("task", "input", F.upper("input").alias("response"))
    got = texts.returned(rows, answers, distinct.select("record_id", "copies"))
    assert got.count() == 6000 and got.filter("response <> upper(input) OR response IS NULL").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan
