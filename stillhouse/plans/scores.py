"""Registered queries: scoring answers against gold outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stillhouse.operators.confusion import confusion_cells, label_report, report_means
from stillhouse.operators.language import with_language
from stillhouse.operators.scoring import (
    accuracy, accuracy_with_empty, below_gate, best_checkpoint, compare_models, missing_predictions, pair_with_gold, score,
)
from stillhouse.plans.datasets import LANGUAGE_LABELS
from stillhouse.plans.derived import (
    ALL_ANSWERS, LANGUAGE_ANSWERS, PII_ANSWERS, RECEIPT_ANSWERS, SENTIMENT_ANSWERS, SQL_ANSWERS, STUDENT_ANSWERS,
    language_answers, pii_answers, receipt_answers, sentiment_answers, sql_answers, student_answers,
)
from stillhouse.plans.registry import registered
from stillhouse.sources.builtin_specs import (
    ALL_TASKS, LANGUAGE, PII_DETECTION, RECEIPT_EXTRACTION, SENTIMENT_ASPECT, SQL_GENERATION,
)
from stillhouse.sources.specs import FREE_TEXT, TaskSpec

# What each derived answer is worth, from how it was made.
SCORED = f"""{ALL_ANSWERS}, {STUDENT_ANSWERS},
scored AS (
  SELECT task, model, record_id, CASE
    WHEN task = 'language' THEN (record_id % 6 < 4)::INT
    WHEN task = 'pii_detection' THEN (record_id % 8 IN (0, 2, 5, 6))::INT
    WHEN task = 'sentiment_aspect' THEN (record_id % 8 NOT IN (1, 5))::INT
    WHEN task = 'receipt_extraction' THEN (record_id % 7 = 0)::INT
    ELSE (record_id % 7 < 5)::INT END::DOUBLE AS score
  FROM all_answers
  UNION ALL
  SELECT task, model, record_id, (response = gold)::INT::DOUBLE FROM student_answers)"""


def scored(t):
    """Each table of answers is scored by its own task, so that no row passes the others' expressions."""
    columns = ["record_id", "task", "model", "response", "gold"]
    answers = [(LANGUAGE, language_answers), (LANGUAGE, student_answers), (PII_DETECTION, pii_answers),
               (SENTIMENT_ASPECT, sentiment_answers), (RECEIPT_EXTRACTION, receipt_answers), (SQL_GENERATION, sql_answers)]
    return reduce(DataFrame.unionByName, [score(f(t).select(columns), [spec]) for spec, f in answers])


@registered("paired_predictions", f"""
WITH {STUDENT_ANSWERS} SELECT s.record_id, s.response, d.lang AS gold FROM student_answers s JOIN documents d ON s.record_id = d.doc_id""")
def paired_predictions(t):
    gold = language_answers(t).select("record_id", "task", "gold")
    return pair_with_gold(student_answers(t).drop("gold"), gold).select("record_id", "response", "gold")


@registered("missing_predictions", "SELECT doc_id AS record_id, lang AS gold FROM documents WHERE doc_id % 10 = 3")
def missing_student_predictions(t):
    gold = language_answers(t).select("record_id", "task", "gold")
    # Here, and only here, the student has left out some documents.
    return missing_predictions(student_answers(t).filter("record_id % 10 <> 3"), gold).select("record_id", "gold")


@registered("label_scores", f"""
WITH {LANGUAGE_ANSWERS}, parsed AS (SELECT record_id, gold,
  CASE WHEN response LIKE 'Final Answer: %' THEN substr(response, 15)
    ELSE list_filter(['ar','de','el','en','es','fr','hi','ru','tr','ur','vi','zh','ot'], lambda x: contains(lower(response), x))[1] END AS label
  FROM language_answers)
SELECT record_id, coalesce((label = gold)::INT, 0)::DOUBLE AS score FROM parsed""")
def label_scores(t):
    return score(language_answers(t), [LANGUAGE]).select("record_id", "score")


@registered("entity_scores", f"""
WITH {PII_ANSWERS}, found AS (
  SELECT record_id, gold, CASE WHEN json_valid(response) THEN response ELSE regexp_extract(response, '(?s)\\[.*\\]') END AS d FROM pii_answers),
items AS (
  SELECT record_id, 'found' AS side, unnest(json_extract(d, '$[*]')) AS item FROM found WHERE json_valid(d) AND json_type(d) = 'ARRAY'
  UNION ALL SELECT record_id, 'gold', unnest(json_extract(gold, '$[*]')) FROM found),
sets AS (SELECT record_id, side, string_agg(DISTINCT coalesce(item ->> '$.type', '?') || '=' || coalesce(item ->> '$.entity', item::VARCHAR), '|'
    ORDER BY coalesce(item ->> '$.type', '?') || '=' || coalesce(item ->> '$.entity', item::VARCHAR)) AS s FROM items GROUP BY record_id, side)
SELECT g.record_id, coalesce((f.s = g.s)::INT, 0)::DOUBLE AS score
FROM sets g LEFT JOIN sets f ON f.record_id = g.record_id AND f.side = 'found' WHERE g.side = 'gold'""")
def entity_scores(t):
    return score(pii_answers(t), ALL_TASKS).select("record_id", "score")


@registered("key_scores", f"""
WITH {SENTIMENT_ANSWERS}, found AS (
  SELECT record_id, gold, CASE WHEN json_valid(response) THEN response ELSE regexp_extract(response, '(?s)\\{{.*\\}}') END AS d FROM sentiment_answers)
SELECT record_id, ((d ->> '$.sentiment') IS NOT DISTINCT FROM (gold ->> '$.sentiment')
  AND (d ->> '$.aspect') IS NOT DISTINCT FROM (gold ->> '$.aspect'))::INT::DOUBLE AS score FROM found""")
def key_scores(t):
    return score(sentiment_answers(t), ALL_TASKS).select("record_id", "score")


@registered("document_scores", f"""
WITH {RECEIPT_ANSWERS}
SELECT record_id, (record_id % 7 = 0)::INT::DOUBLE AS score FROM receipt_answers""")
def document_scores(t):
    return score(receipt_answers(t), ALL_TASKS).select("record_id", "score")


@registered("sql_scores", f"""
WITH {SQL_ANSWERS}, parsed AS (SELECT record_id, gold, CASE
    WHEN regexp_matches(response, '(?is)```sql') THEN regexp_extract(response, '(?is)```sql\\s*(.*?)\\s*```', 1)
    WHEN regexp_matches(response, '(?is)select\\b.*?;') THEN regexp_extract(response, '(?is)select\\b.*?;')
    ELSE response END AS s FROM sql_answers)
SELECT record_id, (lower(regexp_replace(rtrim(s, ';'), '\\s+', ' ', 'g')) = lower(rtrim(gold, ';')))::INT::DOUBLE AS score FROM parsed""")
def sql_scores(t):
    return score(sql_answers(t), ALL_TASKS).select("record_id", "score")


ECHO = TaskSpec(name="echo", display_name="Echo", labels=[], teacher_prompt="{input}", output_format=FREE_TEXT)


@registered("text_scores", f"""
WITH {LANGUAGE_ANSWERS} SELECT record_id, (lower(trim(response, ' ' || chr(10))) = lower(gold))::INT::DOUBLE AS score FROM language_answers""")
def text_scores(t):
    return score(language_answers(t).withColumn("task", F.lit("echo")), [ECHO]).select("record_id", "score")


@registered("accuracy_by_model", f"WITH {SCORED} SELECT task, model, avg(score) AS accuracy, count(*) AS n_examples FROM scored GROUP BY task, model")
def accuracy_by_model(t):
    return accuracy(scored(t), ["task", "model"])


@registered("accuracy_of_all_tasks", f"""
WITH {SCORED}, tasks AS (SELECT DISTINCT task FROM all_answers UNION SELECT 'ticket_routing'),
models AS (SELECT unnest(['teacher', 'student']) AS model)
SELECT t.task, m.model, coalesce(avg(s.score), 0) AS accuracy FROM tasks t, models m
LEFT JOIN scored s ON s.task = t.task AND s.model = m.model GROUP BY t.task, m.model""")
def accuracy_of_all_tasks(t):
    names = [s.name for s in ALL_TASKS]
    expected = t.spark.createDataFrame([(n, m) for n in names for m in ("teacher", "student")], "task string, model string")
    return accuracy_with_empty(scored(t), expected, ["task", "model"]).select("task", "model", "accuracy")


@registered("model_comparison", f"""
WITH {SCORED} SELECT task, avg(score) FILTER (WHERE model = 'teacher') AS teacher, avg(score) FILTER (WHERE model = 'student') AS student
FROM scored GROUP BY task""")
def model_comparison(t):
    return compare_models(accuracy(scored(t), ["task", "model"]), ["teacher", "student"])


@registered("teachers_below_gate", f"""
WITH {SCORED} SELECT task, avg(score) AS accuracy, count(*) AS n_examples FROM scored
WHERE model = 'teacher' GROUP BY task HAVING avg(score) < 0.9::DOUBLE""")
def teachers_below_gate(t):
    rows = scored(t).filter("model = 'teacher'")
    return below_gate(accuracy(rows, ["task"]))


@registered("language_accuracy", f"""
WITH {LANGUAGE_LABELS}
SELECT d.lang, avg((l.response = d.lang)::INT::DOUBLE) AS accuracy, count(*) AS n_examples
FROM documents d JOIN language l ON l.id = d.doc_id GROUP BY d.lang""")
def language_accuracy(t):
    answers = with_language(t.spread("documents").select("doc_id", "text", "lang"), "text", "response")
    rows = answers.select(F.lit("language").alias("task"), "lang", "response", F.col("lang").alias("gold"))
    return accuracy(score(rows, [LANGUAGE]), ["lang"])


# --- per label ----------------------------------------------------------------------------------

CELLS = f"""{LANGUAGE_ANSWERS}, {STUDENT_ANSWERS},
cells AS (
  SELECT task, model, gold, predicted, count(*) AS n FROM (
    SELECT task, model, gold, CASE WHEN response LIKE 'Final Answer: %' THEN substr(response, 15)
      ELSE list_filter({LANGUAGE.labels}, lambda x: contains(lower(response), x))[1] END AS predicted FROM language_answers
    UNION ALL SELECT task, model, gold, response FROM student_answers)
  GROUP BY ALL)"""
REPORT = f"""{CELLS}, groups AS (SELECT DISTINCT task, model FROM cells),
labels AS (SELECT task, model, unnest({LANGUAGE.labels}) AS label FROM groups),
report AS (
  SELECT l.task, l.model, label, coalesce(sum(n) FILTER (WHERE gold = label), 0)::BIGINT AS support,
    coalesce(sum(n) FILTER (WHERE predicted = label), 0)::BIGINT AS predicted, coalesce(sum(n) FILTER (WHERE gold = label AND predicted = label), 0)::BIGINT AS correct
  FROM labels l JOIN cells c ON l.task = c.task AND l.model = c.model GROUP BY ALL),
figures AS (
  SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN correct / support ELSE 0 END AS recall,
    CASE WHEN support + predicted > 0 THEN 2 * correct / (support + predicted) ELSE 0 END AS f1 FROM report)"""


def _language_cells(t):
    columns = ["record_id", "task", "model", "response", "gold"]
    return confusion_cells(language_answers(t).select(columns).unionByName(student_answers(t).select(columns)), [LANGUAGE])


@registered("confusion_cells", f"WITH {CELLS} SELECT * FROM cells")
def language_confusion(t):
    return _language_cells(t)


@registered("label_report", f"""
WITH {REPORT} SELECT task, model, label, support, predicted, correct, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM figures""")
def language_label_report(t):
    return label_report(_language_cells(t), [LANGUAGE]).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@registered("label_report_means", f"""
WITH {REPORT}
SELECT task, model, sum(support)::BIGINT AS n_examples, count(*) FILTER (WHERE support + predicted > 0) AS labels_seen,
  round(sum(correct) / sum(predicted), 9) AS micro_precision, round(sum(correct) / sum(support), 9) AS micro_recall,
  round(2 * sum(correct) / (sum(support) + sum(predicted)), 9) AS micro_f1, round(avg(precision) FILTER (WHERE support + predicted > 0), 9) AS macro_precision,
  round(avg(recall) FILTER (WHERE support + predicted > 0), 9) AS macro_recall, round(avg(f1) FILTER (WHERE support + predicted > 0), 9) AS macro_f1
FROM figures GROUP BY task, model""")
def language_report_means(t):
    means = report_means(label_report(_language_cells(t), [LANGUAGE]))
    return means.withColumns({c: F.round(c, 9) for c in means.columns if c.startswith(("micro", "macro"))})


@registered("best_checkpoints", """
WITH metrics AS (SELECT event_type AS run, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS step, round(avg(value)) AS accuracy
  FROM events GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY accuracy DESC, step) AS r,
  row_number() OVER (PARTITION BY run ORDER BY step DESC) AS l FROM metrics)
SELECT b.run, b.step AS best_step, b.accuracy AS best, e.step AS last_step, e.accuracy AS last, e.accuracy < b.accuracy AS dropped
FROM ranked b JOIN ranked e ON b.run = e.run WHERE b.r = 1 AND e.l = 1""")
def best_checkpoints(t):
    step = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")
    metrics = t.events.groupBy(F.col("event_type").alias("run"), step.alias("step")).agg(F.round(F.avg("value")).alias("accuracy"))
    return best_checkpoint(metrics)
