"""Registered queries: reading, filtering and normalising model answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from stillhouse.functions.answers import free_text, single_label, sql_statement, sql_text
from stillhouse.functions.degenerate import is_degenerate
from stillhouse.functions.once import with_once
from stillhouse.functions.payload import json_text, with_payload
from stillhouse.operators.labeling import label, label_to_table, label_yield, parse_labels
from stillhouse.operators.quality import (
    drop_degenerate, format_report, judge, pii_entities, receipt, removal_counts, removal_totals, sentiment, survivors,
)
from stillhouse.plans.derived import (
    ALL_ANSWERS, LANGUAGE_ANSWERS, PII_ANSWERS, RECEIPT_ANSWERS, SENTIMENT_ANSWERS, SQL_ANSWERS,
    all_answers, language_answers, pii_answers, receipt_answers, sentiment_answers, sql_answers,
)
from stillhouse.plans.registry import registered
from stillhouse.sources.builtin_specs import ALL_TASKS, LANGUAGE, PII_DETECTION, SENTIMENT_ASPECT
from stillhouse.sources.workspace import new_folder

# The degenerate test over any text column, by numbering lines and looking for islands of equal ones.
DEGENERATE_SQL = """
lines AS (
  SELECT id, trim(lower(regexp_replace(line, '[\\t\\x0b\\x0c\\x1c-\\x20\\x85\\xa0]+', ' ', 'g'))) AS line, pos
  FROM (SELECT id, unnest(string_split_regex(text, '\\r\\n|[\\n\\r]')) AS line,
               generate_subscripts(string_split_regex(text, '\\r\\n|[\\n\\r]'), 1) AS pos FROM texts)),
numbered AS (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY pos) AS n FROM lines WHERE line <> ''),
islands AS (SELECT id, line, n - row_number() OVER (PARTITION BY id, line ORDER BY n) AS island FROM numbered),
runs AS (SELECT id, max(c) AS longest FROM (SELECT id, count(*) AS c FROM islands GROUP BY id, line, island) GROUP BY id),
shape AS (
  SELECT id, count(*) AS n, count(DISTINCT line) AS d, count(*) FILTER (WHERE rtrim(line, ':') = 'answer') AS answers
  FROM numbered GROUP BY id),
degenerate AS (
  SELECT t.id, s.id IS NULL OR s.answers >= 5 OR r.longest >= 5 OR (s.n >= 10 AND s.d::DOUBLE / s.n < 0.2::DOUBLE) AS bad
  FROM texts t LEFT JOIN shape s ON t.id = s.id LEFT JOIN runs r ON t.id = r.id)
"""


@registered("parsed_labels", f"""
WITH {LANGUAGE_ANSWERS},
labels AS (SELECT ['ar','de','el','en','es','fr','hi','ru','tr','ur','vi','zh','ot'] AS l),
named AS (SELECT record_id, response, l, lower(trim(regexp_extract(response, 'Final Answer:\\s*(\\w+)', 1))) AS hit
          FROM language_answers, labels)
SELECT record_id, CASE WHEN list_contains(l, hit) THEN hit
  ELSE list_filter(l, lambda x: contains(lower(response), x))[1] END AS label FROM named""")
def parsed_labels(t):
    answers = language_answers(t)
    return answers.select("record_id", single_label(F.col("response"), LANGUAGE.labels, LANGUAGE.output_regex).alias("label"))


@registered("parsed_json", f"""
WITH {PII_ANSWERS}
SELECT record_id,
  CASE WHEN json_valid(response) THEN 'whole'
    WHEN json_valid(regexp_extract(response, '(?s)```json\\s*(.*?)\\s*```', 1)) THEN 'fenced'
    WHEN json_valid(regexp_extract(response, '(?s)\\[.*\\]')) THEN 'array' END AS path,
  CASE WHEN json_valid(response) THEN json_type(response)
    WHEN response LIKE '%[%' THEN 'ARRAY' END AS kind,
  CASE WHEN json_valid(response) AND json_type(response) = 'ARRAY' THEN json_array_length(response)
    WHEN response LIKE '%[%' AND NOT json_valid(response) THEN json_array_length(regexp_extract(response, '(?s)\\[.*\\]')) END AS n_items
FROM pii_answers""")
def parsed_json(t):
    found = with_payload(pii_answers(t), "response")
    doc = F.col("payload.doc")
    kind = F.regexp_extract(F.schema_of_variant(doc), "^[A-Z]+", 0)
    return found.select(
        "record_id", F.col("payload.path").alias("path"), kind.alias("kind"),
        F.when(kind == "ARRAY", F.size(F.try_variant_get(doc, "$", "array<variant>"))).alias("n_items"),
    )


@registered("parsed_free_text", f"""
WITH {LANGUAGE_ANSWERS}
SELECT record_id, CASE WHEN regexp_matches(response, 'Final Answer:\\s*(\\w+)')
    THEN regexp_extract(response, 'Final Answer:\\s*(\\w+)', 1)
  WHEN record_id % 6 = 3 THEN 'json' || chr(10) || '{{"lang": "' || gold || '"}}'
  ELSE trim(response, ' ' || chr(10)) END AS text
FROM language_answers""")
def parsed_free_text(t):
    return language_answers(t).select("record_id", free_text(F.col("response"), r"Final Answer:\s*(\w+)").alias("text"))


@registered("parsed_sql", f"""
WITH {SQL_ANSWERS}
SELECT record_id, CASE
  WHEN regexp_matches(response, '(?is)```sql') THEN regexp_extract(response, '(?is)```sql\\s*(.*?)\\s*```', 1)
  WHEN regexp_matches(response, '(?is)select\\b.*?;') THEN regexp_extract(response, '(?is)select\\b.*?;')
  ELSE response END AS statement
FROM sql_answers""")
def parsed_sql(t):
    return sql_answers(t).select("record_id", sql_text(F.col("response")).alias("statement"))


@registered("isolated_sql", f"""
WITH {SQL_ANSWERS},
parsed AS (SELECT record_id, CASE
  WHEN regexp_matches(response, '(?is)```sql') THEN regexp_extract(response, '(?is)```sql\\s*(.*?)\\s*```', 1)
  WHEN regexp_matches(response, '(?is)select\\b.*?;') THEN regexp_extract(response, '(?is)select\\b.*?;')
  ELSE response END AS s FROM sql_answers),
cut AS (SELECT record_id, CASE WHEN regexp_matches(s, '(?i)\\b(select|with|insert|update|delete)\\b')
  THEN regexp_extract(s, '(?is)\\b(?:select|with|insert|update|delete)\\b.*') ELSE s END AS s FROM parsed)
SELECT record_id, rtrim(s, ';') || ';' AS statement FROM cut""")
def isolated_sql(t):
    return sql_answers(t).select("record_id", sql_statement(F.col("response")).alias("statement"))


@registered("degenerate_documents", f"""
WITH texts AS (SELECT doc_id AS id, text FROM documents), {DEGENERATE_SQL}
SELECT id AS doc_id, bad AS degenerate FROM degenerate""")
def degenerate_documents(t):
    return t.spread("documents").select("doc_id", is_degenerate(F.col("text")).alias("degenerate"))


@registered("kept_conversation_turns", f"""
WITH texts AS (SELECT conv_id * 1000000 + turn AS id, text FROM conversations WHERE role = 'assistant'), {DEGENERATE_SQL}
SELECT id AS record_id FROM degenerate WHERE NOT bad""")
def kept_conversation_turns(t):
    turns = t.conversations.filter("role = 'assistant'")
    return drop_degenerate(turns.select((F.col("conv_id") * 1000000 + F.col("turn")).alias("record_id"), "text"), "text").select("record_id")


def _judged(t, answers):
    return judge(answers.withColumnRenamed("response", "output"), ALL_TASKS)


@registered("valid_labels", f"""
WITH {LANGUAGE_ANSWERS}
SELECT record_id, CASE WHEN record_id % 6 = 4 THEN 'ur' ELSE gold END AS output
FROM language_answers WHERE record_id % 6 <> 5""")
def valid_labels(t):
    return survivors(_judged(t, language_answers(t))).select("record_id", "output")


@registered("valid_pii", f"""
WITH {PII_ANSWERS},
found AS (SELECT record_id, CASE WHEN json_valid(response) THEN response ELSE regexp_extract(response, '(?s)\\[.*\\]') END AS doc
  FROM pii_answers),
listed AS (SELECT record_id, CASE WHEN json_type(doc) = 'OBJECT' THEN json_extract(doc, '$.entities') ELSE doc END AS doc
  FROM found WHERE json_valid(doc)),
items AS (SELECT record_id, unnest(json_extract(doc, '$[*]')) AS item, generate_subscripts(json_extract(doc, '$[*]'), 1) AS pos
  FROM listed),
good AS (SELECT record_id, pos, trim(item ->> '$.entity') AS entity, lower(item ->> '$.type') AS type FROM items
  WHERE json_type(item) = 'OBJECT' AND lower(item ->> '$.type') IN ('person','email','phone','ssn','address','credit_card'))
SELECT record_id, count(*) AS n, string_agg(type || '=' || entity, '|' ORDER BY pos) AS entities FROM good GROUP BY record_id""")
def valid_pii(t):
    found = with_payload(pii_answers(t), "response")
    entities = with_once(found, "e", pii_entities(F.col("payload.doc"), PII_DETECTION.labels))
    shown = F.transform("e", lambda e: F.concat_ws("=", e["type"], e["entity"]))
    return entities.filter("e IS NOT NULL").select(
        "record_id", F.size("e").cast("bigint").alias("n"), F.array_join(shown, "|").alias("entities")
    )


@registered("valid_sentiment", f"""
WITH {SENTIMENT_ANSWERS}, docs AS (
  SELECT record_id, CASE WHEN json_valid(response) THEN response ELSE regexp_extract(response, '(?s)\\{{.*\\}}') END AS d
  FROM sentiment_answers)
SELECT record_id, lower(d ->> '$.sentiment') AS sentiment,
  regexp_replace(trim(lower(d ->> '$.aspect')), '\\s+', '_', 'g') AS aspect,
  CASE WHEN json_type(d, '$.confidence') = 'BOOLEAN' THEN (d ->> '$.confidence')::BOOLEAN::INT::DOUBLE
    ELSE (d ->> '$.confidence')::DOUBLE END AS confidence, d ->> '$.reasoning' AS reasoning
FROM docs WHERE json_type(d, '$.confidence') <> 'VARCHAR' AND (d ->> '$.reasoning') IS NOT NULL
  AND (json_type(d, '$.confidence') = 'BOOLEAN' OR TRY_CAST(d ->> '$.confidence' AS DOUBLE) BETWEEN 0 AND 1)""")
def valid_sentiment(t):
    found = with_payload(sentiment_answers(t), "response")
    typed = with_once(found, "s", sentiment(F.col("payload.doc"), SENTIMENT_ASPECT.labels))
    return typed.filter("s IS NOT NULL").select("record_id", "s.*")


@registered("valid_receipts", f"""
WITH {RECEIPT_ANSWERS}
SELECT record_id, 'Shop ' || record_id AS vendor,
  CASE WHEN record_id % 7 = 5 THEN NULL ELSE '2024-05-01' END AS day,
  CASE WHEN record_id % 7 = 1 THEN NULL ELSE 4.5::DOUBLE END AS total,
  CASE WHEN record_id % 7 = 5 THEN 'Lamp:12.5|Ink:-|Cap:12|Bag:true' ELSE 'Lamp:12.5' END AS items
FROM receipt_answers WHERE record_id % 7 IN (0, 1, 5)""")
def valid_receipts(t):
    found = with_payload(receipt_answers(t), "response")
    typed = with_once(found, "r", receipt(F.col("payload.doc"))).filter("r IS NOT NULL")
    shown = F.transform("r.line_items", lambda i: F.concat_ws(":", i["name"], F.coalesce(i["price"].cast("string"), F.lit("-"))))
    return typed.select(
        "record_id", F.col("r.vendor").alias("vendor"), F.col("r.date").alias("day"), F.col("r.total").alias("total"),
        F.array_join(shown, "|").alias("items"),
    )


@registered("valid_json", f"""
WITH {SENTIMENT_ANSWERS}
SELECT record_id, CASE WHEN record_id % 8 = 6 THEN regexp_extract(response, '\\{{.*\\}}') ELSE response END AS output
FROM sentiment_answers""")
def valid_json(t):
    return sentiment_answers(t).select("record_id", json_text("response").alias("output"))


@registered("valid_sql", f"""
WITH {SQL_ANSWERS}
SELECT record_id, CASE record_id % 7 WHEN 1 THEN response WHEN 5 THEN 'I cannot answer;'
  WHEN 6 THEN regexp_extract(response, 'with.*') || ';' ELSE gold END AS output
FROM sql_answers""")
def valid_sql(t):
    return survivors(_judged(t, sql_answers(t))).select("record_id", "output")


REMOVED_SQL = f"""{ALL_ANSWERS},
removed AS (
  SELECT task, CASE task WHEN 'language' THEN 'degenerate' WHEN 'pii_detection' THEN 'pii_schema'
    WHEN 'sentiment_aspect' THEN 'sentiment_schema' ELSE 'receipt_schema' END AS reason
  FROM all_answers
  WHERE (task = 'language' AND record_id % 6 = 5) OR (task = 'pii_detection' AND record_id % 8 = 4)
    OR (task = 'sentiment_aspect' AND record_id % 8 IN (2, 4, 7))
    OR (task = 'receipt_extraction' AND record_id % 7 NOT IN (0, 1, 5)))"""


@registered("removal_counts", f"WITH {REMOVED_SQL} SELECT task, reason, count(*) AS removed FROM removed GROUP BY task, reason")
def removal_counts_by_task(t):
    return removal_counts(_judged(t, all_answers(t)))


@registered("removal_totals", f"WITH {REMOVED_SQL} SELECT task, reason, count(*) AS removed FROM removed GROUP BY ROLLUP (task, reason)")
def removal_totals_by_task(t):
    return removal_totals(_judged(t, all_answers(t)))


@registered("json_format_report", f"""
WITH {PII_ANSWERS}, {SENTIMENT_ANSWERS}
SELECT task, parse_path, count(*) AS answers FROM (
  SELECT task, CASE record_id % 8 WHEN 2 THEN 'fenced' WHEN 4 THEN 'none' WHEN 6 THEN 'array' ELSE 'whole' END AS parse_path FROM pii_answers
  UNION ALL SELECT task, CASE record_id % 8 WHEN 6 THEN 'object' ELSE 'whole' END FROM sentiment_answers)
GROUP BY task, parse_path""")
def json_format_report(t):
    columns = ["task", "response"]
    return format_report(pii_answers(t).select(columns).unionByName(sentiment_answers(t).select(columns)))


@registered("teacher_labels", f"""
WITH {ALL_ANSWERS}
SELECT task, record_id, CASE
  WHEN task = 'language' THEN CASE record_id % 6 WHEN 4 THEN 'ur' WHEN 5 THEN NULL ELSE gold END
  WHEN task = 'sql_generation' THEN response
  WHEN task = 'sentiment_aspect' THEN CASE WHEN record_id % 8 = 6 THEN regexp_extract(response, '\\{{.*\\}}') ELSE response END
  END AS output
FROM all_answers WHERE task IN ('language', 'sql_generation', 'sentiment_aspect')""")
def teacher_labels(t):
    columns = ["task", "record_id", "response"]
    answers = language_answers(t).select(columns).unionByName(sql_answers(t).select(columns)).unionByName(
        sentiment_answers(t).select(columns)
    )
    return parse_labels(answers, ALL_TASKS).select("task", "record_id", "output")


@registered("label_yield", f"""
WITH {ALL_ANSWERS}
SELECT task, count(*) AS inputs, count(*) FILTER (WHERE
  NOT (task = 'language' AND record_id % 6 = 5) AND NOT (task = 'pii_detection' AND record_id % 8 = 4)) AS labelled
FROM all_answers GROUP BY task""")
def label_yield_by_task(t):
    return label_yield(parse_labels(all_answers(t), ALL_TASKS))


def _prompts(t):
    """One language prompt per conversation turn of a user."""
    return t.conversations.filter("role = 'user'").select(
        F.concat_ws("-", "conv_id", "turn").alias("record_id"), F.lit("language").alias("task"), F.col("text").alias("input"),
    ).withColumn("prompt", LANGUAGE.prompt(F.col("input")))


def _make_offline_labeler():
    """A stand-in for a model client: looks for two English words in the prompt's text."""
    def ask(prompt: str) -> str:
        text = prompt.split("\nText:\n", 1)[1].lower()
        return "Final Answer: " + ("en" if " the " in text or " and " in text else "ot")

    return ask


@registered("labelled_turns", """
SELECT conv_id || '-' || turn AS record_id,
  CASE WHEN contains(lower(text), ' the ') OR contains(lower(text), ' and ') THEN 'en' ELSE 'ot' END AS output
FROM conversations WHERE role = 'user'""")
def labelled_turns(t):
    responses = label_to_table(_prompts(t), _make_offline_labeler, new_folder(t.spark, "responses"), waves=2)
    return parse_labels(responses, [LANGUAGE]).select("record_id", "output")


@registered("labelled_turns_lazy", """
SELECT conv_id || '-' || turn AS record_id,
  CASE WHEN contains(lower(text), ' the ') OR contains(lower(text), ' and ') THEN 'Final Answer: en' ELSE 'Final Answer: ot' END AS response
FROM conversations WHERE role = 'user'""")
def labelled_turns_lazy(t):
    return label(_prompts(t), _make_offline_labeler).select("record_id", "response")
