"""Model answers, gold outputs and a serving log derived from the tables, row by row.

The tables hold no model answers. These expressions make some from the keys, in every form the
parsers have to cope with, so both engines see the same text. Each SQL text below states the
same rows for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stillhouse.plans.registry import Tables

FENCE = "```"


def _by(key: Column, *forms: Column) -> Column:
    """forms[key % len(forms)]"""
    out = F.when(key % len(forms) == 0, forms[0])
    for i, form in enumerate(forms[1:], 1):
        out = out.when(key % len(forms) == i, form)
    return out


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# --- language: documents, gold = lang ----------------------------------------------------------


def language_answers(t: Tables) -> DataFrame:
    k, lang = F.col("doc_id"), F.col("lang")
    response = _by(
        k,
        _cat("Final Answer: ", lang),
        F.upper(lang),
        lang,
        _cat(f'{FENCE}json\n{{"lang": "', lang, f'"}}\n{FENCE}'),
        F.lit("I am not sure"),
        F.lit("Answer:\n" * 5),
    )
    return t.spread("documents").select(
        k.alias("record_id"), F.lit("language").alias("task"), F.lit("teacher").alias("model"),
        response.alias("response"), lang.alias("gold"),
    )


LANGUAGE_ANSWERS = """language_answers AS (
  SELECT doc_id AS record_id, 'language' AS task, 'teacher' AS model, lang AS gold,
    CASE doc_id % 6
      WHEN 0 THEN 'Final Answer: ' || lang
      WHEN 1 THEN upper(lang)
      WHEN 2 THEN lang
      WHEN 3 THEN '```json' || chr(10) || '{"lang": "' || lang || '"}' || chr(10) || '```'
      WHEN 4 THEN 'I am not sure'
      ELSE repeat('Answer:' || chr(10), 5) END AS response
  FROM documents)"""


def student_answers(t: Tables) -> DataFrame:
    """A second model's answers: bare labels, some wrong."""
    k = F.col("doc_id")
    return t.spread("documents").select(
        k.alias("record_id"), F.lit("language").alias("task"), F.lit("student").alias("model"),
        F.when(k % 9 == 0, "ot").otherwise(F.col("lang")).alias("response"), F.col("lang").alias("gold"),
    )


STUDENT_ANSWERS = """student_answers AS (
  SELECT doc_id AS record_id, 'language' AS task, 'student' AS model, lang AS gold,
    CASE WHEN doc_id % 9 = 0 THEN 'ot' ELSE lang END AS response
  FROM documents)"""


# --- PII: customer ------------------------------------------------------------------------------


def pii_answers(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    email = _cat("user", k.cast("string"), "@mail.example.com")
    phone = _cat("555-0", (k % 100 + 100).cast("string"))
    text = _cat("Contact ", F.col("c_name"), " at ", email, " or ", phone)
    first = _cat('{"entity": "', email, '", "type": "email"}')
    second = _cat('{"entity": "', phone, '", "type": "phone"}')
    plain = _cat("[", first, ", ", second, "]")
    response = _by(
        k,
        plain,
        _cat('{"entities": ', plain, "}"),
        _cat(f"{FENCE}json\n", plain, f"\n{FENCE}"),
        _cat("[", first, ', {"entity": "x", "type": "dob"}, ', second, "]"),
        F.lit("There is some personal data in it."),
        _cat('[{"type":"phone","entity":"', phone, '"},', first, "]"),
        _cat("Found: [", first, ", ", first, ", ", second, "]."),
        _cat('[{"entity": "  ', email, ' ", "type": "EMAIL"}, 7, ', second, "]"),
    )
    return t.spread("customer").select(
        k.alias("record_id"), F.lit("pii_detection").alias("task"), F.lit("teacher").alias("model"),
        text.alias("input"), response.alias("response"), plain.alias("gold"),
    )


PII_ANSWERS = """pii_parts AS (
  SELECT c_custkey AS record_id, c_name, 'user' || c_custkey || '@mail.example.com' AS email,
    '555-0' || (100 + c_custkey % 100) AS phone FROM customer),
pii_objects AS (
  SELECT *, '{"entity": "' || email || '", "type": "email"}' AS first,
    '{"entity": "' || phone || '", "type": "phone"}' AS second FROM pii_parts),
pii_answers AS (
  SELECT record_id, 'pii_detection' AS task, 'teacher' AS model, email, phone,
    'Contact ' || c_name || ' at ' || email || ' or ' || phone AS input,
    '[' || first || ', ' || second || ']' AS gold,
    CASE record_id % 8
      WHEN 0 THEN '[' || first || ', ' || second || ']'
      WHEN 1 THEN '{"entities": [' || first || ', ' || second || ']}'
      WHEN 2 THEN '```json' || chr(10) || '[' || first || ', ' || second || ']' || chr(10) || '```'
      WHEN 3 THEN '[' || first || ', {"entity": "x", "type": "dob"}, ' || second || ']'
      WHEN 4 THEN 'There is some personal data in it.'
      WHEN 5 THEN '[{"type":"phone","entity":"' || phone || '"},' || first || ']'
      WHEN 6 THEN 'Found: [' || first || ', ' || first || ', ' || second || '].'
      ELSE '[{"entity": "  ' || email || ' ", "type": "EMAIL"}, 7, ' || second || ']' END AS response
  FROM pii_objects)"""


# --- sentiment: orders --------------------------------------------------------------------------


def _sentiment_json(label, confidence, aspect="delivery", reasoning=', "reasoning": "Says so"') -> Column:
    return _cat('{"sentiment": "', label, f'", "aspect": "{aspect}", "confidence": {confidence}', reasoning, "}")


def sentiment_answers(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    label = _by(F.floor(k / 8).cast("bigint"), *[F.lit(x) for x in ("positive", "negative", "neutral", "mixed")])
    response = _by(
        k,
        _sentiment_json(label, "0.9"),
        _sentiment_json(F.upper(label), "1"),
        _sentiment_json(label, "1.5"),
        _sentiment_json(label, "true"),
        _sentiment_json(label, "0.5", reasoning=""),
        _sentiment_json(label, "0.25", aspect=" Battery  Life "),
        _cat("My answer: ", _sentiment_json(label, "0.75"), " - done"),
        _sentiment_json(label, '"0.9"'),
    )
    return t.spread("orders").select(
        k.alias("record_id"), F.lit("sentiment_aspect").alias("task"), F.lit("teacher").alias("model"),
        response.alias("response"), _sentiment_json(label, "0.8").alias("gold"),
    )


SENTIMENT_ANSWERS = """sentiment_labels AS (
  SELECT o_orderkey AS record_id,
    ['positive', 'negative', 'neutral', 'mixed'][1 + ((o_orderkey // 8) % 4)] AS label FROM orders),
sentiment_answers AS (
  SELECT record_id, 'sentiment_aspect' AS task, 'teacher' AS model, label,
    '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": 0.8, "reasoning": "Says so"}' AS gold,
    CASE record_id % 8
      WHEN 0 THEN '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": 0.9, "reasoning": "Says so"}'
      WHEN 1 THEN '{"sentiment": "' || upper(label) || '", "aspect": "delivery", "confidence": 1, "reasoning": "Says so"}'
      WHEN 2 THEN '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": 1.5, "reasoning": "Says so"}'
      WHEN 3 THEN '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": true, "reasoning": "Says so"}'
      WHEN 4 THEN '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": 0.5}'
      WHEN 5 THEN '{"sentiment": "' || label || '", "aspect": " Battery  Life ", "confidence": 0.25, "reasoning": "Says so"}'
      WHEN 6 THEN 'My answer: {"sentiment": "' || label || '", "aspect": "delivery", "confidence": 0.75, "reasoning": "Says so"} - done'
      ELSE '{"sentiment": "' || label || '", "aspect": "delivery", "confidence": "0.9", "reasoning": "Says so"}' END AS response
  FROM sentiment_labels)"""


# --- receipts: orders ---------------------------------------------------------------------------


def receipt_answers(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    item = '{"name": " Lamp ", "price": 12.5}'

    def doc(total='4.5', lines=f"[{item}]", date='"2024-05-01"') -> Column:
        return _cat('{"vendor": " Shop ', k.cast("string"), f'", "date": {date}, "total": {total}, "line_items": {lines}}}')

    response = _by(
        k,
        doc(),
        doc(total="null"),
        _cat('{"vendor": "Shop ', k.cast("string"), '", "total": 1, "line_items": []}'),
        doc(total='"3"'),
        doc(lines="null"),
        doc(lines=f'[{item}, {{"name": " ", "price": 1}}, {{"name": "Pen", "price": "2"}}, {{"name": "Ink"}}, {{"name": "Cap", "price": 12}}, {{"name": "Bag", "price": true}}, 5]', date="null"),
        _cat("The receipt: ", doc(), " ok"),
    )
    return t.spread("orders").select(
        k.alias("record_id"), F.lit("receipt_extraction").alias("task"), F.lit("teacher").alias("model"),
        response.alias("response"), doc(total="4.50").alias("gold"),
    )


RECEIPT_ANSWERS = """receipt_parts AS (
  SELECT o_orderkey AS record_id, '{"vendor": " Shop ' || o_orderkey || '", "date": ' AS head,
    '"2024-05-01"' AS day, '{"name": " Lamp ", "price": 12.5}' AS item FROM orders),
receipt_answers AS (
  SELECT record_id, 'receipt_extraction' AS task, 'teacher' AS model,
    head || day || ', "total": 4.50, "line_items": [' || item || ']}' AS gold,
    CASE record_id % 7
      WHEN 0 THEN head || day || ', "total": 4.5, "line_items": [' || item || ']}'
      WHEN 1 THEN head || day || ', "total": null, "line_items": [' || item || ']}'
      WHEN 2 THEN '{"vendor": "Shop ' || record_id || '", "total": 1, "line_items": []}'
      WHEN 3 THEN head || day || ', "total": "3", "line_items": [' || item || ']}'
      WHEN 4 THEN head || day || ', "total": 4.5, "line_items": null}'
      WHEN 5 THEN head || 'null, "total": 4.5, "line_items": [' || item
        || ', {"name": " ", "price": 1}, {"name": "Pen", "price": "2"}, {"name": "Ink"}, {"name": "Cap", "price": 12}, {"name": "Bag", "price": true}, 5]}'
      ELSE 'The receipt: ' || head || day || ', "total": 4.5, "line_items": [' || item || ']} ok' END AS response
  FROM receipt_parts)"""


# --- SQL: part ----------------------------------------------------------------------------------


def sql_answers(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    number = k.cast("string")
    statement = _cat("SELECT p_name FROM part WHERE p_partkey = ", number, ";")
    response = _by(
        k,
        statement,
        _cat("select  p_name\nfrom part  where p_partkey = ", number, ";"),
        _cat(f"{FENCE}sql\n", statement, f"\n{FENCE}"),
        _cat("Sure! ", statement, " Anything else?"),
        _cat("SELECT p_name FROM part WHERE p_partkey = ", number),
        F.lit("I cannot answer"),
        _cat("Use a query with one table: SELECT p_name FROM part WHERE p_partkey = ", number),
    )
    return t.spread("part").select(
        k.alias("record_id"), F.lit("sql_generation").alias("task"), F.lit("teacher").alias("model"),
        response.alias("response"), statement.alias("gold"),
    )


SQL_ANSWERS = """sql_answers AS (
  SELECT p_partkey AS record_id, 'sql_generation' AS task, 'teacher' AS model,
    'SELECT p_name FROM part WHERE p_partkey = ' || p_partkey || ';' AS gold,
    CASE p_partkey % 7
      WHEN 0 THEN 'SELECT p_name FROM part WHERE p_partkey = ' || p_partkey || ';'
      WHEN 1 THEN 'select  p_name' || chr(10) || 'from part  where p_partkey = ' || p_partkey || ';'
      WHEN 2 THEN '```sql' || chr(10) || 'SELECT p_name FROM part WHERE p_partkey = ' || p_partkey || ';' || chr(10) || '```'
      WHEN 3 THEN 'Sure! SELECT p_name FROM part WHERE p_partkey = ' || p_partkey || '; Anything else?'
      WHEN 4 THEN 'SELECT p_name FROM part WHERE p_partkey = ' || p_partkey
      WHEN 5 THEN 'I cannot answer'
      ELSE 'Use a query with one table: SELECT p_name FROM part WHERE p_partkey = ' || p_partkey END AS response
  FROM part)"""


def all_answers(t: Tables) -> DataFrame:
    """(record_id, task, model, response, gold) of the five tasks."""
    columns = ["record_id", "task", "model", "response", "gold"]
    parts = [f(t).select(*columns) for f in (language_answers, pii_answers, sentiment_answers, receipt_answers, sql_answers)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ALL_ANSWERS = ",\n".join([LANGUAGE_ANSWERS, PII_ANSWERS, SENTIMENT_ANSWERS, RECEIPT_ANSWERS, SQL_ANSWERS]) + """,
all_answers AS (
  SELECT record_id, task, model, response, gold FROM language_answers
  UNION ALL SELECT record_id, task, model, response, gold FROM pii_answers
  UNION ALL SELECT record_id, task, model, response, gold FROM sentiment_answers
  UNION ALL SELECT record_id, task, model, response, gold FROM receipt_answers
  UNION ALL SELECT record_id, task, model, response, gold FROM sql_answers)"""


# --- serving log: events ------------------------------------------------------------------------


def serving_log(t: Tables) -> DataFrame:
    k = F.col("event_id")
    student = k % 2 == 0
    return t.events.select(
        k.alias("request_id"), F.col("ts"), F.lit("event_routing").alias("task"),
        F.when(student, "student").otherwise("teacher").alias("model"),
        F.col("event_type").alias("label"),
        F.when(k % 11 == 0, "other").otherwise(F.col("event_type")).alias("expected"),
        (F.when(student, 24).otherwise(641) + k % 10).alias("in_tokens"),
        F.when(student, 1).otherwise(4).cast("bigint").alias("out_tokens"),
        F.col("value").alias("latency_ms"),
    )


SERVING_LOG = """serving_log AS (
  SELECT event_id AS request_id, ts, 'event_routing' AS task,
    CASE WHEN event_id % 2 = 0 THEN 'student' ELSE 'teacher' END AS model, event_type AS label,
    CASE WHEN event_id % 11 = 0 THEN 'other' ELSE event_type END AS expected,
    CASE WHEN event_id % 2 = 0 THEN 24 ELSE 641 END + event_id % 10 AS in_tokens,
    CASE WHEN event_id % 2 = 0 THEN 1 ELSE 4 END AS out_tokens, value AS latency_ms
  FROM events)"""
