"""Registered queries: records, inputs, prompts, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from stillhouse.operators.cost import training_manifest
from stillhouse.functions.tokens import estimated_tokens
from stillhouse.operators.inputs import inputs_from_table, student_prompts, teacher_prompts
from stillhouse.operators.language import with_language
from stillhouse.operators.lexicon import ROUTING, with_keyword_label
from stillhouse.operators.pii import detect, redact
from stillhouse.operators.splitting import check_split, head, split_exactly, spot_check, sufficiency, test_size
from stillhouse.operators.student import answer, fit_student
from stillhouse.operators.texts import canonical, distinct_inputs, label_distinct_to_table, leakage, leaked_texts, split_by_group
from stillhouse.operators.language import LATIN_ORDER, LETTERS, WORDS
from stillhouse.plans.answers import DEGENERATE_SQL
from stillhouse.plans.build import build_dataset, judged_table, written_records
from stillhouse.plans.derived import ALL_ANSWERS, all_answers
from stillhouse.plans.registry import registered
from stillhouse.sources.builtin_specs import ALL_TASKS, LANGUAGE
from stillhouse.sources.jsonl import read_jsonl, read_messages, write_jsonl
from stillhouse.sources.messages import assistant_pairs, conversation_records, to_messages, to_pairs
from stillhouse.sources.specs import FREE_TEXT, TaskSpec, dispatch, spec_table
from stillhouse.sources.workspace import new_folder

CHAT = TaskSpec(name="chat", display_name="Chat", labels=[], teacher_prompt="{input}", output_format=FREE_TEXT)

PAIRS = """pairs AS (
  SELECT * FROM (
    SELECT conv_id, turn, role, conv_id || '-' || turn AS record_id, text AS output,
      lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS input,
      lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS input_role FROM conversations)
  WHERE role = 'assistant' AND input IS NOT NULL)"""


def chat_pairs(t):
    return assistant_pairs(t.conversations).withColumn("task", F.lit("chat"))


# --- records ------------------------------------------------------------------------------------


@registered("assistant_pairs", f"WITH {PAIRS} SELECT record_id, conv_id, turn, input_role, md5(input) AS input, md5(output) AS output FROM pairs")
def pairs_of_conversations(t):
    return assistant_pairs(t.conversations).withColumns({"input": F.md5("input"), "output": F.md5("output")})


@registered("conversation_records", """
SELECT * FROM (
  SELECT conv_id, turn, role, md5(text) AS content, coalesce(role = 'assistant', false) AS train,
    count(*) FILTER (WHERE role = 'assistant') OVER (PARTITION BY conv_id) AS targets
  FROM conversations) WHERE targets > 0""")
def records_of_conversations(t):
    return conversation_records(t.conversations).withColumn("content", F.md5("content"))


@registered("message_records", f"""
WITH {PAIRS} SELECT record_id, 'user' AS first_role, md5(input) AS first, 'assistant' AS second_role, md5(output) AS second, 2 AS n FROM pairs""")
def message_records(t):
    m = F.col("messages")
    return to_messages(chat_pairs(t)).select(
        "record_id", m[0]["role"].alias("first_role"), F.md5(m[0]["content"]).alias("first"),
        m[1]["role"].alias("second_role"), F.md5(m[1]["content"]).alias("second"), F.size(m).alias("n"),
    )


@registered("message_pairs", f"WITH {PAIRS} SELECT record_id, length(input) AS input_length, length(output) AS output_length FROM pairs")
def message_pairs(t):
    pairs = to_pairs(to_messages(chat_pairs(t)))
    return pairs.select("record_id", F.length("input").alias("input_length"), F.length("output").alias("output_length"))


@registered("jsonl_round_trip", f"WITH {PAIRS} SELECT md5(input) AS input, md5(output) AS output FROM pairs")
def jsonl_round_trip(t):
    path = new_folder(t.spark, "jsonl")
    write_jsonl(to_messages(chat_pairs(t)).select("messages"), path)
    return to_pairs(read_messages(t.spark, path)).select(F.md5("input").alias("input"), F.md5("output").alias("output"))


@registered("jsonl_generic", "SELECT event_id, event_type, value, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def jsonl_generic(t):
    path = new_folder(t.spark, "jsonl")
    rows = t.events.select("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    write_jsonl(rows, path)
    read = read_jsonl(t.spark, path, "event_id: bigint, event_type: string, value: double, props: struct<k: bigint>")
    return read.select("event_id", "event_type", "value", "props.k")


@registered("spec_registry", f"""
WITH {ALL_ANSWERS}, specs AS (SELECT * FROM (VALUES
  ('language', 'single_label', 13), ('pii_detection', 'json', 6), ('sentiment_aspect', 'json', 4),
  ('receipt_extraction', 'json', 0), ('sql_generation', 'free_text', 0)) s(task, output_format, n_labels))
SELECT task, output_format, n_labels, count(*) AS records FROM all_answers JOIN specs USING (task)
GROUP BY task, output_format, n_labels""")
def spec_registry(t):
    specs = spec_table(t.spark, ALL_TASKS).select(F.col("name").alias("task"), "output_format", F.size("labels").alias("n_labels"))
    counts = all_answers(t).groupBy("task").agg(F.count("*").alias("records"))
    return counts.join(F.broadcast(specs), "task").select("task", "output_format", "n_labels", "records")


# --- inputs and prompts -------------------------------------------------------------------------


@registered("synthetic_inputs", """
WITH k AS (SELECT count(*) AS k FROM nation),
numbered AS (SELECT c_custkey AS record_id, CASE WHEN c_custkey < k THEN c_custkey
  ELSE ('0x' || substr(md5('42|' || c_custkey), 1, 8))::BIGINT % k END AS template_no FROM customer, k)
SELECT record_id, template_no, 'Ticket ' || record_id || ' {from} ' || n_name || ': where is parcel ' || record_id || '?' AS input
FROM numbered JOIN nation ON template_no = n_nationkey""")
def inputs_of_customers(t):
    templates = t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("template_no"),
        F.concat(F.lit("Ticket {idx} {{from}} "), "n_name", F.lit(": where is parcel {idx}?")).alias("template"),
    )
    return inputs_from_table(t.customer, "c_custkey", templates)


@registered("teacher_prompts", f"""
WITH {PAIRS}
SELECT record_id, md5('{LANGUAGE.teacher_prompt[: -len("{input}")]}' || input) AS prompt,
  length(input) + {len(LANGUAGE.teacher_prompt) - len("{input}")} AS prompt_length FROM pairs""")
def prompts_of_pairs(t):
    pairs = chat_pairs(t).withColumn("task", F.lit("language"))
    return teacher_prompts(pairs, [LANGUAGE]).select(
        "record_id", F.md5("prompt").alias("prompt"), F.length("prompt").alias("prompt_length")
    )


@registered("student_prompts", f"WITH {PAIRS} SELECT record_id, 1 AS n, 'user' AS role, md5(input) AS content FROM pairs")
def student_prompts_of_pairs(t):
    rows = student_prompts(chat_pairs(t))
    m = F.col("messages")
    return rows.select("record_id", F.size(m).alias("n"), m[0]["role"].alias("role"), F.md5(m[0]["content"]).alias("content"))


@registered("training_manifest", f"""
WITH {PAIRS}, sized AS (SELECT input_role AS task, ceil((length(input) + length(output)) / 4.0::DOUBLE)::BIGINT AS tokens FROM pairs)
SELECT task, count(*) FILTER (WHERE tokens <= 300) AS records, count(*) FILTER (WHERE tokens > 300) AS too_long,
  (sum(tokens) FILTER (WHERE tokens <= 300))::BIGINT AS tokens,
  (ceil(count(*) FILTER (WHERE tokens <= 300) / 128.0::DOUBLE) * 4)::BIGINT AS steps
FROM sized GROUP BY task""")
def manifest_of_pairs(t):
    pairs = chat_pairs(t).withColumn("task", F.col("input_role"))
    tokens = estimated_tokens(F.concat("input", "output"))
    return training_manifest(pairs, tokens, batch_size=128, epochs=4, max_length=300)


# --- rule-based labels --------------------------------------------------------------------------

# What the spans look like, for an engine whose search is linear in any case.
_SQL_NAMES = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+",
    "credit_card": "\\b(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})\\b",
    "ssn": "\\b(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3} [0-9]{2} [0-9]{4}|[0-9]{9})\\b",
    "phone": "(?:[+][0-9]{1,3}[ -])?(?:[(][0-9]{3}[)] ?|\\b[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}\\b|\\b[0-9]{3}-[0-9]{4}\\b",
}


def _redacted_sql(column: str, kinds) -> str:
    out = column
    for kind in kinds:
        out = f"regexp_replace({out}, '{_SQL_NAMES[kind]}', '[{kind.upper()}]', 'g')"
    return out


def _spans_sql() -> str:
    parts, before = [], []
    for i, kind in enumerate(_SQL_NAMES):
        source = _redacted_sql("text", before)
        parts.append(
            f"SELECT id, {i} AS kind_no, '{kind}' AS type, unnest(hits) AS entity, generate_subscripts(hits, 1) AS place FROM "
            f"(SELECT id, regexp_extract_all({source}, '{_SQL_NAMES[kind]}') AS hits FROM texts)"
        )
        before.append(kind)
    return " UNION ALL ".join(parts)


@registered("pii_spans", f"""
WITH texts AS (SELECT doc_id AS id, text FROM documents), hits AS ({_spans_sql()}),
firsts AS (SELECT id, kind_no, type, entity, min(place) AS place FROM hits GROUP BY id, kind_no, type, entity)
SELECT id AS doc_id, row_number() OVER (PARTITION BY id ORDER BY kind_no, place) - 1 AS position, entity, type FROM firsts""")
def pii_spans(t):
    return detect(t.spread("documents"), "doc_id", "text")


@registered("pii_spans_of_answers", f"""
WITH texts AS (SELECT c_custkey AS id, 'Contact ' || c_name || ' at user' || c_custkey || '@mail.example.com or 555-0' || (100 + c_custkey % 100)
  || ', SSN ' || (100 + c_custkey % 800) || CASE WHEN c_custkey % 2 = 0 THEN '-45-6789' ELSE '456789' END || ', card 4111-1111-1111-' || (1000 + c_custkey % 9000) AS text FROM customer),
hits AS ({_spans_sql()})
SELECT id AS record_id, type, entity FROM hits""")
def pii_spans_of_answers(t):
    k = F.col("c_custkey")
    text = F.concat(
        F.lit("Contact "), "c_name", F.lit(" at user"), k.cast("string"), F.lit("@mail.example.com or 555-0"),
        (k % 100 + 100).cast("string"), F.lit(", SSN "), (k % 800 + 100).cast("string"),
        F.when(k % 2 == 0, "-45-6789").otherwise("456789"), F.lit(", card 4111-1111-1111-"), (k % 9000 + 1000).cast("string"),
    )
    return detect(t.spread("customer").select(k.alias("record_id"), text.alias("text")), "record_id", "text").select("record_id", "type", "entity")


@registered("redacted_documents", f"SELECT doc_id, md5({_redacted_sql('text', _SQL_NAMES)}) AS redacted FROM documents")
def redacted_documents(t):
    return t.spread("documents").select("doc_id", F.md5(redact(F.col("text"))).alias("redacted"))


def _language_sql() -> str:
    def count(pattern: str) -> str:
        return f"(length(c) - length(regexp_replace(c, '{pattern}', '', 'g')))"

    scripts = {
        "latin": "[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}\\x{1e00}-\\x{1eff}]",
        "hi": "[\\x{900}-\\x{97f}]", "el": "[\\x{370}-\\x{3ff}\\x{1f00}-\\x{1fff}]", "ru": "[\\x{400}-\\x{4ff}]",
        "zh": "[\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}]", "arabic": "[\\x{600}-\\x{6ff}\\x{750}-\\x{77f}]",
    }
    noise = ["(?:https?://|www\\.)\\S+", "\\S+@\\S+\\.\\S+", "[@#]\\w+", "(?:[A-Za-z]:)?(?:[/\\\\][\\w.-]+){2,}"]
    plain = "text"
    for pattern in noise:
        plain = f"regexp_replace({plain}, '{pattern}', ' ', 'g')"
    breaks = "\\P{L}+"
    signals = []
    for lang in LATIN_ORDER:
        words = ", ".join(f"'{w}'" for w in WORDS[lang].split())
        letters = " + " + count(LETTERS[lang]) if lang in LETTERS else ""
        signals.append(f"(len(list_filter(w, lambda x: x IN ({words}))){letters})::BIGINT AS {lang}")
    rows = " UNION ALL ".join(f"SELECT id, '{n}' AS name, {count(p)} AS n FROM cleaned" for n, p in scripts.items())
    votes = " UNION ALL ".join(f"SELECT id, '{x}' AS name, {x} AS n FROM signals" for x in LATIN_ORDER)
    return f"""
cleaned AS (SELECT doc_id AS id, lower({plain}) AS c FROM documents),
scripts AS ({rows}),
top_script AS (SELECT id, CASE WHEN max(n) = 0 OR count(*) > 1 THEN 'ot' ELSE min(name) END AS script
  FROM (SELECT *, max(n) OVER (PARTITION BY id) AS best FROM scripts) WHERE n = best GROUP BY id),
words AS (SELECT id, c, list_filter(string_split_regex(c, '{breaks}'), lambda x: x <> '') AS w FROM cleaned),
signals AS (SELECT id, len(w) AS n_words, {", ".join(signals)} FROM words),
votes AS ({votes}),
top_vote AS (SELECT id, max(n) AS best, CASE WHEN count(*) > 1 THEN 'ot' ELSE min(name) END AS winner
  FROM (SELECT *, max(n) OVER (PARTITION BY id) AS best FROM votes) WHERE n = best GROUP BY id),
language AS (SELECT s.id, CASE
    WHEN script <> 'latin' THEN CASE WHEN script = 'arabic' THEN 'ar' ELSE script END
    WHEN n_words <= 2 THEN CASE WHEN greatest(vi, tr, de, es, fr) >= 2 THEN winner ELSE 'ot' END
    WHEN best >= 2 THEN winner
    WHEN en = 1 AND greatest(vi, tr, de, es, fr) < 2 THEN 'en' ELSE 'ot' END AS response
  FROM signals s JOIN top_script USING (id) JOIN top_vote USING (id))"""


LANGUAGE_LABELS = _language_sql()


@registered("language_labels", f"WITH {LANGUAGE_LABELS} SELECT id AS doc_id, response AS language FROM language")
def language_labels(t):
    return with_language(t.spread("documents").select("doc_id", "text"), "text", "language").select("doc_id", "language")


def _keyword_sql() -> str:
    cols = []
    for label, terms in ROUTING.items():
        parts = [f"{w} * len(regexp_extract_all(low, '\\b{term}\\b'))" for term, w in terms.items()]
        cols.append(f"({' + '.join(parts)})::BIGINT AS {label}")
    return ", ".join(cols)


@registered("keyword_labels", f"""
WITH texts AS (SELECT event_id AS id, lower('Our ' || event_type || ' shows an ERROR; the invoice ' || props || ' for login ' || user_id
    || CASE event_id % 4 WHEN 0 THEN ' needs a refund' WHEN 1 THEN ' hit a bug, broken API' WHEN 2 THEN ' password, profile and settings' ELSE '' END) AS low FROM events),
scored AS (SELECT id, {_keyword_sql()} FROM texts)
SELECT id AS event_id, greatest(billing, technical, account, general) AS label_score, CASE greatest(billing, technical, account, general)
  WHEN 0 THEN NULL WHEN billing THEN 'billing' WHEN technical THEN 'technical' WHEN account THEN 'account' ELSE 'general' END AS label
FROM scored""")
def keyword_labels(t):
    k = F.col("event_id") % 4
    ending = F.when(k == 0, " needs a refund").when(k == 1, " hit a bug, broken API").when(k == 2, " password, profile and settings").otherwise("")
    text = F.concat(
        F.lit("Our "), "event_type", F.lit(" shows an ERROR; the invoice "), "props", F.lit(" for login "),
        F.col("user_id").cast("string"), ending,
    )
    return with_keyword_label(t.spread("events").select("event_id", text.alias("text")), "text", ROUTING, "label").select("event_id", "label", "label_score")


@registered("student_accuracy", """
WITH test AS (SELECT lang FROM (SELECT lang, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)
  WHERE rn > CAST(trunc(n * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT))
SELECT sum(n)::BIGINT AS n_examples, max(n) / sum(n) AS majority, true AS beats_majority FROM (SELECT count(*) AS n FROM test GROUP BY lang)""")
def student_accuracy(t):
    """Fit on the train split, score the test split, against always answering the commonest label."""
    split = split_exactly(t.spread("documents").select("doc_id", "text", "lang"), "doc_id", size=0.2)
    model = fit_student(split.filter("split = 'train'"), "text", "lang")
    test = answer(model, split.filter("split = 'test'"))
    right = (F.col("response") == F.col("lang")).cast("double")
    by_label = test.groupBy("lang").agg(F.count("*").alias("n"), F.sum(right).alias("right"))
    return by_label.agg(
        F.sum("n").alias("n_examples"), (F.max("n") / F.sum("n")).alias("majority"), (F.sum("right") > F.max("n")).alias("beats_majority"),
    )


# --- splits -------------------------------------------------------------------------------------

SPLIT = """split AS (
  SELECT doc_id, lang, n, CASE WHEN rn <= CAST(trunc(n * (1.0::DOUBLE - {size})) AS BIGINT) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS rn,
    count(*) OVER (PARTITION BY lang) AS n FROM documents))"""
RULE = "least(0.5::DOUBLE, greatest(0.2::DOUBLE, 200::DOUBLE / n))"


@registered("test_sizes", f"SELECT lang, n, {RULE} AS test_size FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def test_sizes(t):
    counts = t.documents.groupBy("lang").agg(F.count("*").alias("n"))
    return counts.withColumn("test_size", test_size(F.col("n"), 200))


@registered("exact_split", f"WITH {SPLIT.format(size='0.2::DOUBLE')} SELECT doc_id, lang, split FROM split")
def exact_split(t):
    return split_exactly(t.documents.select("doc_id", "lang"), "doc_id", ["lang"], size=0.2)


@registered("exact_split_by_rule", f"WITH {SPLIT.format(size=RULE)} SELECT doc_id, lang, split FROM split")
def exact_split_by_rule(t):
    return split_exactly(t.documents.select("doc_id", "lang"), "doc_id", ["lang"], eval_samples=200)


@registered("exact_split_orders", """
SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM (
  SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('7|' || o_orderkey), o_orderkey)
    <= CAST(trunc(count(*) OVER () * (1.0::DOUBLE - 0.3::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM orders)
GROUP BY split""")
def exact_split_orders(t):
    split = split_exactly(t.orders.select("o_orderkey"), "o_orderkey", size=0.3, seed=7)
    return split.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@registered("split_check", f"""
WITH {SPLIT.format(size='0.2::DOUBLE')}
SELECT lang, count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train,
  count(*) FILTER (WHERE split = 'test') AS test, 0 AS in_both FROM split GROUP BY lang""")
def split_check(t):
    return check_split(split_exactly(t.documents.select("doc_id", "lang"), "doc_id", ["lang"], size=0.2), "doc_id", ["lang"])


@registered("eval_head", """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS rn
  FROM documents) WHERE rn <= 25""")
def eval_head(t):
    return head(t.documents.select("doc_id", "lang"), "doc_id", 25, ["lang"])


@registered("eval_head_overall", "SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 200")
def eval_head_overall(t):
    return head(t.documents.select("doc_id"), "doc_id", 200)


@registered("eval_head_large", """
SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42|' || o_orderkey), o_orderkey) AS rn FROM orders) WHERE rn <= 2000""")
def eval_head_large(t):
    return head(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 2000, ["o_orderstatus"])


@registered("spot_check", f"""
WITH {ALL_ANSWERS}
SELECT task, label, record_id FROM (
  SELECT 'language' AS task, gold AS label, record_id,
    row_number() OVER (PARTITION BY gold ORDER BY md5('42|' || record_id), record_id) AS rn FROM language_answers) WHERE rn <= 10""")
def spot_check_labels(t):
    rows = all_answers(t).filter("task = 'language'").select("task", F.col("gold").alias("label"), "record_id")
    return spot_check(rows, "record_id", ["task", "label"], 10)


@registered("sufficiency", f"""
WITH {ALL_ANSWERS}, counted AS (SELECT task, CASE task WHEN 'language' THEN 'single_label' WHEN 'sql_generation' THEN 'free_text' ELSE 'json' END AS output_format,
  count(*) AS examples FROM all_answers GROUP BY task)
SELECT *, CASE output_format
  WHEN 'single_label' THEN CASE WHEN examples < 200 THEN 'too few' WHEN examples <= 1000 THEN 'enough' ELSE 'plenty' END
  WHEN 'json' THEN CASE WHEN examples < 500 THEN 'too few' WHEN examples <= 2000 THEN 'enough' ELSE 'plenty' END
  ELSE CASE WHEN examples < 1000 THEN 'too few' WHEN examples <= 5000 THEN 'enough' ELSE 'plenty' END END AS verdict
FROM counted""")
def sufficiency_by_task(t):
    return sufficiency(all_answers(t), dispatch(ALL_TASKS, F.col("task"), lambda s: F.lit(s.output_format)))


# --- splits and leakage by text ----------------------------------------------------------------

NORMAL = "lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))"
TEXT_SPLIT = f"""weights AS (
  SELECT lang, md5('42|' || coalesce({NORMAL}, chr(0))) AS key, count(*) AS n FROM documents GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY key) AS upto, CAST(trunc(sum(n) OVER (PARTITION BY lang) * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT) AS target FROM weights),
sides AS (
  SELECT lang, key, CASE WHEN upto <= target OR (upto - n < target AND upto - target < target - (upto - n)) THEN 'train' ELSE 'test' END AS split FROM running),
split AS (
  SELECT d.doc_id, d.lang, d.text, s.split FROM documents d JOIN sides s ON d.lang IS NOT DISTINCT FROM s.lang AND s.key = md5('42|' || coalesce({NORMAL}, chr(0))))"""
RECORD_SPLIT = """split AS (
  SELECT doc_id, lang, text, CASE WHEN rn <= CAST(trunc(n * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents))"""
LEAKS = f"""leaks AS (
  SELECT lang, {NORMAL} AS text, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'test') AS test FROM split
  WHERE {NORMAL} <> '' GROUP BY ALL HAVING count(DISTINCT split) = 2)"""
LEAKAGE = f"""{LEAKS}, leaked AS (SELECT lang, count(*) AS leaked_texts, sum(test)::BIGINT AS leaked_rows FROM leaks GROUP BY lang)
SELECT s.lang, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'test') AS test, coalesce(any_value(leaked_texts), 0) AS leaked_texts,
  coalesce(any_value(leaked_rows), 0) AS leaked_rows, round(coalesce(any_value(leaked_rows), 0) / count(*) FILTER (WHERE split = 'test'), 9) AS share
FROM split s LEFT JOIN leaked l ON l.lang = s.lang GROUP BY s.lang"""


def _split_texts(t):
    return split_by_group(t.documents.select("doc_id", "lang", "text"), canonical(F.col("text")), ["lang"], size=0.2)


def _split_records(t):
    return split_exactly(t.documents.select("doc_id", "lang", "text"), "doc_id", ["lang"], size=0.2)


@registered("split_by_text", f"WITH {TEXT_SPLIT} SELECT doc_id, lang, split FROM split")
def split_by_text(t):
    return _split_texts(t).select("doc_id", "lang", "split")


@registered("leaked_texts", f"WITH {RECORD_SPLIT}, {LEAKS} SELECT lang, md5(text) AS text, train, test FROM leaks")
def texts_in_both_splits(t):
    return leaked_texts(_split_records(t), "text", ["lang"]).withColumn("text", F.md5("text"))


@registered("text_leakage", f"WITH {RECORD_SPLIT}, {LEAKAGE}")
def leakage_of_record_split(t):
    return leakage(_split_records(t), "text", ["lang"]).withColumn("share", F.round("share", 9))


@registered("text_leakage_by_text", f"WITH {TEXT_SPLIT}, {LEAKAGE}")
def leakage_of_text_split(t):
    """No text is on both sides of a split by text."""
    return leakage(_split_texts(t), "text", ["lang"]).withColumn("share", F.round("share", 9))


# --- one question per text ---------------------------------------------------------------------


def _document_prompts(t):
    rows = t.documents.select(F.col("doc_id").cast("string").alias("record_id"), F.lit("language").alias("task"), F.col("text").alias("input"))
    return rows.withColumn("prompt", LANGUAGE.prompt(F.coalesce("input", F.lit(""))))


def _make_article_counter():
    """A stand-in for a model client: English if the prompt's text has more of 'the' than of 'la' and 'der'."""
    def ask(prompt: str) -> str:
        words = prompt.split("\nText:\n", 1)[1].lower().split(" ")
        return "Final Answer: " + ("en" if words.count("the") > words.count("la") + words.count("der") else "ot")

    return ask


@registered("distinct_calls", "SELECT 'language' AS task, count(*) AS records, count(DISTINCT coalesce(text, chr(0))) AS calls FROM documents")
def distinct_calls(t):
    distinct = distinct_inputs(_document_prompts(t), keep=())
    return distinct.groupBy("task").agg(F.sum("copies").alias("records"), F.count("*").alias("calls"))


@registered("labelled_once", """
WITH w AS (SELECT doc_id, string_split(lower(text), ' ') AS words FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS record_id, 'Final Answer: ' || CASE WHEN len(list_filter(words, lambda x: x = 'the')) > len(list_filter(words, lambda x: x IN ('la', 'der')))
  THEN 'en' ELSE 'ot' END AS response FROM w""")
def labelled_once(t):
    """Every document labelled, every distinct text asked once."""
    done = label_distinct_to_table(_document_prompts(t), _make_article_counter, new_folder(t.spark, "responses"), waves=2)
    return done.select("record_id", "response")


# --- the whole path -----------------------------------------------------------------------------

DATASET = f"""WITH {PAIRS}, texts AS (SELECT record_id AS id, output AS text FROM pairs), {DEGENERATE_SQL},
kept AS (SELECT id, row_number() OVER (ORDER BY md5('42|' || id), id) AS rn, count(*) OVER () AS n FROM degenerate WHERE NOT bad),
outcome AS (SELECT CASE WHEN rn <= CAST(trunc(n * (1.0::DOUBLE - {RULE})) AS BIGINT) THEN 'train' ELSE 'test' END AS outcome FROM kept
  UNION ALL SELECT 'degenerate' FROM degenerate WHERE bad)"""


@registered("conversation_dataset", f"{DATASET} SELECT outcome, count(*) AS records FROM outcome GROUP BY outcome")
def conversation_dataset(t):
    """Conversations to assistant pairs, degenerate answers out, exact split by the size rule."""
    judged = judged_table(chat_pairs(t), [CHAT], new_folder(t.spark, "judged"))
    kept = split_exactly(judged.filter("reject_reason IS NULL"), "record_id", ["task"], eval_samples=200)
    outcomes = kept.select(F.col("split").alias("outcome")).unionByName(
        judged.filter("reject_reason IS NOT NULL").select(F.col("reject_reason").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("records"))


@registered("split_files", f"{DATASET} SELECT 'chat' AS task, outcome AS split, count(*) AS records FROM outcome WHERE outcome <> 'degenerate' GROUP BY outcome")
def split_files(t):
    path = new_folder(t.spark, "dataset")
    build_dataset(chat_pairs(t).select("record_id", "task", "input", "output"), [CHAT], path)
    return written_records(t.spark, path).groupBy("task", "split").agg(F.count("input").alias("records"))
