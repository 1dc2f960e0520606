"""Worked cases for reading labels, free text and SQL."""

import pytest
from pyspark.sql import functions as F

from stillhouse.functions.answers import comparable_sql, free_text, single_label, sql_statement, sql_text, whole_word_label

TICKETS = ["billing", "technical", "account", "general"]
TICKET_REGEX = r"\b(billing|technical|account|general)\b"


def run(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.out for r in rows.select("i", expression(F.col("t")).alias("out")).orderBy("i").collect()]


def test_single_label(spark):
    cases = {
        "Final Answer: billing": "billing",
        "Billing.": "billing",
        "general, not billing": "general",
        "GENERAL first, then BILLING": "billing",
        "My accountant called": "account",
        "nothing here": None,
        "": None,
        None: None,
    }
    got = run(spark, list(cases), lambda t: single_label(t, TICKETS, TICKET_REGEX))
    assert got == list(cases.values())


def test_single_label_with_answer_regex(spark):
    got = run(
        spark,
        ["Final Answer: billing", "Final Answer: other, technical", "This is a technical issue"],
        lambda t: single_label(t, TICKETS, r"Final Answer:\s*(\w+)"),
    )
    assert got == ["billing", "technical", "technical"]


def test_whole_word_label(spark):
    got = run(spark, ["My accountant called", "GENERAL first, then BILLING"], lambda t: whole_word_label(t, TICKETS))
    assert got == [None, "general"]


def test_free_text(spark):
    fence = "```"
    assert run(spark, ["SELECT * FROM users;", f"{fence}sql\nSELECT 1;\n{fence}", " \n\t", None], free_text) == [
        "SELECT * FROM users;", "SELECT 1;", None, None,
    ]
    assert run(spark, ["Answer: hello world", "other"], lambda t: free_text(t, r"Answer:\s*(.*)")) == ["hello world", "other"]
    assert run(spark, ["x=12 y"], lambda t: free_text(t, r"\d+")) == ["12"]


def test_sql_text(spark):
    fence = "```"
    cases = {
        f"{fence}sql\nSELECT id FROM orders WHERE total > 100;\n{fence}": "SELECT id FROM orders WHERE total > 100;",
        "Sure! SELECT 1; SELECT 2;": "SELECT 1;",
        "WITH t AS (SELECT 1 AS a) SELECT a FROM t;": "SELECT 1 AS a) SELECT a FROM t;",
        f"Here: {fence}SQL\nselect 1\n{fence} ok": "select 1",
        "no statement": "no statement",
        "  ": None,
    }
    assert run(spark, list(cases), sql_text) == list(cases.values())
    assert run(spark, ["WITH t AS (SELECT 1 AS a) SELECT a FROM t;"], lambda t: sql_text(t, strict=True)) == [
        "WITH t AS (SELECT 1 AS a) SELECT a FROM t;"
    ]


def test_sql_statement(spark):
    cases = {
        "SELECT 1": "SELECT 1;",
        "I cannot answer": "I cannot answer;",
        "Query with joins: SELECT 1": "with joins: SELECT 1;",
        "Sure!\nselect a\nfrom t;\nbye": "select a\nfrom t;",
    }
    assert run(spark, list(cases), sql_statement) == list(cases.values())
    assert run(spark, ["I cannot answer", "SELECT 1", "Query with joins: SELECT 1"], lambda t: sql_statement(t, strict=True)) == [
        None, "SELECT 1;", "SELECT 1;",
    ]


@pytest.mark.parametrize("a,b,same", [
    ("select  ID from T;", "SELECT id FROM t", True),
    ("select 1;;", "SELECT 1", True),
    ("select 1 ;", "SELECT 1", False),
    ("select 1", "select 2", False),
])
def test_comparable_sql(spark, a, b, same):
    left, right = run(spark, [a, b], comparable_sql)
    assert (left == right) is same


def plain_sql(text):
    """The patterns as Python searches them."""
    import re

    match = re.search(r"(?is)(?:```sql\s*\n?(.*?)\n?\s*```|(?:SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\b.*?;)", text)
    if match:
        return (match[1] if match[1] is not None else match[0]).strip()
    return plain_free_text(text)


def plain_free_text(text):
    import re

    match = re.search(r"(?s)```(?:sql)?\s*\n?(.*?)\n?\s*```", text)
    return match[1].strip() if match else text.strip() or None


def test_search_by_position_finds_what_the_patterns_find(spark):
    import random

    random.seed(11)
    parts = ["```", "```sql", "```SQL", "`", "sql", "sqlite", " ", "\n", "\u00a0", "SELECT", "select", "selected", "update x", ";", "a", "\U0001d4b3", "drop\n", "é"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(14))) for _ in range(3000)]
    assert run(spark, texts, free_text) == [plain_free_text(t) for t in texts]
    assert run(spark, texts, sql_text) == [plain_sql(t) for t in texts]


def test_long_answers_take_linear_time(spark):
    import time

    n = 100_000
    texts = ["```" + " " * n, "```sql" + " \n" * n, "```sql " + "`` " * n, "select " * n, "with a as " * n, "```" + "\n" * n + "x"]
    run(spark, ["x"], sql_statement), run(spark, ["x"], free_text)
    for reader in (free_text, sql_text, sql_statement, lambda t: sql_text(t, strict=True)):
        for text in texts:
            began = time.time()
            run(spark, [text], reader)
            assert time.time() - began < 4


def test_callers_patterns_read_unicode(spark):
    assert run(spark, ["Étiquette: été fini"], lambda t: free_text(t, r"Étiquette:\s*(\w+)")) == ["été"]
    assert run(spark, ["Label:\u00a0Été."], lambda t: single_label(t, ["été", "x"], r"Label:\s*(\w+)")) == ["été"]
