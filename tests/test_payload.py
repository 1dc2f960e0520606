"""JSON in answers: strictness, where it is found, typed reading."""

import json
import time

import pytest
from pyspark.sql import functions as F

from stillhouse.functions.payload import find_json, json_text, likely_json, python_spelling, strict_json, with_payload

FENCE = "```"
CASES = {
    '{"key": "value"}': ({"key": "value"}, "whole"),
    f'Here:\n{FENCE}json\n{{"key": "value"}}\n{FENCE}\nDone.': ({"key": "value"}, "fenced"),
    'Some text [{"a": 1}, {"a": 2}] more': ([{"a": 1}, {"a": 2}], "array"),
    'Result: {"line_items": [1, 2]} ok': ([1, 2], "array"),
    '{"a":1} trailing': ({"a": 1}, "object"),
    '{"a":1}{"b":2}': (None, None),
    "{'a': 1}": (None, None),
    '{"a":1,"a":2}': ({"a": 2}, "whole"),
    "42": (42, "whole"),
    "null": (None, None),
    "[1,": (None, None),
    "no json here at all": (None, None),
    "": (None, None),
    "1] x [2": (None, None),
    ' \n{"a": true} ': ({"a": True}, "whole"),
    "1, 2": (None, None),
    '{"a": "café \U0001f600"}': ({"a": "café \U0001f600"}, "whole"),
}


def test_payload_matches_python(spark):
    rows = spark.createDataFrame(list(enumerate(CASES)), "i int, t string")
    got = with_payload(rows, "t").select("i", F.to_json("payload.doc").alias("doc"), "payload.path").orderBy("i").collect()
    for row, (value, path) in zip(got, CASES.values()):
        assert (json.loads(row.doc) if row.doc is not None else None) == value
        assert row.path == path
    for text, (value, path) in CASES.items():
        assert find_json(text)[0] == value


def test_outermost_first(spark):
    rows = spark.createDataFrame([('Result: {"line_items": [1, 2]} ok',)], "t string")
    assert with_payload(rows, "t", outermost_first=True).select(F.to_json("payload.doc")).first()[0] == '{"line_items":[1,2]}'


def test_strict_json_needs_the_whole_text(spark):
    texts = ['{"a":1} x', '{"a":1}{"b":2}', "1] x [2", "[1]", "01", "/*c*/1", '"a\tb"', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(F.to_json(strict_json(F.col("t")))).collect()]
    assert got == [None, None, None, "[1]", None, None, None, None]


def test_text_forms(spark):
    rows = spark.createDataFrame([('x {"b":1.0,"a":"é"}',)], "t string")
    assert rows.select(json_text("t")).first()[0] == '{"b": 1.0, "a": "\\u00e9"}'
    rows = spark.createDataFrame([('{"b":1,"a":[1,2]}',)], "t string")
    assert rows.select(python_spelling("t")).first()[0] == '{"b": 1, "a": [1, 2]}'


def test_not_a_number_is_a_number(spark):
    rows = spark.createDataFrame([('{"a": NaN, "b": 1}',)], "t string")
    got = with_payload(rows, "t").select(F.try_variant_get("payload.doc", "$.a", "double")).first()[0]
    assert got == float("inf")


def test_search_is_linear_and_survives_deep_nesting():
    started = time.perf_counter()
    assert find_json("[" * 200_000 + "]" * 200_000) == (None, None)
    assert find_json("```json" + " " * 200_000 + "x") == (None, None)
    assert find_json("```json\n" + " " * 200_000 + '{"a": 1}```') == ({"a": 1}, "fenced")
    assert time.perf_counter() - started < 1


@pytest.mark.parametrize("text, expected", [
    ("````[1]```", ([1], "array")), ("] [2] {", ([2], "array")), ("``` json\n[3]```", ([3], "array")), ("```json```", (None, None)),
    ('```{"a": [4]}``` ```[5]```', ({"a": [4]}, "fenced")), ("```[6]", ([6], "array")),
])
def test_places_to_look(text, expected):
    assert find_json(text) == expected


PROSE = [
    'The receipt: {"a": [1, 2], "b": "x"} ok', 'My answer: {"a": 1} - done', 'Found: [{"a": 1}, 2].', "No JSON here", 'true {"a": 1}', 'truth: {"a": 1}',
    'nullable [1]', 'NaN [1]', 'Nana [1]', 'x [1] y [2]', 'x {"a": 1} [2', 'x ] {"a": 1} [', '  lead {"a": 1, "a": 2}', 'x [1, NaN]', 'x {"a": NaN} [1]',
    'x [[[[', 'x {[}]', 'x ```json\n{"a": 1}\n``` [2]', "x null", "x []", 'x {"a": "[1]"}', 'é {"a": 1}', "x\n[1,\n2]\ny", 'x [1] {"a": 2}', 'x {"a": 2} [1]',
]


def test_prose_is_decided_in_the_jvm_as_python_does(spark):
    rows = spark.createDataFrame(list(enumerate(PROSE)), "i int, t string")
    for outermost in (False, True):
        got = with_payload(rows, "t", outermost_first=outermost).select("i", F.to_json("payload.doc").alias("doc"), "payload.path").orderBy("i").collect()
        want = [find_json(t, outermost) for t in PROSE]
        assert [r.path for r in got] == [path for _, path in want]
        plain = [(r.doc, v) for r, (v, _) in zip(got, want) if v is not None and "NaN" not in str(v) and "nan" not in str(v)]
        assert [json.loads(d) for d, _ in plain] == [v for _, v in plain]
    decided = rows.filter("i < 3").select(F.to_json(strict_json(likely_json(F.col("t"))["text"])).alias("doc")).collect()
    assert [r.doc for r in decided] == ["[1,2]", '{"a":1}', '[{"a":1},2]']
