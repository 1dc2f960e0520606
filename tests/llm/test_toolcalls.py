import json
import random

import duckdb

from stillhouse.llm import toolcalls
from stillhouse.llm.queries import ORACLES, op6_tool_calls

SCHEMA = "conv bigint, turn bigint, role string, content string, call_id string, name string, arguments string"
TOOLS = {"find": {"properties": {"q": {"type": "string"}, "n": {"type": "integer"}, "how": {"type": "string", "enum": ["a", "b"]}}, "required": ["q"]}}


def run(spark, rows, tools=TOOLS):
    found = toolcalls.linked(spark.createDataFrame(rows, SCHEMA).repartition(3), tools)
    return toolcalls.in_order(found).collect()


def call(conv, turn, ident, arguments, name="find"):
    return (conv, turn, "assistant", None, ident, name, arguments if isinstance(arguments, str) or arguments is None else json.dumps(arguments))


def result(conv, turn, ident, content="done"):
    return (conv, turn, "tool", content, ident, None, None)


def test_results_follow_calls_and_references_come_first(spark):
    rows = [
        (1, 0, "user", "hi", None, None, None), result(1, 1, "a"), call(1, 2, "c", {"q": {"$ref": "b"}}), call(1, 3, "b", {"q": {"$ref": "a"}}),
        call(1, 4, "a", {"q": "x", "n": 2}), result(1, 5, "b"), result(1, 6, "c"), (1, 7, "user", "bye", None, None, None),
    ]
    got = [(r.call_id, r.part) for r in run(spark, rows)]
    assert got == [(None, 0), ("a", 0), ("a", 1), ("b", 0), ("b", 1), ("c", 0), ("c", 1), (None, 0)]


def test_statuses(spark):
    rows = [
        call(1, 0, "ok", {"q": "é\"\n"}), result(1, 1, "ok"), call(1, 2, "alone", {"q": "x"}), result(1, 3, "nobody"), result(1, 4, "ok", "again"), call(1, 5, "ok", {"q": "later"}),
        call(1, 6, "loop1", {"q": {"$ref": "loop2"}}), call(1, 7, "loop2", {"q": {"$ref": "loop1"}}), call(1, 8, "lost", {"q": {"$ref": "gone"}}),
        call(2, 0, "ok", {"q": 3}), call(2, 1, "m", {"n": 1}), call(2, 2, "e", {"q": "x", "how": "c"}), call(2, 3, "u", {"q": "x", "z": 1}), call(2, 4, "t", {}, "other"),
        call(2, 5, "j", "[" * 100_000), call(2, 6, "l", "[1]"), call(2, 7, "b", {"q": "x", "n": True}), call(2, 8, "null", None), result(2, 9, "ok"), call(None, None, "ok", {"q": "x"}),
        result(None, 1, "ok"), call(3, 0, None, {"q": "x"}), result(3, 1, None),
    ]
    got = {(r.conv, r.turn, r.call_id, r.part): (r.status, r.problem) for r in run(spark, rows)}
    want = {
        (1, 0, "ok", 0): ("ok", None), (1, 2, "alone", 0): ("no_result", None), (1, 3, "nobody", 1): ("orphan", None), (1, 5, "ok", 0): ("repeated", None),
        (1, 6, "loop1", 0): ("cyclic", None), (1, 7, "loop2", 0): ("cyclic", None), (1, 8, "lost", 0): ("cyclic", None), (2, 0, "ok", 0): ("invalid", "q is no string"),
        (2, 1, "m", 0): ("invalid", "missing q"), (2, 2, "e", 0): ("invalid", "how is not allowed"), (2, 3, "u", 0): ("invalid", "unexpected z"), (2, 4, "t", 0): ("invalid", "unknown tool"),
        (2, 5, "j", 0): ("invalid", "arguments are no JSON"), (2, 6, "l", 0): ("invalid", "arguments are no object"), (2, 7, "b", 0): ("invalid", "n is no integer"),
        (2, 8, "null", 0): ("invalid", "arguments are no JSON"), (None, None, "ok", 0): ("ok", None), (3, 0, None, 0): ("no_result", None), (3, 1, None, 1): ("orphan", None),
    }
    assert {k: got[k] for k in want} == want
    assert sorted(r.status for r in run(spark, rows) if r.part == 1 and r.call_id == "ok" and r.conv == 1) == ["ok", "repeated"]


def test_json_is_canonical(spark):
    rows = [call(1, 0, "a", '{"q" : "\\u00e9\\n\\"", "n": 1.0}'), result(1, 1, "a", "x\ty"), (1, 2, None, None, None, None, None)]
    assert [r.json for r in run(spark, rows)] == [
        '{"content":null,"role":"assistant","tool_calls":[{"arguments":{"n":1.0,"q":"é\\n\\""},"id":"a","name":"find"}]}',
        '{"content":"x\\ty","role":"tool","tool_call_id":"a"}', '{"content":null,"role":null}',
    ]


def test_empty_repeated_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = [call(1, 0, "a", {"q": "x"})] * 3 + [(1, 1, "user", "same", None, None, None)] * 2
    assert sorted(r.status for r in run(spark, rows)) == ["no_result", "ok", "ok", "repeated", "repeated"]
    wide = spark.createDataFrame([(*rows[0], "z", 1)], SCHEMA + ", status string, mid int")
    assert [r.status for r in toolcalls.linked(wide, TOOLS).collect()] == ["no_result"]


def test_a_long_conversation_and_a_deep_chain(spark):
    rows = [call(1, i, f"c{i}", {"q": {"$ref": f"c{i - 1}"} if 0 < i < 12 else "x"}) for i in range(3000)]
    got = run(spark, rows)
    assert [r.call_id for r in got] == [f"c{i}" for i in range(3000)] and got[11].level == 11


def plain_levels(deps):
    """{call: (level, at)} by walking in rounds; deps: call -> (turn, referred calls)."""
    done = {}
    while True:
        ready = {c: d for c, d in deps.items() if c not in done and all(x in done for x in d[1])}
        if not ready:
            return done
        done |= {c: (1 + max((done[x][0] for x in on), default=-1), max([turn, *(done[x][1] for x in on)])) for c, (turn, on) in ready.items()}


def test_chains_trees_and_circles_of_references(spark):
    random.seed(4)
    deps = {}
    for i in range(5000):
        deps[f"c{i}"] = (i, [f"c{i - 1}"] if i else [])
    for i in range(40):
        deps[f"d{i}"] = (random.randrange(9000), random.sample([f"d{j}" for j in range(max(0, i - 9), i)], min(i, random.randrange(4))) + ([f"c{random.randrange(5000)}"] if i % 7 == 0 else []))
    deps |= {"o1": (1, ["o2"]), "o2": (2, ["o3"]), "o3": (3, ["o1"]), "p": (4, ["o1"]), "q": (5, ["p", "c3"]), "lost": (6, ["gone"]), "r": (7, ["lost"]), "self": (8, ["self"]), "s": (9, ["c1", "c4000"])}
    rows = [call(1, turn, c, {"q": "x", **{f"r{k}": {"$ref": x} for k, x in enumerate(on)}}) for c, (turn, on) in deps.items()]
    got = {r.call_id: (r.level, r.at) if r.status != "cyclic" else None for r in run(spark, rows, {"find": {"properties": {"q": {"type": "string"}} | {f"r{k}": {"type": "string"} for k in range(9)}}})}
    want = plain_levels(deps)
    assert got == {c: want.get(c) for c in deps}


def test_query_over_a_chat_of_many_blocks(spark, tmp_path):
    random.seed(5)
    roles = ["assistant" if random.random() < 0.4 else "user" for _ in range(5000)]
    rows = [(1, t, role, f"t{t}") for t, role in enumerate(roles)] + [(2, t, "user", "x") for t in range(0, 4000, 999)] + [(3, 0, "assistant", "z")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = db.sql(ORACLES["op6_tool_calls"])
    got = [[r[c] for c in found.columns] for r in op6_tool_calls(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((list(r) for r in found.fetchall()), key=str)


def test_query_equals_sql(spark, small):
    rows = op6_tool_calls(spark, small).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    found = db.sql(ORACLES["op6_tool_calls"])
    assert rows and sorted(([r[c] for c in found.columns] for r in rows), key=str) == sorted((list(r) for r in found.fetchall()), key=str)
    assert {r.status for r in rows} == {"ok", "no_result"}
