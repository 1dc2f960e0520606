"""Files, message records, conversations."""

import json

import pytest
from pyspark.sql import Window, functions as F

from stillhouse.plans.build import build_dataset, written_records
from stillhouse.sources import builtin_specs as specs
from stillhouse.sources.jsonl import read_jsonl, read_messages, write_jsonl
from stillhouse.sources.messages import assistant_pairs, conversation_records, previous_turn, to_messages, to_pairs


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([(1, "hello"), (2, None)], "a long, b string")
    write_jsonl(rows, path)
    assert sorted(map(tuple, read_jsonl(spark, path, "a: bigint, b: string").collect()), key=repr) == [(1, "hello"), (2, None)]


def test_reading_is_strict(spark, tmp_path):
    file = tmp_path / "b.jsonl"
    file.write_text('\n{"a": 1, "b": "x"}\n  \n{"a": 2, "b": "y"} trailing\n{"a": 3, "a": 4}\n')
    with pytest.raises(Exception, match="not one JSON object"):
        read_jsonl(spark, str(file), "a: bigint, b: string").collect()
    rows = read_jsonl(spark, str(file), "a: bigint, b: string", strict=False).collect()
    assert [(r.a, r.b) for r in rows if r.bad_line is None] == [(1, "x"), (4, None)]
    assert [r.bad_line for r in rows if r.bad_line] == ['{"a": 2, "b": "y"} trailing']


def test_python_text(spark, tmp_path):
    path = tmp_path / "c"
    rows = spark.createDataFrame([("q", "café")], "input string, output string")
    write_jsonl(to_messages(rows), str(path), python_text=True)
    text = "".join(p.read_text() for p in path.glob("part-*"))
    record = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "café"}]}
    assert text == json.dumps(record) + "\n"
    assert to_pairs(read_messages(spark, str(path))).first().output == "café"


def test_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 5, "assistant", "a2"), (2, 0, "user", "x"),
         (3, 0, "assistant", "first"), (3, 1, "user", "u"), (3, 2, "assistant", "b")],
        "conv_id long, turn long, role string, text string",
    )
    pairs = {r.record_id: (r.input_role, r.input, r.output) for r in assistant_pairs(turns).collect()}
    assert pairs == {"1-2": ("user", "u1", "a1"), "1-5": ("assistant", "a1", "a2"), "3-2": ("user", "u", "b")}
    whole = sorted((r.conv_id, r.turn, r.content, r.train, r.targets) for r in conversation_records(turns).collect())
    assert whole == [(1, 0, "s", False, 2), (1, 1, "u1", False, 2), (1, 2, "a1", True, 2), (1, 5, "a2", True, 2),
                     (3, 0, "first", True, 2), (3, 1, "u", False, 2), (3, 2, "b", True, 2)]


def test_long_and_nameless_conversations(spark):
    role = F.when(F.col("id").isin(3, 7000), "assistant").when(F.col("id") != 5, "user")
    turns = spark.range(10_000).select(
        F.when(F.col("id") >= 5000, F.lit(None)).otherwise(F.lit(1)).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        role.alias("role"), F.concat(F.lit("t"), "id").alias("text"),
    )
    kept = conversation_records(turns)
    assert kept.count() == 10_000 and sorted(r.turn for r in kept.filter("train").collect()) == [3, 7000]
    assert sorted((r.turn, r.input) for r in assistant_pairs(turns).collect()) == [(3, "t2"), (7000, "t6999")]
    assert [r.prev_text for r in previous_turn(turns, "conv_id", "turn", ["text"], 4).filter("turn in (4999, 5000, 5004)").orderBy("turn").collect()] == ["t4998", None, "t5003"]


def test_previous_turn_in_blocks_equals_lag(spark):
    turns = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1001).alias("turn"), F.col("id").alias("v"))
    lagged = turns.withColumn("prev_v", F.lag("v").over(Window.partitionBy("g").orderBy("turn")))
    plain = list(map(tuple, lagged.select("g", "turn", "v", "prev_v").collect()))
    for size in (1, 10, 64, 4096):
        blocks = previous_turn(turns, "g", "turn", ["v"], turns_per_block=size).select("g", "turn", "v", "prev_v")
        assert sorted(map(tuple, blocks.collect()), key=repr) == sorted(plain, key=repr)


def test_build_dataset(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("record_id"), F.when(F.col("id") % 2 == 0, "ticket_routing").otherwise("pii_detection").alias("task"),
        F.concat(F.lit("text "), "id").alias("input"),
        F.when(F.col("id") % 10 == 0, "Answer:\n" * 6).when(F.col("id") % 2 == 0, "Billing").otherwise('[{"entity":"a","type":"EMAIL"}]').alias("output"),
    )
    path = str(tmp_path / "set")
    kept, removed = build_dataset(rows, specs.ALL_TASKS, path, size=0.25, python_text=True)
    assert [tuple(r) for r in removed.collect()] == [("ticket_routing", "degenerate", 40)]
    files = written_records(spark, path)
    assert {(r.task, r.split): r["count"] for r in files.groupBy("task", "split").count().collect()} == {
        ("ticket_routing", "train"): 120, ("ticket_routing", "test"): 40, ("pii_detection", "train"): 150, ("pii_detection", "test"): 50,
    }
    assert {r.output for r in files.select("output").distinct().collect()} == {"billing", '[{"entity": "a", "type": "email"}]'}
    assert kept.count() == 360
