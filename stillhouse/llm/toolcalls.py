"""Tool-call linking: calls and results joined by identifier, topologically ordered, validated, serialised.

Input: ``messages`` (conv, turn, role, content, call_id, name, arguments), where a call has a name and JSON
arguments, a result has the role ``tool`` and the call's id, and any other message has neither. Arguments may hold
``{"$ref": "<call id>"}`` for the result of another call of the conversation; such a call comes after it.

The output has a row per message with its place: ``at`` (the turn, or the latest turn of what it depends on if that is later),
``level`` (depth in the references), ``turn`` and ``part`` (0 messages and calls, 1 results, which
follow their calls). Ordering a conversation by these four is a topological order. ``status`` is ok, or else: ``no_result``,
``orphan`` (result without a call), ``repeated`` (a further call or result of an id), ``cyclic`` (references that
never resolve, also to unknown calls), ``invalid`` (``problem`` says why). ``json`` is canonical: keys sorted by code
point, no blanks, non-ASCII text as it is.

Defined results: a null conversation is a conversation of its own, null turns come first; a null id links to
nothing; of equal ids the first in order (turn, then content) is linked, the others are ``repeated``; rows that
repeat another one in all columns are one message; null content is JSON null; an empty table stays empty;
arguments of any length and nesting that does not parse are ``invalid``. No conversation is gathered in one
task. Other columns are not read.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stillhouse.llm.common import stored
from stillhouse.sources.workspace import new_folder

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}
COLUMNS = ["conv", "turn", "role", "content", "call_id", "name", "arguments"]
CHECKED = StructType([StructField("canonical", StringType()), StructField("problem", StringType()), StructField("refs", StringType())])
DEEPEST = 200


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def references(value, depth: int = 0) -> set[str]:
    if depth > DEEPEST:
        raise RecursionError
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        value = list(value.values())
    return set().union(*[references(v, depth + 1) for v in value]) if isinstance(value, list) else set()


def problem_of(arguments, schema: dict | None) -> str | None:
    """Why arguments do not meet a schema {properties: {name: {type, enum?}}, required: [...]}; None if they do."""
    if schema is None:
        return "unknown tool"
    if not isinstance(arguments, dict):
        return "arguments are no object"
    missing = sorted(set(schema.get("required", [])) - set(arguments))
    if missing:
        return f"missing {missing[0]}"
    for key in sorted(arguments):
        rule, value = schema["properties"].get(key), arguments[key]
        if rule is None:
            return f"unexpected {key}"
        if isinstance(value, dict) and set(value) == {"$ref"}:
            continue
        kind = TYPES[rule["type"]]
        if not isinstance(value, kind) or (isinstance(value, bool) and rule["type"] in ("integer", "number")):
            return f"{key} is no {rule['type']}"
        if "enum" in rule and value not in rule["enum"]:
            return f"{key} is not allowed"
    return None


def _checked(calls: DataFrame, schemas: dict) -> DataFrame:
    @F.pandas_udf(CHECKED)
    def check(names: pd.Series, arguments: pd.Series) -> pd.DataFrame:
        def one(name, text):
            try:
                value = json.loads(text)
                return canonical(value), problem_of(value, schemas.get(name)), canonical(sorted(references(value)))
            except (TypeError, ValueError, RecursionError):
                return "null", "arguments are no JSON", "[]"

        return pd.DataFrame([one(n, a) for n, a in zip(names, arguments)], columns=CHECKED.fieldNames())

    return calls.withColumn("checked", check("name", "arguments")).select("*", "checked.*").drop("checked")


def _chains(singles: DataFrame) -> DataFrame:
    """(mid, to, steps, at, done) for the calls that refer to one other call: where following these references ends.

    Pointer doubling over one written table: each round replaces every pointer to such a call by that call's own pointer, so
    chains of any length take as many rounds as their length has bits. What is still open then runs in a circle.
    """
    inner = singles.select(F.col("mid").alias("to"), F.lit(False).alias("last"))
    now = stored(
        singles.join(inner, "to", "left").select("mid", "to", F.lit(1).cast("bigint").alias("steps"), F.col("turn").alias("at"), F.coalesce("last", F.lit(True)).alias("done")),
        "chains",
    )
    reach, rows = 1, now.count()
    while reach <= rows and not now.filter("NOT done").isEmpty():
        reach *= 2
        onward = now.select(F.col("mid").alias("to"), F.col("to").alias("far"), F.col("steps").alias("more"), F.col("at").alias("beyond"), F.col("done").alias("ends"))
        moved = now.filter("NOT done").join(onward, "to").select(
            "mid", F.col("far").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.greatest("at", "beyond").alias("at"), F.col("ends").alias("done")
        )
        now = stored(now.filter("done").unionByName(moved), "chains")
    return now


def _levels(calls: DataFrame, firsts: DataFrame) -> DataFrame:
    """(mid, at, level) of the calls whose references resolve, level being the depth of their references.

    Calls with one reference are resolved by their chains, whatever these' length. Only calls with several references take
    a round of joins per depth among themselves; each round appends to one table, which is read as a whole.
    """
    named = calls.select("mid", "cid", "turn", F.explode_outer(F.from_json("refs", "array<string>")).alias("on"))
    found = firsts.select("cid", F.col("call_id").alias("on"), F.col("mid").alias("dep"))
    needs = named.filter("on IS NOT NULL").join(found, ["cid", "on"], "left").select("mid", "turn", "dep").distinct()
    counted = needs.groupBy("mid").agg(F.count("*").alias("refs"), F.bool_and(F.col("dep").isNotNull()).alias("known"), F.min("dep").alias("only"), F.first("turn").alias("turn"))
    counted = stored(counted, "references").filter("known")
    chains = _chains(counted.filter("refs = 1").select("mid", F.col("only").alias("to"), "turn")).filter("done")
    several = stored(needs.join(counted.filter("refs > 1").select("mid"), "mid", "left_semi"), "references")
    ends = several.join(chains.select(F.col("mid").alias("dep"), "to", "steps", F.col("at").alias("on_way")), "dep", "left")
    # A chain that never ends has no row in chains, and its calls no level to wait for.
    open_ends = stored(ends.select("mid", "turn", F.coalesce("to", "dep").alias("to"), F.coalesce("steps", F.lit(0)).alias("steps"), "on_way"), "references")

    spark, kind = calls.sparkSession, calls.schema["turn"].dataType.simpleString()
    path, schema = new_folder(spark, "levels"), f"mid bigint, at {kind}, level bigint"
    named.filter("on IS NULL").select("mid", F.col("turn").alias("at"), F.lit(0).cast("bigint").alias("level")).write.parquet(path)
    while not open_ends.isEmpty():
        settled = spark.read.schema(schema).parquet(path).select(F.col("mid").alias("to"), F.col("at").alias("after"), "level")
        met = open_ends.join(settled, "to", "left").groupBy("mid", "turn").agg(
            F.max(F.greatest("on_way", "after")).alias("after"), F.max(F.col("steps") + F.col("level") + 1).alias("level"), F.bool_and(F.col("level").isNotNull()).alias("all"),
        )
        ready = stored(met.filter("all").select("mid", F.greatest("turn", "after").alias("at"), "level"), "ready")
        if ready.isEmpty():
            break
        ready.write.mode("append").parquet(path)
        open_ends = stored(open_ends.join(ready.select("mid"), "mid", "left_anti"), "references")
    settled = spark.read.schema(schema).parquet(path)
    of_ends = settled.select(F.col("mid").alias("to"), F.col("at").alias("after"), F.col("level").alias("below"))
    chained = chains.join(of_ends, "to").select("mid", F.greatest("at", "after").alias("at"), (F.col("steps") + F.col("below")).alias("level"))
    return settled.unionByName(chained).withColumn("level", F.col("level").cast("int"))


@F.pandas_udf(StringType())
def _serialised(roles: pd.Series, contents: pd.Series, ids: pd.Series, names: pd.Series, arguments: pd.Series) -> pd.Series:
    def one(role, content, call, name, text):
        if text is not None:
            made = f'{{"arguments":{text},"id":{canonical(call)},"name":{canonical(name)}}}'
            return f'{{"content":{canonical(content)},"role":{canonical(role)},"tool_calls":[{made}]}}'
        value = {"role": role, "content": content}
        return canonical({**value, "tool_call_id": call} if role == "tool" else value)

    return pd.Series([one(*row) for row in zip(roles, contents, ids, names, arguments)], dtype=object)


def linked(messages: DataFrame, schemas: dict) -> DataFrame:
    """(conv, at, level, turn, call_id, part, status, problem, json), one row per message; the first five after
    ``conv`` order a conversation. ``schemas`` is the catalogue of tools: {name: schema}."""
    keys = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    rows = stored(messages.select(*COLUMNS, keys.alias("cid"), F.monotonically_increasing_id().alias("mid")), "messages")
    is_result = F.coalesce(F.col("role") == "tool", F.lit(False))
    is_call = ~is_result & F.col("name").isNotNull()
    place = F.struct("turn", F.xxhash64("content", "name", "arguments"), "mid").alias("place")

    def first(of: DataFrame) -> DataFrame:
        least = of.filter("call_id IS NOT NULL").groupBy("cid", "call_id").agg(F.min(place).alias("place"))
        return least.select("cid", "call_id", F.col("place.mid").alias("mid"), F.col("place.turn").alias("first_turn"))

    calls = stored(_checked(rows.filter(is_call), schemas), "calls")
    first_calls, first_results = stored(first(calls), "firsts"), stored(first(rows.filter(is_result)), "firsts")
    levels = stored(_levels(calls, first_calls), "levels")

    named_calls = first_calls.select("cid", "call_id", F.col("mid").alias("call_mid"), F.col("first_turn").alias("call_turn"))
    named_results = first_results.select("cid", "call_id", F.col("mid").alias("result_mid"))

    known = calls.drop("arguments").withColumnRenamed("canonical", "arguments").drop("refs")
    known = known.join(named_calls, ["cid", "call_id"], "left").join(named_results.hint("shuffle_hash"), ["cid", "call_id"], "left")
    known = known.join(levels, "mid", "left")
    call_status = (
        F.when(F.col("call_mid") != F.col("mid"), "repeated").when(F.col("level").isNull(), "cyclic")
        .when(F.col("problem").isNotNull(), "invalid").when(F.col("result_mid").isNull(), "no_result").otherwise("ok")
    )
    out_calls = known.select(
        "conv", F.when(F.col("level").isNull(), F.col("turn")).otherwise(F.col("at")).alias("at"), F.coalesce("level", F.lit(0)).alias("level"),
        "turn", "call_id", F.lit(0).alias("part"), call_status.alias("status"), "problem", "role", "content", "name", "arguments",
    )

    results = rows.filter(is_result).join(named_calls.hint("shuffle_hash"), ["cid", "call_id"], "left")
    results = results.join(named_results, ["cid", "call_id"], "left").join(levels.withColumnRenamed("mid", "call_mid"), "call_mid", "left")
    result_status = F.when(F.col("call_mid").isNull(), "orphan").when(F.col("result_mid") != F.col("mid"), "repeated").otherwise("ok")
    own_place = F.col("call_mid").isNull() | F.col("level").isNull()
    out_results = results.select(
        "conv", F.when(own_place, F.col("turn")).otherwise(F.col("at")).alias("at"), F.coalesce("level", F.lit(0)).alias("level"),
        F.when(own_place, F.col("turn")).otherwise(F.col("call_turn")).alias("turn"), "call_id", F.lit(1).alias("part"),
        result_status.alias("status"), F.lit(None).cast("string").alias("problem"), "role", "content", "name", F.lit(None).cast("string").alias("arguments"),
    )
    plain = rows.filter(~is_result & ~is_call).select(
        "conv", F.col("turn").alias("at"), F.lit(0).alias("level"), "turn", "call_id", F.lit(0).alias("part"), F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("problem"), "role", "content", "name", F.lit(None).cast("string").alias("arguments"),
    )
    every = out_calls.unionByName(out_results).unionByName(plain)
    return every.withColumn("json", _serialised("role", "content", "call_id", "name", "arguments")).drop("role", "content", "name", "arguments")


def in_order(linked_rows: DataFrame) -> DataFrame:
    """The rows sorted by conversation and place, for writing: a distributed sort, no group is gathered."""
    return linked_rows.orderBy("conv", "at", "level", "turn", "call_id", "part")
