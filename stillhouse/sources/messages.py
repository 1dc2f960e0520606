"""Message records, flat pairs and conversation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURNS_PER_BLOCK = 4096


def message_record(user: Column, assistant: Column) -> Column:
    """array of the two messages of one training example."""
    return F.array(
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )


def to_messages(pairs: DataFrame, input: str = "input", output: str = "output") -> DataFrame:
    """Flat pairs -> one ``messages`` column; other columns stay."""
    return pairs.withColumn("messages", message_record(F.col(input), F.col(output))).drop(input, output)


def to_pairs(records: DataFrame, messages: str = "messages") -> DataFrame:
    """Message records -> flat ``input``, ``output``: the first two messages, by position."""
    return records.withColumns(
        {"input": F.get(messages, F.lit(0))["content"], "output": F.get(messages, F.lit(1))["content"]}
    ).drop(messages)


def conversation_records(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The turns of every conversation with an assistant turn: (conversation, turn, role, content, train, targets).

    A conversation is one training record of any length, so it stays as rows, ordered by ``turn``, and no group is
    collected. ``train`` marks the assistant turns, ``targets`` counts them in the whole conversation. Turns without
    a conversation id are one conversation; a null role is not trained on.
    """
    train = F.coalesce(F.col(role) == "assistant", F.lit(False))
    rows = turns.select(
        F.col(conversation), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"), train.alias("train")
    )
    counts = rows.filter("train").groupBy(F.col(conversation).alias("__conversation")).agg(F.count("*").alias("targets"))
    return rows.join(counts, F.col(conversation).eqNullSafe(F.col("__conversation"))).drop("__conversation")


def previous_turn(
    turns: DataFrame, group: str, order: str, columns: list[str], turns_per_block: int = TURNS_PER_BLOCK
) -> DataFrame:
    """``lag`` by one row within a group, safe for a group of any size. Adds ``prev_<column>``.

    A plain window sorts a whole group in one task, so ``lag`` runs per block of the order key, and the
    first row of a block takes the last row of the block before it from a table with one row per block.
    Rows with a null group are a group of their own.
    """
    carried = F.struct(*[F.col(c) for c in columns])
    block = F.floor(F.col(order) / F.lit(turns_per_block)).cast("bigint")
    blocked = turns.withColumn("__block", block)
    inside = Window.partitionBy(group, "__block").orderBy(order)
    across = Window.partitionBy(group).orderBy("__block")
    last = blocked.groupBy(group, "__block").agg(F.max_by(carried, F.col(order)).alias("__last"))
    before = (
        last.withColumn("__before", F.lag("__last").over(across))
        .filter(F.col("__before").isNotNull())
        .select(F.col(group).alias("__group"), F.col("__block").alias("__of"), "__before")
    )
    lagged = blocked.withColumn("__lag", F.lag(carried).over(inside))
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col("__block").eqNullSafe(F.col("__of"))
    joined = lagged.join(before, same, "left").drop("__group", "__of")
    prev = F.coalesce("__lag", "__before")
    return joined.withColumns({f"prev_{c}": prev[c] for c in columns}).drop("__block", "__lag", "__before")


def assistant_pairs(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Every assistant turn with the turn before it: (record_id, conversation, turn, input, output).

    An assistant turn that opens a conversation has a null input and is left out.
    """
    paired = previous_turn(turns, conversation, turn, [role, text])
    return paired.filter((F.col(role) == "assistant") & F.col(f"prev_{text}").isNotNull()).select(
        F.concat_ws("-", conversation, turn).alias("record_id"),
        conversation,
        turn,
        F.col(f"prev_{role}").alias("input_role"),
        F.col(f"prev_{text}").alias("input"),
        F.col(text).alias("output"),
    )
