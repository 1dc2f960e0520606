"""Registered queries: three more tasks of the same kind, run on the tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stillhouse.functions.once import with_once
from stillhouse.functions.payload import as_number, as_text, field, strict_json
from stillhouse.operators.confusion import confusion_cells, label_report
from stillhouse.operators.scoring import accuracy, score
from stillhouse.plans.derived import serving_log
from stillhouse.plans.registry import registered
from stillhouse.sources.specs import SINGLE_LABEL, TaskSpec

HANDLERS = {"purchase": "payment_received", "signup": "user_signup", "error": "incident"}
EVENT_ROUTING = TaskSpec(
    name="event_routing", display_name="Event Routing", labels=[*HANDLERS.values(), "activity"],
    teacher_prompt="Name the handler of this event: payment_received, user_signup, incident or activity.\n\n{input}",
    output_format=SINGLE_LABEL,
)
ESCALATION = TaskSpec(
    name="chat_escalation", display_name="Chat Escalation", labels=["escalate", "continue"],
    teacher_prompt="Does this chat need a person? Answer escalate or continue.\n\n{input}", output_format=SINGLE_LABEL,
)


def _handler(event: Column) -> Column:
    return F.coalesce(*[F.when(event == kind, F.lit(name)) for kind, name in HANDLERS.items()], F.lit("activity"))


@registered("event_routing", """
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'payment_received' WHEN 'signup' THEN 'user_signup' WHEN 'error' THEN 'incident'
  ELSE 'activity' END AS handler, CAST(props ->> '$.k' AS DOUBLE) AS k FROM events""")
def event_routing(t):
    """Event payloads in JSON to the handler each goes to."""
    text = F.concat(F.lit('{"event": "'), "event_type", F.lit('", "payload": '), "props", F.lit("}"))
    docs = with_once(t.events.select("event_id", text.alias("input")), "doc", strict_json(F.col("input")))
    kind = as_text(field(F.col("doc"), "event"))
    return docs.select("event_id", _handler(kind).alias("handler"), as_number(field(field(F.col("doc"), "payload"), "k")).alias("k"))


@registered("escalated_chats", """
SELECT conv_id, CASE WHEN arg_max(role, turn) = 'user' OR count(*) FILTER (WHERE role = 'user') >= 4 THEN 'escalate' ELSE 'continue' END AS response
FROM conversations GROUP BY conv_id""")
def escalated_chats(t):
    """Chats that end unanswered, or in which the user came back three times. Summed map-side, so a
    chat of any length costs one small row per task."""
    chats = t.conversations.groupBy("conv_id").agg(
        F.max_by("role", "turn").alias("last_role"), F.count_if(F.col("role") == "user").alias("asked")
    )
    needs = (F.col("last_role") == "user") | (F.col("asked") >= 4)
    return chats.select("conv_id", F.when(needs, "escalate").otherwise("continue").alias("response"))


@registered("escalation_accuracy", """
WITH c AS (SELECT conv_id, arg_max(role, turn) = 'user' AS open, count(*) FILTER (WHERE role = 'user') AS asked FROM conversations GROUP BY conv_id)
SELECT 'chat_escalation' AS task, avg((open = (asked - open::INT >= 3))::INT::DOUBLE) AS accuracy, count(*) AS n_examples FROM c""")
def escalation_accuracy(t):
    """Chats that were really left open, guessed from the turns before the last: a user who has asked three times before."""
    left_open = F.col("last_role") == "user"
    chats = t.conversations.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"), F.count_if(F.col("role") == "user").alias("asked"))
    guess = F.col("asked") - F.coalesce(left_open, F.lit(False)).cast("int") >= 3
    pairs = chats.select(
        F.lit("chat_escalation").alias("task"), F.when(guess, "escalate").otherwise("continue").alias("response"),
        F.when(left_open, "escalate").otherwise("continue").alias("gold"),
    )
    return accuracy(score(pairs, [ESCALATION]), ["task"])


@registered("event_routing_accuracy", """
SELECT 'event_routing' AS task, avg((event_id % 11 <> 0 OR event_type NOT IN ('purchase', 'signup', 'error'))::INT::DOUBLE) AS accuracy, count(*) AS n_examples FROM events""")
def event_routing_accuracy(t):
    """Handlers read from the payloads against those of the labels that the serving log expected."""
    expected = serving_log(t).select(F.col("request_id").alias("event_id"), _handler(F.col("expected")).alias("gold"))
    routed = event_routing(t).select("event_id", F.lit("event_routing").alias("task"), F.concat(F.lit("Handler: "), "handler").alias("response"))
    return accuracy(score(routed.join(expected, "event_id"), [EVENT_ROUTING]), ["task"])


# --- moderation ---------------------------------------------------------------------------------

# Words that insult a person.
INSULTS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless"
MODERATION = TaskSpec(
    name="moderation", display_name="Moderation", labels=["toxic", "safe"],
    teacher_prompt="Does this text insult somebody? Answer toxic or safe.\n\n{input}", output_format=SINGLE_LABEL,
)
MODERATED = """moderated AS (
  SELECT d.doc_id, CASE WHEN len(list_intersect(regexp_split_to_array(lower(text), '[^a-z]+'), {words})) > 0 THEN 'toxic' ELSE 'safe' END AS response,
    CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'safe' END AS gold
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)""".format(words=INSULTS.split())


def _moderated(t):
    insulting = F.lower("text").rlike(rf"(?<![a-z])(?:{'|'.join(INSULTS.split())})(?![a-z])")
    rows = t.spread("documents").select("doc_id", F.when(insulting, "toxic").otherwise("safe").alias("response"))
    gold = t.labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("safe").alias("gold"))
    return rows.join(gold, "doc_id").withColumns({"task": F.lit("moderation"), "model": F.lit("words")})


@registered("moderated_documents", f"WITH {MODERATED} SELECT doc_id, response, gold FROM moderated")
def moderated_documents(t):
    """Every labelled document, toxic if it has an insulting word, and what its label says."""
    return _moderated(t).select("doc_id", "response", "gold")


@registered("moderation_report", f"""
WITH {MODERATED}, labels2 AS (SELECT unnest(['toxic', 'safe']) AS label)
SELECT label, count(*) FILTER (WHERE gold = label) AS support, count(*) FILTER (WHERE response = label) AS predicted, count(*) FILTER (WHERE gold = label AND response = label) AS correct
FROM moderated, labels2 GROUP BY label""")
def moderation_report(t):
    cells = confusion_cells(_moderated(t), [MODERATION])
    return label_report(cells, [MODERATION]).select("label", "support", "predicted", "correct")
