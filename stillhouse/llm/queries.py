"""The registered queries of the corpus operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stillhouse.llm import fingerprints, languages, licenses, linededup, mixing, negatives, packing, periods, quality, sanitise, simhash, toolcalls, vectors
from stillhouse.llm.common import documents, stored

Query = Callable[[SparkSession, str], DataFrame]
NOT_LEARNED = 2


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.planned(documents(spark, folder).select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_sanitised_terms(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    spans = sanitise.found(docs, [F.col("doc_id")])

    def listed(column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    # Base spans come by kind as listed; the kinds of terms follow.
    return spans.select(
        "doc_id", *[number(k) for k in sanitise.KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "terms")).alias("spans"), F.size("terms").cast("bigint").alias("n_terms"),
    )


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder).select("doc_id", "text"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"), keep_removed=True)
    return left.select(
        "doc_id", F.size("removed_lines").cast("bigint").alias("n_removed"), F.array_join("removed_lines", ",").alias("removed_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op5_language_backoff(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == NOT_LEARNED, F.lit(False))
    model = languages.train(docs.filter(~held_out))
    return languages.predicted(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


CHAT_TOOLS = {
    "answer": {
        "properties": {"query": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "string"}}, "required": ["query", "turn"],
    },
}


TURNS_PER_BLOCK = 1000


def chat_messages(conversations: DataFrame) -> DataFrame:
    """The turns as tool traffic: an assistant's turn calls a tool with its text, referring to the assistant's
    call before it; a user's turn after it is the result; other turns are plain messages. Turns are ordered in blocks, so a
    conversation of any length is no single task's work."""
    asked = F.col("role") == "assistant"
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    marked = conversations.withColumns({"__block": block, "__asked": F.when(asked, F.col("turn"))})
    # What a block's turns see of the turns before it: the last call, and the last turn's role, from a table of blocks.
    blocks = Window.partitionBy("conv_id").orderBy("__block")
    before = marked.groupBy("conv_id", "__block").agg(F.max("__asked").alias("call"), F.max_by("role", "turn").alias("role")).select(
        F.col("conv_id").alias("__conv"), F.col("__block").alias("__of"), F.lag("role").over(blocks).alias("__role_before"),
        F.max("call").over(blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("__call_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & F.col("__block").eqNullSafe(F.col("__of"))
    turns = Window.partitionBy("conv_id", "__block").orderBy("turn")
    inside = marked.withColumns({"__call": F.max("__asked").over(turns.rowsBetween(Window.unboundedPreceding, -1)), "__role": F.lag("role").over(turns), "__at": F.row_number().over(turns)})
    rows = inside.join(before, same, "left").withColumns({
        "__earlier": F.coalesce("__call", "__call_before"),
        "__answers": (F.col("role") == "user") & (F.when(F.col("__at") == 1, F.col("__role_before")).otherwise(F.col("__role")) == "assistant"),
    })

    def name(turn: Column) -> Column:
        return F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn)

    after = F.when(F.col("__earlier").isNotNull(), F.struct(name(F.col("__earlier")).alias("$ref")))
    arguments = F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("turn"), after.alias("after")))
    answers = F.coalesce("__answers", F.lit(False))
    return rows.select(
        F.col("conv_id").alias("conv"), "turn", F.when(answers, "tool").otherwise(F.col("role")).alias("role"), F.when(~asked, F.col("text")).alias("content"),
        F.when(asked, name(F.col("turn"))).when(answers, name(F.col("__earlier"))).alias("call_id"), F.when(asked, "answer").alias("name"),
        F.when(asked, arguments).alias("arguments"),
    )


def op6_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    conversations = spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet")
    found = toolcalls.linked(chat_messages(conversations), CHAT_TOOLS)
    return found.withColumnRenamed("conv", "conv_id")


def op7_one_permutation_minhash(spark: SparkSession, folder: str) -> DataFrame:
    made = fingerprints.edited(documents(spark, folder).select("doc_id", "text"))
    printed = fingerprints.with_fingerprint(made, F.col("edited_text"), "edited_fingerprint").select(
        "at", F.col("record").alias("doc_id"), F.col("n").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        F.col("own").alias("fingerprint"), "edited_fingerprint", "times",
    )
    rows = stored(printed, "fingerprints")
    total = F.lit(max(1, rows.count()))
    following = rows.select(F.pmod(F.col("at") - 1, total).alias("at"), F.col("fingerprint").alias("__next"))
    both = rows.join(following, "at").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "times",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )
    return both.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")


def op8_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.verdicts(documents(spark, folder).select("doc_id", "text", "source"))
    return judged.select(F.col("record").alias("doc_id"), *quality.BASE, "base_failed", "kept", "words_removed")


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(documents(spark, folder).select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", periods.made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    best = periods.steepest(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = periods.with_runs(docs).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.concat(listed, F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return stored(found, "runs").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(embeddings(spark, folder).withColumn("label", label))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(embeddings(spark, folder))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_source_mix, op2_sanitised_terms, op3_license_scan, op4_line_dedup, op5_language_backoff, op6_tool_calls,
        op7_one_permutation_minhash, op8_simhash_groups, op9_quality_rules, op10_best_fit_packing, op11_hard_negatives, op12_periodic_runs, op13_near_vectors,
    )
}

SIZED = r"""sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
)"""
# The level at which targets are weight * level unless capped: the first prefix, by cap over weight, that it does not pass.
MIX_SQL = rf"""WITH {SIZED}, sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM sized GROUP BY source
), steps AS (
  SELECT *, 3.0 * source_size / weight AS full_at,
         sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, encode(source) NULLS LAST) AS capped,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY 3.0 * source_size / weight, encode(source) NULLS LAST) AS rest,
         sum(source_size) OVER () AS total
  FROM sources
), levels AS (
  SELECT CAST(total AS DOUBLE) / sum(weight) OVER () AS level, -1.0 AS from_level FROM steps
  UNION ALL
  SELECT CAST(total - capped AS DOUBLE) / rest, full_at FROM steps WHERE rest > 0
), level AS (SELECT max(level) AS level FROM levels WHERE from_level <= level), targets AS (
  SELECT source, source_size, least(3.0 * source_size, weight * level) AS target FROM sources, level
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('17|' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated"""

LICENSE_SQL = r"""WITH templates(license, text) AS (VALUES {values}),
cut AS (
  SELECT license, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM templates
), known AS (
  SELECT DISTINCT license, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                       ELSE [array_to_string(w, ' ')] END) AS shingle FROM cut WHERE len(w) > 0
), sizes AS (SELECT license, count(*) AS n FROM known GROUP BY license), texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents
), own AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: {{'s': array_to_string(w[i:i + 4], ' '), 'i': i - 1}})
                             ELSE [{{'s': array_to_string(w, ' '), 'i': 0}}] END) AS x FROM texts WHERE len(w) > 0
)
SELECT o.doc_id, k.license, CAST(count(DISTINCT k.shingle) AS DOUBLE) / n AS containment,
       CAST(min(o.x.i) AS BIGINT) AS first_word, CAST(max(o.x.i) + 4 AS BIGINT) AS last_word
FROM own o JOIN known k ON o.x.s = k.shingle JOIN sizes s ON s.license = k.license
GROUP BY o.doc_id, k.license, n HAVING count(DISTINCT k.shingle) >= 0.8 * n""".format(
    values=", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items())
)

# Keys of the JSON objects are in order already; an assistant's call has its depth among the conversation's calls as level.
CHAT_SQL = r"""WITH turns AS (
  SELECT *, last_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (
           PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
         coalesce(role = 'user' AND lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'assistant', false) AS answers,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS following,
         count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS calls
  FROM conversations
), named AS (
  SELECT *, CASE WHEN role = 'assistant' THEN turn WHEN answers THEN earlier END AS call_turn FROM turns
), ided AS (SELECT *, 'call-' || conv_id || '-' || call_turn AS call_id, 'call-' || conv_id || '-' || earlier AS earlier_id FROM named)
SELECT conv_id, CASE WHEN answers THEN earlier ELSE turn END AS at, CAST(CASE WHEN call_turn IS NULL THEN 0 ELSE calls END AS INTEGER) AS level,
       CASE WHEN answers THEN earlier ELSE turn END AS turn, call_id, CAST(answers AS INTEGER) AS part,
       CASE WHEN role = 'assistant' AND following IS DISTINCT FROM 'user' THEN 'no_result' ELSE 'ok' END AS status, CAST(NULL AS VARCHAR) AS problem,
       CASE WHEN role = 'assistant' THEN
         '{"content":null,"role":"assistant","tool_calls":[{"arguments":{' ||
         CASE WHEN earlier IS NULL THEN '' ELSE '"after":{"$ref":' || to_json(earlier_id) || '},' END ||
         '"query":' || to_json(text) || ',"turn":' || turn || '},"id":' || to_json(call_id) || ',"name":"answer"}]}'
       WHEN answers THEN '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":' || to_json(call_id) || '}'
       ELSE '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' END AS json
FROM ided"""

NEGATIVES_SQL = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.e) = len(r.e)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""

NEAR_VECTORS_SQL = """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98::DOUBLE
), reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN lowest l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""

ORACLES: dict[str, str] = {
    "op1_source_mix": MIX_SQL, "op3_license_scan": LICENSE_SQL, "op6_tool_calls": CHAT_SQL,
    "op11_hard_negatives": NEGATIVES_SQL, "op13_near_vectors": NEAR_VECTORS_SQL,
}
