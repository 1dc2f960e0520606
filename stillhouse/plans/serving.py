"""Registered queries: latency and monitoring over the serving log."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from stillhouse.operators.cost import PRICES, TUNED, FRONTIER, request_cost
from stillhouse.operators.latency import BENCHMARK_REQUESTS, latency_summary, latency_table
from stillhouse.operators.monitor import (
    agreement, failure_cases, label_drift, label_windows, retrain_windows, shadow_sample, usage,
)
from stillhouse.operators.sessions import user_sessions
from stillhouse.operators.splitting import head
from stillhouse.plans.derived import SERVING_LOG, serving_log
from stillhouse.plans.registry import SCHEMAS, registered
from stillhouse.sources.workspace import new_folder
from stillhouse.streaming.drift import append_to, distinct_requests, latest, read_log, session_counts, shadow_pairs, upsert_to, windowed_labels

STAMP = "yyyy-MM-dd HH:mm:ss"
SQL_STAMP = "%Y-%m-%d %H:%M:%S"
LOG_SCHEMA = SCHEMAS["events"]


def _stamp(c):
    return F.date_format(c, STAMP)


def _latency_sql(keys: str, source: str = "serving_log") -> str:
    return f"""
SELECT {keys}, count(*) AS n, round(avg(latency_ms), 6) AS mean, round(median(latency_ms), 6) AS p50,
  round(list_sort(list(latency_ms))[1 + least(CAST(trunc(count(*) * 0.95::DOUBLE) AS BIGINT), count(*) - 1)], 6) AS p95
FROM {source} GROUP BY {keys}"""


def _rounded_latency(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "p50", "p95")})


@registered("latency_summary", f"WITH {SERVING_LOG} {_latency_sql('label, model')}")
def latency_by_label_and_model(t):
    return _rounded_latency(latency_summary(serving_log(t), ["label", "model"]))


@registered("latency_by_model", f"WITH {SERVING_LOG} {_latency_sql('model')}")
def latency_by_model(t):
    return _rounded_latency(latency_summary(serving_log(t), ["model"]))


@registered("latency_by_user", f"""
WITH {SERVING_LOG}, log AS (SELECT s.*, e.user_id FROM serving_log s JOIN events e ON e.event_id = s.request_id) {_latency_sql('user_id', 'log')}""")
def latency_by_user(t):
    return _rounded_latency(latency_summary(t.events.select("user_id", F.col("value").alias("latency_ms")), ["user_id"]))


@registered("latency_speedup", f"""
WITH {SERVING_LOG}, p AS (SELECT label, median(latency_ms) FILTER (WHERE model = 'teacher') AS a, median(latency_ms) FILTER (WHERE model = 'student') AS b
  FROM serving_log GROUP BY label)
SELECT label, round(a, 6) AS teacher_p50, round(b, 6) AS student_p50, round(a / b, 6) AS speedup FROM p""")
def latency_speedup(t):
    table = latency_table(latency_summary(serving_log(t), ["label", "model"]), "label")
    return table.withColumns({c: F.round(c, 6) for c in ("teacher_p50", "student_p50", "speedup")})


@registered("latency_of_first_requests", f"""
WITH {SERVING_LOG}, log AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY md5('42|' || request_id), request_id) AS rn FROM serving_log)
  WHERE rn <= 20) {_latency_sql('model', 'log')}""")
def latency_of_first_requests(t):
    return _rounded_latency(latency_summary(head(serving_log(t), "request_id", BENCHMARK_REQUESTS, ["model"]), ["model"]))


def _drift_sql(unit: str) -> str:
    return f"""
WITH {SERVING_LOG}, c AS (SELECT date_trunc('{unit}', ts) AS d, label, count(*) AS n FROM serving_log GROUP BY ALL),
grid AS (SELECT d, label FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 {unit})) AS d FROM c), (SELECT DISTINCT label FROM c)),
w AS (SELECT g.d, g.label, coalesce(n, 0) AS n FROM grid g LEFT JOIN c ON c.d = g.d AND c.label = g.label),
s AS (SELECT *, coalesce(n / nullif(sum(n) OVER (PARTITION BY d), 0), 0) AS share FROM w)
SELECT strftime(d, '{SQL_STAMP}') AS window_start, strftime(d + INTERVAL 1 {unit}, '{SQL_STAMP}') AS window_end, label, n,
  round(share, 9) AS share, round(share - lag(share) OVER (PARTITION BY label ORDER BY d), 9) AS change FROM s"""


def _drift(t, width: str):
    drift = label_drift(label_windows(serving_log(t), width), width)
    return drift.select(
        _stamp("window_start").alias("window_start"), _stamp("window_end").alias("window_end"), "label", "n",
        F.round("share", 9).alias("share"), F.round("change", 9).alias("change"),
    )


@registered("label_drift", _drift_sql("day"))
def label_drift_by_day(t):
    return _drift(t, "1 day")


@registered("label_drift_by_hour", _drift_sql("hour"))
def label_drift_by_hour(t):
    """Hours in which a label, or any request, is missing have rows too."""
    return _drift(t, "1 hour")


# --- sessions and repeats -----------------------------------------------------------------------

FINE_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_FINE_STAMP = "%Y-%m-%d %H:%M:%S.%f"
SESSIONS = f"""marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked),
sessions AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS b, count(*) AS n FROM numbered GROUP BY user_id, session)
SELECT user_id, strftime(a, '{SQL_FINE_STAMP}') AS session_start, strftime(b, '{SQL_FINE_STAMP}') AS session_end, n FROM sessions"""


def _stamped_sessions(sessions):
    return sessions.withColumns({c: F.date_format(c, FINE_STAMP) for c in ("session_start", "session_end")})


@registered("user_sessions", f"WITH {SESSIONS}")
def sessions_of_users(t):
    return _stamped_sessions(user_sessions(t.events.select("user_id", "ts"), timedelta(hours=6), ["user_id"]))


@registered("user_sessions_streamed", f"WITH {SESSIONS} WHERE b <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)")
def sessions_of_users_streamed(t):
    """Sessions of a stream that are closed when its data end: a watermark of two days has passed them."""
    spark = t.spark
    log = read_log(spark, f"{t.folder}/events.parquet*", LOG_SCHEMA).select("user_id", "ts")
    out, state = new_folder(spark, "sessions"), new_folder(spark, "state")
    append_to(session_counts(log, "2 days", "6 hours", ["user_id"]), out, state).awaitTermination()
    schema = "user_id bigint, session_start timestamp, session_end timestamp, n bigint"
    return _stamped_sessions(spark.read.schema(schema).parquet(out))


@registered("distinct_requests_streamed", "SELECT event_id, event_type AS label FROM events")
def distinct_requests_streamed(t):
    """A log in which every request was sent twice, as a stream without the repeats."""
    spark = t.spark
    sent, again = (read_log(spark, f"{t.folder}/events.parquet*", LOG_SCHEMA).select("event_id", "ts", "event_type") for _ in range(2))
    out, state = new_folder(spark, "requests"), new_folder(spark, "state")
    append_to(distinct_requests(sent.unionByName(again), "40 days", "event_id"), out, state).awaitTermination()
    rows = spark.read.schema("event_id bigint, ts timestamp, event_type string").parquet(out)
    return rows.select("event_id", F.col("event_type").alias("label"))


@registered("label_windows_sliding", f"""
WITH {SERVING_LOG}, w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - unnest([0, 1, 2, 3]) * INTERVAL 6 HOUR AS s, label FROM serving_log)
SELECT strftime(s, '{SQL_STAMP}') AS window_start, strftime(s + INTERVAL 1 DAY, '{SQL_STAMP}') AS window_end, label, count(*) AS n FROM w GROUP BY s, label""")
def label_windows_sliding(t):
    windows = label_windows(serving_log(t), "1 day", "6 hours")
    return windows.select(_stamp("window_start").alias("window_start"), _stamp("window_end").alias("window_end"), "label", "n")


@registered("label_windows_streamed", f"""
WITH {SERVING_LOG} SELECT strftime(date_trunc('day', ts), '{SQL_STAMP}') AS window_start, label, count(*) AS n FROM serving_log GROUP BY ALL""")
def label_windows_streamed(t):
    """The same counts from a stream over the events file, kept up to date per batch."""
    spark = t.spark
    log = read_log(spark, f"{t.folder}/events.parquet*", LOG_SCHEMA)
    counts = windowed_labels(log.withColumnRenamed("event_type", "label"), "40 days", "1 day")
    out, state = new_folder(spark, "windows"), new_folder(spark, "state")
    upsert_to(counts, out, state).awaitTermination()
    return latest(spark, out).select(_stamp("window_start").alias("window_start"), "label", "n")


@registered("shadow_pairs_streamed", """
SELECT event_id AS request_id, event_type AS label, CASE WHEN event_id % 13 = 0 THEN 'other' ELSE event_type END AS teacher_label
FROM events WHERE ('0x' || substr(md5('42|' || event_id), 1, 8))::BIGINT < 429496729""")
def shadow_pairs_streamed(t):
    """Student and teacher answers joined as two streams with bounded state."""
    spark = t.spark
    log = read_log(spark, f"{t.folder}/events.parquet*", LOG_SCHEMA).select(F.col("event_id").alias("request_id"), "ts", F.col("event_type").alias("label"))
    taught = shadow_sample(read_log(spark, f"{t.folder}/events.parquet*", LOG_SCHEMA).withColumnRenamed("event_id", "request_id"), 0.1).select(
        "request_id", (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("ts"),
        F.when(F.col("request_id") % 13 == 0, "other").otherwise(F.col("event_type")).alias("label"),
    )
    out, state = new_folder(spark, "pairs"), new_folder(spark, "state")
    append_to(shadow_pairs(log, taught, "40 days", "1 minute"), out, state).awaitTermination()
    schema = "request_id bigint, ts timestamp, label string, teacher_label string, agree boolean"
    return spark.read.schema(schema).parquet(out).select("request_id", "label", "teacher_label")


@registered("shadow_agreement", f"""
WITH {SERVING_LOG}, sampled AS (SELECT *, CASE WHEN request_id % 13 = 0 THEN 'other' ELSE label END AS teacher_label FROM serving_log
  WHERE ('0x' || substr(md5('42|' || request_id), 1, 8))::BIGINT < 429496729)
SELECT label, count(*) AS compared, count(*) FILTER (WHERE label = teacher_label) AS agreed, avg((label = teacher_label)::INT::DOUBLE) AS agreement
FROM sampled GROUP BY label""")
def shadow_agreement(t):
    log = serving_log(t)
    teacher = shadow_sample(log, 0.1).select(
        "request_id", F.when(F.col("request_id") % 13 == 0, "other").otherwise(F.col("label")).alias("label")
    )
    return agreement(log, teacher, ["label"])


@registered("retrain_windows", f"""
WITH {SERVING_LOG}
SELECT strftime(date_trunc('day', ts), '{SQL_STAMP}') AS window_start, model, count(*) AS n, avg((label = expected)::INT::DOUBLE) AS accuracy
FROM serving_log GROUP BY ALL HAVING avg((label = expected)::INT::DOUBLE) < 0.908::DOUBLE""")
def retrain_windows_by_day(t):
    return retrain_windows(serving_log(t), "1 day", 0.908).withColumn("window_start", _stamp("window_start"))


@registered("retrain_failures", f"""
WITH {SERVING_LOG}, low AS (SELECT date_trunc('day', ts) AS d, model FROM serving_log GROUP BY ALL HAVING avg((label = expected)::INT::DOUBLE) < 0.908::DOUBLE)
SELECT request_id, s.model, label, expected FROM serving_log s JOIN low ON date_trunc('day', s.ts) = low.d AND s.model = low.model WHERE label <> expected""")
def retrain_failures(t):
    log = serving_log(t)
    return failure_cases(log, retrain_windows(log, "1 day", 0.908), "1 day").select("request_id", "model", "label", "expected")


@registered("usage_by_day", f"""
WITH {SERVING_LOG}, d AS (SELECT CAST(ts AS DATE) AS day, model, count(*) AS requests, sum(in_tokens) AS i, sum(out_tokens) AS o FROM serving_log GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, model, requests, i::BIGINT AS tokens_in, o::BIGINT AS tokens_out,
  round(i / requests, 6) AS in_per_request, round(o / requests, 6) AS out_per_request,
  round(CASE WHEN model = 'student' THEN i * 0.1::DOUBLE + o * 0.1::DOUBLE ELSE i * 1.75::DOUBLE + o * 14::DOUBLE END / 1000000, 9) AS cost,
  round(requests * CASE WHEN model = 'student' THEN 24 * 0.1::DOUBLE + 0.1::DOUBLE ELSE 641 * 1.75::DOUBLE + 4 * 14::DOUBLE END / 1000000, 9) AS projected_cost
FROM d""")
def usage_by_day(t):
    student, teacher = PRICES[-1], PRICES[0]
    planned = F.when(
        F.col("model") == "student", request_cost(F.lit(24), F.lit(1), F.lit(student.in_per_1m), F.lit(student.out_per_1m))
    ).otherwise(request_cost(F.lit(641), F.lit(4), F.lit(teacher.in_per_1m), F.lit(teacher.out_per_1m)))
    rows = usage(serving_log(t), PRICES, planned, price_of={"student": TUNED, "teacher": FRONTIER})
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd")).withColumns(
        {**{c: F.round(c, 6) for c in ("in_per_request", "out_per_request")}, **{c: F.round(c, 9) for c in ("cost", "projected_cost")}}
    )
