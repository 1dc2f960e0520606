"""Streams must equal their batch form, and drop what is too late."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from stillhouse.operators.monitor import label_drift, label_windows
from stillhouse.operators.sessions import user_sessions
from stillhouse.plans import QUERIES
from stillhouse.streaming.drift import (
    COUNTS, append_to, distinct_requests, latest, read_log, retrain_alerts, session_counts, upsert_to, windowed_labels,
)

SCHEMA = "request_id bigint, ts timestamp, label string, expected string, model string"
START = datetime.datetime(2024, 1, 1)


def replay(spark, folder, periods):
    """One file per period, with rising modification times."""
    for i, rows in enumerate(periods):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/raw{i}")
        part = next(p for p in sorted(os.listdir(f"{folder}/raw{i}")) if p.endswith(".parquet"))
        target = f"{folder}/in/{i:03d}.parquet"
        os.makedirs(f"{folder}/in", exist_ok=True)
        os.link(f"{folder}/raw{i}/{part}", target)
        os.utime(target, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return f"{folder}/in"


def request(i, hours, label=None):
    label = label or ("a" if i % 3 else "b")
    return (i, START + datetime.timedelta(hours=hours), label, "a", "student")


FLUSH = request(9999, 24 * 365, "flush")


def as_set(df):
    return {(r.window_start, r.label, r.n) for r in df.filter("label <> 'flush'").collect()}


def test_ordered_replay_equals_batch(spark, tmp_path):
    periods = [[request(d * 24 + h, d * 24 + h) for h in range(24)] for d in range(5)]
    folder = replay(spark, str(tmp_path), [*periods, [FLUSH]])
    log = read_log(spark, folder, SCHEMA, files_per_batch=1)
    append_to(windowed_labels(log, "1 hour", "1 day"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    batch = label_windows(spark.read.schema(SCHEMA).parquet(folder), "1 day")
    assert as_set(spark.read.schema(COUNTS).parquet(f"{tmp_path}/out")) == as_set(batch)


def test_late_rows_are_dropped(spark, tmp_path):
    # Spark judges lateness by the watermark of the batch before the last.
    periods = [[request(1, 1, "a")], [request(2, 50, "a")], [request(3, 51, "a")], [request(4, 2, "a"), request(5, 52, "a")], [FLUSH]]
    folder = replay(spark, str(tmp_path), periods)
    log = read_log(spark, folder, SCHEMA, files_per_batch=1)
    append_to(windowed_labels(log, "1 hour", "1 day"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    counts = {(r.window_start.day, r.n) for r in spark.read.schema(COUNTS).parquet(f"{tmp_path}/out").filter("label = 'a'").collect()}
    assert counts == {(1, 1), (3, 3)}


def test_upserts_survive_a_restart(spark, tmp_path):
    folder = replay(spark, str(tmp_path), [[request(i, i) for i in range(30)], [request(i, i) for i in range(30, 60)]])
    for _ in range(2):
        log = read_log(spark, folder, SCHEMA, files_per_batch=1)
        upsert_to(windowed_labels(log, "30 days", "1 day"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert as_set(latest(spark, f"{tmp_path}/out")) == as_set(label_windows(spark.read.schema(SCHEMA).parquet(folder), "1 day"))


def test_retrain_alerts(spark, tmp_path):
    good = [request(i, i % 24, "a") for i in range(10)]
    bad = [request(i, 24 + i % 24, "b") for i in range(10)]
    folder = replay(spark, str(tmp_path), [good, bad, [FLUSH]])
    alerts = retrain_alerts(read_log(spark, folder, SCHEMA, files_per_batch=1), "1 hour", "1 day", 0.9)
    append_to(alerts, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    rows = spark.read.schema("window_start timestamp, model string, n bigint, accuracy double").parquet(f"{tmp_path}/out").collect()
    assert [(r.window_start.day, r.n, r.accuracy) for r in rows] == [(2, 10, 0.0)]


@pytest.mark.parametrize("name", ["label_windows_streamed", "shadow_pairs_streamed", "user_sessions_streamed", "distinct_requests_streamed"])
def test_streamed_queries_read_a_folder_of_parts_like_one_file(spark, tmp_path, name):
    one = "/root/testdata/sf0.001"
    spark.read.parquet(f"{one}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    rows = [sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in (one, str(tmp_path))]
    assert rows[0] == rows[1] and rows[0]


# --- the upserted table -------------------------------------------------------------------------


def upserted(spark, tmp_path, folder, late="2 hours", fold_every=3):
    log = read_log(spark, folder, SCHEMA, files_per_batch=1)
    upsert_to(windowed_labels(log, late, "6 hours"), f"{tmp_path}/out", f"{tmp_path}/state", late, fold_every).awaitTermination()
    return latest(spark, f"{tmp_path}/out")


def hours(first, last):
    return [[request(h, h), request(1000 + h, h, "c")] for h in range(first, last)]


def batch_counts(spark, folder):
    return as_set(label_windows(spark.read.schema(SCHEMA).parquet(folder), "6 hours"))


def folders(tmp_path, name):
    return sorted(os.listdir(f"{tmp_path}/out/{name}"))


def test_folded_upserts_equal_batch_and_read_few_files(spark, tmp_path):
    folder = replay(spark, str(tmp_path), hours(0, 40))
    got = upserted(spark, tmp_path, folder)
    assert as_set(got) == batch_counts(spark, folder)
    base = f"{tmp_path}/out/base"
    assert len(folders(tmp_path, "base")) >= 10
    # Finished windows are in one base each, and only the newest base's open windows and the deltas after it are read.
    finished = spark.read.schema(COUNTS + ", upto bigint, done boolean").parquet(base).filter("done")
    assert finished.count() == finished.select("window_start", "label").distinct().count() > 0
    newest = max(int(f.split("=")[1]) for f in folders(tmp_path, "base"))
    for file in got.inputFiles():
        assert "done=true" in file or f"upto={newest}/done=false" in file or int(file.split("batch=")[1].split("/")[0]) > newest
    assert len(folders(tmp_path, "delta")) <= 2 * 3 + 1


def test_replayed_batches_and_a_fold_that_did_not_end(spark, tmp_path):
    folder = replay(spark, str(tmp_path), hours(0, 8))
    before = as_set(upserted(spark, tmp_path, folder))
    base = f"{tmp_path}/out/base"
    newest = max(folders(tmp_path, "base"), key=lambda f: int(f.split("=")[1]))
    # The next fold was written but not completed: it counts for nothing, whatever is in it.
    spark.createDataFrame([(START, START, "wrong", 99, False)], COUNTS + ", done boolean").write.partitionBy("done").parquet(f"{base}/upto=99")
    os.remove(f"{base}/upto=99/_SUCCESS")
    assert as_set(latest(spark, f"{tmp_path}/out")) == before
    # The newest fold is lost between its rows and its mark: its deltas are still there.
    os.remove(f"{base}/{newest}/_SUCCESS")
    assert as_set(latest(spark, f"{tmp_path}/out")) == before
    open(f"{base}/{newest}/_SUCCESS", "w").close()
    # The stream forgets that its last batch was committed, and runs it again with more data behind it.
    commits = f"{tmp_path}/state/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(f"{commits}/{last}")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.remove(f"{commits}/.{last}.crc")
    assert as_set(upserted(spark, tmp_path, folder)) == before == batch_counts(spark, folder)


def test_nothing_upserted_yet(spark, tmp_path):
    assert latest(spark, f"{tmp_path}/out").collect() == []


# --- sessions and repeated requests -------------------------------------------------------------

GAP = datetime.timedelta(hours=1)


def minutes(*points, user=1):
    return [(user, START + datetime.timedelta(minutes=m)) for m in points]


def plain_sessions(rows):
    out = []
    for user, at in sorted((r for r in rows if r[1]), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        if out and out[-1][0] == user and at <= out[-1][2]:
            out[-1][2], out[-1][3] = at + GAP, out[-1][3] + 1
        else:
            out.append([user, at, at + GAP, 1])
    return {tuple(s) for s in out}


def test_sessions_equal_a_plain_walk(spark):
    import random

    random.seed(2)
    rows = minutes(0, 60, 120, 181, 181, 500) + minutes(*[random.randrange(4000) for _ in range(300)], user=2) + [(None, START), (None, None)]
    rows += minutes(*range(0, 30_000, 7), user=3)
    frame = spark.createDataFrame(rows, "user_id bigint, ts timestamp").repartition(4)
    assert {tuple(r) for r in user_sessions(frame, GAP, ["user_id"]).collect()} == plain_sessions(rows)
    window = frame.filter("ts IS NOT NULL").groupBy(F.session_window("ts", "1 hour").alias("s"), "user_id").agg(F.count("*").alias("n"))
    assert {(r.user_id, r.s.start, r.s.end, r.n) for r in window.collect()} == plain_sessions(rows)
    assert user_sessions(frame.filter("false"), GAP, ["user_id"]).collect() == []


def test_streamed_sessions_merge_late_rows(spark, tmp_path):
    periods = [minutes(0, 100, user=1) + minutes(10, user=2), minutes(50, 180, user=1), minutes(300, 301, user=2), minutes(60 * 24 * 30, user=9)]
    for i, rows in enumerate(periods):
        spark.createDataFrame(rows, "user_id bigint, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
        for root, _, files in os.walk(f"{tmp_path}/in/part={i}"):
            for f in files:
                os.utime(f"{root}/{f}", (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    log = read_log(spark, f"{tmp_path}/in/part=*", "user_id bigint, ts timestamp", files_per_batch=1)
    append_to(session_counts(log, "5 hours", "1 hour", ["user_id"]), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = spark.read.schema("user_id bigint, session_start timestamp, session_end timestamp, n bigint").parquet(f"{tmp_path}/out").collect()
    want = {s for s in plain_sessions([r for p in periods for r in p]) if s[0] != 9}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_repeats_are_dropped_within_the_watermark_and_after_a_restart(spark, tmp_path):
    first = [[request(1, 0), request(2, 0), request(1, 1)], [request(1, 2), request(3, 3)]]
    later = [[request(3, 4), request(4, 30)], [request(5, 31)], [request(6, 50)], [request(7, 51)], [request(1, 60), request(4, 61), request(6, 55)]]

    def run(periods):
        folder = replay(spark, str(tmp_path / str(len(periods))), periods)
        os.makedirs(f"{tmp_path}/all", exist_ok=True)
        start = len(os.listdir(f"{tmp_path}/all"))
        for i, name in enumerate(sorted(os.listdir(folder))):
            target = f"{tmp_path}/all/{start + i:03d}.parquet"
            os.link(f"{folder}/{name}", target)
            os.utime(target, (1_700_000_000 + (start + i) * 10,) * 2)
        log = read_log(spark, f"{tmp_path}/all", SCHEMA, files_per_batch=1)
        append_to(distinct_requests(log, "6 hours"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        return sorted(r.request_id for r in spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").collect())

    assert run(first) == [1, 2, 3]
    # 3 (after a restart) and 6 come again within the delay, 1 and 4 long after theirs have been forgotten.
    assert run(later) == [1, 1, 2, 3, 4, 4, 5, 6, 7]


# --- drift --------------------------------------------------------------------------------------


def test_vanished_labels_and_empty_windows_have_rows(spark):
    day = datetime.timedelta(days=1)
    rows = [(START, START + day, "a", 3), (START, START + day, "b", 1), (START + day, START + 2 * day, "a", 2), (START + 3 * day, START + 4 * day, "b", 5)]
    drift = label_drift(spark.createDataFrame(rows, COUNTS), "1 day", ["a", "z"])
    got = {(r.window_start, r.label): (r.window_end - r.window_start, r.n, r.share, r.change) for r in drift.collect()}
    assert len(got) == 12 and all(v[0] == day for v in got.values())
    assert [got[START + i * day, "b"][1:] for i in range(4)] == [(1, 0.25, None), (0, 0.0, -0.25), (0, 0.0, 0.0), (5, 1.0, 1.0)]
    assert [got[START + i * day, "a"][2] for i in range(4)] == [0.75, 1.0, 0.0, 0.0] and got[START, "z"][1:] == (0, 0.0, None)
    assert label_drift(spark.createDataFrame([], COUNTS), "1 day").collect() == []
