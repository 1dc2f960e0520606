"""Label windows, sessions, repeated requests, shadow agreement and retrain triggers on a stream of served requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stillhouse.operators.monitor import label_windows
from stillhouse.sources.folders import children, remove

COUNTS = "window_start timestamp, window_end timestamp, label string, n bigint"
# Batches between two foldings of the deltas of an upserted table.
FOLD_EVERY = 16


def read_log(spark: SparkSession, path: str, schema: str, ts: str = "ts", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a log as a stream, oldest file first. ``path`` may be a pattern of files and folders.

    ``ts`` becomes a TIMESTAMP: watermarks refuse TIMESTAMP_NTZ.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def windowed_labels(log: DataFrame, late: str, width: str, slide: str | None = None, label: str = "label", ts: str = "ts") -> DataFrame:
    """Label counts per window of a stream. Rows more than ``late`` behind the newest are dropped.

    State holds one row per open window and label, whatever the traffic.
    """
    return label_windows(log.withWatermark(ts, late), width, slide, label, ts)


def append_to(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each window once, when the watermark has passed it, for all data there is now."""
    return (
        counts.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_to(counts: DataFrame, path: str, checkpoint: str, late: str | None = None, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Keep a table of the newest counts of every window and label; ``latest`` reads it.

    Each batch adds a small delta folder; every ``fold_every`` batches the deltas are folded into a base. Windows that the
    stream has finished (``late`` is its watermark's delay) go to the base once and are never written again, so a fold
    writes the open windows and those that have just finished. A batch that is run again overwrites its own delta,
    which readers pass over if a base has it already: a restart counts nothing twice.
    """
    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/delta/batch={number}")
        if (number + 1) % fold_every == 0 and number > _folded(spark, path):
            fold(spark, path, number, late)

    return (
        counts.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return sorted(int(c.split("=", 1)[1]) for c in children(spark, path) if c.startswith(f"{name}="))


def _bases(spark: SparkSession, path: str) -> list[int]:
    """The last batches of the bases that are complete: a job marks its folder at its very end, and that is the switch."""
    return [n for n in _numbers(spark, f"{path}/base", "upto") if "_SUCCESS" in children(spark, f"{path}/base/upto={n}")]


def _folded(spark: SparkSession, path: str) -> int:
    return max(_bases(spark, path), default=-1)


def _read(spark: SparkSession, root: str, folders: list[str], key: str, more: str = "") -> DataFrame:
    schema = f"{COUNTS}, {key} bigint{more}"
    rows = spark.read.schema(schema).option("basePath", root).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.withColumnRenamed(key, "batch").drop("done")


def _rows(spark: SparkSession, path: str, finished: bool) -> DataFrame:
    """The counts of the newest base and the deltas after it, with the batch they are from; ``finished``: with all finished windows."""
    bases = _bases(spark, path)
    folded = bases[-1] if bases else -1
    parts = [(n, part) for n in bases for part in children(spark, f"{path}/base/upto={n}")]
    wanted = [f"{path}/base/upto={n}/{part}" for n, part in parts if part == "done=true" and finished or part == "done=false" and n == folded]
    deltas = [f"{path}/delta/batch={n}" for n in _numbers(spark, f"{path}/delta", "batch") if n > folded]
    return _read(spark, f"{path}/base", wanted, "upto", ", done boolean").unionByName(_read(spark, f"{path}/delta", deltas, "batch"))


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("window_end", "n"), "batch").alias("s")
    return rows.groupBy("window_start", "label").agg(newest).select(
        "window_start", F.col("s.window_end").alias("window_end"), "label", F.col("s.n").alias("n")
    )


def fold(spark: SparkSession, path: str, upto: int, late: str | None = None) -> None:
    """Write the base that has all batches up to ``upto``. Until it is complete, readers use the one before and its deltas.

    Deltas of the base before that one go; those just folded stay until the next fold, for readers that have begun.
    """
    folded, state = _folded(spark, path), _newest(_rows(spark, path, finished=False))
    done = F.lit(False)
    if late:
        # A window starts before its newest row, so the stream's watermark has passed this time.
        horizon = state.agg(F.unix_micros(F.max("window_start") - F.expr(f"INTERVAL {late}"))).first()[0]
        done = F.unix_micros("window_end") <= F.lit(horizon).cast("bigint") if horizon is not None else done
    state.withColumn("done", done).write.mode("overwrite").partitionBy("done").parquet(f"{path}/base/upto={upto}")
    for number in _numbers(spark, f"{path}/delta", "batch"):
        if number <= folded:
            remove(spark, f"{path}/delta/batch={number}")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every window and label that ``upsert_to`` wrote: the base and the deltas after it."""
    return _newest(_rows(spark, path, finished=True))


def session_counts(log: DataFrame, late: str, gap: str, users: list[str], ts: str = "ts") -> DataFrame:
    """(users, session_start, session_end, n) of a stream, as ``user_sessions`` in batch.

    A request opens a session of its own that is merged with the ones in state it overlaps, so late requests can join two
    sessions. Append output has a session once the watermark has passed its end; state holds the open sessions.
    """
    session = F.session_window(ts, gap)
    return log.withWatermark(ts, late).groupBy(session.alias("session"), *users).agg(F.count("*").alias("n")).select(
        *users, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "n"
    )


def distinct_requests(log: DataFrame, late: str, request: str = "request_id", ts: str = "ts") -> DataFrame:
    """The stream without requests that were seen before: the first row of each id.

    Ids are remembered until the watermark is ``late`` past their first row, so repeats up to ``late`` apart
    are dropped for certain, and state holds the ids of that time only.
    """
    return log.withWatermark(ts, late).dropDuplicatesWithinWatermark([request])


def shadow_pairs(student: DataFrame, teacher: DataFrame, late: str, within: str, ts: str = "ts") -> DataFrame:
    """Joins a stream of student answers to a stream of teacher answers to the same requests.

    The teacher answers after the student, at most ``within`` later; both watermarks bound the state.
    """
    s = student.withWatermark(ts, late).alias("s")
    t = teacher.withWatermark(ts, late).alias("t")
    same = (
        (F.col("s.request_id") == F.col("t.request_id"))
        & (F.col(f"t.{ts}") >= F.col(f"s.{ts}"))
        & (F.col(f"t.{ts}") <= F.col(f"s.{ts}") + F.expr(f"INTERVAL {within}"))
    )
    return s.join(t, same).select(
        F.col("s.request_id").alias("request_id"), F.col(f"s.{ts}").alias(ts),
        F.col("s.label").alias("label"), F.col("t.label").alias("teacher_label"),
        (F.col("s.label") == F.col("t.label")).alias("agree"),
    )


def retrain_alerts(log: DataFrame, late: str, width: str, threshold: float, ts: str = "ts") -> DataFrame:
    """Windows of a stream whose accuracy on spot-checks is below the threshold."""
    right = (F.col("label") == F.col("expected")).cast("double")
    return (
        log.withWatermark(ts, late)
        .filter(F.col("expected").isNotNull())
        .groupBy(F.window(ts, width).alias("window"), "model")
        .agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))
        .filter(F.col("accuracy") < threshold)
        .select(F.col("window.start").alias("window_start"), "model", "n", "accuracy")
    )
