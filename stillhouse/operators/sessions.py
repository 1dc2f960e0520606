"""User sessions in batch: requests of a user that follow each other within a gap."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

MICRO = timedelta(microseconds=1)


def user_sessions(log: DataFrame, gap: timedelta, users: list[str], ts: str = "ts") -> DataFrame:
    """(users, session_start, session_end, n); a session ends ``gap`` after its last request, and a request up to then belongs to it.

    Requests are first summed by slots of the gap's length, map-side: those of one slot are always one session.
    Sessions are then joined from slots, of which a user has no more than the log's time span has gaps, so the
    requests of a user, however many, are never sorted or gathered. Rows without a time are left out; rows without a user
    are one user.
    """
    step = gap // MICRO
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = log.filter(F.col(ts).isNotNull()).select(*users, at.alias("at"))
    slots = rows.groupBy(*users, F.floor(F.col("at") / step).alias("slot")).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n")
    )
    order = Window.partitionBy(*users).orderBy("slot")
    apart = F.coalesce(F.col("first") - F.lag("last").over(order) > step, F.lit(True))
    pieces = slots.withColumn("apart", apart.cast("int")).withColumn("session", F.sum("apart").over(order))
    return pieces.groupBy(*users, "session").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).select(
        *users, F.timestamp_micros("first").alias("session_start"), F.timestamp_micros(F.col("last") + step).alias("session_end"), "n"
    )
