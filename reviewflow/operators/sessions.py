"""Inactivity sessions: events of a key with gaps of at most ``gap`` belong together
(events exactly ``gap`` apart still touch, as with ``session_window``).

Batch form of the keep-alive view: session boundaries come from ordered scans per
(key, hour) with a per-hour summary, then a plain aggregate per (key, session) with
partial aggregation, so a key holding most rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan


def gap_sessions(df: DataFrame, key: str, ts: str, id_col: str, gap_minutes: int = 30,
                 bucket_seconds: int = 3600) -> DataFrame:
    """Adds ``session_id`` (id of the session's first row) to every row."""
    p = df.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp"))) \
          .withColumn("__b", scan.time_bucket(ts, bucket_seconds))
    p = scan.previous_values(p, [key], ["__us", id_col], "__b", ["__us"], prefix="__prev")
    start = F.col("__prev__us").isNull() | ((F.col("__us") - F.col("__prev__us")) > gap_minutes * 60_000_000)
    p = p.withColumn("__start", F.when(start, F.col(id_col)))
    p = scan.carry_forward(p, [key], ["__us", id_col], "__b", "__start", "session_id")
    return p.drop("__us", "__b", "__prev__us", "__start")


def activity_sessions(events: DataFrame, key: str = "model_id", ts: str = "ts", id_col: str = "event_id",
                      gap_minutes: int = 30) -> DataFrame:
    """``key, session_start, session_end, n_events``; the end is the last event plus
    the gap (the moment the idle timer would fire), as ``session_window`` reports it."""
    s = gap_sessions(events, key, ts, id_col, gap_minutes)
    return (s.groupBy(key, "session_id")
             .agg(F.min(ts).alias("session_start"), F.max(ts).alias("last_ts"),
                  F.count(F.lit(1)).alias("n_events"))
             .select(key, "session_start",
                     (F.col("last_ts") + F.expr(f"INTERVAL {gap_minutes} MINUTES")).alias("session_end"),
                     "n_events"))
