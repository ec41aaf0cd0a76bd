"""Streaming queries: activity sessions, watermark dedup, the stateful lifecycle.

Each stages the derived event log as time-ordered Parquet slices in the shared
scratch folder, runs the stream to completion with ``availableNow`` (one micro-batch
per slice), and returns the sink read back as a batch frame. Their answers are
checked against the same SQL as the batch forms.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle as lc
from ..operators import sessions
from ..session import scratch_path
from ..sources import requests
from ..streaming import service, staging
from ..tables import lifecycle_events
from .lifecycle import APP_URL, FOLD_SQL, OUTBOX_SQL, snapshot_sql
from .registry import query
from .requests import ARN_PREFIX

L = ("lifecycle_events",)
# The staged source reads the files of a slice in any order: its disorder bounds the delay.
DELAY_SECONDS = staging.SLICE_DAYS * 86_400

SESSIONS_SQL = """
WITH p AS (
  SELECT model_id, event_id, ts,
         CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_session
  FROM lifecycle_events WHERE kind = 'predict'
  WINDOW w AS (PARTITION BY model_id ORDER BY ts, event_id)),
s AS (
  SELECT model_id, ts,
         sum(new_session) OVER (PARTITION BY model_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM p)
SELECT model_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS n_events
FROM s GROUP BY model_id, sid"""


@query("activity_sessions", SESSIONS_SQL, L)
def activity_sessions(spark, sf_dir):
    ev = lifecycle_events(spark, sf_dir, kinds=("predict",))
    return sessions.activity_sessions(ev)


def _flush(extra=None):
    row = {"model_id": F.lit(staging.FLUSH_KEY), "event_id": F.col("event_id") + 1,
           "ts": F.col("ts") + F.expr("INTERVAL 365 DAYS"), "kind": F.lit("predict")}
    row.update(extra or {})
    return row


def _stage(spark, df, flush=True):
    path = scratch_path(spark, "stream-in")
    staging.stage_slices(df, path, flush_row=_flush() if flush else None)
    return path


@query("stream_activity_sessions", SESSIONS_SQL, L)
def stream_activity_sessions(spark, sf_dir):
    ev = lifecycle_events(spark, sf_dir, kinds=("predict",))
    src = _stage(spark, ev)
    s = (staging.read_stream(spark, src, ev.schema)
         .withColumn("ts", F.col("ts").cast("timestamp"))
         .withWatermark("ts", staging.SOURCE_DISORDER)
         .groupBy("model_id", F.session_window("ts", "30 minutes"))
         .agg(F.count(F.lit(1)).alias("n_events"))
         .select("model_id", F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
                 F.col("session_window.end").cast("timestamp_ntz").alias("session_end"), "n_events"))
    sink, ckpt = scratch_path(spark, "sessions-out"), scratch_path(spark, "sessions-ckpt")
    staging.run_to_parquet(s, sink, ckpt)
    return spark.read.parquet(sink).where(F.col("model_id") != staging.FLUSH_KEY)


@query("stream_dedup", """
SELECT event_id, ts, model_id, kind FROM lifecycle_events""", L)
def stream_dedup(spark, sf_dir):
    """Every status poll is delivered twice; the stream keeps the first copy per
    event id while the watermark still covers it."""
    ev = lifecycle_events(spark, sf_dir)
    doubled = ev.unionByName(ev.where(F.col("kind") == "status"))
    src = _stage(spark, doubled, flush=False)
    s = (staging.read_stream(spark, src, ev.schema)
         .withColumn("ts", F.col("ts").cast("timestamp"))
         .withWatermark("ts", staging.SOURCE_DISORDER)
         .dropDuplicatesWithinWatermark(["event_id"])
         .select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "model_id", "kind"))
    sink, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    staging.run_to_parquet(s, sink, ckpt)
    return spark.read.parquet(sink)


def _service(spark, delay=DELAY_SECONDS):
    return service.LifecycleService(spark, scratch_path(spark, "service"), delay, APP_URL)


def _served(spark, sf_dir):
    """The event log through the stream service, then closed: every timer has fired."""
    ev = lifecycle_events(spark, sf_dir)
    out = _service(spark)
    service.run(staging.read_stream(spark, _stage(spark, ev, flush=False), ev.schema), out, scratch_path(spark, "service-ckpt"))
    out.flush()
    return out


TRANSITIONS_SQL = """
SELECT model_id, ts, event_id, status_before AS from_status, status_after AS to_status,
       kind AS reason,
       CASE WHEN has_endpoint_before OR has_endpoint_after THEN cycle_endpoint END AS endpoint_name
FROM annotated WHERE status_before <> status_after"""


@query("stream_lifecycle", FOLD_SQL + TRANSITIONS_SQL, L)
def stream_lifecycle(spark, sf_dir):
    """Lifecycle transitions of the stream service; same answer as the batch fold."""
    return lc.transitions(_served(spark, sf_dir).read("annotated"))


@query("stream_state_snapshot", snapshot_sql("true"), L)
def stream_state_snapshot(spark, sf_dir):
    """State per model in the service's bucketed table once the log is closed (every timer has fired)."""
    s = _served(spark, sf_dir).states().withColumn("cycle_ts_us", F.col("entry_cycle_ts"))
    return s.select("model_id", F.col("entry_status").alias("status"), F.when(F.col("entry_has_ep"), lc.endpoint_of_cycle()).alias("endpoint_name"),
                    lc.as_time("entry_deadline").alias("deadline"), "last_event_id",
                    F.when(F.col("served"), F.lit(0).cast("long")).otherwise(F.col("n_members")).alias("pending_subscribers"))


@query("stream_outbox", OUTBOX_SQL, L)
def stream_outbox(spark, sf_dir):
    """The service's notifications; the same as the batch outbox."""
    return _served(spark, sf_dir).read("outbox").drop("cycle_id")


@query("stream_late_events", """
WITH w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM lifecycle_events WHERE event_id % 20 <> 7)
SELECT event_id, model_id, ts, event_id % 20 = 7 AND ts < mark AS late FROM lifecycle_events, w""", L)
def stream_late_events(spark, sf_dir):
    """A twentieth of the events comes after all others, with a delay of one day allowed: each row is
    either folded or kept as late."""
    ev = lifecycle_events(spark, sf_dir)
    src, ckpt, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-ckpt"), _service(spark, 86_400)
    straggler = F.coalesce(F.col("event_id") % 20 == 7, F.lit(False))
    for k, part in enumerate((ev.where(~straggler), ev.where(straggler))):
        part.write.parquet(f"{src}/part={k}")
        service.run(staging.read_stream(spark, src, ev.schema), out, ckpt)
    out.flush()
    final = out.read("annotated").where("row_type = 'event'").select("event_id", "model_id", lc.as_time("ts_us").alias("ts"), F.lit(False).alias("late"))
    return final.unionByName(out.read("incoming").where("lane = 'late'").select("event_id", "model_id", "ts", F.lit(True).alias("late")))


@query("stream_raw_events", FOLD_SQL.replace("FROM lifecycle_events)", "FROM lifecycle_events WHERE event_id % 50 <> 3)") + TRANSITIONS_SQL + """
UNION ALL SELECT 'unreadable', NULL, event_id, NULL, NULL, 'not a whole line', NULL FROM lifecycle_events WHERE event_id % 50 = 3""", L)
def stream_raw_events(spark, sf_dir):
    """The log as raw JSON lines, a fiftieth of them cut off, through the text stream: transitions of the
    readable ones, and the others as they were quarantined."""
    ev = lifecycle_events(spark, sf_dir)
    detail = F.struct("kind", "name", "phone", "text")
    line = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), F.array(
        F.concat(F.lit(ARN_PREFIX), F.col("model_id"))).alias("resources"), detail.alias("detail")))
    cut = F.when(F.col("event_id") % 50 == 3, F.substring_index(line, ",", 2)).otherwise(line)
    src, out = scratch_path(spark, "raw-events"), _service(spark)
    ev.select(cut.alias("value")).write.text(src)
    service.run(requests.parse_event_lines(spark.readStream.text(src)), out, scratch_path(spark, "raw-events-ckpt"))
    out.flush()
    bad = out.read("incoming").where("lane = 'bad'")
    nothing = lambda *names: [F.lit(None).cast("string").alias(c) for c in names]
    return lc.transitions(out.read("annotated")).unionByName(bad.select(
        F.lit("unreadable").alias("model_id"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.regexp_extract("line", r'"event_id":(\d+)', 1).cast("long").alias("event_id"), *nothing("from_status", "to_status"),
        "reason", *nothing("endpoint_name")))
