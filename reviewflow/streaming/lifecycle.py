"""The lifecycle state machine on a stream: ``applyInPandasWithState`` keyed by model
with an event-time timeout.

Rows of one micro-batch arrive unordered and may be overtaken by rows of the next
batch that are still within the watermark delay. So each model's state keeps a
buffer of not-yet-final events; an event is folded once the watermark has passed
its time (no earlier event can still arrive), and the idle timer fires once the
watermark has passed the deadline. The engine's timeout calls the function again
when the watermark moves, even without new rows for the model.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import present
from ..operators import lifecycle as lc

STATE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("has_ep", T.BooleanType()),
    T.StructField("deadline", T.LongType()), T.StructField("cycle_id", T.LongType()),
    T.StructField("cycle_ts", T.LongType()),
    T.StructField("buf_ts", T.ArrayType(T.LongType())), T.StructField("buf_id", T.ArrayType(T.LongType())),
    T.StructField("buf_kind", T.ArrayType(T.StringType())), T.StructField("buf_name", T.ArrayType(T.StringType())),
    T.StructField("buf_phone", T.ArrayType(T.StringType())),
    T.StructField("buf_valid", T.ArrayType(T.BooleanType())), T.StructField("buf_text", T.ArrayType(T.BooleanType())),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("model_id", T.StringType()), T.StructField("row_type", T.StringType()),
    T.StructField("event_id", T.LongType()), T.StructField("ts_us", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("phone", T.StringType()), T.StructField("status_before", T.StringType()),
    T.StructField("status_after", T.StringType()), T.StructField("has_endpoint_before", T.BooleanType()),
    T.StructField("has_endpoint_after", T.BooleanType()), T.StructField("deadline_before_us", T.LongType()),
    T.StructField("deadline_us", T.LongType()), T.StructField("action", T.StringType()),
    T.StructField("code", T.IntegerType()), T.StructField("extended", T.BooleanType()),
    T.StructField("cycle_id", T.LongType()), T.StructField("cycle_ts_us", T.LongType()),
])
_OUT = [f.name for f in OUTPUT_SCHEMA.fields]
_BUF = ["ts_us", "event_id", "kind", "name", "phone", "valid_start", "has_text"]


def _step_fn(idle_us: int, extend_us: int):
    def step(key, pdfs, state):
        model = key[0]
        if state.exists:
            (status, has_ep, deadline, cycle_id, cycle_ts, *bufs) = state.get
            buf = {c: list(v) for c, v in zip(_BUF, bufs)}
        else:
            status, has_ep, deadline, cycle_id, cycle_ts = lc.STOPPED, False, None, None, None
            buf = {c: [] for c in _BUF}
        for pdf in pdfs:
            for c in _BUF:
                buf[c].extend(pdf[c].tolist())
        wm_us = state.getCurrentWatermarkMs() * 1000
        order = sorted(range(len(buf["ts_us"])), key=lambda i: (buf["ts_us"][i], buf["event_id"][i]))
        ready = [i for i in order if buf["ts_us"][i] < wm_us]
        later = [i for i in order if buf["ts_us"][i] >= wm_us]
        st = lc.EndpointState(status, has_ep, deadline)
        cyc = [cycle_id, cycle_ts]
        out = {c: [] for c in _OUT}
        cur = {}

        def emit(row_type, i, t, before, after, ep_b, ep_a, d_b, d_a, action, code, extended):
            ev = i >= 0
            if ev and action == "create":
                cyc[0], cyc[1] = cur["event_id"], t
            vals = (model, row_type, cur["event_id"] if ev else None, t, cur["kind"] if ev else "timer",
                    cur["name"] if ev else None, cur["phone"] if ev else None, before, after,
                    ep_b, ep_a, d_b, d_a, action, code, extended, cyc[0], cyc[1])
            for c, v in zip(_OUT, vals):
                out[c].append(v)

        for i in ready:
            cur = {c: buf[c][i] for c in _BUF}
            st.apply(0, cur["ts_us"], cur["kind"], cur["valid_start"], cur["has_text"], idle_us, extend_us, emit)
        st.expire(wm_us, emit)
        rest = {c: [buf[c][i] for i in later] for c in _BUF}
        state.update((st.status, st.has_ep, st.deadline, cyc[0], cyc[1], *[rest[c] for c in _BUF]))
        due = rest["ts_us"][:1] + ([st.deadline] if st.status == lc.IN_SERVICE else [])
        if due:
            state.setTimeoutTimestamp(max(min(due) // 1000, wm_us // 1000 + 1))
        if out["model_id"]:
            res = pd.DataFrame(out)
            for c in ("event_id", "deadline_before_us", "deadline_us", "cycle_id", "cycle_ts_us"):
                res[c] = res[c].astype("Int64")
            res["code"] = res["code"].astype("Int32")
            yield res
    return step


def stream_annotate(events: DataFrame, watermark: str = "10 minutes",
                    idle_minutes: int = lc.IDLE_MINUTES,
                    extend_below_minutes: int = lc.EXTEND_BELOW_MINUTES) -> DataFrame:
    """Streaming counterpart of ``operators.lifecycle.annotate`` (same rows, no epoch
    column); ``events`` is a streaming frame of lifecycle events."""
    idle_us, extend_us = idle_minutes * 60_000_000, extend_below_minutes * 60_000_000
    s = (events.withColumn("ts", F.col("ts").cast("timestamp"))
               .withWatermark("ts", watermark)
               .select("model_id", "ts", F.unix_micros("ts").alias("ts_us"), "event_id", "kind", "name", "phone",
                       ((F.col("kind") == "start") & present("name") & present("phone")).alias("valid_start"),
                       present("text").alias("has_text")))
    return s.groupBy("model_id").applyInPandasWithState(
        _step_fn(idle_us, extend_us), OUTPUT_SCHEMA, STATE_SCHEMA, "append", "EventTimeTimeout")


# ---- durable state snapshot from the stream ---------------------------------------

SNAPSHOT_COLUMNS = ["model_id", "ts_us", "event_id", "status_after", "has_endpoint_after", "deadline_us",
                    "cycle_id", "cycle_ts_us", "n_members", "served"]


def _versions(spark, path: str) -> list[int]:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch="))


def _delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def latest_snapshot(spark, path: str) -> DataFrame:
    """The newest complete snapshot version below ``path``."""
    v = _versions(spark, path)
    if not v:
        raise FileNotFoundError(f"no snapshot below {path}")
    return spark.read.parquet(f"{path}/batch={v[-1]:012d}")


def snapshot_writer(path: str):
    """``foreachBatch`` function keeping one row per model: the state after its latest
    event plus the size of its current subscriber list. Each micro-batch writes a new
    version folder from the previous version and the batch (a replayed batch rewrites
    its own version, so the sink is idempotent); readers take the newest version."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        event = F.col("row_type") == "event"
        # a timer row ends the state like an event, but the last event id stays
        latest = (batch.groupBy("model_id")
                    .agg(F.max(F.struct("ts_us", (~event).alias("timer"), "event_id", "status_after", "has_endpoint_after",
                                        "deadline_us", "cycle_id", "cycle_ts_us")).alias("l"),
                         F.max(F.when(event, F.struct("ts_us", "event_id"))).alias("e"))
                    .select("model_id", "l.ts_us", "e.event_id", "l.status_after", "l.has_endpoint_after",
                            "l.deadline_us", "l.cycle_id", "l.cycle_ts_us"))
        per_cycle = (batch.where(event & F.col("cycle_id").isNotNull())
                       .groupBy("model_id", "cycle_id")
                       .agg(F.sum(F.col("action").isin("create", "append").cast("long")).alias("n_new"),
                            F.max((F.col("kind") == "in_service").cast("int")).alias("served_new")))
        fresh = (latest.join(per_cycle, ["model_id", "cycle_id"], "left")
                       .select(*SNAPSHOT_COLUMNS[:8], F.coalesce("n_new", F.lit(0)).alias("n_new"),
                               F.coalesce("served_new", F.lit(0)).alias("served_new")))
        older = [v for v in _versions(spark, path) if v < batch_id]
        if older:
            prev = spark.read.parquet(f"{path}/batch={older[-1]:012d}")
            same_cycle = F.col("p.cycle_id").eqNullSafe(F.col("f.cycle_id"))
            merged = (prev.alias("p").join(fresh.alias("f"), "model_id", "full_outer")
                      .select(
                          "model_id",
                          *[(F.coalesce("f.event_id", "p.event_id") if c == "event_id" else
                             F.when(F.col("f.ts_us").isNotNull(), F.col(f"f.{c}")).otherwise(F.col(f"p.{c}"))).alias(c)
                            for c in SNAPSHOT_COLUMNS[1:8]],
                          F.when(F.col("f.ts_us").isNull(), F.col("p.n_members"))
                           .when(same_cycle, F.col("p.n_members") + F.col("f.n_new"))
                           .otherwise(F.col("f.n_new")).alias("n_members"),
                          F.when(F.col("f.ts_us").isNull(), F.col("p.served"))
                           .when(same_cycle, F.col("p.served") | (F.col("f.served_new") == 1))
                           .otherwise(F.col("f.served_new") == 1).alias("served")))
        else:
            merged = fresh.select(*SNAPSHOT_COLUMNS[:8], F.col("n_new").alias("n_members"),
                                  (F.col("served_new") == 1).alias("served"))
        merged.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
        for v in older[:-1]:   # the version before stays for readers and for a replay
            _delete(spark, f"{path}/batch={v:012d}")
    return write


def run_snapshot(stream: DataFrame, path: str, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(snapshot_writer(path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
