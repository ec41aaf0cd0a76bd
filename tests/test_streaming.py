"""Streams against their batch forms when rows arrive out of order across
micro-batches (but within the watermark delay)."""

import datetime as dt

from pyspark.sql import functions as F

from reviewflow.operators import lifecycle as lc
from reviewflow.session import scratch_path
from reviewflow.streaming import lifecycle as slc
from reviewflow.streaming import staging

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, model_id string, kind string, name string, phone string, text string"
KINDS = ["start", "in_service", "predict", "status", "predict", "status", "start", "predict",
         "shutdown", "start", "in_service", "status"]


def _events():
    rows, t = [], T0
    for i in range(48):
        t += dt.timedelta(minutes=(i * 7) % 23 + 1)
        rows.append((i, t, f"m{i % 2}", KINDS[i % len(KINDS)], "ann", "855-555-1212", "{}"))
    return rows


def test_stream_lifecycle_with_disorder_equals_batch(spark):
    rows = _events()
    # file 1 runs a few events ahead; file 2 brings the skipped ones (a few minutes
    # older than file 1's newest row, inside the 10 minute watermark delay)
    first = rows[:20] + rows[22:24]
    second = rows[20:22] + rows[24:]
    src = scratch_path(spark, "t-stream")
    for i, part in enumerate((first, second)):
        # one file per write: the disorder is exactly the one constructed above
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{src}/f{i}")
    flush = [(10_000, T0 + dt.timedelta(days=400), staging.FLUSH_KEY, "predict", None, None, "")]
    spark.createDataFrame(flush, SCHEMA).coalesce(1).write.mode("append").parquet(f"{src}/f9")
    stream = staging.read_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    sink, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")
    staging.run_to_parquet(slc.stream_annotate(stream, watermark="10 minutes"), sink, ckpt)
    got = lc.transitions(spark.read.parquet(sink).where(F.col("model_id") != staging.FLUSH_KEY))
    want = lc.transitions(lc.annotate(spark.createDataFrame(rows, SCHEMA)))
    key = ["model_id", "ts", "event_id", "from_status", "to_status", "reason", "endpoint_name"]
    assert sorted(map(tuple, got.select(key).collect()), key=repr) == \
        sorted(map(tuple, want.select(key).collect()), key=repr)
    assert got.count() > 5


def test_session_stream_over_multi_file_slices_equals_batch(spark):
    """Slices written as several files (read one per micro-batch, in any order) still
    give the batch sessions when the watermark covers the source's disorder."""
    from reviewflow.operators import sessions
    df = spark.createDataFrame(_events(), SCHEMA).where(F.col("kind") == "predict").repartition(4)
    src = scratch_path(spark, "t-slices")
    staging.stage_slices(df, src, slice_days=1, flush_row={
        "model_id": F.lit(staging.FLUSH_KEY), "event_id": F.col("event_id") + 1,
        "ts": F.col("ts") + F.expr("INTERVAL 365 DAYS"), "kind": F.lit("predict")})
    s = (staging.read_stream(spark, src, df.schema).withColumn("ts", F.col("ts").cast("timestamp"))
         .withWatermark("ts", "1 day")
         .groupBy("model_id", F.session_window("ts", "30 minutes")).agg(F.count(F.lit(1)).alias("n_events"))
         .select("model_id", F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
                 "n_events"))
    sink, ckpt = scratch_path(spark, "t-sess"), scratch_path(spark, "t-sess-ckpt")
    staging.run_to_parquet(s, sink, ckpt)
    got = sorted(map(tuple, spark.read.parquet(sink).where(F.col("model_id") != staging.FLUSH_KEY)
                     .select("model_id", "session_start", "n_events").collect()))
    want = sorted(map(tuple, sessions.activity_sessions(df).select("model_id", "session_start", "n_events")
                      .collect()))
    assert got == want and len(want) > 3
