"""The endpoint lifecycle as a stream service: ``foreachBatch`` over versioned Parquet tables.

A micro-batch is folded by the batch operator (``operators.lifecycle.annotate``), which cuts every
model's events into chunks, so a model with most of the events spreads over tasks; what is keyed
by model alone is one small row a model. Between batches live, below ``root``:

- ``incoming``  every row that came, once, in lanes: ``ok``; ``late`` (behind the watermark); ``bad`` (with a reason)
- ``pending``   ok rows that an earlier event may still precede (not yet behind the watermark)
- ``state``     a row a model, hash-bucketed: a batch writes the buckets that it changes and no other
- ``annotated`` final rows, as ``annotate`` gives them, and the timers that fired
- ``waiting``   subscribers of cycles that haven't come into service
- ``outbox``    the notifications of the batch, a row for each (cycle, subscriber event)
- ``commits``   watermark and row counts, written last

Every table has a folder for each batch, and readers see committed batches only. A batch reads
the newest committed version before its own number, so a batch that is replayed after a failure at any point
rewrites its own folders and nothing is sent or counted twice. The watermark is the latest event time
less ``delay``; a row behind the watermark of the batches before is late: it is kept and counted, and
changes nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import present
from ..operators import lifecycle as lc

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, model_id string, kind string, name string, phone string, text string"
EVENT_COLUMNS = [c.split()[0] for c in EVENT_SCHEMA.split(", ")]
STATE_SCHEMA = ("model_id string, entry_status string, entry_has_ep boolean, entry_deadline long, entry_cycle_id long, entry_cycle_ts long, "
                "last_event_id long, n_members long, served boolean")
WAITING_SCHEMA = "model_id string, cycle_id long, subscriber_event_id long, name string, phone string"
OUTBOX_SCHEMA = ("model_id string, in_service_event_id long, notified_at timestamp_ntz, subscriber_event_id long, name string, phone string, "
                 "message string, cycle_id long")
COMMIT_SCHEMA = "watermark_us long, rows_in long, rows_late long, rows_bad long, rows_pending long, rows_final long, rows_sent long"
INCOMING_SCHEMA = EVENT_SCHEMA + ", line string, reason string, lane string"
ANNOTATED_SCHEMA = lc.ANNOTATED_SCHEMA
END_OF_TIME = 1 << 62
STATE_BUCKETS = 64


class LifecycleService:
    """``write`` is the ``foreachBatch`` function; ``flush`` closes the log (every pending row is
    final, every timer fires); ``read``, ``states`` and ``commits`` are the outputs."""

    def __init__(self, spark: SparkSession, root: str, delay_seconds: int, app_url: str, buckets: int = STATE_BUCKETS):
        self.spark, self.root, self.app_url, self.buckets = spark, root.rstrip("/"), app_url, buckets
        self.delay_us = delay_seconds * 1_000_000

    # ---- versions -------------------------------------------------------------------

    def _path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch:09d}"

    def _children(self, path: str, prefix: str) -> list[int]:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(prefix))

    def committed(self, before: int | None = None) -> list[int]:
        """The batches whose commit was written (the folder alone isn't enough)."""
        jvm, found = self.spark._jvm, []
        for b in self._children(f"{self.root}/commits", "batch="):
            p = jvm.org.apache.hadoop.fs.Path(f"{self._path('commits', b)}/_SUCCESS")
            if (before is None or b < before) and p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
                found.append(b)
        return found

    def _version(self, spark, table: str, batch: int | None, schema: str) -> DataFrame:
        if batch is None or batch not in self._children(f"{self.root}/{table}", "batch="):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._path(table, batch))

    def read(self, table: str) -> DataFrame:
        """All committed rows of ``annotated``, ``outbox`` or ``incoming``."""
        schema = {"annotated": ANNOTATED_SCHEMA, "outbox": OUTBOX_SCHEMA, "incoming": INCOMING_SCHEMA}[table]
        done = self.committed()
        if not done or not self._children(f"{self.root}/{table}", "batch="):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema + ", batch int").parquet(f"{self.root}/{table}")
        return rows.where(F.col("batch") <= done[-1]).drop("batch")

    def commits(self) -> DataFrame:
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], COMMIT_SCHEMA + ", batch int")
        return self.spark.read.schema(COMMIT_SCHEMA + ", batch int").parquet(f"{self.root}/commits").where(F.col("batch") <= done[-1])

    def state_files(self, before: int | None = None) -> dict[int, str]:
        """For each bucket the newest committed folder that holds it."""
        found = {}
        for b in self.committed(before):
            for bucket in self._children(self._path("state", b), "bucket="):
                found[bucket] = f"{self._path('state', b)}/bucket={bucket}"
        return found

    def states(self, spark=None, before: int | None = None, buckets=None) -> DataFrame:
        """A row a model: its state after the newest committed batch."""
        spark = spark or self.spark
        paths = [p for b, p in sorted(self.state_files(before).items()) if buckets is None or b in buckets]
        return spark.read.schema(STATE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], STATE_SCHEMA)

    # ---- a micro-batch ------------------------------------------------------------------

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch.sparkSession, batch, batch_id, None)

    def flush(self) -> None:
        done = self.committed()
        self._step(self.spark, self.spark.createDataFrame([], EVENT_SCHEMA), done[-1] + 1 if done else 0, END_OF_TIME)

    def _put(self, df: DataFrame, table: str, batch: int, *by: str) -> None:
        w = df.write.mode("overwrite")
        (w.partitionBy(*by) if by else w).parquet(self._path(table, batch))

    def _step(self, spark: SparkSession, batch: DataFrame, batch_id: int, close_at: int | None) -> None:
        done = self.committed(before=batch_id)
        prev = done[-1] if done else None
        old = spark.read.schema(COMMIT_SCHEMA).parquet(self._path("commits", prev)).first() if done else None
        watermark = old.watermark_us if old else -END_OF_TIME
        # the batch is read once: written in lanes
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        extra = [F.col(c) if c in batch.columns else F.lit(None).cast("string").alias(c) for c in ("line", "reason")]
        rows = batch.select(*EVENT_COLUMNS, *extra).withColumn("reason", F.coalesce(
            "reason", F.when(F.col("model_id").isNull(), "no model").when(F.col("ts").isNull(), "no time")))
        lane = F.when(F.col("reason").isNotNull(), "bad").when(us < watermark, "late").otherwise("ok")
        self._put(rows.withColumn("lane", lane), "incoming", batch_id, "lane")
        incoming = spark.read.schema(INCOMING_SCHEMA).parquet(self._path("incoming", batch_id))
        lanes = {r.lane: r for r in incoming.groupBy("lane").agg(F.count("*").alias("n"), F.max(us).alias("top")).collect()}
        if close_at is not None:
            watermark = close_at
        elif "ok" in lanes:
            watermark = max(watermark, lanes["ok"].top - self.delay_us)
        pool = self._version(spark, "pending", prev, EVENT_SCHEMA).unionByName(incoming.where("lane = 'ok'").select(*EVENT_COLUMNS))
        self._put(pool.where(us >= watermark), "pending", batch_id)
        ready = pool.where(us < watermark)
        states = self.states(spark, before=batch_id)
        final = lc.annotate(ready, start=states, close=False)
        final, changed = self._advance(final, states, watermark)
        self._put(final, "annotated", batch_id)
        final = spark.read.schema(ANNOTATED_SCHEMA).parquet(self._path("annotated", batch_id))
        self._update_states(spark, changed, batch_id)
        self._notify(spark, final, prev, batch_id)
        count = lambda table: spark.read.parquet(self._path(table, batch_id)).count()  # noqa: E731  from the footers
        counts = [lanes[k].n if k in lanes else 0 for k in ("late", "bad")]
        commit = (watermark, sum(r.n for r in lanes.values()), *counts, count("pending"), final.where("row_type = 'event'").count(), count("outbox"))
        self._put(spark.createDataFrame([commit], COMMIT_SCHEMA).coalesce(1), "commits", batch_id)
        for table in ("pending", "waiting"):  # the version before stays, for a replay of this batch
            for b in self._children(f"{self.root}/{table}", "batch="):
                if prev is not None and b < prev:
                    path = spark._jvm.org.apache.hadoop.fs.Path(self._path(table, b))
                    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def _advance(self, final: DataFrame, states: DataFrame, watermark: int) -> tuple[DataFrame, DataFrame]:
        """The batch's final rows with the timers that the watermark has passed, and the states that changed."""
        event = F.col("row_type") == "event"
        member = event & F.col("action").isin("create", "append")
        served = event & (F.col("kind") == "in_service")
        last = final.groupBy("model_id").agg(
            # a timer row ends the state like an event, but the last event stays
            F.max(F.struct("ts_us", (~event).alias("timer"), "event_id", "status_after", "has_endpoint_after", "deadline_us", "cycle_id",
                           "cycle_ts_us")).alias("l"), F.max(F.when(event, F.struct("ts_us", "event_id"))).alias("e"))
        cycle = final.where(F.col("cycle_id").isNotNull()).groupBy("model_id", "cycle_id").agg(
            F.sum(member.cast("long")).alias("new_members"), F.max(served).alias("new_served"))
        last = last.select("model_id", F.col("l.status_after").alias("entry_status"), F.col("l.has_endpoint_after").alias("entry_has_ep"),
                           F.col("l.deadline_us").alias("entry_deadline"), F.col("l.cycle_id").alias("cycle_id"),
                           F.col("l.cycle_ts_us").alias("entry_cycle_ts"), F.col("e.event_id").alias("new_event_id"))
        was = states.select("model_id", F.col("entry_cycle_id").alias("was_cycle"), F.col("last_event_id").alias("was_event"),
                            F.col("n_members").alias("was_members"), F.col("served").alias("was_served"))
        same = F.col("was_cycle").eqNullSafe(F.col("cycle_id"))
        touched = last.join(cycle, ["model_id", "cycle_id"], "left").join(was, "model_id", "left").select(
            "model_id", "entry_status", "entry_has_ep", "entry_deadline", F.col("cycle_id").alias("entry_cycle_id"), "entry_cycle_ts",
            F.coalesce("new_event_id", "was_event").alias("last_event_id"),
            (F.coalesce("new_members", F.lit(0)) + F.when(same, F.coalesce("was_members", F.lit(0))).otherwise(0)).alias("n_members"),
            (F.coalesce("new_served", F.lit(False)) | (same & F.coalesce("was_served", F.lit(False)))).alias("served"))
        due = (F.col("entry_status") == lc.IN_SERVICE) & (F.col("entry_deadline") < watermark)
        idle = states.where(due).join(last.select("model_id"), "model_id", "left_anti")
        changed = touched.unionByName(idle.select(touched.columns))
        timers = changed.where(due).select(
            "model_id", F.lit(None).cast("long").alias("bucket"), F.lit("timer").alias("row_type"), F.lit(None).cast("long").alias("event_id"),
            F.col("entry_deadline").alias("ts_us"), F.lit("timer").alias("kind"), *(F.lit(None).cast("string").alias(c) for c in ("name", "phone")),
            F.lit(lc.IN_SERVICE).alias("status_before"), F.lit(lc.STOPPED).alias("status_after"), F.col("entry_has_ep").alias("has_endpoint_before"),
            F.lit(False).alias("has_endpoint_after"), F.col("entry_deadline").alias("deadline_before_us"), F.lit(None).cast("long").alias("deadline_us"),
            F.lit("timer").alias("action"), F.lit(None).cast("int").alias("code"), F.lit(False).alias("extended"),
            F.col("entry_cycle_id").alias("cycle_id"), F.col("entry_cycle_ts").alias("cycle_ts_us"))
        stopped = changed.withColumns({"entry_deadline": F.when(~F.coalesce(due, F.lit(False)), F.col("entry_deadline")),
                                       "entry_has_ep": F.when(F.coalesce(due, F.lit(False)), False).otherwise(F.col("entry_has_ep")),
                                       "entry_status": F.when(F.coalesce(due, F.lit(False)), lc.STOPPED).otherwise(F.col("entry_status"))})
        return final.unionByName(timers), stopped

    def _update_states(self, spark: SparkSession, changed: DataFrame, batch_id: int) -> None:
        """Upsert by key: the buckets that hold a changed model are written anew, the files of the others stay."""
        bucket = F.pmod(F.xxhash64("model_id"), F.lit(self.buckets)).cast("int")
        fresh = f"{self.root}/changed/batch={batch_id:09d}"
        changed.write.mode("overwrite").parquet(fresh)
        changed = spark.read.schema(STATE_SCHEMA).parquet(fresh)
        hit = [r[0] for r in changed.select(bucket.alias("b")).distinct().collect()]  # at most the number of buckets
        kept = self.states(spark, before=batch_id, buckets=set(hit)).join(changed.select("model_id"), "model_id", "left_anti")
        out = kept.unionByName(changed).withColumn("bucket", bucket)
        self._put(out.repartition("bucket"), "state", batch_id, "bucket")

    def _notify(self, spark: SparkSession, final: DataFrame, prev: int | None, batch_id: int) -> None:
        """Messages to the subscribers whose cycle came into service in this batch; the others go on waiting,
        as long as theirs is the model's cycle."""
        events = final.where("row_type = 'event'")
        joined = events.where(F.col("action").isin("create", "append") & present("phone")).select(
            "model_id", "cycle_id", F.col("event_id").alias("subscriber_event_id"), "name", "phone")
        waiting = self._version(spark, "waiting", prev, WAITING_SCHEMA).unionByName(joined)
        served = events.where((F.col("kind") == "in_service") & F.col("cycle_id").isNotNull()).groupBy("model_id", "cycle_id").agg(
            F.min(F.struct("ts_us", "event_id")).alias("f"))
        self._put(lc.messages(waiting.join(served, ["model_id", "cycle_id"]), self.app_url).select(
            *[c.split()[0] for c in OUTBOX_SCHEMA.split(", ")]), "outbox", batch_id)
        current = reduce(DataFrame.unionByName, [
            self.states(spark, before=batch_id).select("model_id", F.col("entry_cycle_id").alias("cycle_id")),
            spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/changed/batch={batch_id:09d}").select("model_id", F.col("entry_cycle_id").alias("cycle_id"))])
        open_ = current.join(served.select("model_id", "cycle_id"), ["model_id", "cycle_id"], "left_anti").distinct()
        self._put(waiting.join(open_, ["model_id", "cycle_id"], "left_semi"), "waiting", batch_id)


def run(stream: DataFrame, service: LifecycleService, checkpoint: str) -> None:
    """Drain what ``stream`` has into the service; a rerun goes on where the last one stopped."""
    q = stream.writeStream.foreachBatch(service.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
