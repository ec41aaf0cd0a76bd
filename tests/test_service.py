"""The stream service: disorder, lateness, replay after failures, bucketed state, raw lines."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from reviewflow.operators import lifecycle as lc
from reviewflow.session import scratch_path
from reviewflow.sources import requests
from reviewflow.streaming import service

T0 = dt.datetime(2024, 1, 1)
KINDS = ["start", "start", "in_service", "predict", "status", "predict", "status", "start", "predict", "shutdown", "start", "in_service", "status"]
KEY = ["model_id", "row_type", "event_id", "ts_us", "status_before", "status_after", "action", "code", "deadline_us", "cycle_id"]


def events(n=60, models=3):
    rows, t = [], T0
    for i in range(n):
        t += dt.timedelta(minutes=(i * 7) % 23 + 1)
        rows.append((i, t, f"m{i * i % models}", KINDS[i % len(KINDS)], f"ann{i}", "855-555-1212" if i % 5 else None, "{}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, service.EVENT_SCHEMA)


def local(spark, path):
    return path.removeprefix("file://").removeprefix("file:")


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def outbox_key(df):
    return rows_of(df, ["model_id", "in_service_event_id", "subscriber_event_id", "name", "notified_at", "message"])


def test_micro_batches_with_disorder_equal_the_batch(spark):
    rows = events()
    src = scratch_path(spark, "service-in")
    # later batches bring rows some minutes older than the newest before them; the last is far too late
    parts = [rows[:20] + rows[22:24], rows[20:22] + rows[24:40], rows[40:], [(900, T0, "m0", "shutdown", None, None, "")]]
    for k, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.mode("append").parquet(f"{src}/part={k}")
    s = service.LifecycleService(spark, scratch_path(spark, "service"), 3 * 3600, "u", buckets=4)
    stream = spark.readStream.schema(frame(spark, []).schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(src)
    service.run(stream, s, scratch_path(spark, "service-ckpt"))
    commits = s.commits().orderBy("batch").collect()
    assert len(commits) == 4 and [c.rows_late for c in commits] == [0, 0, 0, 1]
    assert 0 < commits[0].rows_final < 22 and commits[0].rows_pending + commits[0].rows_final == 22  # not all rows are final at once
    s.flush()
    whole = lc.annotate(frame(spark, rows))
    assert rows_of(s.read("annotated"), KEY) == rows_of(whole, KEY)
    assert outbox_key(s.read("outbox")) == outbox_key(lc.outbox(whole, "u")) and s.read("outbox").count() > 3
    # rows in = rows out + late + bad, at every commit with what is pending
    done = s.commits().orderBy("batch").collect()
    total = lambda c: sum(r[c] for r in done)
    assert total("rows_in") == len(rows) + 1 == total("rows_final") + total("rows_late") + total("rows_bad") and done[-1].rows_pending == 0
    assert [r.event_id for r in s.read("incoming").where("lane = 'late'").collect()] == [900]


def test_replay_after_a_failure_sends_nothing_twice(spark, monkeypatch):
    rows = events()
    s = service.LifecycleService(spark, scratch_path(spark, "replay"), 600, "u", buckets=4)
    s.write(frame(spark, rows[:25]), 0)
    put = s._put

    def failing(df, table, batch, *by):
        if table == "commits":
            raise OSError("lost before the commit")
        put(df, table, batch, *by)
    monkeypatch.setattr(s, "_put", failing)
    before = s.read("outbox").count(), rows_of(s.states(), ["model_id", "entry_status", "last_event_id"])
    with pytest.raises(OSError):
        s.write(frame(spark, rows[25:]), 1)
    # everything but the commit was written; readers see the batch before
    assert (s.read("outbox").count(), rows_of(s.states(), ["model_id", "entry_status", "last_event_id"])) == before
    monkeypatch.undo()
    s.write(frame(spark, rows[25:]), 1)
    s.write(frame(spark, rows[25:]), 1)  # a replay of a batch that was committed
    s.flush()
    whole = lc.annotate(frame(spark, rows))
    assert outbox_key(s.read("outbox")) == outbox_key(lc.outbox(whole, "u"))
    assert rows_of(s.read("annotated"), KEY) == rows_of(whole, KEY)


def test_untouched_buckets_keep_their_files(spark):
    s = service.LifecycleService(spark, scratch_path(spark, "buckets"), 0, "u", buckets=16)
    many = [(i, T0 + dt.timedelta(seconds=i), f"model-{i}", "in_service", None, None, "") for i in range(60)]
    s.write(frame(spark, many), 0)
    first = s.state_files()
    one = [(100 + i, T0 + dt.timedelta(seconds=100 + i), "model-7", "status", None, None, "") for i in range(2)]
    s.write(frame(spark, one), 1)
    second = s.state_files()
    changed = {b for b in second if second[b] != first.get(b)}
    own = spark.createDataFrame([("model-7",), ("model-59",)], "m string").select(F.pmod(F.xxhash64("m"), F.lit(16)).alias("b")).collect()
    assert changed <= {r.b for r in own} and own[0].b in changed and len(second) > 8
    names = {b: sorted(os.listdir(local(spark, p))) for b, p in first.items()}
    assert all(sorted(os.listdir(local(spark, second[b]))) == names[b] for b in second if b not in changed)
    assert s.states().count() == 60 and s.states().select("model_id").distinct().count() == 60


def test_timers_fire_by_watermark_without_new_events(spark):
    s = service.LifecycleService(spark, scratch_path(spark, "timers"), 0, "u", buckets=2)
    hour = dt.timedelta(hours=1)
    s.write(frame(spark, [(1, T0, "a", "in_service", None, None, ""), (2, T0 + dt.timedelta(seconds=1), "b", "status", None, None, "")]), 0)
    s.write(frame(spark, [(3, T0 + hour, "b", "status", None, None, ""), (4, T0 + 2 * hour, "b", "status", None, None, "")]), 1)
    timer = s.read("annotated").where("row_type = 'timer'").collect()
    assert [(r.model_id, r.status_after) for r in timer] == [("a", "STOPPED")]
    assert {r.model_id: r.entry_status for r in s.states().collect()}["a"] == "STOPPED"
    s.flush()
    assert s.read("annotated").where("row_type = 'timer'").count() == 1


def test_empty_stream(spark):
    s = service.LifecycleService(spark, scratch_path(spark, "none"), 0, "u")
    assert s.read("annotated").count() == 0 and s.states().count() == 0 and s.commits().count() == 0
    s.write(frame(spark, []), 0)
    s.flush()
    assert s.read("outbox").count() == 0 and s.states().count() == 0 and s.commits().count() == 2


def test_raw_lines(spark):
    good = {"event_id": 1, "time": "2024-01-01 00:00:01.5", "resources": ["arn:x:y/z/m1", "arn:other"], "detail": {"kind": "status", "name": None}}
    lines = [json.dumps(good), json.dumps(good)[:30], "", "no json", json.dumps({**good, "resources": []}), json.dumps({**good, "time": "soon"}),
             json.dumps({**good, "event_id": None}), json.dumps({**good, "more": 1}), "[1]"]
    got = requests.parse_event_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.reason for r in got] == [None, "not a whole line", "not a whole line", "not a whole line", "no model", "no time", "no id or kind", None,
                                       "not a whole line"]
    assert all((r.line is None) == (r.reason is None) for r in got) and [r.line for r in got if r.line is not None][0] == lines[1]
    assert (got[0].event_id, got[0].model_id, got[0].kind, got[0].ts) == (1, "m1", "status", dt.datetime(2024, 1, 1, 0, 0, 1, 500000))
