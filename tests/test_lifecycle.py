"""Lifecycle state machine: hand-written edge cases and a property test that the
epoch-split fold equals one sequential fold over each model's whole history."""

import datetime as dt
import itertools
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewflow.operators import lifecycle as lc

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = "event_id long, ts timestamp_ntz, model_id string, kind string, name string, phone string, text string"


def _events(spark, rows):
    """rows: (seconds after T0, kind[, name, phone, text]) for model m."""
    out = []
    for i, r in enumerate(rows):
        sec, kind = r[0], r[1]
        name = r[2] if len(r) > 2 else "ann"
        phone = r[3] if len(r) > 3 else "855-555-1212"
        txt = r[4] if len(r) > 4 else "{}"
        out.append((i, T0 + dt.timedelta(seconds=sec), "m", kind, name, phone, txt))
    return spark.createDataFrame(out, SCHEMA)


def _run(spark, rows, **kw):
    a = lc.annotate(_events(spark, rows), **kw)
    return sorted(a.collect(), key=lambda r: (r.ts_us, -1 if r.event_id is None else r.event_id))


def test_predict_keeps_alive_until_deadline(spark):
    rows = [(0, "start"), (60, "in_service"), (31 * 60, "predict"), (61 * 60 + 1, "predict")]
    got = [(r.row_type, r.action, r.code) for r in _run(spark, rows)]
    assert got == [("event", "create", 200), ("event", "in_service", None),
                   ("event", "accept", 200),                  # at the deadline: still alive
                   ("timer", "timer", None),                  # fired at 61:00
                   ("event", "unavailable", 404)]


def test_status_extends_only_below_fifteen_minutes(spark):
    rows = [(0, "start"), (0, "in_service"), (15 * 60, "status"), (15 * 60 + 1, "status")]
    r = _run(spark, rows)
    # deadline 30:00; at 15:00 exactly 15 minutes are left -> poll; at 15:01 14:59 -> extend
    assert [x.action for x in r[2:4]] == ["poll", "extend"]
    assert r[3].deadline_us - r[3].ts_us == 30 * 60 * 1_000_000


def test_start_rules(spark):
    rows = [(0, "start", None), (1, "start"), (1, "start"), (2, "in_service"), (3, "start")]
    got = [(r.action, r.code, r.status_after) for r in _run(spark, rows)]
    assert got[:5] == [("invalid", 400, "STOPPED"), ("create", 200, "CREATING"),
                       ("append", 200, "CREATING"), ("in_service", None, "IN_SERVICE"),
                       ("noop", 200, "IN_SERVICE")]


def test_outbox_only_on_first_in_service(spark):
    rows = [(0, "start", "ann"), (5, "start", "cy"), (10, "in_service"), (20, "in_service")]
    a = lc.annotate(_events(spark, rows))
    box = lc.outbox(a, "https://example.org").collect()
    assert sorted(r.name for r in box) == ["ann", "cy"]
    assert {r.in_service_event_id for r in box} == {2}
    assert box[0].message.startswith("Hi ")


def test_no_endpoint_after_in_service_from_stopped(spark):
    rows = [(0, "in_service"), (60, "predict")]
    r = _run(spark, rows)
    assert (r[1].action, r[1].code) == ("unavailable", 404)


def test_shutdown_cases_and_stale_list(spark):
    rows = [(0, "shutdown"), (10, "start", "ann"), (20, "shutdown"), (30, "in_service"), (40, "shutdown")]
    r = _run(spark, rows)
    assert [x.action for x in r] == ["noop", "create", "stop", "in_service", "stop"]
    box = lc.outbox(lc.annotate(_events(spark, rows)), "u").collect()
    assert [b.name for b in box] == ["ann"]      # the list survives the shutdown


def test_stuck_creating_cycles(spark):
    # cycle 1 comes into service after 10 min (not stuck); cycle 2 is stopped after
    # 20 min (stuck, left to STOPPED); cycle 3 never leaves CREATING and is measured to
    # the last event of the log (a status poll 40 min later)
    rows = [(0, "start"), (600, "in_service"), (700, "shutdown"),
            (1000, "start"), (2200, "shutdown"),
            (3000, "start"), (3000 + 40 * 60, "status")]
    got = sorted(lc.stuck_creating(lc.annotate(_events(spark, rows))).collect(), key=lambda r: r.cycle_id)
    assert [(r.cycle_id, r.left_to, r.creating_seconds, r.still_creating) for r in got] == [
        (3, "STOPPED", 1200.0, False), (5, None, 2400.0, True)]
    assert got[1].endpoint_name == f"{lc.ENDPOINT_PREFIX}{int((T0 + dt.timedelta(seconds=3000)).replace(tzinfo=dt.timezone.utc).timestamp())}"


def test_uptime_splits_at_midnight(spark):
    rows = [(-10 * 60, "in_service")]            # 23:50 the day before, fires at 00:20
    up = {str(r.day): r.uptime_seconds for r in lc.uptime_daily(lc.annotate(_events(spark, rows))).collect()}
    assert up == {"2023-12-31": 600.0, "2024-01-01": 1200.0}


# ---- property: epochs + entry resolution + cycles == one sequential fold ----------

KINDS = ["start", "in_service", "status", "predict", "shutdown"]


def _sequential(rows):
    """Reference: fold each model's whole history in one go."""
    out = []
    idle, ext = lc.IDLE_MINUTES * 60_000_000, lc.EXTEND_BELOW_MINUTES * 60_000_000
    by_model = itertools.groupby(sorted(rows, key=lambda r: (r[2], r[1], r[0])), key=lambda r: r[2])
    for model, evs in by_model:
        evs = list(evs)
        state = lc.EndpointState()
        cyc = [None]
        cur = [None]

        def emit(row_type, i, t, before, after, ep_b, ep_a, d_b, d_a, action, code, extended):
            if row_type == "event" and action == "create":
                cyc[0] = cur[0][0]
            out.append((model, row_type, cur[0][0] if row_type == "event" else None, t, before, after,
                        action, code, d_a, cyc[0]))

        for ev in evs:
            cur[0] = ev
            us = int((ev[1] - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
            valid = ev[3] == "start" and bool(ev[4]) and bool(ev[5])
            state.apply(0, us, ev[3], valid, bool(ev[6]), idle, ext, emit)
        if state.status == lc.IN_SERVICE:
            state.expire(state.deadline + 1, emit)
    return sorted(out, key=repr)


event = st.tuples(st.integers(0, 2), st.integers(0, 50 * 60), st.sampled_from(KINDS),
                  st.booleans(), st.booleans())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=60))
def test_epoch_fold_equals_sequential_fold(spark, evs):
    rows, t = [], T0
    for i, (m, gap, kind, has_name, has_text) in enumerate(evs):
        t = t + dt.timedelta(seconds=gap)
        rows.append((i, t, f"m{m}", kind, "n" if has_name else None, "855-555-1212", "{}" if has_text else ""))
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.model_id, r.row_type, r.event_id, r.ts_us, r.status_before, r.status_after,
                   r.action, r.code, r.deadline_us, r.cycle_id)
                  for r in lc.annotate(df, bucket_seconds=300, super_buckets=3).collect()), key=repr)
    assert got == _sequential(rows)


busy = st.tuples(st.just(0), st.integers(0, 16 * 60),
                 st.sampled_from(["status"] * 5 + ["predict"] * 3 + ["start", "in_service", "shutdown"]),
                 st.booleans(), st.booleans())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(busy, min_size=20, max_size=120))
def test_busy_model_chunks_equal_sequential_fold(spark, evs):
    """One never-idle model, mostly polls: deadlines cross many 2-minute chunks, so
    the symbolic deadline intervals of the speculative pass are exercised."""
    rows, t = [], T0
    for i, (m, gap, kind, has_name, has_text) in enumerate(evs):
        t = t + dt.timedelta(seconds=gap)
        rows.append((i, t, "hot", kind, "n" if has_name else None, "855-555-1212", "{}" if has_text else ""))
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.model_id, r.row_type, r.event_id, r.ts_us, r.status_before, r.status_after,
                   r.action, r.code, r.deadline_us, r.cycle_id)
                  for r in lc.annotate(df, bucket_seconds=120, super_buckets=4).collect()), key=repr)
    assert got == _sequential(rows)


def test_speculation_pieces_cover_entries():
    """Every entry state maps to exactly one piece."""
    us = 60_000_000
    evs = [(1, 0, "status", False, True), (2, 5 * us, "status", False, True), (3, 20 * us, "predict", False, True)]
    pieces = lc.speculate_chunk(evs, 30 * us, 15 * us)
    for ptype in ("IT", "IF"):
        spans = sorted((p[1], p[2]) for p in pieces if p[0] == ptype)
        assert spans[0][0] == -(1 << 62) and spans[-1][1] == 1 << 62
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


chunk_events = st.lists(st.tuples(st.integers(0, 25 * 60), st.sampled_from(KINDS), st.booleans(), st.booleans()),
                        min_size=0, max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(chunk_events, min_size=1, max_size=5),
       st.sampled_from([(lc.STOPPED, False), (lc.CREATING, True), (lc.IN_SERVICE, True), (lc.IN_SERVICE, False)]),
       st.integers(-40 * 60, 40 * 60))
def test_composed_maps_equal_stepwise_and_exact(chunks, entry, d_offset):
    """Pure Python: applying chunk maps one by one, applying their composition, and
    folding the events exactly all give the same final state and cycle."""
    us = 1_000_000
    idle, ext = lc.IDLE_MINUTES * 60 * us, lc.EXTEND_BELOW_MINUTES * 60 * us
    t, ev_id, maps, flat = 0, 0, [], []
    for ch in chunks:
        evs = []
        for gap, kind, valid, has_text in ch:
            t += gap * us
            ev_id += 1
            evs.append((ev_id, t, kind, valid, has_text))
        flat.extend(evs)
        maps.append(lc.speculate_chunk(evs, idle, ext) if evs else
                    lc.speculate_chunk([], idle, ext))
    status, has_ep = entry
    # a live deadline lies at most the idle time after the next event
    first = flat[0][1] if flat else 0
    d = min(d_offset * us, first + idle) if status == lc.IN_SERVICE else None
    start = (status, has_ep, d, (None, None))
    step = start
    for m in maps:
        step = lc.apply_map(step, m)
    composed = maps[0]
    for m in maps[1:]:
        composed = lc.compose_maps(composed, m)
    assert lc.apply_map(start, composed) == step
    exact = lc.EndpointState(status, has_ep, d)
    cyc = [None, None]

    def emit(row_type, i, tt, before, after, ep_b, ep_a, d_b, d_a, action, code, extended):
        if action == "create":
            cyc[0], cyc[1] = flat[i][0], tt

    for i, (eid, tt, kind, valid, has_text) in enumerate(flat):
        exact.apply(i, tt, kind, valid, has_text, idle, ext, emit)
    assert (exact.status, exact.has_ep, exact.deadline, tuple(cyc)) == \
        (step[0], step[1], step[2], tuple(step[3]))


def test_fold_is_linear_and_its_map_bounded():
    """100,000 polls, starts or predicts of one model in one hour: seconds, not hours, and
    no more pieces than entry states, however many events there are."""
    us = 1_000_000
    idle, ext = lc.IDLE_MINUTES * 60 * us, lc.EXTEND_BELOW_MINUTES * 60 * us
    for kind in ("status", "start", "predict"):
        began = time.process_time()
        pieces = lc.speculate_chunk(((i, i * 36_000, kind, True, True) for i in range(100_000)), idle, ext)
        assert time.process_time() - began < 60
        assert len(pieces) <= 2 * (lc.IDLE_MINUTES * 60 + 2) + 2


def test_composition_of_many_start_chunks_is_bounded():
    """1,024 chunks of starts only: whatever follows, a map has no more pieces than entry states."""
    us = 1_000_000
    idle, ext = lc.IDLE_MINUTES * 60 * us, lc.EXTEND_BELOW_MINUTES * 60 * us
    began, acc, ev = time.process_time(), None, 0
    for c in range(1024):
        evs = [(ev + k, (c * 600 + 5 * k) * us, "start", True, True) for k in range(116)]
        ev += 116
        m = lc.speculate_chunk(evs, idle, ext)
        acc = m if acc is None else lc.compose_maps(acc, m, idle)
        assert len(acc) <= 2 * (lc.IDLE_MINUTES * 60 + 2) + 2
    assert time.process_time() - began < 60
    for d in (0, 7 * us, 600 * us, idle):
        exact = lc.EndpointState(lc.IN_SERVICE, True, d)
        for c in range(1024):
            for k in range(116):
                exact.apply(0, (c * 600 + 5 * k) * us, "start", True, True, idle, ext)
        got = lc.apply_map((lc.IN_SERVICE, True, d, (None, None)), acc)
        assert got[:3] == (exact.status, exact.has_ep, exact.deadline)


def test_log_in_two_parts_equals_whole(spark):
    """A fold that starts from the states another one ended in."""
    rows, t = [], T0
    for i in range(60):
        t = t + dt.timedelta(minutes=(i * 11) % 37)
        rows.append((i, t, f"m{i % 2}", KINDS[i * i % 5], "ann", "855-555-1212", "{}"))
    df = spark.createDataFrame(rows, SCHEMA)
    whole = lc.annotate(df)
    first = lc.annotate(df.where("event_id < 25"), close=False)
    columns = ["status_after", "has_endpoint_after", "deadline_us", "cycle_id", "cycle_ts_us"]
    end = {}
    for r in sorted(first.collect(), key=lambda r: (r.ts_us, r.event_id is None, r.event_id or 0)):
        end[r.model_id] = tuple(r[c] for c in columns)
    start = spark.createDataFrame([(m, *v) for m, v in end.items()],
                                  "model_id string, " + ", ".join(f"{c} {k}" for c, k in lc.STATE_COLUMNS.items()))
    rest = lc.annotate(df.where("event_id >= 25"), start=start)
    key = ["model_id", "row_type", "event_id", "ts_us", "status_before", "status_after", "action", "code", "deadline_us", "cycle_id"]
    rows_of = lambda d: [tuple(r[c] for c in key) for r in d.collect()]
    assert sorted(rows_of(first) + rows_of(rest), key=repr) == sorted(rows_of(whole), key=repr)


def test_events_without_model_or_time_are_listed(spark):
    rows = [(1, T0, "m", "start", "ann", "855-555-1212", ""), (2, None, "m", "start", "ann", "1", ""), (3, T0, None, "status", None, None, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert lc.annotate(df).where("row_type = 'event'").count() == 1
    assert sorted((r.event_id, r.reason) for r in lc.unplaced(df).collect()) == [(2, "no time"), (3, "no model")]
