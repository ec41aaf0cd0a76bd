"""Endpoint lifecycle over the event log (start / in_service / status / predict /
shutdown), per model: status STOPPED -> CREATING -> IN_SERVICE -> STOPPED with an
idle deadline, subscribers, and the responses each request got.

How the sequential fold is split for scale
-------------------------------------------
The state machine is a fold in event order per model, and one model may hold a large
share of all events, so the fold must not run as one task per model. Events are cut
into *chunks* of (model, time bucket), and the fold becomes three passes:

1. **speculate** (per chunk, in parallel): run the chunk from every possible entry
   state at once, as vectors. Status and endpoint flag are finite, and a live deadline
   is one of the whole seconds up to the idle time after the chunk's first event. The
   result is a piecewise map of bounded size: entry state -> exit state (exit deadline
   known, or "unchanged").
2. **resolve** in two levels: the chunk maps of each super-chunk (``super_buckets``
   consecutive buckets) are composed in parallel; super-chunk entries are resolved per
   model in time order from the initial STOPPED state (``super_buckets`` times fewer
   rows than chunks); chunk entries are then resolved inside each super-chunk in
   parallel. No task holds a model's whole history.
3. **annotate** (per chunk, in parallel): fold each chunk exactly from its resolved
   entry, streaming (constant state per chunk, no chunk held in memory).

Endpoint names and subscriber lists are not carried as values: they follow from the
*cycle* (event id and time of the start that created the endpoint), which the three
passes carry like the state (each branch remembers its last creation), and the outbox
and list outputs are joins and aggregates on it.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import present
from ..session import checkpointed
from . import scan

# Status names, idle time and poll threshold, endpoint name prefix.
STOPPED, CREATING, IN_SERVICE = "STOPPED", "CREATING", "IN_SERVICE"
IDLE_MINUTES = 30
EXTEND_BELOW_MINUTES = 15
ENDPOINT_PREFIX = "sentiment-model-endpoint-"

_MIN_US = 60_000_000
_SEC_US = 1_000_000
BUCKET_SECONDS = 3600



def _deadline(t_us: int, idle_us: int) -> int:
    # the schedule text keeps whole seconds, so the timer fires at the truncated time
    return ((t_us + idle_us) // _SEC_US) * _SEC_US


class EndpointState:
    """Mutable state of one model: status, whether an endpoint name is stored, and the
    idle deadline (microseconds, whole seconds). Shared by the batch folds and the
    streaming state function, so both apply identical rules."""

    __slots__ = ("status", "has_ep", "deadline")

    def __init__(self, status: str = STOPPED, has_ep: bool = False, deadline: int | None = None):
        self.status, self.has_ep, self.deadline = status, has_ep, deadline

    def expire(self, now_us: int, emit=None) -> None:
        """Fire the idle timer if its deadline lies before ``now_us``."""
        if self.status == IN_SERVICE and self.deadline < now_us:
            if emit is not None:
                emit("timer", -1, self.deadline, IN_SERVICE, STOPPED, self.has_ep, False,
                     self.deadline, None, "timer", None, False)
            self.status, self.has_ep, self.deadline = STOPPED, False, None

    def apply(self, i: int, t: int, kind: str, valid_start: bool, has_text: bool,
              idle_us: int, extend_us: int, emit=None) -> None:
        self.expire(t, emit)
        before, ep_before, d_before = self.status, self.has_ep, self.deadline
        code, extended = None, False
        if kind == "start":
            code = 200
            if not valid_start:
                action, code = "invalid", 400
            elif self.status == STOPPED:
                self.status, self.has_ep, action = CREATING, True, "create"
            elif self.status == CREATING:
                action = "append"
            else:
                action = "noop"
        elif kind == "in_service":
            self.status, self.deadline, action = IN_SERVICE, _deadline(t, idle_us), "in_service"
        elif kind == "status":
            code = 200
            if self.status == IN_SERVICE and self.deadline - t < extend_us:
                self.deadline, extended, action = _deadline(t, idle_us), True, "extend"
            else:
                action = "poll"
        elif kind == "predict":
            if self.status == IN_SERVICE and self.has_ep:
                self.deadline, extended = _deadline(t, idle_us), True
                action, code = ("accept", 200) if has_text else ("no_text", 400)
            else:
                action, code = "unavailable", 404
        elif kind == "shutdown":
            action = "stop" if self.status != STOPPED else "noop"
            self.status, self.has_ep, self.deadline = STOPPED, False, None
        else:
            action = "unknown"
        if emit is not None:
            emit("event", i, t, before, self.status, ep_before, self.has_ep, d_before, self.deadline,
                 action, code, extended)


_ANN_COLS = ["row_type", "event_id", "ts_us", "kind", "name", "phone", "status_before", "status_after",
             "has_endpoint_before", "has_endpoint_after", "deadline_before_us", "deadline_us",
             "action", "code", "extended"]


def _rows(batches, keys, cols):
    """Yield (key tuple, row dict) for a partition sorted by ``keys`` then time; rows
    stream through, nothing of a chunk is held beyond the current row."""
    for pdf in batches:
        if pdf.empty:
            continue
        kv = [pdf[k].tolist() for k in keys]
        data = {c: pdf[c].tolist() for c in cols}
        for i in range(len(pdf)):
            yield tuple(k[i] for k in kv), {c: data[c][i] for c in cols}


# ---- pass 1: speculative summary of a chunk ------------------------------------------

_LO, _HI = -(1 << 62), 1 << 62
_NONE, _EXACT, _SYM = 0, 1, 2
# entry piece types: STOPPED, CREATING, IN_SERVICE with / without endpoint name
_PIECE_OF = {(STOPPED, False): "S", (CREATING, True): "C", (IN_SERVICE, True): "IT", (IN_SERVICE, False): "IF"}


_S, _C, _I = 0, 1, 2
_STATUS = (STOPPED, CREATING, IN_SERVICE)
_NO_DEADLINE = -(1 << 62)
_PIECE_ROWS = 10_000


class ChunkFold:
    """Folds a chunk's events, as they arrive, from all entry states at once.

    A deadline is a whole second, and one that is live at the chunk's first event lies at
    most the idle time after it, so the entry states are finitely many: STOPPED, CREATING,
    and IN_SERVICE with or without an endpoint name, expired or with one of these seconds
    (1,801 at 30 minutes). They are held as vectors; equal columns are joined from time to
    time. An event costs a few vector operations, whatever came before, and the chunk's map
    has at most as many pieces as there are entry states."""

    def __init__(self, first_us: int, idle_us: int, extend_us: int):
        self.idle_us, self.extend_us = idle_us, extend_us
        live = np.arange(-(-first_us // _SEC_US), (first_us + idle_us) // _SEC_US + 1) * _SEC_US
        k = len(live)
        #: entries: S, C, then (expired, live seconds) with and without an endpoint name
        self.entry = np.concatenate([[_NO_DEADLINE] * 3, live, [_NO_DEADLINE], live])
        self.low = np.concatenate([[_LO] * 3, live, [_LO], live])
        self.kind = np.repeat([0, 1, 2, 3], [1, 1, k + 1, k + 1])
        live_at = self.entry != _NO_DEADLINE
        self.status = np.where(live_at, _I, np.where(self.kind == 1, _C, _S))
        self.has_ep = live_at & (self.kind == 2) | (self.kind == 1)
        self.deadline = self.entry.copy()
        self.cycle = np.full(len(self.entry), -1)       # position in ``created``; -1: the entry's
        self.created: list[tuple[int, int]] = []
        self.owner = np.arange(len(self.entry))         # entry -> column
        self.steps, self.wait = 0, 16

    def step(self, ev_id: int, t: int, kind: str, valid: bool) -> None:
        gone = (self.status == _I) & (self.deadline < t)
        if gone.any():                                  # the timer first, then the event
            self._stop(gone)
        if kind == "start" and valid:
            new = self.status == _S
            if new.any():
                self.status[new], self.has_ep[new], self.cycle[new] = _C, True, len(self.created)
                self.created.append((ev_id, t))
        elif kind == "in_service":
            self.status[:], self.deadline[:] = _I, _deadline(t, self.idle_us)
        elif kind == "status":
            self.deadline[(self.status == _I) & (self.deadline - t < self.extend_us)] = _deadline(t, self.idle_us)
        elif kind == "predict":
            self.deadline[(self.status == _I) & self.has_ep] = _deadline(t, self.idle_us)
        elif kind == "shutdown":
            self._stop(slice(None))
        self.steps += 1
        if self.steps >= self.wait and len(self.status) > 1:
            self._join()

    def _stop(self, where) -> None:
        self.status[where], self.has_ep[where], self.deadline[where] = _S, False, _NO_DEADLINE

    def _join(self) -> None:
        columns = np.stack([self.status, self.has_ep, self.deadline, self.cycle])
        order = np.lexsort(columns)
        differ = np.r_[True, (columns[:, order[1:]] != columns[:, order[:-1]]).any(0)]
        name = np.empty(len(order), int)
        name[order] = np.cumsum(differ) - 1
        keep = order[differ]
        shrunk = len(keep) < 0.9 * len(order)
        if len(keep) < len(order):
            self.owner = name[self.owner]
            self.status, self.has_ep = self.status[keep], self.has_ep[keep]
            self.deadline, self.cycle = self.deadline[keep], self.cycle[keep]
        self.steps, self.wait = 0, 16 if shrunk else min(2 * self.wait, 1024)

    def pieces(self) -> list[tuple]:
        """``(piece_type, lo, hi, exit_status, exit_has_ep, exit_dkind, exit_deadline,
        exit_cycle)``; a deadline that is the entry's is symbolic, neighbouring entries with
        the same exit are one piece."""
        st, ep, d, cyc = (x[self.owner] for x in (self.status, self.has_ep, self.deadline, self.cycle))
        same = (st == _I) & (d == self.entry)
        shown = np.where(same, 1, d)                    # no whole second in microseconds is 1
        rows = np.stack([self.kind, st, ep, shown, cyc])
        heads = np.flatnonzero(np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(0)])
        names, out = ("S", "C", "IT", "IF"), []
        for i, nxt in zip(heads.tolist(), [*heads[1:].tolist(), len(st)]):
            last_of_kind = nxt == len(st) or self.kind[nxt] != self.kind[i]
            dk = _SYM if same[i] else _EXACT if st[i] == _I else _NONE
            out.append((names[self.kind[i]], int(self.low[i]), _HI if last_of_kind else int(self.low[nxt]),
                        _STATUS[st[i]], bool(ep[i]), dk, int(d[i]) if dk == _EXACT else None,
                        self.created[cyc[i]] if cyc[i] >= 0 else None))
        return out


def identity_map() -> list[tuple]:
    """The map of a chunk without events."""
    return [("S", _LO, _HI, STOPPED, False, _NONE, None, None), ("C", _LO, _HI, CREATING, True, _NONE, None, None),
            ("IT", _LO, _HI, IN_SERVICE, True, _SYM, None, None), ("IF", _LO, _HI, IN_SERVICE, False, _SYM, None, None)]


def speculate_chunk(events, idle_us: int, extend_us: int) -> list[tuple]:
    """The map of one chunk's events ``(event_id, ts, kind, valid_start, has_text)`` in time order."""
    fold = None
    for ev_id, t, kind, valid, _ in events:
        fold = fold or ChunkFold(t, idle_us, extend_us)
        fold.step(ev_id, t, kind, valid)
    return fold.pieces() if fold else identity_map()


_PIECE_COLS = ["piece", "lo", "hi", "exit_status", "exit_has_ep", "exit_dkind", "exit_deadline",
               "exit_cycle_id", "exit_cycle_ts"]
_SPEC_SCHEMA = ("model_id string, bucket long, piece string, lo long, hi long, exit_status string, "
                "exit_has_ep boolean, exit_dkind int, exit_deadline long, exit_cycle_id long, "
                "exit_cycle_ts long")


def _speculate_fn(idle_us: int, extend_us: int):
    cols = ["event_id", "ts_us", "kind", "valid_start"]
    names = ["model_id", "bucket", *_PIECE_COLS]

    def run(batches):
        rows, key, fold = [], None, None

        def close():
            rows.extend(key + p[:7] + (p[7] or (None, None)) for p in fold.pieces())

        def frame():
            return _piece_frame(dict(zip(names, map(list, zip(*rows)))))

        for pdf in batches:
            for m, b, i, t, kind, valid in zip(*(pdf[c].tolist() for c in ["model_id", "bucket", *cols])):
                if (m, b) != key:
                    if fold is not None:
                        close()
                    if len(rows) >= _PIECE_ROWS:
                        yield frame()
                        rows.clear()
                    key, fold = (m, b), ChunkFold(t, idle_us, extend_us)
                fold.step(i, t, kind, valid)
        if fold is not None:
            close()
            yield frame()
    return run


# ---- pass 2: resolve entries per model ------------------------------------------------

_ENTRY_SCHEMA = ("model_id string, bucket long, entry_status string, entry_has_ep boolean, "
                 "entry_deadline long, entry_cycle_id long, entry_cycle_ts long, is_last boolean")
_SUPER_SCHEMA = _SPEC_SCHEMA.replace("bucket long", "super long")
_SUPER_ENTRY_SCHEMA = _ENTRY_SCHEMA.replace("bucket long", "super long")


_START = (STOPPED, False, None, (None, None))   # status, has_ep, deadline, cycle


def apply_map(state, pieces):
    """The state after a chunk (or a run of chunks) whose map is ``pieces``."""
    status, has_ep, d, cyc = state
    ptype = _PIECE_OF[(status, has_ep)]
    for p in pieces:
        if p[0] == ptype and (ptype in ("S", "C") or p[1] <= d < p[2]):
            _, _, _, xs, xe, xk, xd, xc = p
            if xk != _SYM:
                d = xd if xk == _EXACT else None
            return xs, xe, d, xc if xc is not None else cyc
    raise AssertionError(f"no speculative piece for entry {(status, has_ep, d)}")


def compose_maps(f, g, cap: int = _HI):
    """Map of 'f, then g' for piecewise maps (pieces as in ``speculate_chunk``).

    ``cap``: no deadline at f's entry lies above it (the idle time after f's first event).
    What f leaves symbolic isn't split beyond it, so a composition of any number of maps has no more
    pieces than there are whole seconds up to ``cap``."""
    after: dict[str, list] = {}
    for p in sorted(g, key=lambda p: p[1]):
        after.setdefault(p[0], []).append(p)
    lows = {k: [p[1] for p in v] for k, v in after.items()}
    out = []
    for pt, lo, hi, xs, xe, xk, xd, xc in f:
        qt = _PIECE_OF[(xs, xe)]
        later = after[qt]
        if xk == _SYM:                      # f leaves the entry deadline in place: g's pieces split [lo, hi)
            k = bisect_right(lows[qt], lo) - 1
            last = max(k, bisect_right(lows[qt], min(hi - 1, cap)) - 1)
            for i in range(k, last + 1):
                _, qlo, qhi, ys, ye, yk, yd, yc = later[i]
                out.append((pt, max(lo, qlo), hi if i == last else qhi, ys, ye, yk, yd, yc if yc is not None else xc))
        else:
            _, _, _, ys, ye, yk, yd, yc = later[bisect_right(lows[qt], xd) - 1 if qt in ("IT", "IF") else 0]
            if yk == _SYM:                  # g keeps f's known deadline
                yk, yd = _EXACT, xd
            out.append((pt, lo, hi, ys, ye, yk, yd, yc if yc is not None else xc))
    # neighbours with the same exit are one piece
    out.sort(key=lambda p: (p[0], p[1]))
    joined = []
    for p in out:
        if joined and joined[-1][0] == p[0] and joined[-1][2] == p[1] and joined[-1][3:] == p[3:]:
            joined[-1] = (p[0], joined[-1][1], *p[2:])
        else:
            joined.append(p)
    return joined


def resolve_chunks(chunks, start=_START):
    """``chunks``: ordered list of (bucket, pieces). Entry state of every chunk from
    ``start``; rows are ``[bucket, status, has_ep, deadline, cycle_id, cycle_ts, False]``."""
    state = start
    out = []
    for bucket, pieces in chunks:
        out.append([bucket, state[0], state[1], state[2], state[3][0], state[3][1], False])
        state = apply_map(state, pieces)
    return out


_ENTRY_COLS = ["entry_status", "entry_has_ep", "entry_deadline", "entry_cycle_id", "entry_cycle_ts"]


def _opt(v):
    return None if v is None or pd.isna(v) else int(v)


def _piece(r):
    cid = _opt(r["exit_cycle_id"])
    return (r["piece"], r["lo"], r["hi"], r["exit_status"], r["exit_has_ep"], r["exit_dkind"],
            _opt(r["exit_deadline"]), None if cid is None else (cid, _opt(r["exit_cycle_ts"])))


def _piece_frame(out):
    res = pd.DataFrame(out)
    for c in ("exit_deadline", "exit_cycle_id", "exit_cycle_ts"):
        res[c] = res[c].astype("Int64")
    return res


def _entry_frame(out):
    res = pd.DataFrame(out)
    for c in ("entry_deadline", "entry_cycle_id", "entry_cycle_ts"):
        res[c] = res[c].astype("Int64")
    return res


def _groups_of(batches, group_keys, order_key, cols):
    """Yield (group key, [(order value, [row, ...]), ...]) for sorted partitions."""
    key, runs = None, []
    for k, r in _rows(batches, group_keys + [order_key], cols):
        g, o = k[:-1], k[-1]
        if g != key:
            if key is not None:
                yield key, runs
            key, runs = g, []
        if not runs or runs[-1][0] != o:
            runs.append((o, []))
        runs[-1][1].append(r)
    if key is not None:
        yield key, runs


def _compose_fn(bucket_us: int, idle_us: int):
    """Per (model, super): the composed map of its chunks in bucket order."""
    def run(batches):
        out = {c: [] for c in ["model_id", "super"] + _PIECE_COLS}
        for (model, sup), runs in _groups_of(batches, ["model_id", "super"], "bucket", _PIECE_COLS):
            acc, cap = None, (runs[0][0] + 1) * bucket_us + idle_us
            for _, rows in runs:
                m = [_piece(r) for r in rows]
                acc = m if acc is None else compose_maps(acc, m, cap)
            for p in acc:
                cyc = p[7] or (None, None)
                for c, v in zip(out, (model, sup) + p[:7] + cyc):
                    out[c].append(v)
        if out["model_id"]:
            yield _piece_frame(out)
    return run


def _state(r):
    return r["entry_status"], bool(r["entry_has_ep"]), _opt(r["entry_deadline"]), (_opt(r["entry_cycle_id"]), _opt(r["entry_cycle_ts"]))


def _resolve_supers_fn(close: bool):
    """Per model: entry state of each super-chunk (one row per super, in order)."""
    def run(batches):
        out = {c: [] for c in ["model_id", "super"] + _ENTRY_COLS + ["is_last"]}
        for (model,), runs in _groups_of(batches, ["model_id"], "super", _PIECE_COLS + _ENTRY_COLS):
            first = runs[0][1][0]
            start = _START if first["entry_status"] is None else _state(first)
            rows = resolve_chunks([(sup, [_piece(r) for r in rs]) for sup, rs in runs], start)
            rows[-1][6] = close
            for row in rows:
                for c, v in zip(out, [model] + row):
                    out[c].append(v)
        if out["model_id"]:
            yield _entry_frame(out)
    return run


def _resolve_within_fn():
    """Per (model, super): entry state of each chunk, starting from the super's entry."""
    cols = _PIECE_COLS + _ENTRY_COLS + ["is_last"]

    def run(batches):
        out = {c: [] for c in ["model_id", "bucket"] + _ENTRY_COLS + ["is_last"]}
        for (model, _sup), runs in _groups_of(batches, ["model_id", "super"], "bucket", cols):
            r0 = runs[0][1][0]
            start = _state(r0)
            rows = resolve_chunks([(b, [_piece(r) for r in rs]) for b, rs in runs], start)
            rows[-1][6] = bool(r0["is_last"])
            for row in rows:
                for c, v in zip(out, [model] + row):
                    out[c].append(v)
        if out["model_id"]:
            yield _entry_frame(out)
    return run


# ---- pass 3: exact annotation per chunk ---------------------------------------------

def _annotate_fn(idle_us: int, extend_us: int):
    cols = ["event_id", "ts_us", "kind", "name", "phone", "valid_start", "has_text",
            "entry_status", "entry_has_ep", "entry_deadline", "entry_cycle_id", "entry_cycle_ts", "is_last"]

    def frame(out):
        res = pd.DataFrame(out)
        for c in ("event_id", "deadline_before_us", "deadline_us", "cycle_id", "cycle_ts_us"):
            res[c] = res[c].astype("Int64")
        res["code"] = res["code"].astype("Int32")
        return res

    def run(batches):
        out = {c: [] for c in ["model_id", "bucket"] + _ANN_COLS + ["cycle_id", "cycle_ts_us"]}
        key, st, last, cur, cyc = None, None, False, {}, [None, None]

        def emit(row_type, i, t, before, after, ep_b, ep_a, d_b, d_a, action, code, extended):
            ev = i >= 0
            if ev and action == "create":
                cyc[0], cyc[1] = cur["event_id"], t
            vals = key + (row_type, cur["event_id"] if ev else None, t, cur["kind"] if ev else "timer",
                          cur["name"] if ev else None, cur["phone"] if ev else None, before, after,
                          ep_b, ep_a, d_b, d_a, action, code, extended, cyc[0], cyc[1])
            for c, v in zip(out, vals):
                out[c].append(v)

        def close():
            if last and st.status == IN_SERVICE:       # after a model's last event
                st.expire(st.deadline + 1, emit)

        for k, r in _rows(batches, ["model_id", "bucket"], cols):
            if k != key:
                if key is not None:
                    close()
                key = k
                d0 = r["entry_deadline"]
                st = EndpointState(r["entry_status"], bool(r["entry_has_ep"]), None if pd.isna(d0) else int(d0))
                last = bool(r["is_last"])
                c0, c1 = r["entry_cycle_id"], r["entry_cycle_ts"]
                cyc = [None if pd.isna(c0) else int(c0), None if pd.isna(c1) else int(c1)]
            cur = r
            st.apply(0, r["ts_us"], r["kind"], r["valid_start"], r["has_text"], idle_us, extend_us, emit)
            if len(out["model_id"]) >= 10_000:
                yield frame(out)
                out = {c: [] for c in out}
        if key is not None:
            close()
        if out["model_id"]:
            yield frame(out)
    return run


ANNOTATED_SCHEMA = (
    "model_id string, bucket long, row_type string, event_id long, ts_us long, kind string, "
    "name string, phone string, status_before string, status_after string, "
    "has_endpoint_before boolean, has_endpoint_after boolean, deadline_before_us long, "
    "deadline_us long, action string, code int, extended boolean, cycle_id long, cycle_ts_us long")


def _prepared(events: DataFrame, bucket_seconds: int) -> DataFrame:
    return events.select(
        "model_id", "event_id", "kind", "name", "phone",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        ((F.col("kind") == "start") & present("name") & present("phone")).alias("valid_start"),
        present("text").alias("has_text"),
        scan.time_bucket("ts", bucket_seconds).alias("bucket"))


def _pass_partitions(spark) -> int | None:
    """Partition count for the shuffles that feed the Python chunk passes. AQE would
    coalesce them by bytes, but these passes cost CPU per row, not per byte, so they
    keep the session's shuffle partition count (sized for the data by the cluster)."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return None


def _by(df: DataFrame, n: int | None, *cols: str) -> DataFrame:
    return df.repartition(n, *cols) if n else df.repartition(*cols)


#: State of a model between two logs, as ``annotate`` takes it.
STATE_COLUMNS = {"entry_status": "string", "entry_has_ep": "boolean", "entry_deadline": "long", "entry_cycle_id": "long", "entry_cycle_ts": "long"}


def unplaced(events: DataFrame) -> DataFrame:
    """The events that ``annotate`` can't place, with the reason: no model or no time."""
    reason = F.when(F.col("model_id").isNull(), "no model").when(F.col("ts").isNull(), "no time")
    return events.withColumn("reason", reason).where(F.col("reason").isNotNull())


# Buckets per super-chunk in the two-level resolution of pass 2.
SUPER_BUCKETS = 1024


def annotate(events: DataFrame, idle_minutes: int = IDLE_MINUTES,
             extend_below_minutes: int = EXTEND_BELOW_MINUTES,
             bucket_seconds: int = BUCKET_SECONDS,
             super_buckets: int = SUPER_BUCKETS, start: DataFrame | None = None, close: bool = True) -> DataFrame:
    """One row per event (``row_type='event'``) and per timer firing (``'timer'``)
    with the status before and after, the response code and action, the deadline
    and the creating cycle (``cycle_id``, ``cycle_ts_us``) it belongs to.

    ``bucket_seconds`` sets the chunk width: pick it so that a chunk of the busiest
    model fits a task comfortably (e.g. 60 s at millions of events per hour).

    ``start`` (model_id and the entry columns of ``STATE_COLUMNS``, a row a model) gives the state
    that models are in before the first of ``events``; without it, and without a row, a
    model is STOPPED. ``close=False`` leaves out the timer after a model's last event, for logs that go on.
    Events without a model or a time have no place in the order: see ``unplaced``."""
    idle_us, extend_us = idle_minutes * _MIN_US, extend_below_minutes * _MIN_US
    order = ["model_id", "bucket", "ts_us", "event_id"]
    # materialised once (lineage cut in the shared checkpoint folder), hash-partitioned
    # by chunk and sorted, so both chunk passes stream contiguous chunks
    n = _pass_partitions(events.sparkSession)
    placed = events.where(F.col("model_id").isNotNull() & F.col("ts").isNotNull())
    staged = _by(_prepared(placed, bucket_seconds), n, "model_id", "bucket").sortWithinPartitions(*order)
    staged = checkpointed(staged)
    pieces = (staged.select("model_id", "bucket", "event_id", "ts_us", "kind", "valid_start", "has_text")
                    .mapInPandas(_speculate_fn(idle_us, extend_us), _SPEC_SCHEMA)
                    .withColumn("super", F.floor(F.col("bucket") / F.lit(super_buckets)).cast("long")))
    pieces = checkpointed(pieces)
    # pass 2 in two levels, so no task sees a whole model: compose the chunk maps of
    # each super-chunk, resolve super-chunk entries per model (super_buckets times
    # fewer rows), then resolve chunk entries inside each super-chunk
    supers = (_by(pieces, n, "model_id", "super").sortWithinPartitions("model_id", "super", "bucket")
                    .mapInPandas(_compose_fn(bucket_seconds * _SEC_US, idle_us), _SUPER_SCHEMA))
    if start is None:
        supers = supers.select("*", *(F.lit(None).cast(t).alias(c) for c, t in STATE_COLUMNS.items()))
    else:
        supers = supers.join(start.select("model_id", *STATE_COLUMNS), "model_id", "left")
    super_entries = checkpointed(supers.repartition("model_id").sortWithinPartitions("model_id", "super")
                                 .mapInPandas(_resolve_supers_fn(close), _SUPER_ENTRY_SCHEMA))
    seeded = pieces.join(super_entries, ["model_id", "super"])
    entries = (_by(seeded, n, "model_id", "super").sortWithinPartitions("model_id", "super", "bucket")
                     .mapInPandas(_resolve_within_fn(), _ENTRY_SCHEMA))
    entries = checkpointed(entries)
    joined = _by(staged.join(entries, ["model_id", "bucket"]), n, "model_id", "bucket").sortWithinPartitions(*order)
    rows = joined.select("model_id", "bucket", "event_id", "ts_us", "kind", "name", "phone", "valid_start",
                         "has_text", "entry_status", "entry_has_ep", "entry_deadline", "entry_cycle_id",
                         "entry_cycle_ts", "is_last") \
                 .mapInPandas(_annotate_fn(idle_us, extend_us), ANNOTATED_SCHEMA)
    # timer rows keep the bucket of the chunk that fired them; later scans order by time
    out = rows.withColumn("bucket", F.floor(F.col("ts_us") / F.lit(bucket_seconds * _SEC_US)).cast("long"))
    # the annotated log feeds several outputs (outbox, cycles, snapshot, uptime); it is
    # written once rather than re-folded by each consumer
    return checkpointed(out)


def as_time(us_col: str) -> F.Column:
    return F.timestamp_micros(F.col(us_col)).cast("timestamp_ntz")


def endpoint_of_cycle() -> F.Column:
    return F.concat(F.lit(ENDPOINT_PREFIX), F.floor(F.col("cycle_ts_us") / _SEC_US).cast("string"))


def transitions(annotated: DataFrame) -> DataFrame:
    """Status changes: ``model_id, ts, event_id, from_status, to_status, reason,
    endpoint_name`` (reason is the event kind, or ``timer``)."""
    changed = annotated.where(F.col("status_before") != F.col("status_after"))
    ep = F.when(F.col("has_endpoint_before") | F.col("has_endpoint_after"), endpoint_of_cycle())
    return changed.select("model_id", as_time("ts_us").alias("ts"), "event_id",
                          F.col("status_before").alias("from_status"),
                          F.col("status_after").alias("to_status"),
                          F.col("kind").alias("reason"), ep.alias("endpoint_name"))


def uptime_daily(annotated: DataFrame) -> DataFrame:
    """Seconds IN_SERVICE per model and UTC day, and the saving against always-on.

    A span ends at the model's next transition, found by an ordered scan per
    (model, bucket) with a per-bucket summary (no window over a whole model)."""
    t = annotated.where(F.col("status_before") != F.col("status_after"))
    t = scan.previous_values(t, ["model_id"], ["ts_us", "event_id"], "bucket", ["ts_us"],
                             prefix="next_", reverse=True)
    spans = (t.withColumnRenamed("next_ts_us", "end_us")
              .where(F.col("status_after") == IN_SERVICE)
              .select("model_id", as_time("ts_us").alias("s"), as_time("end_us").alias("e")))
    days = spans.withColumn("day", F.explode(F.sequence(F.to_date("s"), F.to_date("e"))))
    start = F.greatest(F.col("s"), F.col("day").cast("timestamp_ntz"))
    end = F.least(F.col("e"), F.date_add("day", 1).cast("timestamp_ntz"))
    secs = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)
    return (days.groupBy("model_id", "day").agg(F.sum(secs).alias("uptime_seconds"))
                .select("model_id", "day", F.round("uptime_seconds", 3).alias("uptime_seconds"),
                        F.round(1 - F.col("uptime_seconds") / 86400, 6).alias("saving")))


def cycles(annotated: DataFrame) -> DataFrame:
    """One row per creating cycle: the first starter, the members, and when (if ever)
    the endpoint came into service for them."""
    ev = annotated.where(F.col("row_type") == "event")
    members = ev.where(F.col("action").isin("create", "append"))
    firsts = members.where(F.col("action") == "create").select(
        "model_id", "cycle_id", "cycle_ts_us",
        F.col("name").alias("first_name"), F.col("phone").alias("first_phone"))
    sizes = members.groupBy("model_id", "cycle_id").agg(F.count(F.lit(1)).alias("n_members"))
    served = (ev.where((F.col("kind") == "in_service") & F.col("cycle_id").isNotNull())
                .groupBy("model_id", "cycle_id")
                .agg(F.min(F.struct("ts_us", "event_id")).alias("first_in_service")))
    return (firsts.join(sizes, ["model_id", "cycle_id"])
                  .join(served, ["model_id", "cycle_id"], "left"))


# Fixed value: the longest start-up the service announces ("5-15 minutes").
STUCK_AFTER_MINUTES = 15


def stuck_creating(annotated: DataFrame, after_minutes: int = STUCK_AFTER_MINUTES) -> DataFrame:
    """Creating cycles that stayed CREATING longer than ``after_minutes``: a failed
    create is never reset, so the model would stay CREATING for good.

    A cycle leaves CREATING once (in service, or an explicit stop); one still creating
    is measured up to the last event of the log (the observation time, a scalar
    subquery). Keyed by cycle, so a busy model's cycles spread over tasks."""
    ev = annotated.where(F.col("row_type") == "event")
    created = ev.where(F.col("action") == "create").select("model_id", "cycle_id", "cycle_ts_us")
    left = (annotated.where((F.col("status_before") == CREATING) & (F.col("status_after") != CREATING))
                     .groupBy("model_id", "cycle_id")
                     .agg(F.min(F.struct("ts_us", "event_id", "status_after")).alias("l")))
    horizon = ev.agg(F.max("ts_us")).scalar()
    j = (created.join(left, ["model_id", "cycle_id"], "left")
                .withColumn("__us", F.coalesce(F.col("l.ts_us"), horizon) - F.col("cycle_ts_us")))
    secs = F.col("__us") / F.lit(float(_SEC_US))
    return (j.where(F.col("__us") > F.lit(after_minutes * _MIN_US))
             .select("model_id", "cycle_id", as_time("cycle_ts_us").alias("created_at"),
                     endpoint_of_cycle().alias("endpoint_name"),
                     as_time("l.ts_us").alias("left_at"), F.col("l.status_after").alias("left_to"),
                     F.round(secs, 3).alias("creating_seconds"),
                     F.col("l").isNull().alias("still_creating")))


# Response messages of the start and predict handlers.
START_MESSAGES = {
    "invalid": "Name and phone number are required.",
    "noop": "Model is already running and ready for analysis.",
    "append": "Model is starting up. You will receive an SMS when it is ready.",
    "create": "Model deployment started. You will receive an SMS when it is ready.",
}
PREDICT_ERRORS = {
    "unavailable": "Model is not currently running or available.",
    "no_text": "Input text is required.",
}
# Fixed value: the subscriber notification; %s is the name (``there`` when
# missing), %d the idle minutes, the last %s the application address.
NOTIFY_TEMPLATE = "Hi %s. The sentiment analysis model is now available for use for the next %d minutes here: %s"
DEFAULT_NAME = "there"


def outbox(annotated: DataFrame, app_url: str) -> DataFrame:
    """One message per subscriber with a phone, at the first in-service event after
    the list was started; members join the list through their cycle id."""
    ev = annotated.where(F.col("row_type") == "event")
    members = ev.where(F.col("action").isin("create", "append") & present("phone")).select(
        "model_id", "cycle_id", F.col("event_id").alias("subscriber_event_id"), "name", "phone")
    first_served = (ev.where((F.col("kind") == "in_service") & F.col("cycle_id").isNotNull())
                      .groupBy("model_id", "cycle_id")
                      .agg(F.min(F.struct("ts_us", "event_id")).alias("f")))
    return messages(members.join(first_served, ["model_id", "cycle_id"]), app_url).drop("cycle_id")


def messages(served_members: DataFrame, app_url: str) -> DataFrame:
    """The notification of each subscriber, given with the in-service event ``f`` (ts_us, event_id) of the cycle."""
    name = F.coalesce(F.col("name"), F.lit(DEFAULT_NAME))
    return served_members.select(
        "model_id", F.col("f.event_id").alias("in_service_event_id"), as_time("f.ts_us").alias("notified_at"),
        "subscriber_event_id", "name", "phone",
        F.format_string(NOTIFY_TEMPLATE, name, F.lit(IDLE_MINUTES), F.lit(app_url)).alias("message"), "cycle_id")


def request_bodies(annotated: DataFrame, texts: DataFrame, scorer) -> DataFrame:
    """The requests (start, predict, status) of an annotated log with the body that each was answered with.

    Accepted predicts meet their text (``texts``: event_id, text) and go through ``scorer``, a function
    that adds ``label_code`` and ``score`` to a frame with a ``text`` column (a fitted pipeline, a plug-in
    model in Arrow batches, or expressions); their body is the endpoint's answer ``[{label, score}]``."""
    asked = annotated.where((F.col("row_type") == "event") & F.col("kind").isin("start", "predict", "status"))
    message = F.lit(None).cast("string")
    for (kind, key), texts_of in {("start", "message"): START_MESSAGES, ("predict", "error"): PREDICT_ERRORS}.items():
        for action, said in texts_of.items():
            named = "error" if action == "invalid" else key
            message = F.when((F.col("kind") == kind) & (F.col("action") == action), F.to_json(F.struct(F.lit(said).alias(named)))).otherwise(message)
    body = F.when(F.col("kind") == "status", F.to_json(F.struct((F.col("status_before") == IN_SERVICE).alias("is_running")))).otherwise(message)
    accepted = (F.col("kind") == "predict") & (F.col("action") == "accept")
    scored = scorer(asked.where(accepted).join(texts.select("event_id", "text"), "event_id"))
    answer = F.to_json(F.array(F.struct(F.col("label_code").alias("label"), F.col("score").alias("score"))))
    return asked.where(~accepted).withColumn("body", body).unionByName(scored.withColumn("body", answer).select(*asked.columns, "body"))
