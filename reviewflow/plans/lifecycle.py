"""Lifecycle queries over the endpoint event log: transitions, outbox, uptime,
state lookups, responses, cycles and subscriber lists.

The oracle for all of them is one brute-force recursive CTE stepping through each
model's events one at a time (no epochs), so it checks the epoch split as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, model
from ..operators import lifecycle as lc
from ..tables import lifecycle_events, read_table
from .registry import query

L = ("lifecycle_events",)
# Fixed value: the address placed in notifications.
APP_URL = "https://example.org/sentiment"

FOLD_SQL = """
WITH RECURSIVE
ev AS (
  SELECT event_id, ts, model_id, kind, name, phone,
         row_number() OVER (PARTITION BY model_id ORDER BY ts, event_id) AS rn,
         (kind = 'start' AND coalesce(name, '') <> '' AND coalesce(phone, '') <> '') AS valid_start,
         coalesce(text, '') <> '' AS has_text
  FROM lifecycle_events),
fold(model_id, rn, status, has_ep, deadline, timer_at, timer_has_ep, status_before,
     has_ep_before, deadline_before, action, code, extended) AS (
  SELECT model_id, CAST(0 AS BIGINT), 'STOPPED', false, CAST(NULL AS TIMESTAMP),
         CAST(NULL AS TIMESTAMP), false, CAST(NULL AS VARCHAR), false, CAST(NULL AS TIMESTAMP),
         CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), false
  FROM (SELECT DISTINCT model_id FROM ev) m
  UNION ALL
  SELECT x.model_id, x.rn,
    CASE WHEN x.kind = 'start' AND x.valid_start AND x.s0 = 'STOPPED' THEN 'CREATING'
         WHEN x.kind = 'in_service' THEN 'IN_SERVICE'
         WHEN x.kind = 'shutdown' THEN 'STOPPED' ELSE x.s0 END,
    CASE WHEN x.kind = 'start' AND x.valid_start AND x.s0 = 'STOPPED' THEN true
         WHEN x.kind = 'shutdown' THEN false ELSE x.e0 END,
    CASE WHEN x.kind = 'in_service'
           OR (x.kind = 'status' AND x.s0 = 'IN_SERVICE' AND x.d0 - x.ts < INTERVAL 15 MINUTE)
           OR (x.kind = 'predict' AND x.s0 = 'IN_SERVICE' AND x.e0)
         THEN date_trunc('second', x.ts + INTERVAL 30 MINUTE)
         WHEN x.kind = 'shutdown' THEN NULL ELSE x.d0 END,
    x.timer_at, x.timer_has_ep, x.s0, x.e0, x.d0,
    CASE x.kind
      WHEN 'start' THEN CASE WHEN NOT x.valid_start THEN 'invalid' WHEN x.s0 = 'STOPPED' THEN 'create'
                             WHEN x.s0 = 'CREATING' THEN 'append' ELSE 'noop' END
      WHEN 'in_service' THEN 'in_service'
      WHEN 'status' THEN CASE WHEN x.s0 = 'IN_SERVICE' AND x.d0 - x.ts < INTERVAL 15 MINUTE
                              THEN 'extend' ELSE 'poll' END
      WHEN 'predict' THEN CASE WHEN NOT (x.s0 = 'IN_SERVICE' AND x.e0) THEN 'unavailable'
                               WHEN x.has_text THEN 'accept' ELSE 'no_text' END
      WHEN 'shutdown' THEN CASE WHEN x.s0 <> 'STOPPED' THEN 'stop' ELSE 'noop' END
      ELSE 'unknown' END,
    CASE x.kind
      WHEN 'start' THEN CASE WHEN x.valid_start THEN 200 ELSE 400 END
      WHEN 'status' THEN 200
      WHEN 'predict' THEN CASE WHEN NOT (x.s0 = 'IN_SERVICE' AND x.e0) THEN 404
                               WHEN x.has_text THEN 200 ELSE 400 END END,
    (x.kind = 'status' AND x.s0 = 'IN_SERVICE' AND x.d0 - x.ts < INTERVAL 15 MINUTE)
      OR (x.kind = 'predict' AND x.s0 = 'IN_SERVICE' AND x.e0)
  FROM (
    SELECT e.model_id, e.rn, e.ts, e.kind, e.valid_start, e.has_text,
      CASE WHEN f.status = 'IN_SERVICE' AND f.deadline < e.ts THEN f.deadline END AS timer_at,
      CASE WHEN f.status = 'IN_SERVICE' AND f.deadline < e.ts THEN f.has_ep ELSE false END AS timer_has_ep,
      CASE WHEN f.status = 'IN_SERVICE' AND f.deadline < e.ts THEN 'STOPPED' ELSE f.status END AS s0,
      CASE WHEN f.status = 'IN_SERVICE' AND f.deadline < e.ts THEN false ELSE f.has_ep END AS e0,
      CASE WHEN f.status = 'IN_SERVICE' AND f.deadline < e.ts THEN NULL ELSE f.deadline END AS d0
    FROM fold f JOIN ev e ON e.model_id = f.model_id AND e.rn = f.rn + 1) x
),
steps AS (
  SELECT f.*, e.event_id, e.ts, e.kind, e.name, e.phone,
         max(CASE WHEN f.action = 'create' THEN f.rn END)
           OVER (PARTITION BY f.model_id ORDER BY f.rn ROWS UNBOUNDED PRECEDING) AS cyc_rn
  FROM fold f JOIN ev e ON e.model_id = f.model_id AND e.rn = f.rn
  WHERE f.rn > 0),
last_step AS (
  SELECT s.* FROM steps s
  JOIN (SELECT model_id, max(rn) AS rn FROM steps GROUP BY model_id) m
    ON m.model_id = s.model_id AND m.rn = s.rn),
ann AS (
  SELECT model_id, 'event' AS row_type, event_id, ts, kind, name, phone, status_before,
         status AS status_after, has_ep_before AS has_endpoint_before,
         has_ep AS has_endpoint_after, deadline_before, deadline, action, code, extended, cyc_rn
  FROM steps
  UNION ALL
  SELECT s.model_id, 'timer', NULL, s.timer_at, 'timer', NULL, NULL, 'IN_SERVICE', 'STOPPED',
         s.timer_has_ep, false, s.timer_at, NULL, 'timer', NULL, false, p.cyc_rn
  FROM steps s LEFT JOIN steps p ON p.model_id = s.model_id AND p.rn = s.rn - 1
  WHERE s.timer_at IS NOT NULL
  UNION ALL
  SELECT model_id, 'timer', NULL, deadline, 'timer', NULL, NULL, 'IN_SERVICE', 'STOPPED',
         has_ep, false, deadline, NULL, 'timer', NULL, false, cyc_rn
  FROM last_step WHERE status = 'IN_SERVICE'),
annotated AS (
  SELECT a.*, c.event_id AS cycle_id, c.ts AS cycle_ts,
         'sentiment-model-endpoint-' || CAST(epoch_us(c.ts) // 1000000 AS VARCHAR) AS cycle_endpoint
  FROM ann a LEFT JOIN steps c ON c.model_id = a.model_id AND c.rn = a.cyc_rn)"""


def _annotated(spark, sf_dir):
    return lc.annotate(lifecycle_events(spark, sf_dir))


@query("lifecycle_transitions", FOLD_SQL + """
SELECT model_id, ts, event_id, status_before AS from_status, status_after AS to_status,
       kind AS reason,
       CASE WHEN has_endpoint_before OR has_endpoint_after THEN cycle_endpoint END AS endpoint_name
FROM annotated WHERE status_before <> status_after""", L)
def lifecycle_transitions(spark, sf_dir):
    return lc.transitions(_annotated(spark, sf_dir))


@query("uptime_daily", FOLD_SQL + """,
t AS (SELECT * FROM annotated WHERE status_before <> status_after),
spans AS (
  SELECT model_id, status_after, ts AS s,
         lead(ts) OVER (PARTITION BY model_id ORDER BY ts, event_id NULLS FIRST) AS e
  FROM t),
days AS (
  SELECT model_id, s, e,
         CAST(unnest(generate_series(date_trunc('day', s), date_trunc('day', e), INTERVAL 1 DAY)) AS DATE) AS day
  FROM spans WHERE status_after = 'IN_SERVICE'),
agg AS (
  SELECT model_id, day,
         sum(epoch_us(least(e, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY))
             - epoch_us(greatest(s, CAST(day AS TIMESTAMP)))) / 1e6 AS secs
  FROM days GROUP BY model_id, day)
SELECT model_id, day, round(secs, 3) AS uptime_seconds, round(1 - secs / 86400, 6) AS saving
FROM agg""", L)
def uptime_daily(spark, sf_dir):
    return lc.uptime_daily(_annotated(spark, sf_dir))


OUTBOX_SQL = FOLD_SQL + """,
members AS (
  SELECT model_id, cycle_id, event_id AS subscriber_event_id, name, phone FROM annotated
  WHERE row_type = 'event' AND action IN ('create', 'append') AND coalesce(phone, '') <> ''),
served AS (
  SELECT model_id, cycle_id, event_id, ts FROM (
    SELECT model_id, cycle_id, event_id, ts,
           row_number() OVER (PARTITION BY model_id, cycle_id ORDER BY ts, event_id) AS k
    FROM annotated WHERE row_type = 'event' AND kind = 'in_service' AND cycle_id IS NOT NULL) z
  WHERE k = 1)
SELECT m.model_id, s.event_id AS in_service_event_id, s.ts AS notified_at,
       m.subscriber_event_id, m.name, m.phone,
       'Hi ' || coalesce(m.name, 'there') || '. The sentiment analysis model is now available for use for the next 30 minutes here: https://example.org/sentiment' AS message
FROM members m JOIN served s ON s.model_id = m.model_id AND s.cycle_id = m.cycle_id"""


@query("notification_outbox", OUTBOX_SQL, L)
def notification_outbox(spark, sf_dir):
    return lc.outbox(_annotated(spark, sf_dir), APP_URL)


@query("state_lookup", FOLD_SQL + """
SELECT event_id, model_id, kind, status_before,
       CASE WHEN has_endpoint_before THEN cycle_endpoint END AS endpoint_before,
       deadline_before
FROM annotated WHERE row_type = 'event'""", L)
def state_lookup(spark, sf_dir):
    """As-of lookup: the state each event saw when it arrived (after any timer that
    had fired since the previous event of its model)."""
    a = _annotated(spark, sf_dir).where(F.col("row_type") == "event")
    return a.select("event_id", "model_id", "kind", "status_before",
                    F.when(F.col("has_endpoint_before"), lc.endpoint_of_cycle()).alias("endpoint_before"),
                    lc.as_time("deadline_before_us").alias("deadline_before"))


@query("status_response", FOLD_SQL + """
SELECT event_id, model_id, status_before = 'IN_SERVICE' AS is_running,
       CASE WHEN status_before = 'IN_SERVICE' THEN 'IN SERVICE' ELSE 'STOPPED' END AS display,
       extended,
       '{"is_running":' || CASE WHEN status_before = 'IN_SERVICE' THEN 'true' ELSE 'false' END || '}' AS body
FROM annotated WHERE row_type = 'event' AND kind = 'status'""", L)
def status_response(spark, sf_dir):
    a = _annotated(spark, sf_dir).where((F.col("row_type") == "event") & (F.col("kind") == "status"))
    running = F.coalesce(F.col("status_before") == lc.IN_SERVICE, F.lit(False))
    return a.select("event_id", "model_id", running.alias("is_running"),
                    F.when(running, F.lit("IN SERVICE")).otherwise(F.lit("STOPPED")).alias("display"),
                    "extended", F.to_json(F.struct(running.alias("is_running"))).alias("body"))


# The fixed hashed linear model over a request's text.
_SCORED_SQL = """,
logits AS (
  SELECT event_id, list_sum([('0x' || substr(md5(x), 1, 6))::BIGINT % 2001 - 1000 FOR x IN string_split_regex(lower(text), '[^a-z0-9]+') IF x <> '']) / 1000.0 AS z
  FROM lifecycle_events WHERE kind = 'predict' AND text <> ''),
answers AS (
  SELECT event_id, '[{"label":"' || CASE WHEN 1 / (1 + exp(-z)) >= 0.5 THEN 'LABEL_1' ELSE 'LABEL_0' END || '","score":'
         || round(greatest(1 / (1 + exp(-z)), 1 - 1 / (1 + exp(-z))), 6) || '}]' AS answer
  FROM (SELECT event_id, CAST(coalesce(z, 0) AS DOUBLE) AS z FROM logits) l)"""


@query("request_outcomes", FOLD_SQL + _SCORED_SQL + """
SELECT a.event_id, model_id, kind, status_before, code, action AS outcome,
       CASE
         WHEN kind = 'start' AND action = 'invalid' THEN '{"error":"Name and phone number are required."}'
         WHEN kind = 'start' AND action = 'noop' THEN '{"message":"Model is already running and ready for analysis."}'
         WHEN kind = 'start' AND action = 'append' THEN '{"message":"Model is starting up. You will receive an SMS when it is ready."}'
         WHEN kind = 'start' AND action = 'create' THEN '{"message":"Model deployment started. You will receive an SMS when it is ready."}'
         WHEN kind = 'predict' AND action = 'unavailable' THEN '{"error":"Model is not currently running or available."}'
         WHEN kind = 'predict' AND action = 'no_text' THEN '{"error":"Input text is required."}'
         WHEN kind = 'predict' THEN answer
         WHEN kind = 'status' AND status_before = 'IN_SERVICE' THEN '{"is_running":true}'
         WHEN kind = 'status' THEN '{"is_running":false}' END AS body
FROM annotated a LEFT JOIN answers s ON s.event_id = a.event_id
WHERE row_type = 'event' AND kind IN ('start', 'predict', 'status')""", L)
def request_outcomes(spark, sf_dir):
    """Every request with its answer; accepted predicts carry the scored body."""
    texts = lifecycle_events(spark, sf_dir, kinds=("predict",))
    answered = lc.request_bodies(_annotated(spark, sf_dir), texts, lambda df: model.hashed_score(df, "text"))
    return answered.select("event_id", "model_id", "kind", "status_before", "code", F.col("action").alias("outcome"), "body")


@query("predict_answers", FOLD_SQL + _SCORED_SQL + """
SELECT a.event_id, model_id, answer AS body FROM annotated a JOIN answers s ON s.event_id = a.event_id
WHERE row_type = 'event' AND kind = 'predict' AND action = 'accept'""", L)
def predict_answers(spark, sf_dir):
    """Accepted predicts answered by a plug-in model, called on Arrow batches of texts."""
    def plugged(df):
        return model.score_with(df, model.make_hashed_predict, "text").withColumn("score", F.round("score", 6))
    answered = lc.request_bodies(_annotated(spark, sf_dir), lifecycle_events(spark, sf_dir, kinds=("predict",)), plugged)
    return answered.where((F.col("kind") == "predict") & (F.col("action") == "accept")).select("event_id", "model_id", "body")


# Requests of another table: every document asks for a model's state; one model gets half of them and
# some models have no log.
_ASKED_SQL = """
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'model-3' ELSE 'model-' || CAST(doc_id % 12 AS VARCHAR) END AS model_id,
         TIMESTAMP '2024-01-01' + to_seconds(doc_id * 7919 % 2678400) AS asked_at FROM documents"""


@query("asof_state", FOLD_SQL + f""",
asked AS ({_ASKED_SQL}),
known AS (
  SELECT * FROM annotated QUALIFY row_number() OVER (PARTITION BY model_id, ts ORDER BY row_type DESC, event_id DESC) = 1)
SELECT q.doc_id, q.model_id, q.asked_at, k.ts AS known_since, coalesce(k.status_after, 'STOPPED') AS status,
       CASE WHEN k.has_endpoint_after THEN k.cycle_endpoint END AS endpoint_name, k.deadline
FROM asked q ASOF LEFT JOIN known k ON k.model_id = q.model_id AND k.ts <= q.asked_at""", L)
def asof_state(spark, sf_dir):
    """State lookups for requests that aren't rows of the log, each at its own time."""
    d = F.col("doc_id")
    asked = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.when(d % 2 == 0, "model-3").otherwise(F.concat(F.lit("model-"), (d % 12).cast("string"))).alias("model_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=d * 7919 % 2678400)).alias("asked_at"))
    log = _annotated(spark, sf_dir).select(
        "model_id", lc.as_time("ts_us").alias("known_since"), (F.col("row_type") == "timer").alias("timer"), "event_id",
        "status_after", "has_endpoint_after", "deadline_us", "cycle_ts_us")
    found = asof.asof_join(asked, log, "model_id", "asked_at", "known_since", ["timer", "event_id"])
    return found.select("doc_id", "model_id", "asked_at", "known_since", F.coalesce("status_after", F.lit(lc.STOPPED)).alias("status"),
                        F.when(F.col("has_endpoint_after"), lc.endpoint_of_cycle()).alias("endpoint_name"),
                        lc.as_time("deadline_us").alias("deadline"))


_CYCLES_SQL = FOLD_SQL + """,
members AS (
  SELECT model_id, cycle_id, event_id, ts, name, phone, action FROM annotated
  WHERE row_type = 'event' AND action IN ('create', 'append')),
sizes AS (SELECT model_id, cycle_id, count(*) AS n_members FROM members GROUP BY model_id, cycle_id),
served AS (
  SELECT model_id, cycle_id, min(ts) AS in_service_at FROM annotated
  WHERE row_type = 'event' AND kind = 'in_service' AND cycle_id IS NOT NULL
  GROUP BY model_id, cycle_id)"""


@query("first_starter", _CYCLES_SQL + """
SELECT m.model_id, m.cycle_id, m.ts AS created_at, m.name, m.phone,
       'sentiment-model-endpoint-' || CAST(epoch_us(m.ts) // 1000000 AS VARCHAR) AS endpoint_name,
       z.n_members, s.in_service_at
FROM members m JOIN sizes z USING (model_id, cycle_id)
LEFT JOIN served s USING (model_id, cycle_id)
WHERE m.action = 'create'""", L)
def first_starter(spark, sf_dir):
    """First writer wins: the start that moved a STOPPED model to CREATING owns the
    endpoint; later starts of the same cycle are its subscribers."""
    c = lc.cycles(_annotated(spark, sf_dir))
    return c.select("model_id", "cycle_id", lc.as_time("cycle_ts_us").alias("created_at"),
                    F.col("first_name").alias("name"), F.col("first_phone").alias("phone"),
                    lc.endpoint_of_cycle().alias("endpoint_name"), "n_members",
                    lc.as_time("first_in_service.ts_us").alias("in_service_at"))


@query("subscriber_lists", _CYCLES_SQL + """
SELECT model_id, cycle_id, event_id AS subscriber_event_id, ts, name, phone,
       CASE WHEN action = 'create' THEN 'first' ELSE 'joined' END AS role
FROM members""", L)
def subscriber_lists(spark, sf_dir):
    """Subscriber lists as rows keyed by cycle (list append = a member row); a list
    is never gathered into one value, however many people join."""
    a = _annotated(spark, sf_dir).where(
        (F.col("row_type") == "event") & F.col("action").isin("create", "append"))
    return a.select("model_id", "cycle_id", F.col("event_id").alias("subscriber_event_id"),
                    lc.as_time("ts_us").alias("ts"), "name", "phone",
                    F.when(F.col("action") == "create", F.lit("first")).otherwise(F.lit("joined")).alias("role"))


def snapshot_sql(timers: str) -> str:
    """State per model after its last row: its events and the timer rows that ``timers`` admits."""
    return _CYCLES_SQL + f""",
counted AS (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY ts DESC, row_type DESC, event_id DESC) AS newest
  FROM annotated WHERE row_type = 'event' OR {timers}),
latest_event AS (SELECT model_id, arg_max(event_id, (ts, event_id)) AS event_id FROM annotated WHERE row_type = 'event' GROUP BY model_id)
SELECT l.model_id, l.status_after AS status,
       CASE WHEN l.has_endpoint_after THEN l.cycle_endpoint END AS endpoint_name,
       l.deadline, e.event_id AS last_event_id,
       CASE WHEN l.cycle_id IS NOT NULL AND s.in_service_at IS NULL THEN z.n_members ELSE 0 END
         AS pending_subscribers
FROM counted l JOIN latest_event e ON e.model_id = l.model_id
LEFT JOIN sizes z ON z.model_id = l.model_id AND z.cycle_id = l.cycle_id
LEFT JOIN served s ON s.model_id = l.model_id AND s.cycle_id = l.cycle_id
WHERE l.newest = 1"""


# the idle timer fires once an event (of any model) is later than the deadline
SNAPSHOT_SQL = snapshot_sql("ts < (SELECT max(ts) FROM annotated WHERE row_type = 'event')")


@query("state_snapshot", SNAPSHOT_SQL, L)
def state_snapshot(spark, sf_dir):
    """State per model at the log's last time, as the state table would hold it: status
    (timers that fired by then included), endpoint, deadline and the subscribers still waiting."""
    a = _annotated(spark, sf_dir)
    event = F.col("row_type") == "event"
    end = a.where(event).agg(F.max("ts_us")).first()[0]
    rows = a.where(event | (F.col("ts_us") < F.lit(end)))
    last = (rows.groupBy("model_id")
              .agg(F.max(F.struct("ts_us", (~event).alias("timer"), "event_id", "status_after", "has_endpoint_after",
                                  "deadline_us", "cycle_id", "cycle_ts_us")).alias("l"),
                   F.max(F.when(event, F.struct("ts_us", "event_id"))).alias("e"))
              .select("model_id", "l.status_after", "l.has_endpoint_after", "l.deadline_us", "l.cycle_id", "l.cycle_ts_us", "e.event_id"))
    c = lc.cycles(a).select("model_id", "cycle_id", "n_members",
                            F.col("first_in_service").isNull().alias("waiting"))
    j = last.join(c, ["model_id", "cycle_id"], "left")
    pending = F.when(F.col("waiting"), F.col("n_members")).otherwise(F.lit(0)).cast("long")
    return j.select("model_id", F.col("status_after").alias("status"),
                    F.when(F.col("has_endpoint_after"), lc.endpoint_of_cycle()).alias("endpoint_name"),
                    lc.as_time("deadline_us").alias("deadline"), F.col("event_id").alias("last_event_id"),
                    F.coalesce(pending, F.lit(0).cast("long")).alias("pending_subscribers"))


@query("stuck_creating", FOLD_SQL + f""",
created AS (
  SELECT model_id, cycle_id, ts AS created_at, cycle_endpoint FROM annotated
  WHERE row_type = 'event' AND action = 'create'),
left_creating AS (
  SELECT model_id, cycle_id, min(ts) AS left_at, arg_min(status_after, ts) AS left_to FROM annotated
  WHERE status_before = 'CREATING' AND status_after <> 'CREATING'
  GROUP BY model_id, cycle_id),
horizon AS (SELECT max(ts) AS h FROM annotated WHERE row_type = 'event'),
spans AS (
  SELECT c.*, l.left_at, l.left_to,
         epoch_us(coalesce(l.left_at, (SELECT h FROM horizon))) - epoch_us(c.created_at) AS us
  FROM created c LEFT JOIN left_creating l USING (model_id, cycle_id))
SELECT model_id, cycle_id, created_at, cycle_endpoint AS endpoint_name, left_at, left_to,
       round(us / 1e6, 3) AS creating_seconds, left_at IS NULL AS still_creating
FROM spans WHERE us > {lc.STUCK_AFTER_MINUTES} * 60000000""", L)
def stuck_creating(spark, sf_dir):
    """Cycles CREATING longer than the announced start-up time (a failed create is
    never reset); still-creating ones are measured to the end of the log."""
    return lc.stuck_creating(_annotated(spark, sf_dir))
