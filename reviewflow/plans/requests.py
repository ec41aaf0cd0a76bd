"""Request parsing and validation, phone checks, deadline and schedule text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timefmt
from ..functions.phone import phone_digits, phone_ok
from ..functions.text import first_element, nonblank, present, utrim
from ..sources import requests as rq
from ..tables import lifecycle_events, read_table
from .registry import query

L = ("lifecycle_events",)
# Endpoint name prefix and the ARN layout of a platform event.
ENDPOINT_PREFIX = "sentiment-model-endpoint-"
ARN_PREFIX = "arn:cloud:ml:region-1:000000000000:endpoint/"


def platform_events(spark, sf_dir):
    """One platform event per lifecycle event; shutdown events carry no resource."""
    ev = lifecycle_events(spark, sf_dir)
    arn = F.concat(F.lit(ARN_PREFIX), F.lit(ENDPOINT_PREFIX), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    body = F.when(F.col("kind") == "shutdown", F.to_json(F.struct(F.array().cast("array<string>").alias("resources")))) \
            .otherwise(F.to_json(F.struct(F.array(arn).alias("resources"))))
    return ev.select("event_id", body.alias("event_json"))


@query("parse_platform_event", """
WITH e AS (
  SELECT event_id,
         CASE WHEN kind = 'shutdown' THEN NULL
              ELSE 'arn:cloud:ml:region-1:000000000000:endpoint/sentiment-model-endpoint-'
                   || CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS arn
  FROM lifecycle_events)
SELECT event_id, string_split(arn, '/')[-1] AS endpoint_name,
       string_split(arn, ':')[5] AS account FROM e""", L)
def parse_platform_event(spark, sf_dir):
    pe = platform_events(spark, sf_dir)
    arn = first_element(F.from_json("event_json", rq.PLATFORM_EVENT)["resources"])
    return pe.select("event_id", rq.resource_name("event_json").alias("endpoint_name"),
                     rq.arn_field(arn, 4).alias("account"))


def request_bodies(spark, sf_dir):
    """start -> {name, phone}; predict -> {text}; other kinds carry no body."""
    ev = lifecycle_events(spark, sf_dir)
    body = (F.when(F.col("kind") == "start", F.to_json(F.struct("name", "phone")))
             .when(F.col("kind") == "predict", F.to_json(F.struct("text"))))
    return ev.select("event_id", "kind", body.alias("body"))


@query("parse_request_body", r"""
SELECT event_id, kind,
       CASE WHEN kind = 'start' THEN name END AS name,
       CASE WHEN kind = 'start' THEN phone END AS phone,
       CASE WHEN kind = 'predict' THEN text END AS text,
       CASE kind WHEN 'start' THEN coalesce(name, '') <> '' AND coalesce(phone, '') <> ''
                 WHEN 'predict' THEN coalesce(text, '') <> ''
                 ELSE false END AS body_ok
FROM lifecycle_events""", L)
def parse_request_body(spark, sf_dir):
    b = request_bodies(spark, sf_dir).withColumn("p", rq.parse_body("body"))
    ok = (F.when(F.col("kind") == "start", present("p.name") & present("p.phone"))
           .when(F.col("kind") == "predict", present("p.text"))
           .otherwise(F.lit(False)))
    return b.select("event_id", "kind", F.col("p.name").alias("name"), F.col("p.phone").alias("phone"),
                    F.col("p.text").alias("text"), ok.alias("body_ok"))


def phone_inputs(spark, sf_dir):
    """Four spellings of a number derived from each customer key."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    local = F.concat(F.lpad(((k * 7) % 1000).cast("string"), 3, "0"), F.lit("-555-"),
                     F.lpad((k % 10000).cast("string"), 4, "0"))
    forms = {"plain": local, "newline": F.concat(local, F.lit("\n")),
             "padded": F.concat(F.lit("  "), local, F.lit(" ")),
             "digits": F.replace(local, F.lit("-"), F.lit(""))}
    rows = F.array(*(F.struct(F.lit(name).alias("form"), e.alias("phone")) for name, e in forms.items()))
    return c.select("c_custkey", F.inline(rows))


@query("phone_valid", r"""
WITH c AS (
  SELECT c_custkey,
         lpad(CAST((c_custkey * 7) % 1000 AS VARCHAR), 3, '0') || '-555-' ||
         lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS local FROM customer),
f AS (
  SELECT c_custkey, 'plain' AS form, local AS phone FROM c UNION ALL
  SELECT c_custkey, 'newline', local || chr(10) FROM c UNION ALL
  SELECT c_custkey, 'padded', '  ' || local || ' ' FROM c UNION ALL
  SELECT c_custkey, 'digits', replace(local, '-', '') FROM c)
SELECT c_custkey, form, phone,
       coalesce(regexp_matches(regexp_replace(phone, '^\s+|\s+$', '', 'g'),
                               '^[2-9][0-8][0-9]-[0-9]{3}-[0-9]{4}\z'), false) AS phone_ok,
       replace(regexp_replace(phone, '^\s+|\s+$', '', 'g'), '-', '') AS phone_digits
FROM f""")
def phone_valid(spark, sf_dir):
    p = phone_inputs(spark, sf_dir)
    return p.select("c_custkey", "form", "phone", phone_ok("phone").alias("phone_ok"),
                    phone_digits("phone").alias("phone_digits"))


@query("nonblank_text", r"""
SELECT conv_id, turn, role,
       coalesce(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '') <> '' AS nonblank,
       length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS trimmed_length
FROM conversations""")
def nonblank_text(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", nonblank("text").alias("nonblank"),
                    F.length(utrim("text")).alias("trimmed_length"))


@query("shutdown_deadline", """
SELECT event_id, model_id, ts + INTERVAL 30 MINUTE AS deadline,
       'at(' || strftime(ts + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S') || ')' AS schedule,
       'shutdown-schedule-sentiment-model-endpoint-' || CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS schedule_name
FROM lifecycle_events WHERE kind = 'in_service'""", L)
def shutdown_deadline(spark, sf_dir):
    ev = lifecycle_events(spark, sf_dir, kinds=("in_service",))
    deadline = timefmt.plus_minutes("ts", timefmt.IDLE_MINUTES)
    name = F.concat(F.lit("shutdown-schedule-" + ENDPOINT_PREFIX),
                    F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    return ev.select("event_id", "model_id", deadline.alias("deadline"),
                     timefmt.schedule_text(deadline).alias("schedule"), name.alias("schedule_name"))


@query("status_extend_check", """
WITH s AS (
  SELECT event_id, ts,
         'at(' || strftime(ts + to_minutes(CAST(floor(value) AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || ')' AS schedule
  FROM events WHERE event_type = 'view'),
p AS (
  SELECT event_id, ts, schedule,
         strptime(substr(schedule, 4, length(schedule) - 4), '%Y-%m-%dT%H:%M:%S') AS scheduled
  FROM s)
SELECT event_id, schedule,
       round((epoch_us(scheduled) - epoch_us(ts)) / 60000000.0, 4) AS minutes_remaining,
       (epoch_us(scheduled) - epoch_us(ts)) / 60000000.0 < 15 AS extend,
       CASE WHEN (epoch_us(scheduled) - epoch_us(ts)) / 60000000.0 < 15
            THEN 'at(' || strftime(ts + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S') || ')'
            ELSE schedule END AS new_schedule
FROM p""")
def status_extend_check(spark, sf_dir):
    """Status polls against a schedule set ``value`` minutes ahead of the poll."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    current = F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))
    s = ev.select("event_id", "ts", timefmt.schedule_text(current).alias("schedule"))
    left = timefmt.minutes_between(timefmt.schedule_time("schedule"), "ts")
    extend = left < timefmt.EXTEND_BELOW_MINUTES
    new = F.when(extend, timefmt.schedule_text(timefmt.plus_minutes("ts", timefmt.IDLE_MINUTES))) \
           .otherwise(F.col("schedule"))
    return s.select("event_id", "schedule", F.round(left, 4).alias("minutes_remaining"),
                    extend.alias("extend"), new.alias("new_schedule"))
