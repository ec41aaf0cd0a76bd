"""Request bodies and platform events arriving as JSON text.

Parsing is ``from_json`` with a fixed schema: a malformed or missing body gives a
struct of nulls (the request is then rejected by the field checks), never a failed
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_element, nth_element

START_BODY = T.StructType([T.StructField("name", T.StringType()), T.StructField("phone", T.StringType())])
PREDICT_BODY = T.StructType([T.StructField("text", T.StringType())])
PLATFORM_EVENT = T.StructType([T.StructField("resources", T.ArrayType(T.StringType()))])
TIMER_INPUT = T.StructType([T.StructField("schedule_name", T.StringType()),
                            T.StructField("endpoint_arn", T.StringType())])
SHUTDOWN_INPUT = T.StructType([T.StructField("endpoint_name", T.StringType())])
REQUEST_BODY = T.StructType(START_BODY.fields + PREDICT_BODY.fields)


def parse_body(body: Column | str, schema: T.StructType = REQUEST_BODY) -> Column:
    """A missing body reads as ``{}``."""
    b = F.col(body) if isinstance(body, str) else body
    return F.from_json(F.coalesce(b, F.lit("{}")), schema)


def last_segment(text: Column | str, sep: str = "/") -> Column:
    """Text after the last ``sep``; the whole text when there is none; null stays null."""
    t = F.col(text) if isinstance(text, str) else text
    return F.element_at(F.split(t, F.lit(sep)), -1)


def resource_name(event_json: Column | str) -> Column:
    """Endpoint name of a platform event: the first resource ARN, after its last ``/``."""
    ev = F.from_json(event_json if isinstance(event_json, Column) else F.col(event_json), PLATFORM_EVENT)
    return last_segment(first_element(ev["resources"]))


def arn_field(arn: Column | str, index: int) -> Column:
    """``index``-th (0-based) ``:``-separated field of an ARN, e.g. 4 = account."""
    a = F.col(arn) if isinstance(arn, str) else arn
    return nth_element(F.split(a, F.lit(":")), index + 1)


# A raw line of the event stream: a platform event whose first resource names the model.
EVENT_LINE = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("time", T.StringType()),
    T.StructField("resources", T.ArrayType(T.StringType())),
    T.StructField("detail", T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "name", "phone", "text")])),
    T.StructField("_corrupt_record", T.StringType())])


def parse_event_lines(lines: DataFrame) -> DataFrame:
    """Lifecycle events of raw JSON lines (column ``value``), batch or stream: the model is the name of the
    first resource. A line that isn't whole JSON, or lacks id, kind, resource or a readable time, keeps its
    text in ``line`` and gets a ``reason``; its event columns may be null."""
    e = F.from_json("value", EVENT_LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = lines.select("value", e.alias("e")).select(
        "value", "e.event_id", F.try_to_timestamp("e.time").cast("timestamp_ntz").alias("ts"),
        last_segment(first_element(F.col("e.resources"))).alias("model_id"), "e.detail.*", F.col("e._corrupt_record").alias("corrupt"))
    reason = (F.when(F.col("corrupt").isNotNull() | F.col("event_id").isNull() & F.col("kind").isNull(), "not a whole line")
              .when(F.col("event_id").isNull() | F.col("kind").isNull(), "no id or kind")
              .when(F.col("model_id").isNull(), "no model").when(F.col("ts").isNull(), "no time"))
    return parsed.select("event_id", "ts", "model_id", "kind", "name", "phone", "text",
                         F.when(reason.isNotNull(), F.col("value")).alias("line"), reason.alias("reason"))
