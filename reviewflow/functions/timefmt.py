"""Deadline arithmetic and the ``at(...)`` schedule text, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Idle time before shutdown, and the remaining time below which a
# status poll pushes the deadline out again.
IDLE_MINUTES = 30
EXTEND_BELOW_MINUTES = 15
SCHEDULE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plus_minutes(ts: Column | str, minutes: int) -> Column:
    return _c(ts) + F.expr(f"INTERVAL {int(minutes)} MINUTES")


def schedule_text(ts: Column | str) -> Column:
    """``at(YYYY-MM-DDTHH:MM:SS)``; fractions of a second are dropped."""
    return F.concat(F.lit("at("), F.date_format(_c(ts), SCHEDULE_FORMAT), F.lit(")"))


def schedule_time(expr: Column | str) -> Column:
    """Inverse of ``schedule_text``: strip ``at(`` and ``)`` and read the time as UTC."""
    e = _c(expr)
    inner = e.substr(F.lit(4), F.length(e) - 4)
    return F.to_timestamp_ntz(inner, F.lit(SCHEDULE_FORMAT))


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)
