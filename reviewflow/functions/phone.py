"""Subscriber phone checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import present, utrim

# Fixed value: North American number as ``NXX-NXX-XXXX`` with the first digit 2-9
# and the second 0-8; ASCII digits only, nothing after the last digit.
PHONE_PATTERN = r"^[2-9][0-8][0-9]-[0-9]{3}-[0-9]{4}\z"


def phone_ok(phone: Column | str) -> Column:
    p = F.col(phone) if isinstance(phone, str) else phone
    return F.coalesce(utrim(p).rlike(PHONE_PATTERN), F.lit(False))


def subscriber_ok(name: Column | str, phone: Column | str) -> Column:
    return present(name) & phone_ok(phone)


def phone_digits(phone: Column | str) -> Column:
    p = F.col(phone) if isinstance(phone, str) else phone
    return F.replace(utrim(p), F.lit("-"), F.lit(""))
