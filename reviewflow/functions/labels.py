"""Rating polarity, label names and confidence text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ratings up to 3 are negative (0), above 3 positive (1); the positive
# class code of the classifier and the two display names.
NEGATIVE_MAX_RATING = 3
POSITIVE_CODE = "LABEL_1"
NEGATIVE_CODE = "LABEL_0"
POSITIVE_NAME = "POSITIVE"
NEGATIVE_NAME = "NEGATIVE"


def polarity(rating: Column | str, on_missing: str = "null") -> Column:
    """0 when the integer part of the rating is at most 3, else 1.

    The integer part truncates toward zero (3.9 -> 3 -> negative). A missing rating
    (null or NaN) gives null, or fails the job with ``on_missing="fail"``."""
    r = F.col(rating) if isinstance(rating, str) else rating
    missing = r.isNull() | F.isnan(r.cast("double"))
    label = F.when(r.cast("double").cast("long") <= NEGATIVE_MAX_RATING, F.lit(0)).otherwise(F.lit(1))
    if on_missing == "fail":
        return F.when(missing, F.raise_error(F.lit("rating is missing")).cast("int")).otherwise(label)
    return F.when(missing, F.lit(None).cast("int")).otherwise(label)


def label_name(code: Column | str) -> Column:
    """``LABEL_1`` is positive; anything else, null included, is negative."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c == POSITIVE_CODE, F.lit(POSITIVE_NAME)).otherwise(F.lit(NEGATIVE_NAME))


def percent_text(score: Column | str) -> Column:
    """Score as a percentage with two decimals, e.g. 0.9731 -> ``97.31%`` (half-up)."""
    s = F.col(score) if isinstance(score, str) else score
    # format_string would print a null as "nu%"
    return F.when(s.isNotNull(), F.format_string("%.2f%%", F.round(s * 100, 2)))
