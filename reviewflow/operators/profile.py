"""Distributions and shape of a frame: value counts, histogram, shape, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, out: str = "n_rows") -> DataFrame:
    """Count per non-missing value, most frequent first (ties by value).

    A partial aggregate runs before the shuffle, so each task sends at most one row
    per distinct value."""
    c = F.col(col)
    missing = c.isNull()
    if dict(df.dtypes)[col] in ("double", "float"):
        missing = missing | F.isnan(c)
    return (df.where(~missing).groupBy(col).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.col(out).desc(), c.asc()))


def histogram(df: DataFrame, col: str, out: str = "n_rows") -> DataFrame:
    """Count per non-missing value in value order (the bar chart's data)."""
    return value_counts(df, col, out).orderBy(col)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``key``; Spark rows have no order of their own.
    Plans as TakeOrderedAndProject: each task keeps its own top n."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
