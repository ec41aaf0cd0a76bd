"""Ordered scans along a key without sending the whole key to one task.

A window partitioned by a key alone puts every row of that key into one task; with
one hot key holding a large share of the rows that task dominates the job. Here the
window runs per (key, time bucket); a bucket's first rows take their predecessor
from a one-row-per-bucket summary, whose own window is bounded by the number of
buckets in the key's time span, not by its row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bucket(ts: Column | str, seconds: int) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
                    cols: Sequence[str], prefix: str = "prev_", reverse: bool = False) -> DataFrame:
    """Adds ``prev_<c>`` = value of ``c`` on the previous row of the same key in
    ``order`` (null on the key's first row); with ``reverse`` the next row instead."""
    keys, order, cols = list(keys), list(order), list(cols)
    ordering = [F.col(o).desc_nulls_last() if reverse else F.col(o).asc_nulls_first() for o in order]
    w = Window.partitionBy(*keys, bucket).orderBy(*ordering)
    out = df
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.lag(c).over(w))
    out = out.withColumn("__first", F.row_number().over(w) == 1)
    pick = F.min if reverse else F.max
    last = (df.groupBy(*keys, bucket)
              .agg(pick(F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"v_{c}") for c in cols])).alias("__last")))
    wb = Window.partitionBy(*keys).orderBy(F.col(bucket).desc() if reverse else F.col(bucket).asc())
    carried = last.select(*keys, bucket, F.lag("__last").over(wb).alias("__carry"))
    out = out.join(carried, [*keys, bucket], "left")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}",
                             F.when(F.col("__first"), F.col(f"__carry.v_{c}")).otherwise(F.col(f"{prefix}{c}")))
    return out.drop("__first", "__carry")


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str,
                  col: str, out: str) -> DataFrame:
    """Adds ``out`` = last non-null ``col`` at or before each row of the same key."""
    keys, order = list(keys), list(order)
    w = (Window.partitionBy(*keys, bucket).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    res = df.withColumn(out, F.last(col, ignorenulls=True).over(w))
    last = (df.groupBy(*keys, bucket)
              .agg(F.max(F.when(F.col(col).isNotNull(),
                                F.struct(*[F.col(o) for o in order], F.col(col).alias("v")))).alias("__l")))
    wb = (Window.partitionBy(*keys).orderBy(bucket)
          .rowsBetween(Window.unboundedPreceding, -1))
    carried = last.select(*keys, bucket, F.last(F.col("__l.v"), ignorenulls=True).over(wb).alias("__carry"))
    res = res.join(carried, [*keys, bucket], "left")
    return res.withColumn(out, F.coalesce(F.col(out), F.col("__carry"))).drop("__carry")
