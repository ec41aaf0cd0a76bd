"""Point-in-time joins: each row of one table with the latest row of another at or before its time.

Both tables are united and cut by (key, time bucket); a window inside each bucket hands the
latest right row on, and a bucket that starts without one takes it from a summary of one row a
bucket (``scan.carry_forward``). No window spans a whole key, so a key with most of the rows spreads over
as many tasks as it has buckets, and no row is multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan

BUCKET_SECONDS = 3600


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              ties: Sequence[str] = (), bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every row of ``left`` with the columns of the latest row of ``right`` that has the same ``key`` and
    a time not after its own (nulls where there is none); of right rows with one time the one
    that comes last by ``ties``. A null key or time matches nothing. The columns of the two, the key
    aside, have different names."""
    values = [c for c in right.columns if c != key]
    clash = {c.lower() for c in left.columns} & {c.lower() for c in values}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    usable = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    side = lambda time, own, value, place: [
        F.col(key).alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.lit(place).alias("s"), value.alias("v"), own.alias("l")]
    no_left = F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType)
    no_right = F.lit(None).cast(right.select(F.struct(*values).alias("x")).schema["x"].dataType)
    # the tie columns order right rows of one time; a right row comes before a left one of its time
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(ties)]
    rows = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        *side(right_time, no_left, F.struct(*values), 0), *order)
    asked = left.where(usable).select(*side(left_time, F.struct(*left.columns), no_right, 1),
                                      *(F.lit(None).cast(right.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(ties)))
    both = rows.unionByName(asked).withColumn("b", F.floor(F.col("t") / F.lit(bucket_seconds * 1_000_000)).cast("long"))
    carried = scan.carry_forward(both, ["k"], ["t", "s", *(f"o{i}" for i in range(len(ties)))], "b", "v", "found")
    matched = carried.where("s = 1").select("l.*", *(F.col("found")[c].alias(c) for c in values))
    return matched.unionByName(left.where(~F.coalesce(usable, F.lit(False))), allowMissingColumns=True)
