"""Reproducible exact-size samples and train / test splits.

Row order in Spark depends on partitioning, and ``rand()`` depends on it too, so
every choice here is keyed on a hash of ``seed:key``: the same rows come out however
the input is split into files or partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


# bits of the 60-bit hash prefix resolved per histogram pass
_BITS_PER_PASS = 16


def _prefix(h: Column) -> Column:
    """First 15 hex digits of the md5 as a non-negative long (orders like the text)."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def kth_cut(df: DataFrame, key: str, k, seed: int = 42):
    """``(hash, key)`` of the k-th row (1-based) in hash order, found exactly without
    sorting the input: each pass counts rows per bucket of the next 16 prefix bits
    inside the bucket known to hold the k-th row (a partial aggregate, one small row per
    bucket to the driver), down to the keys that share one 60-bit prefix. ``k`` may be a
    function of the row count, which the first pass gives (0: no cut, None)."""
    keyed = df.select(F.col(key), hash_order(key, seed).alias("__h")).withColumn("__p", _prefix(F.col("__h")))
    lo, width_bits, below, total = 0, 60, 0, None         # candidates: lo <= p < lo + 2**width_bits
    while width_bits:
        cand = keyed.where((F.col("__p") >= lo) & (F.col("__p") < lo + (1 << width_bits)))
        shift = max(width_bits - _BITS_PER_PASS, 0)
        counts = sorted((r[0], r[1]) for r in cand.groupBy(F.shiftright("__p", shift).alias("b"))
                        .agg(F.count(F.lit(1))).collect())
        if total is None:
            total = sum(c for _, c in counts)
            k = k(total) if callable(k) else k
            if k == 0:
                return None
            if total < k:
                raise ValueError(f"cannot select row {k}: the frame has only {total} rows")
        for b, c in counts:
            if below + c >= k:
                lo, width_bits = b << shift, shift
                break
            below += c
    rows = keyed.where(F.col("__p") == lo).groupBy("__h", key).agg(F.count(F.lit(1)).alias("n")).collect()
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        below += r["n"]
        if below >= k:
            return r[0], r[1]
    raise AssertionError("the counts of a pass and of its bucket differ")


def _up_to(h: Column, kc: Column, cut) -> Column:
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (kc <= F.lit(cut[1])))


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42, strict: bool = True,
                 keys: DataFrame | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement, the first ``n`` in ``(hash, key)`` order
    (``key`` unique). ``n`` larger than the frame is an error when ``strict``, else the
    whole frame. The n-th (hash, key) is found by ``kth_cut`` over the key column alone
    and the sample is a filter, so no task ever holds the sampled rows. ``keys``: a cheaper
    frame with the same keys, where ``df`` has joins that the cut doesn't need."""
    if n < 0:
        raise ValueError("n must be >= 0")
    if n == 0:
        return df.limit(0)
    try:
        cut = kth_cut(df if keys is None else keys, key, n, seed)
    except ValueError:
        if strict:
            raise
        return df
    return df.where(_up_to(hash_order(key, seed), F.col(key), cut))


def split_exact(df: DataFrame, key: str, test_fraction: float = 0.1, seed: int = 42, keys: DataFrame | None = None):
    """(train, test) with ``ceil(rows * test_fraction)`` test rows, chosen by hash.

    The k-th hash is found by ``kth_cut``, whose first pass counts the rows too, so both
    sides are plain filters of the input: no sort of the input, no anti-join, no task
    holding the test set. ``keys`` as in ``sample_exact``."""
    cut = kth_cut(df if keys is None else keys, key, lambda n: int(math.ceil(n * test_fraction)), seed)
    if cut is None:
        return df, df.limit(0)
    test = _up_to(hash_order(key, seed), F.col(key), cut)
    return df.where(~test), df.where(test)


def bucket_split(df: DataFrame, key: str, test_percent: int = 10, seed: int = 42) -> DataFrame:
    """Adds ``split`` = ``test`` / ``train`` from a hash bucket in [0, 100).

    One pass, no shuffle, no count; the test share is ``test_percent`` only in
    expectation. The form to use when the input is large."""
    bucket = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(bucket < test_percent, F.lit("test")).otherwise(F.lit("train")))
