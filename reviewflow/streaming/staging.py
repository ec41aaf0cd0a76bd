"""Stage a table as a growing folder of Parquet files for a file-source stream.

Slices are written one after another in event-time order, so the file source (which
picks up files by modification time) sees time move forward; a final flush row far
after the data moves the watermark past every open window and timer, which lets a
``trigger(availableNow=True)`` run emit everything a batch job would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLUSH_KEY = "__flush__"
SLICE_DAYS = 7
# Files of one slice may be read in any order (one micro-batch per file), so rows of a
# slice can arrive up to a slice apart: the watermark delay of a stream over a staged
# source must cover that, or rows would be dropped as late.
SOURCE_DISORDER = f"{SLICE_DAYS} days"


def stage_slices(df: DataFrame, path: str, ts: str = "ts", slice_days: int = SLICE_DAYS,
                 flush_row: dict | None = None) -> None:
    """Write ``df`` below ``path`` in consecutive ``slice_days`` ranges of ``ts``.

    The input is read once: it is written partitioned by slice next to ``path``, and
    each slice is then copied in time order from its own partition folder (partition
    pruning), so the file source sees slices arrive one after another. The I/O is
    twice the input however many slices there are; the slice numbers themselves (data
    span / slice length, a handful of values) come from the written partitions.
    ``flush_row`` maps column -> Column expression over the data (e.g. latest time plus
    one year) and is written last."""
    sliced = df.withColumn("__slice", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / (slice_days * 86400)))
    parts = f"{path}-by-slice"
    sliced.write.mode("overwrite").partitionBy("__slice").parquet(parts)
    staged = df.sparkSession.read.parquet(parts)
    slices = sorted(r[0] for r in staged.select("__slice").distinct().collect())
    for s in slices:
        (staged.where(F.col("__slice") == s).drop("__slice").select(*df.columns)
               .write.mode("append").parquet(f"{path}/slice={s:012d}"))
    if flush_row is not None:
        exprs = [flush_row[c].alias(c) if c in flush_row else F.lit(None).cast(t).alias(c)
                 for c, t in df.dtypes]
        df.agg(*[F.max(F.col(c)).alias(c) for c in df.columns]).select(*exprs) \
          .write.mode("append").parquet(f"{path}/slice=flush")


def read_stream(spark: SparkSession, path: str, schema, bytes_per_batch: str | None = None) -> DataFrame:
    """A file stream; ``bytes_per_batch`` (e.g. ``"64g"``) bounds a micro-batch, unset it
    takes all files that are there."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str, output_mode: str = "append") -> None:
    q = (stream.writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
