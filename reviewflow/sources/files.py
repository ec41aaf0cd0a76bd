"""File scans and sinks.

JSON lines are read one object per line, recursively below the given folder (the
ETL's raw layout has sub-folders). An explicit schema is preferred: inference costs
a full extra pass over the input, which at scale is a second read of everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    recursive: bool = True, drop_all_null_fields: bool = False) -> DataFrame:
    reader = (spark.read.option("multiLine", False)
              .option("recursiveFileLookup", recursive))
    if schema is not None:
        reader = reader.schema(schema)
    elif drop_all_null_fields:
        # with inference, an all-null field is otherwise typed STRING and kept
        reader = reader.option("dropFieldIfAllNull", True)
    return reader.json(path)


def read_json_permissive(spark: SparkSession, path: str, schema: T.StructType,
                         recursive: bool = True) -> DataFrame:
    """Malformed lines become rows whose ``_corrupt_record`` holds the raw text.

    Spark refuses a query on raw JSON that references only the corrupt-record column,
    so callers should split good and bad rows in the same pass (see ``flag_corrupt``)."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (spark.read.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("multiLine", False)
            .option("recursiveFileLookup", recursive)
            .json(path))


#: Partition column of a staged scan: whether the line was malformed.
BAD_COLUMN = "_bad_line"


def flag_corrupt(df: DataFrame) -> DataFrame:
    """A permissive scan with ``_bad_line``. Written partitioned by it, the scan parses its
    input once, and good and bad rows are read back without each other."""
    return df.withColumn(BAD_COLUMN, F.col(CORRUPT_COLUMN).isNotNull())


def good_rows(staged: DataFrame) -> DataFrame:
    return staged.where(~F.col(BAD_COLUMN)).drop(BAD_COLUMN, CORRUPT_COLUMN)


def bad_rows(staged: DataFrame) -> DataFrame:
    """The raw text of the quarantined lines."""
    return staged.where(F.col(BAD_COLUMN)).select(CORRUPT_COLUMN)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                  mode: str = "overwrite", compression: str = "snappy") -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_json_permissive(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """A stream of JSON lines; malformed ones as in ``read_json_permissive``."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (spark.readStream.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("multiLine", False)
            .option("recursiveFileLookup", True)
            .json(source))


def ingest_new_json(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                    checkpoint: str, transform=None) -> None:
    """Read only the JSON files not yet seen (tracked in ``checkpoint``), apply
    ``transform`` and append them to the Parquet ``sink``; returns when drained.

    The sink is partitioned by ``_bad_line``: malformed lines land in a partition of their
    own with their raw text (``good_rows`` / ``bad_rows`` read it). ``transform`` sees the
    columns of ``schema`` of good and bad rows and must keep the two quarantine columns.
    Rerunning it after new files land processes just those files, and a failed run resumes
    from its checkpoint."""
    stream = flag_corrupt(stream_json_permissive(spark, source, schema))
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet")
         .option("path", sink)
         .option("checkpointLocation", checkpoint)
         .option("compression", "snappy")
         .partitionBy(BAD_COLUMN)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
