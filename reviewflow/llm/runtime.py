"""Helpers that the operators share: shipping the package to Python workers, scratch
tables in the shared folder, bounded caches and slices of Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application. Worker functions import
    it by name, so what a module keeps (vocabularies, caches) lives as long as the worker."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="reviewflow-ship-"))
    name = os.path.join(folder, "reviewflow_package.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for base, _, files in os.walk(PACKAGE_DIR):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(base, f)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE_DIR)))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only where that is
    unset (tests) a folder of its own is made."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        current = "file://" + tempfile.mkdtemp(prefix="reviewflow-shared-")
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-scratch/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut by a table
    that outlives any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """``written`` in as many buckets of ``column`` as shuffles have partitions: steps that group by it don't shuffle
    the table again. The catalog knows the table only until it is read back; the files stay."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    table = f"llm_{os.path.basename(path).replace('-', '_')}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).saveAsTable(table, format="parquet")
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Generations(dict):
    """A cache of two generations. ``turn()``, called between batches, makes the young one
    the old one when it has ``size`` entries; entries that are used again move back. Within
    a batch nothing goes. Losing an entry only costs the time to make it again."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def turn(self) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()

    def known(self, keys) -> list:
        """The keys' values, None where there is none."""
        out, old, get = list(map(self.get, keys)), self.old, self.old.get
        if old:
            for i in [i for i, value in enumerate(out) if value is None]:
                value = get(keys[i])
                if value is not None:
                    out[i] = self[keys[i]] = value
        return out

    def unknown(self, keys) -> list:
        """Of different keys, those that are in neither generation."""
        # membership tests, key by key: a set difference would walk through the whole cache
        old = self.old
        return [k for k in keys if k not in self and k not in old]


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 1_500_000, rows: int = 2_000):
    """Slices of a batch with their texts (null: empty), bounded by bytes, so that what a
    worker holds doesn't follow the batch size. One long text is a slice of its own."""
    at = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate([*sizes, chars + 1]):
        if i > start and (held + size > chars or i - start >= rows):
            part = batch.slice(start, i - start)
            yield part, [t if t is not None else "" for t in part.column(at).to_pylist()]
            start, held = i, 0
        held += size


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
