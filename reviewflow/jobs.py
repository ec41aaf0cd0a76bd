"""The reference's end-to-end jobs as single calls, built from the operators.

``clean_reviews``: raw JSON lines (malformed ones quarantined) -> review fields -> drop empty / sentinel-only
columns -> data-quality rules -> snappy Parquet (written row count as a run metric).
``IncrementalClean``: the same job over a growing folder, each new file read once.
``prepare_reviews``: processed Parquet -> label and text columns -> Parquet, plus an
exact seeded sample. ``train_classifier``: prepared Parquet ->
90/10 split -> fit -> metrics -> saved model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .operators import clean, model, prepare, quality, sampling
from .sources import files


def clean_reviews(spark: SparkSession, raw_path: str, out_path: str,
                  schema: T.StructType | None = None,
                  fields=tuple(prepare.REVIEW_FIELDS), null_strings=(), null_numbers=(),
                  rules=quality.DEFAULT_RULES, on_fail: str = "report",
                  partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """Returns (rule table, run metrics).

    The raw lines are parsed once: the wanted fields are staged as Parquet below
    ``<out_path>.staged``, partitioned by good and malformed lines; the profile, the rules and
    the written rows come from the good partition, the malformed lines stay in the other
    (``files.bad_rows``) and are counted. The rule table is stored below ``<out_path>.rules``.

    The quality outcome does not block the write
    unless ``on_fail="raise"``. The written row count is read from the Parquet footers
    (no data pass). ``observe`` would do it inside the write, but on Spark 4.1 a session
    that has used an ``Observation`` can no longer run the RDD-based ML evaluators."""
    if schema is None:
        found = files.read_json_lines(spark, raw_path).schema
        schema = T.StructType([f for f in found.fields if f.name != files.CORRUPT_COLUMN])
    raw = files.flag_corrupt(files.read_json_permissive(spark, raw_path, schema))
    wanted = prepare.select_fields(raw, (*fields, files.CORRUPT_COLUMN, files.BAD_COLUMN))
    staged_path = f"{out_path}.staged"
    files.write_parquet(wanted, staged_path, (files.BAD_COLUMN,))
    staged = spark.read.schema(wanted.schema).parquet(staged_path)
    kept = clean.drop_null_fields(files.good_rows(staged), null_strings, null_numbers)
    files.write_parquet(quality.evaluate(kept, rules, on_fail), f"{out_path}.rules")
    report = files.read_parquet(spark, f"{out_path}.rules")
    files.write_parquet(kept, out_path, partition_by)
    return report, {"rows_written": files.read_parquet(spark, out_path).count(),
                    "rows_quarantined": files.bad_rows(staged).count(), "columns_written": len(kept.columns)}


class IncrementalClean:
    """The ETL job over a folder of raw JSON lines that grows.

    ``run`` takes the files that no run has seen: their wanted fields are staged as Parquet (good and malformed
    lines apart) together with the counters of the null profile over the good ones, in folders of
    their own micro-batch; a replayed micro-batch rewrites its own. Which columns are empty, and how the rules come out, depends on
    all rows seen so far, and follows from the merged counters: no earlier row is read again. A column that was
    empty comes back, with its old rows, as soon as a file brings values for it."""

    def __init__(self, spark: SparkSession, raw_path: str, out_path: str, schema: T.StructType,
                 fields=tuple(prepare.REVIEW_FIELDS), null_strings=(), null_numbers=()):
        self.spark, self.raw, self.out = spark, raw_path, out_path
        self.schema, self.fields = schema, tuple(fields)
        self.sentinels = tuple(null_strings), tuple(null_numbers)
        empty = spark.createDataFrame([], schema)
        self.kept = prepare.select_fields(empty, self.fields).schema
        self.staged_schema = T.StructType([*self.kept.fields, T.StructField(files.CORRUPT_COLUMN, T.StringType()),
                                           T.StructField(files.BAD_COLUMN, T.BooleanType()), T.StructField("batch", T.IntegerType())])

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        staged = f"{self.out}/staged/batch={batch_id}"
        wanted = prepare.select_fields(files.flag_corrupt(batch), (*self.fields, files.CORRUPT_COLUMN, files.BAD_COLUMN))
        files.write_parquet(wanted, staged, (files.BAD_COLUMN,))
        good = files.good_rows(batch.sparkSession.read.schema(wanted.schema).parquet(staged))
        files.write_parquet(clean.profile_counts(good, *self.sentinels), f"{self.out}/counts/batch={batch_id}")

    def run(self, checkpoint: str) -> None:
        """Take what is new; a failed run resumes from its checkpoint."""
        stream = files.stream_json_permissive(self.spark, self.raw, self.schema)
        q = (stream.writeStream.foreachBatch(self._write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()

    def staged(self) -> DataFrame:
        return self.spark.read.schema(self.staged_schema).parquet(f"{self.out}/staged").drop("batch")

    def profile(self) -> DataFrame:
        """The null profile of all rows, from the merged counters."""
        counts = self.spark.read.parquet(f"{self.out}/counts").drop("batch")
        return clean.profile_of_counts(clean.merge_counts(counts), self.kept, *self.sentinels)

    def result(self) -> DataFrame:
        """All good rows without the columns that are empty so far."""
        gone = [r["path"] for r in self.profile().where("drop").select("path").collect()]
        return clean.drop_fields(files.good_rows(self.staged()), gone)

    def report(self, rules=quality.DEFAULT_RULES, on_fail: str = "report") -> DataFrame:
        """The rule table of all rows, from the merged counters (completeness of top-level columns)."""
        rows = self.profile().collect()
        left = {r["path"].split(".")[0] for r in rows if not r["drop"]}
        return quality.from_counts(self.spark, rules, len(left), rows[0]["n_rows"], {r["path"]: r["n_with_value"] for r in rows}, on_fail)


def prepare_reviews(spark: SparkSession, processed_path: str, out_path: str,
                    sample_path: str | None = None, sample_n: int = 150_000, seed: int = 42,
                    key: str = "doc_id") -> None:
    """Label and text columns for every processed review; optionally an exact sample
    of ``sample_n`` rows (keyed hash order, reproducible) written next to it."""
    prepared = prepare.prepare(files.read_parquet(spark, processed_path))
    files.write_parquet(prepared, out_path)
    if sample_path is not None:
        files.write_parquet(sampling.sample_exact(files.read_parquet(spark, out_path), sample_n, key, seed),
                            sample_path)


def train_classifier(spark: SparkSession, prepared_path: str, model_path: str, key: str = "doc_id",
                     test_fraction: float = 0.1, seed: int = 42, **params) -> dict:
    rows = prepare.training_rows(files.read_parquet(spark, prepared_path)).select(key, "label", "review_full_text")
    train, test = sampling.split_exact(rows, key, test_fraction, seed)
    fitted = model.fit(train, **params)
    model.save(fitted, model_path)
    return model.metrics(model.score(fitted, test))
