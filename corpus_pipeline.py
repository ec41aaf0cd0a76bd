"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
documents that hold benchmark items go, the rest is encoded and decoded again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; all but
the last return the columns of ``docs``. Rows with a null id or text pass every filter whose
question doesn't apply to them; an empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm import bpe, decontaminate, minhash, toxicity
from reviewflow.llm.queries import table, tokenizer_path
from reviewflow.llm.runtime import free_name, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents scored below the cut by a model fitted on the labels that aren't held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    name = free_name(docs, "_toxicity")
    return toxicity.score(docs, model, into=name).where(F.col(name) < toxicity.SCORE_CUT).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their five-word shingles."""
    return minhash.keep_one(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of the text that they decode to."""
    path = tokenizer_path()
    decoded = bpe.round_trip(docs.select("doc_id", "text"), path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]
#: Toxicity scores, near-duplicate groups and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = scratch(spark, f"pipeline-{k}-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
