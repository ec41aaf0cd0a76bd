"""Review preparation: field selection, polarity label, text columns, renames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import polarity
from ..functions.text import fill_blank, full_text

# The three review fields kept by the ETL job, with the types the
# preparation step expects when a field is missing from a file.
REVIEW_FIELDS: dict[str, T.DataType] = {
    "rating": T.DoubleType(), "title": T.StringType(), "text": T.StringType()}


def select_fields(df: DataFrame, fields: Sequence[str] = tuple(REVIEW_FIELDS),
                  restore_missing: bool = False) -> DataFrame:
    """Keep ``fields`` (pruned into the scan by Catalyst). With ``restore_missing`` a
    field absent from the input comes back as a typed null column."""
    have = set(df.columns)
    cols = []
    for f in fields:
        if f in have:
            cols.append(F.col(f))
        elif restore_missing:
            cols.append(F.lit(None).cast(REVIEW_FIELDS.get(f, T.StringType())).alias(f))
    return df.select(*cols)


def add_polarity(df: DataFrame, rating: str = "rating", out: str = "sentiment",
                 on_missing: str = "null") -> DataFrame:
    return df.withColumn(out, polarity(rating, on_missing))


def add_text_columns(df: DataFrame, title: str = "title", text: str = "text",
                     fill_concat: bool = False) -> DataFrame:
    """``review_headline`` / ``review_body`` are the empty-filled fields; the full text
    joins the *unfilled* ones unless ``fill_concat`` is set."""
    return (df.withColumn("review_headline", fill_blank(title))
              .withColumn("review_body", fill_blank(text))
              .withColumn("review_full_text", full_text(title, text, fill=fill_concat)))


def prepare(df: DataFrame, on_missing: str = "null", fill_concat: bool = False) -> DataFrame:
    """Processed reviews -> prepared frame (label plus text columns)."""
    for f, t in REVIEW_FIELDS.items():
        if f not in df.columns:
            df = df.withColumn(f, F.lit(None).cast(t))
    return add_text_columns(add_polarity(df, on_missing=on_missing), fill_concat=fill_concat)


def model_frame(prepared: DataFrame) -> DataFrame:
    return prepared.select("sentiment", "review_full_text")


def rename_label(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("sentiment", "label")


def training_rows(prepared: DataFrame) -> DataFrame:
    """Rows a classifier can learn from: a label and a non-null full text."""
    return (rename_label(prepared)
            .where(F.col("label").isNotNull() & F.col("review_full_text").isNotNull()))
