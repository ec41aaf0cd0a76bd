"""Queries over the prepared review set: fields, labels, distributions, preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as prep
from ..operators import profile
from ..tables import read_table, reviews, reviews_from
from .registry import query

R = ("reviews",)


@query("scan_parquet_shape", """
SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM reviews""", R)
def scan_parquet_shape(spark, sf_dir):
    return profile.shape(reviews(spark, sf_dir, with_rating=False))


@query("preview_head", """
SELECT doc_id, rating, title, text FROM reviews ORDER BY doc_id LIMIT 5""", R)
def preview_head(spark, sf_dir):
    # the rows are chosen before their ratings are joined
    first = profile.preview(read_table(spark, sf_dir, "documents"), "doc_id", 5)
    return reviews_from(first, read_table(spark, sf_dir, "labels"))


@query("distinct_values", """
SELECT DISTINCT rating FROM reviews""", R)
def distinct_values(spark, sf_dir):
    return profile.distinct_values(reviews(spark, sf_dir), "rating")


@query("select_fields", """
SELECT rating, title, text FROM reviews""", R)
def select_fields(spark, sf_dir):
    return prep.select_fields(reviews(spark, sf_dir))


_PREPARED_SQL = """
prepared AS (
  SELECT doc_id, rating, title, text,
         CASE WHEN rating IS NULL OR isnan(rating) THEN NULL
              WHEN CAST(trunc(rating) AS BIGINT) <= 3 THEN 0 ELSE 1 END AS sentiment,
         coalesce(title, '') AS review_headline,
         coalesce(text, '') AS review_body,
         title || '. ' || text AS review_full_text
  FROM reviews)
"""


def _prepared(spark, sf_dir):
    return prep.prepare(reviews(spark, sf_dir))


@query("label_polarity", f"""
WITH {_PREPARED_SQL}
SELECT doc_id, rating, sentiment FROM prepared""", R)
def label_polarity(spark, sf_dir):
    return _prepared(spark, sf_dir).select("doc_id", "rating", "sentiment")


@query("model_frame", f"""
WITH {_PREPARED_SQL}
SELECT sentiment, review_full_text FROM prepared""", R)
def model_frame(spark, sf_dir):
    return prep.model_frame(_prepared(spark, sf_dir))


@query("rename_label", f"""
WITH {_PREPARED_SQL}
SELECT sentiment AS label, review_full_text FROM prepared""", R)
def rename_label(spark, sf_dir):
    return prep.rename_label(prep.model_frame(_prepared(spark, sf_dir)))


@query("fill_text", f"""
WITH {_PREPARED_SQL}
SELECT doc_id, review_headline, review_body FROM prepared""", R)
def fill_text(spark, sf_dir):
    return prep.prepare(reviews(spark, sf_dir, with_rating=False)).select("doc_id", "review_headline", "review_body")


@query("full_text", f"""
WITH {_PREPARED_SQL}
SELECT doc_id, review_full_text FROM prepared""", R)
def full_text(spark, sf_dir):
    return prep.prepare(reviews(spark, sf_dir, with_rating=False)).select("doc_id", "review_full_text")


@query("full_text_filled", """
SELECT doc_id, coalesce(title, '') || '. ' || coalesce(text, '') AS review_full_text
FROM reviews""", R)
def full_text_filled(spark, sf_dir):
    return prep.prepare(reviews(spark, sf_dir, with_rating=False), fill_concat=True).select("doc_id", "review_full_text")


@query("rating_counts", """
SELECT rating, count(*) AS n_rows FROM reviews
WHERE rating IS NOT NULL AND NOT isnan(rating)
GROUP BY rating ORDER BY n_rows DESC, rating""", R)
def rating_counts(spark, sf_dir):
    return profile.value_counts(reviews(spark, sf_dir), "rating")


@query("rating_histogram", """
SELECT rating, count(*) AS n_rows FROM reviews
WHERE rating IS NOT NULL AND NOT isnan(rating)
GROUP BY rating ORDER BY rating""", R)
def rating_histogram(spark, sf_dir):
    return profile.histogram(reviews(spark, sf_dir), "rating")


@query("polarity_counts", f"""
WITH {_PREPARED_SQL}
SELECT sentiment, count(*) AS n_rows FROM prepared WHERE sentiment IS NOT NULL
GROUP BY sentiment ORDER BY n_rows DESC, sentiment""", R)
def polarity_counts(spark, sf_dir):
    return profile.value_counts(_prepared(spark, sf_dir), "sentiment")


def polarity_by_rating(spark, sf_dir):
    """Flagship: reviews per rating with their polarity and mean full-text length."""
    p = _prepared(spark, sf_dir)
    return (p.groupBy("rating", "sentiment")
             .agg(F.count(F.lit(1)).alias("n_reviews"),
                  F.round(F.avg(F.length("review_full_text")), 4).alias("avg_full_text_chars"))
             .orderBy(F.col("rating").asc_nulls_last()))


query("polarity_by_rating", f"""
WITH {_PREPARED_SQL}
SELECT rating, sentiment, count(*) AS n_reviews,
       round(avg(length(review_full_text)), 4) AS avg_full_text_chars
FROM prepared GROUP BY rating, sentiment ORDER BY rating NULLS LAST""", R)(polarity_by_rating)
