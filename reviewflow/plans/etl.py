"""ETL queries: JSON-lines scans, quarantine, Parquet round trip, incremental
ingest, null-field profile and drop, data-quality rules.

The file-based queries first write the given table to the shared scratch folder
(below ``spark.checkpoint.dir``) in the raw layout the ETL job reads, then run the
job over it.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, quality
from ..operators import prepare as prep
from ..session import scratch_path
from ..sources import files
from ..tables import read_table, reviews
from .registry import query

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])

_BY_LANG_SQL = """
SELECT lang, count(*) AS n_docs, sum(n_chars) AS sum_chars,
       sum(length(text)) AS sum_text_length
FROM documents GROUP BY lang"""


def _by_lang(df):
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"),
                                  F.sum("n_chars").alias("sum_chars"),
                                  F.sum(F.length("text")).alias("sum_text_length"))


def _write_raw_json(spark, sf_dir, where=None):
    """documents as JSON lines, in one sub-folder per source (the raw layout)."""
    path = scratch_path(spark, "raw-json")
    docs = read_table(spark, sf_dir, "documents")
    if where is not None:
        docs = docs.where(where)
    docs.write.mode("overwrite").partitionBy("source").json(path)
    return path


@query("scan_json_lines", _BY_LANG_SQL)
def scan_json_lines(spark, sf_dir):
    path = _write_raw_json(spark, sf_dir)
    return _by_lang(files.read_json_lines(spark, path, DOC_SCHEMA))


_BY_LANG_QUARANTINE_SQL = _BY_LANG_SQL + """
UNION ALL
SELECT '_corrupt_record' AS lang, count(*) AS n_docs, CAST(NULL AS BIGINT) AS sum_chars,
       CAST(NULL AS BIGINT) AS sum_text_length
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1"""


def _lines_with_bad(spark, sf_dir, docs):
    """Every row of ``docs`` as a JSON line, and documents labelled toxic also as a line
    that is cut off (column ``value``; ``lang`` beside it)."""
    bad_ids = read_table(spark, sf_dir, "labels").where(F.col("toxic") == 1).select("doc_id")
    line = F.to_json(F.struct(*docs.columns))
    good = docs.select("lang", line.alias("value"))
    cut = docs.join(bad_ids, "doc_id", "left_semi").select("lang", F.substring(line, 1, 10).alias("value"))
    return good.unionByName(cut)


def _by_lang_and_bad(scan):
    """Good rows by language and the number of bad ones, in one pass over the scan."""
    bad = F.col(files.CORRUPT_COLUMN).isNotNull()
    return (scan.groupBy(F.when(bad, F.lit(files.CORRUPT_COLUMN)).otherwise(F.col("lang")).alias("lang"))
                .agg(F.count(F.lit(1)).alias("n_docs"),
                     F.sum(F.when(~bad, F.col("n_chars"))).alias("sum_chars"),
                     F.sum(F.when(~bad, F.length("text"))).alias("sum_text_length")))


def _doc_lines(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    return _lines_with_bad(spark, sf_dir, docs)


@query("scan_json_quarantine", _BY_LANG_QUARANTINE_SQL)
def scan_json_quarantine(spark, sf_dir):
    """Every document as a good line; documents labelled toxic also as a cut-off line."""
    path = scratch_path(spark, "raw-mixed")
    _doc_lines(spark, sf_dir).select("value").write.mode("overwrite").text(path)
    return _by_lang_and_bad(files.read_json_permissive(spark, path, DOC_SCHEMA))


@query("incremental_ingest", _BY_LANG_QUARANTINE_SQL)
def incremental_ingest(spark, sf_dir):
    """Two runs over a growing raw folder that holds malformed lines too: the second run
    reads only the new files, bad lines are quarantined."""
    src = scratch_path(spark, "incoming")
    sink = scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest-ckpt")
    lines = _doc_lines(spark, sf_dir)
    first = F.coalesce(F.col("lang") == "en", F.lit(False))
    for k, part in enumerate((lines.where(first), lines.where(~first))):
        part.select("value").write.mode("overwrite").text(f"{src}/batch={k}")
        files.ingest_new_json(spark, src, DOC_SCHEMA, sink, ckpt)
    return _by_lang_and_bad(files.read_parquet(spark, sink))


_PREPARED_AGG_SQL = """
WITH p AS (
  SELECT CASE WHEN rating IS NULL OR isnan(rating) THEN NULL
              WHEN CAST(trunc(rating) AS BIGINT) <= 3 THEN 0 ELSE 1 END AS sentiment,
         title, title || '. ' || text AS review_full_text FROM reviews)
SELECT sentiment, count(*) AS n_reviews, count(title) AS n_titles,
       sum(length(review_full_text)) AS sum_full_text_length
FROM p GROUP BY sentiment"""


@query("sink_parquet_roundtrip", _PREPARED_AGG_SQL, ("reviews",))
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "prepared")
    files.write_parquet(prep.prepare(reviews(spark, sf_dir)), path)
    back = files.read_parquet(spark, path)
    return back.groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.count("title").alias("n_titles"),
        F.sum(F.length("review_full_text")).alias("sum_full_text_length"))


# Fixed values for the profiled frame: sentinel sets of the query.
NULL_STRINGS = ("", "null")
NULL_NUMBERS = (-1, None)


def profiled_frame(spark, sf_dir):
    """reviews plus an all-null column, a void column, sentinel-only string and
    number columns, a nested struct and an array of struct."""
    r = reviews(spark, sf_dir)
    no_rating = F.col("rating").isNull()
    return r.select(
        "doc_id", "rating", "title", "text",
        F.lit(None).cast("string").alias("all_null"),
        F.lit(None).alias("void_col"),
        F.when(no_rating, F.lit("null")).otherwise(F.lit(" ")).alias("note"),
        F.when(no_rating, F.lit(-1)).alias("score"),
        F.struct(F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("memo")).alias("meta"),
        F.array(F.struct(F.substring_index(F.col("text"), " ", 1).alias("word"),
                         F.lit(None).cast("bigint").alias("code"))).alias("tags"))


_PROFILE_SQL = r"""
WITH f AS (
  SELECT doc_id, rating, title, text, CAST(NULL AS VARCHAR) AS all_null,
         CASE WHEN rating IS NULL THEN 'null' ELSE ' ' END AS note,
         CASE WHEN rating IS NULL THEN -1 END AS score,
         split_part(text, ' ', 1) AS tag_word
  FROM reviews),
a AS (
  SELECT count(*) AS n_rows,
    count(doc_id) AS v_doc_id, coalesce(bool_or(doc_id IS NOT NULL AND doc_id <> -1), false) AS b_doc_id,
    count(rating) AS v_rating, coalesce(bool_or(rating IS NOT NULL AND rating <> -1), false) AS b_rating,
    count(title) AS v_title, coalesce(bool_or(title IS NULL OR regexp_replace(title, '^\s+|\s+$', '', 'g') NOT IN ('', 'null')), false) AS b_title,
    count(text) AS v_text, coalesce(bool_or(text IS NULL OR regexp_replace(text, '^\s+|\s+$', '', 'g') NOT IN ('', 'null')), false) AS b_text,
    count(all_null) AS v_all_null, coalesce(bool_or(all_null IS NULL OR regexp_replace(all_null, '^\s+|\s+$', '', 'g') NOT IN ('', 'null')), false) AS b_all_null,
    count(note) AS v_note, coalesce(bool_or(note IS NULL OR regexp_replace(note, '^\s+|\s+$', '', 'g') NOT IN ('', 'null')), false) AS b_note,
    count(score) AS v_score, coalesce(bool_or(score IS NOT NULL AND score <> -1), false) AS b_score,
    count(tag_word) AS v_tag_word,
    coalesce(bool_or(tag_word IS NULL OR regexp_replace(tag_word, '^\s+|\s+$', '', 'g') NOT IN ('', 'null')), false) AS b_tag_word
  FROM f),
leaf(path, data_type, n_with_value, bad, examined, void) AS (
  SELECT 'doc_id', 'bigint', v_doc_id, b_doc_id, true, false FROM a UNION ALL
  SELECT 'rating', 'double', v_rating, b_rating, true, false FROM a UNION ALL
  SELECT 'title', 'string', v_title, b_title, true, false FROM a UNION ALL
  SELECT 'text', 'string', v_text, b_text, true, false FROM a UNION ALL
  SELECT 'all_null', 'string', v_all_null, b_all_null, true, false FROM a UNION ALL
  SELECT 'void_col', 'void', 0, true, false, true FROM a UNION ALL
  SELECT 'note', 'string', v_note, b_note, true, false FROM a UNION ALL
  SELECT 'score', 'int', v_score, b_score, true, false FROM a UNION ALL
  SELECT 'meta.id', 'bigint', v_doc_id, b_doc_id, true, false FROM a UNION ALL
  SELECT 'meta.memo', 'string', 0, true, true, false FROM a UNION ALL
  SELECT 'tags.word', 'string', v_tag_word, b_tag_word, true, false FROM a UNION ALL
  SELECT 'tags.code', 'bigint', 0, false, true, false FROM a)
SELECT path, data_type, n_rows, n_with_value,
       (examined AND NOT bad) AS only_sentinels,
       (n_rows > 0 AND (void OR n_with_value = 0 OR (examined AND NOT bad))) AS dropped
FROM leaf, a"""


@query("null_field_profile", _PROFILE_SQL, ("reviews",))
def null_field_profile(spark, sf_dir):
    return (clean.profile(profiled_frame(spark, sf_dir), NULL_STRINGS, NULL_NUMBERS)
            .withColumnRenamed("drop", "dropped"))


@query("drop_null_fields", """
SELECT path, data_type, n_with_value FROM (
  SELECT 'doc_id' AS path, 'bigint' AS data_type, count(doc_id) AS n_with_value FROM reviews UNION ALL
  SELECT 'rating', 'double', count(rating) FROM reviews UNION ALL
  SELECT 'title', 'string', count(title) FROM reviews UNION ALL
  SELECT 'text', 'string', count(text) FROM reviews UNION ALL
  SELECT 'meta.id', 'bigint', count(doc_id) FROM reviews UNION ALL
  SELECT 'tags.word', 'string', count(*) FROM reviews) s""", ("reviews",))
def drop_null_fields(spark, sf_dir):
    kept = clean.drop_null_fields(profiled_frame(spark, sf_dir), NULL_STRINGS, NULL_NUMBERS)
    return clean.profile(kept).select("path", "data_type", "n_with_value")


# The job's rule plus two completeness / size rules (extension).
QUALITY_RULES = 'Rules = [ColumnCount > 0, RowCount > 0, Completeness "title" >= 0.8]'


@query("quality_report", """
SELECT 'ColumnCount > 0' AS rule, CAST(6 AS DOUBLE) AS observed, 'Passed' AS outcome
UNION ALL
SELECT 'RowCount > 0', CAST(count(*) AS DOUBLE), CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END FROM reviews
UNION ALL
SELECT 'Completeness "title" >= 0.8', count(title) / count(*),
       CASE WHEN count(title) / count(*) >= 0.8 THEN 'Passed' ELSE 'Failed' END FROM reviews""", ("reviews",))
def quality_report(spark, sf_dir):
    kept = clean.drop_null_fields(profiled_frame(spark, sf_dir), NULL_STRINGS, NULL_NUMBERS)
    return quality.evaluate(kept, QUALITY_RULES)


# Row rules of the review table.
ROW_RULES = 'Rules = [RowCount > 0, Completeness "title" >= 0.8, Completeness "rating" >= 0.9, ColumnValues "rating" >= 2, ColumnLength "text" <= 4000]'
_ROW_CHECKS = {'Completeness "title" >= 0.8': "title IS NOT NULL", 'Completeness "rating" >= 0.9': "rating IS NOT NULL",
               'ColumnValues "rating" >= 2': "coalesce(rating >= 2, false)", 'ColumnLength "text" <= 4000': "coalesce(length(text) <= 4000, false)"}


def _checked_reviews(spark, sf_dir):
    """The reviews with their row outcomes, written in one pass and read back."""
    path = scratch_path(spark, "checked")
    files.write_parquet(quality.with_outcomes(reviews(spark, sf_dir), ROW_RULES), path)
    return files.read_parquet(spark, path)


@query("quality_row_failures", " UNION ALL ".join(
    f"SELECT doc_id, '{rule}' AS rule FROM reviews WHERE NOT ({check})" for rule, check in _ROW_CHECKS.items()), ("reviews",))
def quality_row_failures(spark, sf_dir):
    """Every row and rule that it fails."""
    return _checked_reviews(spark, sf_dir).select("doc_id", F.explode(quality.FAILED_COLUMN).alias("rule"))


@query("quality_outcomes", """
SELECT 'RowCount > 0' AS rule, CAST(count(*) AS DOUBLE) AS observed, CAST(NULL AS BIGINT) AS failed_rows,
       CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END AS outcome FROM reviews""" + "".join(
    f"""
UNION ALL SELECT '{rule}', avg(CASE WHEN {check} THEN 1.0 ELSE 0.0 END), count(*) FILTER (WHERE NOT ({check})),
       CASE WHEN {f"avg(CASE WHEN {check} THEN 1.0 ELSE 0.0 END) >= {rule.split()[-1]}" if rule.startswith("Completeness")
                  else f"bool_and({check})"} THEN 'Passed' ELSE 'Failed' END FROM reviews""" for rule, check in _ROW_CHECKS.items()), ("reviews",))
def quality_outcomes(spark, sf_dir):
    """The rule table, aggregated from the outcomes that were written beside the data."""
    return quality.outcomes(_checked_reviews(spark, sf_dir), ROW_RULES)


RAW_REVIEW_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
    T.StructField("rating", T.DoubleType()), T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("extra_note", T.StringType())])


_ETL_SQL = """
SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns, count(title) AS n_titles,
       sum(rating) AS sum_rating, sum(length(text)) AS sum_text_length,
       CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END AS quality_outcome, count(*) AS rows_written,
       (SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1) AS rows_quarantined
FROM reviews"""


def _raw_reviews(spark, sf_dir):
    """The reviews as raw lines (``value``; ``lang`` beside it): an always-empty extra field, some lines cut off."""
    docs = (reviews(spark, sf_dir).join(read_table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
            .withColumn("extra_note", F.lit(None).cast("string")))
    return _lines_with_bad(spark, sf_dir, docs)


def _etl_result(back, outcome, written, quarantined):
    return back.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.lit(len(back.columns)).cast("long").alias("n_columns"),
                    F.count("title").alias("n_titles"), F.sum("rating").alias("sum_rating"),
                    F.sum(F.length("text")).alias("sum_text_length"),
                    F.lit(outcome).alias("quality_outcome"),
                    F.lit(written).cast("long").alias("rows_written"),
                    F.lit(quarantined).cast("long").alias("rows_quarantined"))


@query("etl_job", _ETL_SQL, ("reviews",))
def etl_job(spark, sf_dir):
    """The whole ETL job: reviews as raw JSON lines (one folder per language, an
    always-empty extra field, some lines cut off) -> select -> drop empty columns -> rules -> Parquet."""
    from ..jobs import clean_reviews
    raw = scratch_path(spark, "raw-reviews")
    _raw_reviews(spark, sf_dir).write.mode("overwrite").partitionBy("lang").text(raw)
    out = scratch_path(spark, "processed")
    report, metrics = clean_reviews(spark, raw, out, schema=RAW_REVIEW_SCHEMA)
    outcome = report.where("rule = 'ColumnCount > 0'").first()["outcome"]
    return _etl_result(files.read_parquet(spark, out), outcome, metrics["rows_written"], metrics["rows_quarantined"])


@query("etl_incremental", _ETL_SQL, ("reviews",))
def etl_incremental(spark, sf_dir):
    """The whole ETL job in three runs over a growing folder: the same answer as one run over all of it."""
    from ..jobs import IncrementalClean
    raw, ckpt = scratch_path(spark, "raw-growing"), scratch_path(spark, "etl-ckpt")
    job = IncrementalClean(spark, raw, scratch_path(spark, "cleaned"), RAW_REVIEW_SCHEMA)
    lines, lang = _raw_reviews(spark, sf_dir), F.coalesce(F.col("lang"), F.lit(""))
    for k, part in enumerate((lang == "en", lang == "de", ~lang.isin("en", "de"))):
        lines.where(part).select("value").write.text(f"{raw}/arrived={k}")
        job.run(ckpt)
    back = job.result()
    outcome = job.report().where("rule = 'ColumnCount > 0'").first()["outcome"]
    return _etl_result(back, outcome, files.good_rows(job.staged()).count(), files.bad_rows(job.staged()).count())
