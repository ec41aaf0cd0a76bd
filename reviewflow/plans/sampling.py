"""Sampling and split queries over the prepared reviews."""

from __future__ import annotations

from ..operators import prepare as prep
from ..operators import sampling
from ..tables import read_table, reviews
from .registry import query

R = ("reviews",)
SAMPLE_N = 100
SEED = 42

_PREP = """
WITH p AS (
  SELECT doc_id, rating,
         CASE WHEN rating IS NULL OR isnan(rating) THEN NULL
              WHEN CAST(trunc(rating) AS BIGINT) <= 3 THEN 0 ELSE 1 END AS sentiment,
         md5(concat('42:', CAST(doc_id AS VARCHAR))) AS h
  FROM reviews)"""


def _prepared(spark, sf_dir):
    return prep.prepare(reviews(spark, sf_dir)).select("doc_id", "rating", "sentiment")


def _keys(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id")   # one review for each document


@query("sample_exact", _PREP + f"""
SELECT doc_id, rating, sentiment FROM p ORDER BY h, doc_id LIMIT {SAMPLE_N}""", R)
def sample_exact(spark, sf_dir):
    return sampling.sample_exact(_prepared(spark, sf_dir), SAMPLE_N, "doc_id", SEED, keys=_keys(spark, sf_dir))


_TEST_SQL = _PREP + """,
t AS (SELECT doc_id FROM p ORDER BY h, doc_id
      LIMIT (SELECT CAST(ceil(count(*) * 0.1) AS BIGINT) FROM p))"""


@query("test_split", _TEST_SQL + """
SELECT doc_id, rating, sentiment FROM p WHERE doc_id IN (SELECT doc_id FROM t)""", R)
def test_split(spark, sf_dir):
    return sampling.split_exact(_prepared(spark, sf_dir), "doc_id", 0.1, SEED, keys=_keys(spark, sf_dir))[1]


@query("train_split", _TEST_SQL + """
SELECT doc_id, rating, sentiment FROM p WHERE doc_id NOT IN (SELECT doc_id FROM t)""", R)
def train_split(spark, sf_dir):
    return sampling.split_exact(_prepared(spark, sf_dir), "doc_id", 0.1, SEED, keys=_keys(spark, sf_dir))[0]


@query("bucket_split", _PREP + """
SELECT doc_id, rating, sentiment,
       CASE WHEN ('0x' || substr(h, 1, 8))::BIGINT % 100 < 10 THEN 'test' ELSE 'train' END AS split
FROM p""", R)
def bucket_split(spark, sf_dir):
    return sampling.bucket_split(_prepared(spark, sf_dir), "doc_id", 10, SEED)
