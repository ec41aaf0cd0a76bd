"""As-of joins against a loop, row outcomes of rules, plug-in scoring by value."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reviewflow.operators import asof, model, quality

T0 = dt.datetime(2024, 1, 1)


def test_asof_join_against_a_loop(spark):
    rng = random.Random(4)
    at = lambda s: T0 + dt.timedelta(seconds=s)
    log = [(rng.choice(["hot"] * 5 + ["b", "c"]), at(rng.randrange(0, 20_000, 50)), k, f"v{k}") for k in range(300)]
    asked = [(k, rng.choice(["hot"] * 5 + ["b", "c", "none", None]), at(rng.randrange(-100, 21_000, 50)) if rng.random() < .95 else None) for k in range(400)]
    right = spark.createDataFrame([*log, (None, T0, 1000, "x"), ("hot", None, 1001, "y")], "key string, since timestamp_ntz, n int, value string")
    left = spark.createDataFrame(asked, "id int, key string, t timestamp_ntz")
    got = {r.id: (r.since, r.value) for r in asof.asof_join(left, right, "key", "t", "since", ["n"], bucket_seconds=900).collect()}
    by = {}
    for key, t, n, v in sorted(log, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(key, []).append((t, v))
    for i, key, t in asked:
        known = by.get(key, []) if t is not None else []
        k = bisect.bisect_right([x[0] for x in known], t) - 1 if known else -1
        assert got[i] == (known[k] if k >= 0 else (None, None)), i
    assert len(got) == len(asked)


def test_asof_join_edges(spark):
    left = spark.createDataFrame([(1, "a", T0)], "id int, key string, t timestamp_ntz")
    right = spark.createDataFrame([], "key string, since timestamp_ntz, v string")
    assert [tuple(r) for r in asof.asof_join(left, right, "key", "t", "since").collect()] == [(1, "a", T0, None, None)]
    assert asof.asof_join(left.where("id = 2"), right, "key", "t", "since").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(left, right.withColumnRenamed("v", "ID"), "key", "t", "since")


def test_asof_join_spreads_a_hot_key(spark):
    """Exchanges are by (key, bucket); only the summary, a row a bucket, is windowed by key."""
    left = spark.range(1000).select("id", F.lit("hot").alias("key"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 60)).alias("t"))
    right = left.select("key", F.col("t").alias("since"), F.col("id").alias("v"))
    plan = asof.asof_join(left, right, "key", "t", "since")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("[k#" in w and ", b#" in w.split("], [")[1] for w in windows) == 1


def test_row_outcomes(spark):
    rows = [(1, "a", 3.0), (2, None, 1.0), (3, "long title", None), (4, None, None)]
    df = spark.createDataFrame(rows, "id int, title string, rating double")
    rules = 'Rules = [RowCount > 3, ColumnCount = 3, Completeness "title" >= 0.5, ColumnValues "rating" >= 2, ColumnLength "title" < 5]'
    checked = quality.with_outcomes(df, rules)
    failed = {r.id: list(r.failed_rules) for r in checked.collect()}
    c, v, n = 'Completeness "title" >= 0.5', 'ColumnValues "rating" >= 2', 'ColumnLength "title" < 5'
    assert failed == {1: [], 2: [c, v, n], 3: [v, n], 4: [c, v, n]}
    table = {r.rule: (r.observed, r.failed_rows, r.outcome) for r in quality.outcomes(checked, rules).collect()}
    assert table == {"RowCount > 3": (4.0, None, "Passed"), "ColumnCount = 3": (3.0, None, "Passed"), c: (0.5, 2, "Passed"),
                     v: (0.25, 3, "Failed"), n: (0.25, 3, "Failed")}
    empty = quality.outcomes(quality.with_outcomes(df.where("id > 9"), rules), rules).collect()
    assert [r.outcome for r in empty] == ["Failed", "Passed", "Failed", "Passed", "Passed"]
    assert quality.with_outcomes(df, quality.DEFAULT_RULES).where("size(failed_rules) > 0").count() == 0


def test_plug_in_scores_equal_expressions(spark):
    texts = [None, "", "Good, GOOD phone!", "bad 2 bad", "é ü 漢字", "x" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    own = {r.id: (r.label_code, r.score) for r in model.hashed_score(df, "text").collect()}
    plugged = {r.id: (r.label_code, round(r.score, 6)) for r in model.score_with(df, model.make_hashed_predict, "text").collect()}
    assert own == plugged and own[0] == own[1] == ("LABEL_1", 0.5) and len(set(own.values())) > 3
