"""Training by epochs and the incremental ETL job."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewflow import jobs
from reviewflow.operators import epochs
from reviewflow.session import scratch_path
from reviewflow.sources import files

ROWS = "key long, label double, indices array<int>, values array<double>"


def test_ridge_weights_match_the_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) @ np.array([[1, .2, 0], [0, 1, .1], [0, 0, .8]])
    x -= x.mean(0)
    y = x @ np.array([1.5, -2.0, 0.5]) + 0.7 + rng.normal(size=400) / 10
    rows = [(k, float(y[k]), [0, 1, 2], x[k].tolist()) for k in range(400)]
    df = spark.createDataFrame(rows, ROWS).repartition(4).cache()
    decay = 0.05
    plan = epochs.Plan(epochs=60, batch_rows=None, learning_rate=0.6, warmup_steps=2, final_share=1.0, weight_decay=decay, loss="squared")
    (w, bias), history = epochs.train(df, df, 3, plan)
    # decoupled decay's fixed point: gradient + decay * w = 0
    want = np.linalg.solve(x.T @ x / 400 + decay * np.eye(3), x.T @ (y - y.mean()) / 400)
    assert np.abs(w - want).max() < 1e-4 and abs(bias - y.mean()) < 1e-6
    assert len(history) == 60 and history[-1]["test_loss"] < history[0]["test_loss"]


def test_mini_batches_cover_every_row_once_an_epoch(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    plan = epochs.Plan(batch_rows=100)
    for epoch in range(2):
        sizes = df.groupBy(epochs.in_batch(F.col("key"), plan, epoch, 10).alias("b")).count().collect()
        assert sum(r["count"] for r in sizes) == 1000 and len(sizes) == 10
    again = lambda e: [r.b for r in df.select(epochs.in_batch(F.col("key"), plan, e, 10).alias("b")).collect()]
    assert again(0) != again(1) and again(0) == again(0)
    assert [round(epochs.Plan(learning_rate=1.0, warmup_steps=4, final_share=0.0).rate(s, 8), 3) for s in range(8)] == [.25, .5, .75, 1, 1, .75, .5, .25]


def test_classifier_learns_by_epochs(spark):
    texts = [(k, k % 2, ("great fine good " if k % 2 else "bad awful poor ") + f"item {k % 7}") for k in range(300)]
    texts += [(900, 1, ""), (901, 0, None)]
    rows = epochs.hashed_features(spark.createDataFrame(texts, "id long, y int, text string"), "id", "y", "text", 512).cache()
    got = {r.key: r for r in rows.collect()}
    assert got[900].indices == [] == got[901].values and abs(sum(v * v for v in got[0]["values"]) - 1) < 1e-9
    train, test = rows.where("key % 5 <> 0"), rows.where("key % 5 = 0")
    model, history = epochs.train(train, test, 512, epochs.Plan(epochs=3, batch_rows=60, learning_rate=2.0, momentum=0.9))
    assert [h["epoch"] for h in history] == [1, 2, 3] and history[-1]["steps"] == 3 * math.ceil(train.count() / 60)
    assert history[-1]["test_loss"] < 0.2 < history[0]["train_loss"]
    p = {r.key: r.p_positive for r in epochs.score(test, model).collect()}
    assert all((p[k] > 0.5) == bool(k % 2) for k in p if k < 900)
    again, _ = epochs.train(train.repartition(7), test, 512, epochs.Plan(epochs=3, batch_rows=60, learning_rate=2.0, momentum=0.9))
    assert np.abs(again[0] - model[0]).max() < 1e-9  # the partitioning doesn't matter
    (w, bias), none = epochs.train(train.where("key < 0"), test, 512)
    assert not w.any() and bias == 0 and none[-1]["train_loss"] is None


def test_a_step_reads_its_batch_alone(spark, monkeypatch):
    """The table is read once an epoch (and counted once), not once a step, and rounds and pieces change nothing."""
    rng = np.random.default_rng(5)
    rows = [(k // 2 if k % 9 else None, float(k % 2), [k % 2, 2 + k % 5], [1.0, float(rng.normal())]) for k in range(400)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, ROWS).repartition(3).mapInArrow(counted, ROWS)
    test = spark.createDataFrame(rows[:40], ROWS)
    plan = epochs.Plan(epochs=2, batch_rows=10, learning_rate=1.0)
    (w, bias), history = epochs.train(df, test, 8, plan)
    assert read.value <= 400 * (1 + plan.epochs) and history[-1]["steps"] == 80
    # the same steps, taken one row after another
    u, c = np.zeros(8), 0.0
    batch_of = {e: {r.key: r.b for r in df.select("key", epochs.in_batch(F.col("key"), plan, e, 40).alias("b")).distinct().collect()} for e in range(2)}
    for step in range(80):
        mine = [r for r in rows if batch_of[step // 40][r[0]] == step % 40]
        g, g_c, rate = np.zeros(8), 0.0, plan.rate(step, 80)
        for _, y, at, x in mine:
            d = 1 / (1 + math.exp(-(c + sum(u[i] * v for i, v in zip(at, x))))) - y
            g_c += d
            for i, v in zip(at, x):
                g[i] += d * v
        if mine:
            u = u * (1 - rate * plan.weight_decay) - rate * g / len(mine)
            c -= rate * g_c / len(mine)
    assert np.abs(w - u).max() < 1e-9 and abs(bias - c) < 1e-9
    monkeypatch.setattr(epochs, "TASK_ROWS", 4)
    monkeypatch.setattr(epochs, "ROUND", 30)
    again, _ = epochs.train(df, test, 8, plan)
    assert np.abs(again[0] - w).max() < 1e-9


def test_long_text_features(spark):
    long = " ".join(f"w{k % 900}" for k in range(40_000))
    r = epochs.hashed_features(spark.createDataFrame([(1, 1, long)], "id long, y int, text string"), "id", "y", "text", 1 << 14).first()
    assert 800 < len(r.indices) <= 900 and r.indices == sorted(set(r.indices))


SCHEMA = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("rating", T.DoubleType()),
                       T.StructField("other", T.StringType())])


def _lines(spark, folder, rows):
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in rows], "value string").coalesce(1).write.text(folder)


def test_three_incremental_runs_equal_one(spark):
    parts = [[{"text": "a", "rating": 1.0}, {"text": "b"}, "{cut"],
             [{"text": "c", "title": "now a title"}, {"text": " "}],
             [{"text": None, "rating": 2.0, "other": "x"}, "no json", {"title": "t"}]]
    raw, ckpt = scratch_path(spark, "growing"), scratch_path(spark, "growing-ckpt")
    job = jobs.IncrementalClean(spark, raw, scratch_path(spark, "out"), SCHEMA, ("title", "text", "rating"))
    rules = 'Rules = [ColumnCount > 2, RowCount > 5, Completeness "text" >= 0.5]'
    for k, part in enumerate(parts):
        _lines(spark, f"{raw}/part={k}", part)
        job.run(ckpt)
        if k == 0:  # no titles so far
            assert job.result().columns == ["text", "rating"]
            assert [r.outcome for r in job.report(rules).collect()] == ["Failed", "Failed", "Passed"]
    job.run(ckpt)  # nothing new
    out = scratch_path(spark, "at-once")
    report, metrics = jobs.clean_reviews(spark, raw, out, schema=SCHEMA, fields=("title", "text", "rating"), rules=rules)
    once = files.read_parquet(spark, out)
    assert job.result().columns == once.columns
    assert sorted(map(tuple, job.result().collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    assert sorted(map(tuple, job.report(rules).collect())) == sorted(map(tuple, report.collect()))
    assert files.bad_rows(job.staged()).count() == metrics["rows_quarantined"] == 2
    with pytest.raises(ValueError, match="rule failed"):
        job.report('Rules = [RowCount > 99]', on_fail="raise")
