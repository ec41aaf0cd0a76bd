"""Positive-unlabelled learning: held-out accuracy, edge cases, the risk's gradient."""

import random
import zlib

import numpy as np

from reviewflow.llm import toxicity


def corpus(n=700):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        bad = i % 7 == 0
        if bad:
            for _ in range(rng.randint(2, 5)):
                text[rng.randrange(len(text))] = rng.choice(["idiot", "scum", "zzkrau" + rng.choice(["ni", "ta", "lo", "mee"])])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    truth = dict(labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 150
    assert np.mean([(got[i] >= toxicity.SCORE_CUT) == bool(truth[i]) for i in held]) > 0.95


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a == b


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "some text", 3.0), (3, "x " * 50_000, 4.0), (3, "x", 4.0)],
                                 "doc_id long, text string, other double")
    none = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.0] * 5
    rows, labels = corpus(150)
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "other", "score"]
    assert all(0 <= r.score <= 1 for r in scored.collect())
    empty = docs.where("false")
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(empty.select("doc_id", "text"), none) == toxicity.Model({}, 0.0, 0.0)


def test_training_separates_and_keeps_the_risk_non_negative():
    rng = np.random.default_rng(1)
    positive = [np.array([0, 2 + rng.integers(0, 5)]) for _ in range(200)]
    unlabelled = [np.array([0]) for _ in range(100)] + [np.array([1, 2 + rng.integers(0, 5)]) for _ in range(900)]
    weights, bias = toxicity.train(positive, unlabelled, 7, 0.1)
    assert weights[0] + bias > 0.85 > -1 > weights[1] + bias


def test_registered_query(spark):
    from reviewflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op3_toxicity"](spark, d).collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.85


def test_two_fits_agree_bit_for_bit(spark):
    """Equal texts, in the sample as labelled and as unlabelled rows, in another order and partitioning."""
    rng = random.Random(5)
    docs, labels = corpus(500)
    docs += [(1000 + i, t) for i, t in docs]
    labels = labels[::2]
    models = []
    for parts in (1, 7):
        rng.shuffle(docs)
        models.append(toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
                                   spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts)))
    assert models[0].weights and models[0] == models[1]
    clash = spark.createDataFrame([(1, "vile hate", 9.0)], "doc_id long, text string, Score double")
    assert toxicity.score(clash, models[0]).columns == ["doc_id", "text", "Score", "_score"]
