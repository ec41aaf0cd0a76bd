import hashlib
import math

import pytest

from reviewflow.operators import sampling, text


def _frame(spark, n):
    return spark.range(n).withColumnRenamed("id", "k")


@pytest.mark.parametrize("n", [0, 1, 50])
def test_sample_exact_sizes(spark, n):
    df = _frame(spark, 50)
    got = sampling.sample_exact(df, n, "k")
    ids = [r.k for r in got.collect()]
    assert len(ids) == n and len(set(ids)) == n


def test_sample_too_large(spark):
    with pytest.raises(ValueError):
        sampling.sample_exact(_frame(spark, 5), 6, "k")


def test_sample_independent_of_partitioning(spark):
    df = _frame(spark, 500)
    a = {r.k for r in sampling.sample_exact(df, 40, "k").collect()}
    b = {r.k for r in sampling.sample_exact(df.repartition(7), 40, "k").collect()}
    assert a == b


def test_sample_not_strict_gives_whole_frame(spark):
    assert sampling.sample_exact(_frame(spark, 5), 6, "k", strict=False).count() == 5


@pytest.mark.parametrize("k", [1, 777, 3000])
def test_kth_cut_histogram_passes_equal_brute_force(spark, k):
    order = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in range(3000))
    assert sampling.kth_cut(_frame(spark, 3000), "k", k) == order[k - 1]
    got = {r.k for r in sampling.sample_exact(_frame(spark, 3000), k, "k").collect()}
    assert got == {i for _, i in order[:k]}


@pytest.mark.parametrize("n", [1, 9, 10, 11])
def test_split_sizes_and_partition(spark, n):
    df = _frame(spark, n)
    train, test = sampling.split_exact(df, "k", 0.1)
    tr, te = {r.k for r in train.collect()}, {r.k for r in test.collect()}
    assert len(te) == math.ceil(n * 0.1)
    assert tr | te == set(range(n)) and not (tr & te)


def test_encode_edges(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a b"), (3, "a b c d"), (4, "a b c d e f"), (5, "zz a")],
                                 "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 10, 2), ("b", 5, 3), ("c", 4, 4), ("d", 3, 5)],
                                  "token string, n_occurrences long, token_id int")
    got = {r.doc_id: (r.n_tokens, r.input_ids, r.attention_mask)
           for r in text.encode(docs, vocab, length=4).collect()}
    assert got[1] == (0, [0, 0, 0, 0], [0, 0, 0, 0])
    assert got[2] == (2, [2, 3, 0, 0], [1, 1, 0, 0])
    assert got[3] == (4, [2, 3, 4, 5], [1, 1, 1, 1])
    assert got[4] == (6, [2, 3, 4, 5], [1, 1, 1, 1])
    assert got[5] == (2, [1, 2, 0, 0], [1, 1, 0, 0])


def test_token_counts_whole_text(spark):
    docs = spark.createDataFrame([(1, "A a, b!"), (2, "a c")], "doc_id long, text string")
    got = {r.token: (r.n_occurrences, r.n_docs) for r in text.token_counts(docs).collect()}
    assert got == {"a": (3, 2), "b": (1, 1), "c": (1, 1)}


def test_kth_cut_matches_sort(spark):
    """The histogram search finds the same k-th row as a full sort."""
    df = _frame(spark, 3000)
    rows = sorted((r.h, r.k) for r in df.select("k", sampling.hash_order("k").alias("h")).collect())
    for k in (1, 7, 1500, 3000):
        assert sampling.kth_cut(df, "k", k) == rows[k - 1]


def test_large_sample_too_large_raises(spark):
    with pytest.raises(ValueError):
        sampling.sample_exact(_frame(spark, 30), 40, "k")


def test_full_vocabulary_ranks(spark):
    counts = spark.createDataFrame([(f"t{i}", i % 7, 1) for i in range(200)], "token string, n_occurrences long, n_docs long")
    got = {r.token: r.token_id for r in text.full_vocabulary(counts).collect()}
    order = sorted(((-(i % 7), f"t{i}") for i in range(200)))
    assert got == {t: k + 2 for k, (_, t) in enumerate(order)}


def test_token_counts_edges(spark):
    docs = spark.createDataFrame([(1, "-b, a b"), (2, "B!"), (2, "B!"), (3, ""), (4, None), (5, "é?")], "doc_id long, text string")
    got = {r.token: (r.n_occurrences, r.n_docs) for r in text.token_counts(docs).collect()}
    assert got == {"a": (1, 1), "b": (4, 3)}


def test_encode_keeps_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "b b a"), (None, "a"), (None, None)], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "token string, token_id int")
    got = sorted((str(r.doc_id), r.n_tokens, r.input_ids, r.attention_mask) for r in text.encode(docs, vocab, length=2).collect())
    assert got == [("1", 2, [2, 3], [1, 1]), ("1", 2, [2, 3], [1, 1]), ("1", 3, [3, 3], [1, 1]),
                   ("None", 0, [0, 0], [0, 0]), ("None", 1, [2, 0], [1, 0])]


def test_a_changed_table_is_fitted_anew(spark, tmp_path):
    from reviewflow.plans.text_model import _files_digest

    one, two = (str(tmp_path / n) for n in ("one", "two"))
    for path in (one, two):
        spark.range(3).write.parquet(path)
    before = _files_digest(spark, one, two)
    assert before == _files_digest(spark, one, two)
    spark.range(2).write.mode("append").parquet(two)
    assert before != _files_digest(spark, one, two)


def test_encode_with_plugin_tokenizer(spark):
    docs = spark.createDataFrame([(1, "ab cd"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.input_ids, r.attention_mask)
           for r in text.encode_with(docs, lambda s: [len(w) for w in s.split()], length=3).collect()}
    assert got == {1: (2, [2, 2, 0], [1, 1, 0]), 2: (0, [0, 0, 0], [0, 0, 0]), 3: (0, [0, 0, 0], [0, 0, 0])}


def test_score_with_plugin_model(spark):
    import numpy as np

    from reviewflow.operators import model as mdl

    def make_predict():
        def predict(texts):
            return np.array([0.9 if "good" in t else 0.2 for t in texts], dtype=np.float64)
        return predict

    df = spark.createDataFrame([("good stuff",), ("bad",)], "review_full_text string")
    rows = {r.review_full_text: (r.label_code, round(r.score, 2)) for r in mdl.score_with(df, make_predict).collect()}
    assert rows == {"good stuff": ("LABEL_1", 0.9), "bad": ("LABEL_0", 0.8)}
