"""Embedding groups against all pairs in double precision."""

import numpy as np

from reviewflow.llm import embeddings


def brute_force(rows, cut=embeddings.COSINE):
    ids = [r[0] for r in rows]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = dict.fromkeys(ids, 0)
    good = {i: np.array(v, float) for i, v, y in rows if i is not None and v is not None and y is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {r[0]: r[2] for r in rows}
    names = sorted(good)
    for a in names:
        for b in names:
            if a < b and label[a] == label[b] and len(good[a]) == len(good[b]):
                x, y = good[a] / np.linalg.norm(good[a]), good[b] / np.linalg.norm(good[b])
                if x @ y >= cut:
                    links[a] += 1
                    links[b] += 1
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    return {(i, links[i], find(i), find(i) == i) for i in ids}


def cloud(seed, n=160, width=12):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.normal(size=width).astype(np.float32)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.choice([1, 1, 3, 12]))):
            v = (base + rng.normal(size=width).astype(np.float32) * rng.choice([0, 0.15, 0.3])).tolist()
            rows.append((len(rows), [float(np.float32(x)) for x in v], label))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def result(df):
    return {tuple(r) for r in embeddings.groups(df).collect()}


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_LIST", 10)
    rows = cloud(1)
    want = brute_force(rows)
    assert sum(w[1] for w in want) > 100
    assert result(spark.createDataFrame(rows, SCHEMA)) == want
    monkeypatch.setattr(embeddings, "BLOCK", 7)  # lists and their queries in many cells
    monkeypatch.setattr(embeddings, "SAMPLE_ROWS", 30)
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 3.0], 0),
            (7, [float("nan"), 2.0, 3.0], 0), (8, [float("inf"), 2.0, 3.0], 0), (9, [1.0, 2.0], 0), (10, v, 1), (11, v, 0), (12, [], 0)]
    df = spark.createDataFrame(rows + rows[:2], SCHEMA)
    assert result(df.withColumn("n_links", df.vec_id)) == brute_force(rows)
    assert result(spark.createDataFrame([(None, v, 0), (1, v, 0)], SCHEMA)) == {(None, 0, None, True), (1, 0, 1, True)}
    assert embeddings.groups(df.where("false")).count() == 0
    assert result(df.where("vec_id = 4")) == {(4, 0, 4, True)}


def test_bounds_are_sure():
    """Whatever lies within the distance is probed and passes the code's bound."""
    rng = np.random.default_rng(3)
    sample = embeddings.unit(rng.normal(size=(400, 16)))
    q = embeddings.Quantiser(sample, 20)
    near = embeddings.unit(sample + rng.normal(size=sample.shape) * 0.07)
    own, probes = q.assign(sample)
    to, _ = q.assign(near)
    codes, error = q.encode(near, to)
    close = (sample * near).sum(1) >= embeddings.COSINE
    assert close.sum() > 100 and (own != to).any()
    for i in np.flatnonzero(close):
        assert probes[i, to[i]]
        bound = np.sqrt(2 - 2 * embeddings.COSINE) + embeddings.SLACK + error[i]
        assert q.lookup(sample[i:i + 1], to[i], codes[i:i + 1])[0, 0] <= bound


def narrow(n=1500, width=64, within=4, seed=5):
    """Pairs at cosines of 0.93 to 0.96 whose two vectors differ in few dimensions only."""
    rng = np.random.default_rng(seed)
    one = embeddings.unit(rng.normal(size=(n, width)))
    step = np.zeros((n, width))
    step[:, :within] = rng.normal(size=(n, within))
    step -= (step * one).sum(1)[:, None] * one
    c = rng.uniform(0.931, 0.96, n)[:, None]
    two = c * one + np.sqrt(1 - c * c) * embeddings.unit(step)
    return [(i, v, 0) for i, v in enumerate(np.concatenate([one, two]).tolist())]


def links_of(rows):
    x = embeddings.unit(np.array([v for _, v, _ in rows]))
    return {i: int(k) for (i, _, _), k in zip(rows, ((x @ x.T) >= embeddings.COSINE).sum(1) - 1)}


def test_neighbours_in_few_dimensions(spark, monkeypatch):
    """64 dimensions, 50 lists: no link is lost and each counts for both ends."""
    monkeypatch.setattr(embeddings, "PER_LIST", 60)
    rows = narrow()
    want = links_of(rows)
    assert sum(want.values()) >= len(rows)
    got = embeddings.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.n_links for r in got} == want


def test_longer_vectors_beside(spark, monkeypatch):
    """A vector of another length takes no links from the others."""
    monkeypatch.setattr(embeddings, "PER_LIST", 60)
    rows = narrow(seed=6, within=64)
    want = links_of(rows) | {9999: 0}
    rows.append((9999, [1.0] * 1024, 0))
    got = embeddings.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.n_links for r in got} == want
