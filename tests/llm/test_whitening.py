import math
import random

import numpy as np

from reviewflow.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>"


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for low, high, rows, width in [(0, 1, 1, 3), (-5, 6, 200, 4), (99_000, 101_000, 65, 9), (-2**61, 2**61, 70, 3), (7, 8, 10, 2)]:
        x = rng.integers(low, high, (rows, width))
        n, sums, cross = w.scatter(x)
        o = x.astype(object)
        assert n == rows and list(sums) == list(o.sum(0)) and (cross == o.T @ o).all()


def test_limbs():
    for value in [0, 1, -1, 2**200 - 1 >> 60, -2**130, 2**124 * 10**9]:
        assert sum(v << w.LIMB * k for k, v in enumerate(w._limbs(value))) == value


def expected(rows):
    """Plain numpy over all usable vectors of one length."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in usable], object)
    n, sums = len(x), x.sum(0)
    y = (x * n - sums)
    cov = (y.T @ y / n**3).astype(float)
    e, vec = np.linalg.eigh(cov)
    return usable, n, (y * y).sum(1), cov, e[::-1], vec[:, ::-1], (y / n).astype(float)


def test_against_numpy(spark):
    rng = np.random.default_rng(4)
    basis = rng.normal(size=(12, 12)) * np.arange(1, 13)
    rows = [(k, (rng.normal(size=12) @ basis / 50).tolist()) for k in range(5000)]
    rows += [(5000, None), (5001, [1.0] * 11 + [None]), (5002, [float("nan")] * 12), (5003, [float("inf")] * 12), (5004, [])]
    rows += [(None, rows[0][1]), (3, rows[3][1])]
    got = w.components_of(w.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))).toPandas()
    usable, n, deviation, cov, e, vec, centred = expected(rows)
    assert len(got) == 8 * len(usable) and set(got.n) == {n}
    assert got.identity_error.max() <= 1e-9 and got.identity_error.nunique() == 1
    by = {i: d for (i, _), d in zip(usable, deviation)}
    assert all(by[None if math.isnan(i) else int(i)] == d for i, d in zip(got.vec_id, got.deviation))
    for k in range(8):
        mine = got[(got.component == k + 1) & got.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id")
        want = {i: c for (i, _), c in zip(usable, centred @ vec[:, k] / math.sqrt(e[k])) if i is not None}
        a, b = mine.whitened.to_numpy(), np.array([want[int(i)] for i in mine.index])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert abs(mine.explained.iloc[0] / (e[k] / np.trace(cov)) - 1) < 1e-9


def test_edges(spark):
    def run(rows, schema=SCHEMA):
        return w.components_of(w.whiten(spark.createDataFrame(rows, schema))).collect()
    assert run([]) == []
    assert run([(1, None), (2, [])]) == []
    one = run([(1, [0.5, 0.25])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    # equal vectors, another length beside them, no variance in one dimension
    mixed = run([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 3.0]), (4, [1.0]), (5, [2.0]), (6, [2.0])])
    two = [r for r in mixed if r.vec_id == 1]
    assert [r.n for r in two] == [3, 3] and two[1].whitened is None and abs(two[0].explained - 1) < 1e-12
    assert [r.n for r in mixed if r.vec_id == 5] == [3]
    # far apart: a deviation that no long holds, and an entry whose integer has no 62 bits
    far = run([(1, [1e15]), (2, [-1e15]), (3, [3.0e38]), (4, [0.0])])
    assert {r.vec_id for r in far} == {1, 2, 4} and [r.deviation for r in far if r.vec_id == 1] == [None]
    assert abs(sum(r.whitened ** 2 for r in far) / 3 - 1) < 1e-9
    clash = run([(1, [1.0], 1, 2), (2, [3.0], 3, 4)], SCHEMA + ", n int, Whitened int")
    assert len(clash) == 2


def test_wide_vectors_in_blocks(monkeypatch):
    monkeypatch.setattr(w, "PAIR_WORDS", 5)
    rng = random.Random(1)
    x = np.array([[rng.randint(-50, 50) for _ in range(30)] for _ in range(40)])
    assert (w.scatter(x)[2] == x.astype(object).T @ x).all()
