"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

1. Every entry c of a usable vector becomes the integer x = floor(1024 c) + 100000. Within a
   block of rows each dimension is shifted by its least x, and every bit of the shifted numbers
   is a plane: one bit a row, packed into 64-bit words. The popcount of two planes' AND, weighted
   by both bits' values, summed over all planes is the exact cross-product of two dimensions.
2. A task adds its blocks up and gives one row a matrix entry, split into 40-bit limbs, so that
   Spark's sums of longs stay exact. What reaches the driver is one matrix of the vector's width.
3. The covariance is centred in integers, n * sum(xy) - sum(x) * sum(y), divided once by n squared,
   and decomposed by ``eigh``. All vectors are then projected in one pass, and the covariance of
   the projections is measured in another.

Results, by case: vectors that are null, empty, hold null or non-finite entries or an entry whose x
has no 62-bit form are left out; vectors of different lengths are fitted apart (n counts those of the
row's own length); components without variance keep their rows with a null ``whitened`` and
``explained`` 0 (all of them where one vector or only equal ones remain); equal eigenvalues
give any basis of their space; a deviation that no long holds is null; null and repeated ids keep
their rows; an empty table gives no rows. Vectors of any length fit: planes are met in blocks of
dimensions. Only the id and vector columns are read, whatever others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import ship, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 4096
LIMB = 40
LIMBS = 4
PAIR_WORDS = 1 << 20


def integer_vectors(batch: pa.RecordBatch):
    """(positions, x) for each vector length in a batch (id, vector): the rows that can be used."""
    lists = batch.column(1)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    begin = np.cumsum(sizes) - sizes
    for width in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == width)
        c = flat[begin[at][:, None] + np.arange(width)]
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(c * SCALE)
            usable = (np.abs(x) < 2.0**62).all(1)  # false for NaN and infinities
        if usable.any():
            yield at[usable], x[usable].astype(np.int64) + SHIFT


def planes(y: np.ndarray) -> np.ndarray:
    """Bit planes (bit, dimension, word) of non-negative integers (row, dimension)."""
    bits = int(y.max()).bit_length()
    rows = -(-len(y) // 64) * 64
    out = np.zeros((bits, y.shape[1], rows // 64), np.uint64)
    for b in range(bits):
        packed = np.zeros((y.shape[1], rows // 8), np.uint8)
        plane = np.packbits((y.T >> b & 1).astype(np.uint8), axis=1)
        packed[:, :plane.shape[1]] = plane
        out[b] = packed.view(np.uint64)
    return out


def and_counts(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """popcount(p_i & q_j) for all pairs of rows of words."""
    step = max(1, PAIR_WORDS // max(1, q.size))
    return np.concatenate([np.bitwise_count(p[i:i + step, None] & q[None]).sum(-1, dtype=np.int64)
                           for i in range(0, len(p), step)])


def scatter(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, cross-products) of integer vectors, as Python integers."""
    n, width = x.shape
    low = x.min(0)
    # a shifted value has up to 63 bits: both are within 2^62 of zero
    p = planes(x - low)
    cross = np.zeros((width, width), object)
    sums = np.zeros(width, object)
    small = 2 * len(p) + n.bit_length() < 62
    total = np.zeros((width, width), np.int64)
    for a in range(len(p)):
        sums += np.bitwise_count(p[a]).sum(-1, dtype=np.int64).astype(object) * (1 << a)
        for b in range(a, len(p)):
            count = and_counts(p[a], p[b])
            count = count if a == b else count + count.T
            if small:
                total += count << (a + b)
            else:
                cross += count.astype(object) * (1 << a + b)
    cross = cross + total.astype(object)
    low = low.astype(object)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return n, sums + n * low, cross


def _limbs(value: int) -> list[int]:
    mask = (1 << LIMB) - 1
    return [value >> LIMB * k & mask for k in range(LIMBS - 1)] + [value >> LIMB * (LIMBS - 1)]


def moments(vectors: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """n, sums and cross-products of the integer vectors, for each vector length."""
    ship(vectors.sparkSession)

    def run(batches):
        from reviewflow.llm import whitening as w
        held = {}
        for batch in batches:
            for _, x in w.integer_vectors(batch):
                for k in range(0, len(x), w.BLOCK):
                    part = w.scatter(x[k:k + w.BLOCK])
                    old = held.get(x.shape[1])
                    held[x.shape[1]] = tuple(a + b for a, b in zip(old, part)) if old else part
        for width, (n, sums, cross) in held.items():
            i, j = np.triu_indices(width)
            value = [n, *sums.tolist(), *cross[i, j].tolist()]
            first = np.r_[-2, np.full(width, -1), i].astype(np.int32)
            second = np.r_[0, np.arange(width), j].astype(np.int32)
            for k in range(0, len(value), 50_000):
                parts = list(zip(*(w._limbs(int(v)) for v in value[k:k + 50_000])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(parts[0]), width, np.int32)), pa.array(first[k:k + 50_000]), pa.array(second[k:k + 50_000]),
                     *(pa.array(x, pa.int64()) for x in parts)], names=["width", "i", "j", *(f"l{x}" for x in range(w.LIMBS))])

    names = [f"l{k}" for k in range(LIMBS)]
    rows = vectors.mapInArrow(run, "width int, i int, j int, " + ", ".join(f"{c} long" for c in names))
    out: dict[int, list] = {}
    for r in rows.groupBy("width", "i", "j").agg(*(F.sum(c).alias(c) for c in names)).toLocalIterator():
        value = sum(r[c] << LIMB * k for k, c in enumerate(names))
        n, sums, cross = out.setdefault(r.width, [0, [0] * r.width, [[0] * r.width for _ in range(r.width)]])
        if r.i == -2:
            out[r.width][0] = value
        elif r.i == -1:
            sums[r.j] = value
        else:
            cross[r.i][r.j] = cross[r.j][r.i] = value
    return {width: tuple(x) for width, x in out.items()}


def fit(n: int, sums: list[int], cross: list[list[int]], components: int = COMPONENTS) -> dict:
    """The projection of one vector length: covariance centred in integers, then ``eigh``."""
    width = len(sums)
    cov = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(width)] for i in range(width)], float)
    trace = sum(n * cross[i][i] - sums[i] ** 2 for i in range(width)) / (n * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    e, v = values[order], vectors[:, order]
    v = v * np.where(v[np.abs(v).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    varies = e > max(values.max(), 0) * width * np.finfo(float).eps
    return {"n": n, "sums": sums, "e": np.where(varies, e, 0.0), "v": v, "explained": (np.where(varies, e, 0.0) / trace if trace else e * 0).tolist()}


def project(x: np.ndarray, model: dict) -> tuple[list, np.ndarray]:
    """(deviations, whitened coordinates) of integer vectors."""
    n, width = model["n"], x.shape[1]
    middle = [s // n for s in model["sums"]]
    rest = [s - n * m for s, m in zip(model["sums"], middle)]
    y = x - np.array(middle, np.int64)
    far = (np.abs(y.astype(float)).max() + 1) * n
    if width * far * far < 2.0**62:
        z = y * n - np.array(rest, np.int64)
        deviations = (z * z).sum(1).tolist()
    else:
        z = y.astype(object) * n - np.array(rest, object)
        deviations = [d if d < 2**63 else None for d in (z * z).sum(1)]
    root = np.sqrt(np.where(model["e"] > 0, model["e"], 1.0))
    return deviations, (z.astype(float) / n) @ (model["v"] / root)


WHITENED = "vec_id long, width int, n long, deviation long, coordinates array<double>"


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, width, n, deviation, coordinates, explained, identity_error) of every usable
    vector; the last three arrays and figures belong to the vector's length."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    models = {width: fit(*m, components=components) for width, m in moments(rows).items()}
    held = spark.sparkContext.broadcast(models)

    def run(batches):
        from reviewflow.llm import whitening as w
        for batch in batches:
            for at, x in w.integer_vectors(batch):
                model = held.value[x.shape[1]]
                deviations, out = w.project(x, model)
                missing = np.broadcast_to(model["e"] == 0, out.shape).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1]), pa.int32()),
                                                 pa.array(out.ravel(), pa.float64(), mask=missing))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array([x.shape[1]] * len(x), pa.int32()), pa.array([model["n"]] * len(x), pa.int64()),
                     pa.array(deviations, pa.int64()), lists], names=["vec_id", "width", "n", "deviation", "coordinates"])

    out = written(rows.mapInArrow(run, WHITENED), "whitened")
    figures = [(width, m["explained"], error) for (width, m), error in zip(models.items(), identity_errors(out, models, components))]
    schema = T.StructType([T.StructField("_width", T.IntegerType()), T.StructField("explained", T.ArrayType(T.DoubleType())),
                           T.StructField("identity_error", T.DoubleType())])
    return out.join(spark.createDataFrame(figures, schema), F.col("width") == F.col("_width")).drop("_width")


def identity_errors(out: DataFrame, models: dict, components: int) -> list[float]:
    """For each vector length the largest absolute entry of (covariance of the coordinates - identity),
    measured on all rows, centred before multiplying."""
    w = [F.get("coordinates", F.lit(k)) for k in range(components)]
    means = {r.width: r for r in out.groupBy("width").agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(w))).collect()}
    if not means:
        return []
    spark = out.sparkSession
    schema = "_width int, " + ", ".join(f"m{k} double" for k in range(components))
    centres = spark.createDataFrame([tuple(r) for r in means.values()], schema)
    d = [c - F.col(f"m{k}") for k, c in enumerate(w)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    measured = {r.width: r for r in out.join(centres, F.col("width") == F.col("_width")).groupBy("width").agg(
        *(F.avg(d[i] * d[j]).alias(f"c{i}_{j}") for i, j in pairs)).collect()}
    errors = []
    for width in models:
        r = measured[width]
        errors.append(max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None), default=0.0))
    return errors


def components_of(whitened: DataFrame) -> DataFrame:
    """One row for each vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    both = F.arrays_zip(F.col("coordinates").alias("w"), F.col("explained").alias("share"))
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(both).alias("k", "c")).select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.col("c.w").alias("whitened"),
        F.col("c.share").alias("explained"), "identity_error")
