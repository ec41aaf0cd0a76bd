"""Training by epochs: mini-batch gradient steps over a distributed table.

Rows are (key, label, indices, values): a sparse feature vector and its target. An epoch deals the
rows into mini-batches by a hash of seed, epoch and key, so every row is in one batch an epoch, whatever the
partitioning. One shuffle puts each batch into partitions of its own, which are kept. A step is one Spark job over its batch's
partitions alone, so it costs the same however many rows there are: each task sums the loss and the gradient of its rows, and
the driver takes the step. With one batch (all rows) the partial gradients are summed by feature with map-side combining. What
passes the driver is gradients, bounded by the number of features and a step's tasks. The learning rate warms up over the first steps and
falls linearly to ``final_share`` of itself; weight decay is decoupled (the weights shrink by lr * decay at each step, the
bias excepted). After each epoch the test split's loss is measured.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import tokens

BIAS = -1
# Rows of a step for each task, and the partitions that one shuffle deals.
TASK_ROWS = 8192
ROUND = 2048


@dataclass(frozen=True)
class Plan:
    """Hyper-parameters. ``batch_rows``: about how many rows a step takes (None: all)."""

    epochs: int = 3
    batch_rows: int | None = 512
    learning_rate: float = 0.5
    warmup_steps: int = 4
    final_share: float = 0.1
    weight_decay: float = 0.01
    loss: str = "logistic"      # or "squared"
    momentum: float = 0.0
    seed: int = 42

    def rate(self, step: int, steps: int) -> float:
        """The learning rate of step 0 .. steps - 1."""
        if step < self.warmup_steps:
            return self.learning_rate * (step + 1) / self.warmup_steps
        left = (steps - step) / max(1, steps - self.warmup_steps)
        return self.learning_rate * (self.final_share + (1 - self.final_share) * left)


def hashed_features(df: DataFrame, key: str, label: str, text: str, features: int = 1 << 14) -> DataFrame:
    """(key, label, indices, values): token frequencies by hash, scaled to unit length."""
    slots = F.transform(tokens(text), lambda x: F.pmod(F.xxhash64(x), F.lit(features)).cast("int"))
    rows = df.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"), slots.alias("slots"))

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                lists = batch.column("slots")
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                # a text's slots in order, each with its count
                code, n = np.unique(row * features + lists.flatten().to_numpy(zero_copy_only=False), return_counts=True)
                row, value = code // features, np.log1p(n)
                norm = np.sqrt(np.bincount(row, value * value, batch.num_rows))
                ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("label"), pa.ListArray.from_arrays(ends, pa.array((code % features).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(value / norm[row]))], names=["key", "label", "indices", "values"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, label double, indices array<int>, values array<double>")


def _residuals(loss: str):
    """A function that gives the loss of some rows, their residuals and each value's row. Made here so that
    it is pickled by value."""
    def run(y, size, index, x, w, bias):
        row = np.repeat(np.arange(len(y)), size)
        z = bias + np.bincount(row, x * w[index], len(y))
        if loss == "logistic":
            return float(np.logaddexp(0, np.where(y > 0.5, -z, z)).sum()), 1 / (1 + np.exp(-z)) - y, row
        r = z - y
        return float((r * r).sum() / 2), r, row
    return run


def _gradient(rows: DataFrame, weights, loss: str, only_loss: bool) -> DataFrame:
    """(feature, value, loss, rows): sums over ``rows``; the bias is feature -1 and carries loss and count."""
    held, residuals = rows.sparkSession.sparkContext.broadcast(weights), _residuals(loss)

    def run(batches):
        w, bias = held.value
        total, n, g_bias, grad = 0.0, 0, 0.0, None if only_loss else np.zeros(len(w))
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("label").to_numpy(zero_copy_only=False)
            lists = batch.column("indices")
            index = lists.flatten().to_numpy(zero_copy_only=False)
            x = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            lost, r, row = residuals(y, np.diff(lists.offsets.to_numpy()), index, x, w, bias)
            total += lost
            n += len(y)
            g_bias += float(r.sum())
            if grad is not None:
                grad += np.bincount(index, x * r[row], len(w))
        at = np.flatnonzero(grad) if grad is not None else np.zeros(0, int)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[BIAS, at].astype(np.int32)), pa.array(np.r_[g_bias, grad[at] if grad is not None else at * 0.0]),
             pa.array([total] + [0.0] * len(at)), pa.array([n] + [0] * len(at), pa.int64())], names=["feature", "value", "loss", "rows"])

    parts = rows.select("label", "indices", "values").mapInArrow(run, "feature int, value double, loss double, rows long")
    return parts.groupBy("feature").agg(F.sum("value").alias("value"), F.sum("loss").alias("loss"), F.sum("rows").alias("rows"))


def in_batch(key: Column, plan: Plan, epoch: int, batches: int) -> Column:
    """The mini-batch of a row in an epoch."""
    return F.pmod(F.xxhash64(F.lit(plan.seed), F.lit(epoch), key), F.lit(batches))


def dealt(rows: DataFrame, plan: Plan, epoch: int, batches: int, low: int, high: int) -> RDD:
    """The rows of an epoch's batches ``low`` to ``high`` - 1, kept: batch low + k lies in the partitions from k * pieces(plan)
    on, as packed tables of at most ``TASK_ROWS`` rows (label, sizes, indices, values)."""
    batch, parts = in_batch(F.col("key"), plan, epoch, batches), pieces(plan)
    piece = F.pmod(F.xxhash64(F.lit(plan.seed), F.col("key"), F.lit("piece")), F.lit(parts))
    place = ((batch - low) * parts + piece).cast("int")
    mine = rows.where((batch >= low) & (batch < high)).select("label", "indices", "values", place.alias("place"))
    most = TASK_ROWS

    def pack(batches):
        held, n = [], 0

        def packed():
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lists = t.column("indices")
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in (
                t.column("label").to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()),
                lists.flatten().to_numpy(zero_copy_only=False), t.column("values").flatten().to_numpy(zero_copy_only=False))],
                names=["label", "sizes", "indices", "values"])

        for whole in batches:
            for start in range(0, whole.num_rows, most):
                held.append(whole.slice(start, most))
                n += held[-1].num_rows
                if n >= most:
                    yield packed()
                    held, n = [], 0
        if n:
            yield packed()

    made = mine.repartitionById((high - low) * parts, F.col("place")).drop("place")
    kept = made.mapInArrow(pack, "label binary, sizes binary, indices binary, values binary").rdd.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def pieces(plan: Plan) -> int:
    """The tasks of a step."""
    return math.ceil(plan.batch_rows / TASK_ROWS)


def _step(kept: RDD, k: int, weights, plan: Plan):
    """(gradient's sum, bias's, loss, rows) of the k-th batch of ``kept``: a job over that batch's partitions alone."""
    residuals = _residuals(plan.loss)

    def run(tables):
        w, bias = weights
        grad, g_bias, total, n = np.zeros(len(w)), 0.0, 0.0, 0
        for label, sizes, indices, values in tables:
            y, size, index, x = (np.frombuffer(c, t) for c, t in zip((label, sizes, indices, values), ("<f8", "<i4", "<i4", "<f8")))
            lost, r, row = residuals(y, size, index, x, w, bias)
            grad += np.bincount(index, x * r[row], len(w))
            g_bias, total, n = g_bias + float(r.sum()), total + lost, n + len(y)
        if n:
            at = np.flatnonzero(grad)
            yield at.astype("<i4").tobytes(), grad[at].tobytes(), g_bias, total, n

    parts = pieces(plan)
    grad, g_bias, total, n = np.zeros(len(weights[0])), 0.0, 0.0, 0
    for at, value, one_bias, lost, size in kept.context.runJob(kept, run, range(k * parts, (k + 1) * parts)):
        grad[np.frombuffer(at, "<i4")] += np.frombuffer(value)
        g_bias, total, n = g_bias + one_bias, total + lost, n + size
    return grad, g_bias, total, n


def _full_step(rows: DataFrame, weights, plan: Plan):
    """As ``_step``, over all of ``rows``."""
    found = _gradient(rows, weights, plan.loss, False).toArrow()
    at, value = found.column("feature").to_numpy(), found.column("value").to_numpy()
    grad = np.zeros(len(weights[0]))
    grad[at[at >= 0]] = value[at >= 0]
    return grad, float(value[at < 0].sum()), sum(found.column("loss").to_pylist()), int(sum(found.column("rows").to_pylist()))


def train(train_rows: DataFrame, test_rows: DataFrame, features: int, plan: Plan = Plan()):
    """((weights, bias), history): a row an epoch of ``epoch, steps, learning_rate, train_loss`` (mean over the
    epoch's steps, as they were taken), ``test_loss`` and ``test_rows``. Training rows are read once for ``ROUND`` partitions of an
    epoch's batches (with one batch, once a step), test rows once an epoch: give tables. Without training rows the weights stay zero."""
    n = train_rows.count()
    batches = max(1, math.ceil(n / plan.batch_rows)) if plan.batch_rows else 1
    w, bias, speed, speed_bias = np.zeros(features), 0.0, np.zeros(features), 0.0
    steps, step, history = plan.epochs * batches, 0, []
    at_once = max(1, ROUND // pieces(plan)) if plan.batch_rows else 1
    for epoch in range(plan.epochs):
        total = seen = 0
        kept = None
        for b in range(batches if n else 0):
            if batches == 1:
                g, g_bias, lost, size = _full_step(train_rows, (w, bias), plan)
            else:
                if b % at_once == 0:
                    if kept is not None:
                        kept.unpersist()
                    kept = dealt(train_rows, plan, epoch, batches, b, min(b + at_once, batches))
                g, g_bias, lost, size = _step(kept, b % at_once, (w, bias), plan)
            rate = plan.rate(step, steps)
            step += 1
            if not size:
                continue
            speed = plan.momentum * speed + g / size
            speed_bias = plan.momentum * speed_bias + g_bias / size
            w = w * (1 - rate * plan.weight_decay) - rate * speed
            bias -= rate * speed_bias
            total, seen = total + lost, seen + size
        if kept is not None:
            kept.unpersist()
        measured = _gradient(test_rows, (w, bias), plan.loss, True).agg(F.sum("loss").alias("loss"), F.sum("rows").alias("rows")).first()
        history.append({"epoch": epoch + 1, "steps": step, "learning_rate": plan.rate(step - 1, steps) if step else 0.0, "train_loss": total / seen if seen else None,
                        "test_loss": measured.loss / measured.rows if measured.rows else None, "test_rows": measured.rows or 0})
    return (w, bias), history


def score(rows: DataFrame, model) -> DataFrame:
    """``rows`` (key, label, indices, values) with ``p_positive`` of a logistic model."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        w, bias = held.value
        for batch in batches:
            lists = batch.column("indices")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            index = lists.flatten().to_numpy(zero_copy_only=False)
            z = bias + np.bincount(row, batch.column("values").flatten().to_numpy(zero_copy_only=False) * w[index], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(1 / (1 + np.exp(-z)))],
                                             names=["key", "label", "p_positive"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "label", "indices", "values").mapInArrow(run, f"key {kind}, label double, p_positive double")
