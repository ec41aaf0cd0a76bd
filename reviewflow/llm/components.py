"""Connected components of an edge table, as local contractions and Spark joins."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship, written

CELL = 1_000_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (u, v) contracted: every node that isn't its component's least, with that one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while len(a):
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    below = label != np.arange(len(nodes))
    return nodes[below], nodes[label[below]]


def contracted(e: DataFrame, cells: int) -> DataFrame:
    """``e`` (u, v) with the edges of each of at most ``cells`` tasks contracted, without a shuffle."""
    ship(e.sparkSession)

    def run(batches):
        from reviewflow.llm import components
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            u, v = components.stars(t.column("u").to_numpy(), t.column("v").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return e.coalesce(cells).mapInArrow(run, "u long, v long")


def connected(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of an undirected edge table; the component is its
    least node. Tasks contract about ``CELL`` edges each on their own; what several of them leave is
    joined by large-star and small-star steps, until the edges are stars: every
    node that isn't a root has one edge, to a root. Each round is written to the shared folder.
    Self-loops and repeated edges do no harm, edges with a null end are left out, an empty
    table gives no rows."""
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v"), "edges")
    while True:
        cells = math.ceil(e.count() / CELL)
        e = written(contracted(e, max(1, cells)), "edges")
        if cells <= 1:  # one task has seen all edges
            break
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
            e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("root")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up + root > 1").isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
