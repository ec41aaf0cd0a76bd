"""Near-duplicate vectors by product quantisation.

Equal vectors of a label are one class first. A bounded sample fits coarse centroids (inverted
lists) and one codebook for each subspace of the residuals; every vector is indexed: its list, the
codes of its residual and the length of what the codes leave out.

A vector probes the lists that can hold a neighbour. Cosine ``c`` means a distance of at most
``d = sqrt(2 - 2c)`` between unit vectors, and a point that lies nearer to centroid j than to a
query's own centroid i has a distance of at least (|q-cj|^2 - |q-ci|^2) / (2 |cj-ci|) from the query,
so lists above ``d`` there are left out. In a list, table lookups give the distance from the
query to each coded vector; it differs from the true one by at most the coding error, so whatever
exceeds ``d`` plus that error is left out. The exact cosine in double precision decides on the rest.
Both bounds are sure, hence recall is 1 whatever the sample, the dimensions and the directions in which
neighbours differ; the sample only sets the speed. In many dimensions the first bound leaves out few lists, so
there are only as many as the largest label and length needs, and a pair of lists meets once: a vector probes
its own list and later ones, and each link found counts for both ends.

Lists and the vectors that probe them meet in cells of at most ``BLOCK`` by ``BLOCK`` rows. A cell
gives each query's number of links and a spanning forest, never all pairs.

Results, by case: a null label, a null vector, null or non-finite components, a zero vector and a
null id link with nothing (a null id has a null component and is kept); vectors of different lengths
don't link; repeated rows count once; one id with different vectors shares its component and adds
the links of each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .minhash import Forest
from .runtime import ship, written

COSINE = 0.93
SAMPLE_ROWS = 8_192
SAMPLE_VALUES = 4_000_000
PER_LIST = 1_024
MOST_LISTS = 1_024
SUBSPACES = 8
CODES = 256
BLOCK = 2_048
SLACK = 1e-5

INDEXED = "rep long, copies long, kind long, list int, probes array<int>, codes binary, error double, vector "


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    top = np.abs(rows).max(1, keepdims=True)
    scaled = rows / np.where(top > 0, top, 1)
    return scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-300)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def kmeans(rows: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([squared(rows[i:i + 1024], centres).argmin(1) for i in range(0, len(rows), 1024)])
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, rows)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and residual codebooks for vectors of at most ``width`` components.
    Shorter ones are padded with zeros, which changes no distance, so no bound depends on ``width``."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.width = sample.shape[1]
        self.centres = kmeans(sample, lists)
        own = squared(sample, self.centres).argmin(1)
        residual = sample - self.centres[own]
        edges = np.linspace(0, self.width, min(SUBSPACES, self.width) + 1).astype(int)
        self.parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        self.books = [kmeans(residual[:, a:b], CODES) for a, b in self.parts]
        self.apart = np.sqrt(squared(self.centres, self.centres))

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each row, and which lists it has to probe."""
        far = squared(rows, self.centres)
        own = far.argmin(1)
        margin = far - far[np.arange(len(rows)), own][:, None]
        return own, margin <= 2 * (np.sqrt(2 - 2 * COSINE) + SLACK) * self.apart[own] + SLACK

    def encode(self, rows: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        residual = rows - self.centres[own]
        codes = np.stack([squared(residual[:, a:b], book).argmin(1) for (a, b), book in zip(self.parts, self.books)], 1)
        left = residual - np.concatenate([book[c] for book, c in zip(self.books, codes.T)], 1)
        return codes.astype(np.uint8), np.linalg.norm(left, axis=1)

    def lookup(self, queries: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Distances from queries to coded vectors of one list, by tables."""
        residual = queries - self.centres[centre]
        total = np.zeros((len(queries), len(codes)))
        for s, ((a, b), book) in enumerate(zip(self.parts, self.books)):
            total += squared(residual[:, a:b], book)[:, codes[:, s]]
        return np.sqrt(total)


def padded(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for row, x in zip(out, lists):
        row[:len(x)] = x
    return out


def fit(classes: DataFrame) -> Quantiser | None:
    """From at most SAMPLE_ROWS vectors (SAMPLE_VALUES numbers), chosen by a hash of their id."""
    total = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not total.n:
        return None
    rows = min(SAMPLE_ROWS, max(256, SAMPLE_VALUES // total.width))
    sample = classes.orderBy(F.xxhash64("rep")).limit(rows).select("vector").collect()
    largest = classes.groupBy("kind").count().agg(F.max("count")).first()[0]
    lists = min(MOST_LISTS, max(1, largest // PER_LIST))
    return Quantiser(unit(padded([r.vector for r in sample], total.width)), lists)


def index(classes: DataFrame, quantiser: Quantiser) -> DataFrame:
    ship(classes.sparkSession)
    shared = classes.sparkSession.sparkContext.broadcast(quantiser)  # bounded by MOST_LISTS and CODES

    def run(batches):
        from reviewflow.llm import embeddings
        q = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                rows = embeddings.unit(embeddings.padded(batch.column(3).to_pylist(), q.width))
                own, probes = q.assign(rows)
                codes, error = q.encode(rows, own)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(own, pa.int32()),
                     pa.array([(np.flatnonzero(p[i:]) + i).tolist() for p, i in zip(probes, own)], pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.float64()), batch.column(3)],
                    names=["rep", "copies", "kind", "list", "probes", "codes", "error", "vector"])

    return classes.select("rep", "copies", "kind", "vector").mapInArrow(run, INDEXED + classes.schema["vector"].dataType.simpleString())


def search(indexed: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Rows (rep, links, other): in each cell a vector's links, or (links null) a link to another."""
    spark = indexed.sparkSession
    ship(spark)
    members = indexed.groupBy("kind", "list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    queries = indexed.select("kind", F.col("list").alias("home"), F.explode("probes").alias("list"), "rep", "copies", "vector")
    asked = indexed.select("kind", F.explode("probes").alias("list")).groupBy("kind", "list").agg(
        F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("askers"))
    cells = members.join(asked, ["kind", "list"])  # a row for each list of a label
    cell = F.xxhash64("kind", "list", F.col("block").cast("int"), F.col("asker").cast("int"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = (indexed.join(cells, ["kind", "list"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .select("*", spread("askers").alias("asker"))
            .select(cell.alias("cell"), "list", F.lit(0).alias("side"), "rep", "copies", "codes", "error", "vector",
                    F.col("list").alias("home")))
    put = (queries.join(cells, ["kind", "list"]).withColumn("asker", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("askers")).cast("int"))
           .select("*", spread("blocks").alias("block"))
           .select(cell.alias("cell"), "list", F.lit(1).alias("side"), "rep", "copies",
                   F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), "vector", "home"))
    shared = spark.sparkContext.broadcast(quantiser)

    def run(batches):
        from reviewflow.llm import embeddings
        at = embeddings.CellSearch(shared.value)
        for batch in batches:
            yield from at.take(batch)
        yield from at.close()

    rows = held.unionByName(put).repartition("cell").sortWithinPartitions("cell", "side", "rep")
    return rows.mapInArrow(run, "rep long, links long, other long")


class CellSearch:
    """Reads rows sorted by cell and side: a cell's index first, then its queries. Every pair
    is met once: queries come from lists before the cell's, or from it with a smaller id."""

    def __init__(self, quantiser: Quantiser):
        self.q, self.cell, self.held, self.index = quantiser, None, [], None

    def close(self):
        """The links of the cell's index rows."""
        if self.index is not None:
            reps, some = self.index[0], np.flatnonzero(self.links)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(reps[some], pa.int64()), pa.array(self.links[some]), pa.nulls(len(some), pa.int64())],
                                                 names=["rep", "links", "other"])

    def take(self, batch: pa.RecordBatch):
        if not batch.num_rows:
            return
        cell, side = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (side[1:] != side[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if cell[a] != self.cell:
                yield from self.close()
                self.cell, self.held, self.index = cell[a], [], None
            part = batch.slice(a, b - a)
            if side[a] == 0:
                self.held.append(part)
            else:
                for start in range(0, part.num_rows, 256):
                    yield from self.ask(part.slice(start, 256))

    def ask(self, part: pa.RecordBatch):
        if not self.held:
            return
        if self.index is None:
            t = pa.Table.from_batches(self.held)
            rows = unit(padded(t.column("vector").to_pylist(), self.q.width))
            codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), np.uint8).reshape(len(rows), -1)
            length = np.array([len(v) for v in t.column("vector").to_pylist()])
            self.index = (t.column("rep").to_numpy(), t.column("copies").to_numpy(), codes, t.column("error").to_numpy(), rows, length,
                          int(t.column("list")[0].as_py()))
            self.links = np.zeros(len(rows), np.int64)
        reps, copies, codes, error, rows, length, centre = self.index
        own, times, home = (part.column(k).to_numpy() for k in (3, 4, 8))
        vectors = part.column(7).to_pylist()
        queries = unit(padded(vectors, self.q.width))
        near = self.q.lookup(queries, centre, codes) <= np.sqrt(2 - 2 * COSINE) + SLACK + error
        near &= np.where((home == centre)[:, None], reps > own[:, None], reps != own[:, None])
        near &= length == np.array([len(v) for v in vectors])[:, None]
        a, b = np.nonzero(near)
        hit = np.concatenate([np.einsum("ij,ij->i", queries[a[k:k + 8192]], rows[b[k:k + 8192]]) >= COSINE
                              for k in range(0, len(a), 8192)] or [np.zeros(0, bool)])
        a, b = a[hit], b[hit]
        links = np.bincount(a, copies[b], len(own)).astype(np.int64)
        self.links += np.bincount(b, times[a], len(reps)).astype(np.int64)
        some = np.flatnonzero(links)
        # a forest over queries and index rows
        names = np.unique(np.r_[own[a], reps[b]])
        forest, u, v = Forest(len(names)), [], []
        x, y = np.searchsorted(names, own[a]), np.searchsorted(names, reps[b])
        for i, j in ((k, np.flatnonzero(x == k)) for k in np.unique(x)):
            others = np.unique(y[j])
            others = others[forest.root[others] != forest.root[i]]
            if len(others):
                _, first = np.unique(forest.root[others], return_index=True)
                forest.link(i, others)
                u += [names[i]] * len(first)
                v += names[others[first]].tolist()
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(own[some], pa.int64()), pa.array(links[some]), pa.nulls(len(some), pa.int64())],
                                             names=["rep", "links", "other"])
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.nulls(len(u), pa.int64()), pa.array(v, pa.int64())],
                                             names=["rep", "links", "other"])


def groups(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    single = vectors.schema[vector].dataType.elementType.simpleString() == "float"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{'float' if single else 'double'}>").alias("vector"),
                          F.col(label).alias("label")).distinct()
    rows = written(rows.withColumn("linkable", usable(F.col("vector"), F.col("label")) & F.col("vec_id").isNotNull())
                   .withColumn("kind", F.xxhash64(F.col("label").cast("string"), F.size("vector"))), "vectors")
    same = ["kind", "digest1", "digest2"]
    good = rows.where("linkable").select("vec_id", "kind", "vector", F.xxhash64("vector").alias("digest1"),
                                         F.xxhash64(F.lit(1), "vector").alias("digest2"))
    classes = good.groupBy(*same).agg(F.min(F.struct("vec_id", "vector")).alias("r"), F.count("*").alias("copies"))
    classes = written(classes.select(*same, F.col("r.vec_id").alias("rep"), "copies", F.col("r.vector").alias("vector")), "classes")
    quantiser = fit(classes)
    ids = rows.groupBy("vec_id").agg(F.lit(None).alias("x")).select("vec_id")
    if quantiser is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(search(written(index(classes, quantiser), "indexed"), quantiser), "found")
    links = found.where("links is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    own = good.select("vec_id", *same).join(classes.select(*same, "rep", "copies"), same)
    own = own.join(links, "rep", "left").select("vec_id", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    edges = found.where("other is not null").select(F.col("rep").alias("u"), F.col("other").alias("v"))
    edges = edges.unionByName(own.where("vec_id != rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    parts = connected(edges)
    counts = own.groupBy("vec_id").agg(F.sum("n").cast("long").alias("n"))
    out = ids.join(counts, "vec_id", "left").join(parts, F.col("vec_id") == F.col("node"), "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
                      (F.coalesce("component", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept"))
