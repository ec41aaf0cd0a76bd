"""Near-duplicate texts by a chosen-path set similarity join over word shingles.

1. A text's set is its distinct shingles of ``words`` words (ASCII letters lower-cased, words
   parted by ASCII white space), as 64-bit hashes. One pass gives its size, a 128-bit
   digest of the set, ``COORDINATES`` minwise values (16 bits each, the sketch) and the
   ``TREES`` minwise tokens (64 bits) that choose a text's node in each tree. Equal sets are
   collapsed to one representative first.
2. Each tree branches the texts by its token. Nodes of at most ``NODE`` texts are compared
   exhaustively by sketch. Larger ones are compared with a pivot. The share of differing
   coordinates is a metric, so texts near the pivot can't be near ones that agree with it in less
   than 2 * ``MIN_AGREE`` - 1: where no text lies between the two bounds, the near ones are settled and only the far
   ones go on; else all do, along one further coordinate, at most ``DEPTH`` times. What is still large then is
   compared in blocks. Two sets at the threshold share a node in a tree with probability 0.8, and 0.8 more for each
   coordinate that a large node took: all 16 trees miss them with probability 1e-11 in small nodes and 2e-3 after four.
   Within a node only a spanning forest of the pairs whose sketches agree in at least
   ``MIN_AGREE`` of the coordinates is emitted, five standard deviations below 0.8.
3. The components of those links are small candidate groups. The texts of a group come
   together once, and links are confirmed on the full sets: 100 * |A and B| >= 80 * |A or B|.
   Pairs that confirmed links join already are skipped. Groups above ``BLOCK`` texts are
   split: every block is compared within itself and with shared pivots, then whatever isn't in
   the group's largest component is compared with every block.

Results, by case: null, empty and blank texts have an empty set and link with nothing; fewer words
than a shingle make one shingle; a null id links with nothing, has a null component and is kept;
repeated rows count once; rows of one id with different texts share that id's component; an empty
table gives no rows. Only the id and text columns are read, whatever others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .runtime import free_name, ship, written

WORDS = 4
PERCENT = 80
COORDINATES = 128
TREES = 16
NODE = 2048
DEPTH = 4
MIN_AGREE = 0.62
BLOCK = 1024
PIVOTS = 8

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_seeds = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**63, (COORDINATES, 2), dtype=np.uint64)
_XOR, _MULTIPLY = _seeds[:, 0], _seeds[:, 1] << np.uint64(1) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    doc_end = np.cumsum([len(d) + 1 for d in data])
    a = np.frombuffer(b"\n".join(data).lower() + b"\n", np.uint8)
    space = _SPACES[a]
    inner = ~space
    begin = np.flatnonzero(inner & np.r_[True, space[:-1]])
    end = np.flatnonzero(inner & np.r_[space[1:], True]) + 1
    # polynomial hash of each word from prefix sums
    power = np.full(len(a), _BASE)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.r_[np.uint64(0), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)]
    inverse = np.full(len(a), _INVERSE)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    h = mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    first = np.r_[0, np.searchsorted(begin, doc_end)]
    full = h.copy()
    for k in range(1, min(words, len(h))):
        full[:len(h) - k] = full[:len(h) - k] * _BASE + h[k:]
    full = mixed(full)
    out = []
    for x, y in zip(first[:-1].tolist(), first[1:].tolist()):
        if y - x >= words:
            out.append(np.unique(full[x:y - words + 1]))
        elif y > x:
            one = np.uint64(y - x)
            with np.errstate(over="ignore"):
                for w in h[x:y]:
                    one = one * _BASE + w
            out.append(mixed(np.array([one ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise values of each set that isn't empty, a row of COORDINATES for each."""
    out = np.zeros((len(sets), COORDINATES), np.uint64)
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (stop == start or held + len(sets[stop]) <= 50_000):
            held += len(sets[stop])
            stop += 1
        h = np.concatenate(sets[start:stop])
        heads = np.cumsum([0, *map(len, sets[start:stop])])[:-1]
        for k in range(COORDINATES):
            out[start:stop, k] = np.minimum.reduceat((h ^ _XOR[k]) * _MULTIPLY[k], heads)
        start = stop
    return out


SIGNATURES = "doc_id long, n_shingles long, digest1 long, digest2 long, tokens array<long>, sketch binary"


def signatures(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches):
        from reviewflow.llm import bpe, minhash, runtime
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "text", chars=1_000_000):
                sets = minhash.shingle_sets(texts, words)
                some = [k for k, s in enumerate(sets) if len(s)]
                low = minhash.minwise([sets[k] for k in some])
                sketches = (low >> np.uint64(20)).astype("<u2")
                tokens, sketch = [None] * len(sets), [None] * len(sets)
                for k, t, s in zip(some, low[:, :minhash.TREES].view(np.int64).tolist(), sketches):
                    tokens[k], sketch[k] = t, s.tobytes()
                sums = [[int(np.sum(minhash.mixed(s ^ np.uint64(c))).astype(np.int64)) for s in sets] for c in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(s, pa.int64()) for s in sums),
                     pa.array(tokens, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n_shingles", "digest1", "digest2", "tokens", "sketch"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SIGNATURES)


def whole_groups(batches, key: str, rows: int = 4096):
    """Tables of whole groups from batches sorted by ``key``, of about ``rows`` rows."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        t = pa.Table.from_batches(held)
        keys = t.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield t.slice(0, cut)
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over positions 0 .. n-1."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(self.root[np.r_[i, others]])
        self.root[np.isin(self.root, roots)] = roots[0]


def sketch_links(ids: np.ndarray, sketches: np.ndarray, begin: np.ndarray, agree: int, side: np.ndarray | None = None):
    """Links of a spanning forest of similar sketches in each group of rows. With ``side``,
    only pairs of different sides are compared."""
    size = np.diff(np.r_[begin, len(ids)])
    pivot = np.repeat(begin, size)
    near = (sketches == sketches[pivot]).sum(1) >= agree
    if side is not None:
        near &= (side != side[pivot]) | (np.arange(len(ids)) == pivot)
    u, v = [ids[pivot[near]]], [ids[near]]
    settled = np.logical_and.reduceat(near, begin) if len(begin) else np.zeros(0, bool)
    for g in np.flatnonzero(~settled & (size > 1)):
        a, b = int(begin[g]), int(begin[g] + size[g])
        s, forest = sketches[a:b], Forest(b - a)
        if side is None:
            forest.link(0, np.flatnonzero(near[a:b]))
        for i in range(0 if side is not None else 1, b - a):
            rest = np.flatnonzero(forest.root[i + 1:] != forest.root[i]) + i + 1
            if side is not None:
                rest = rest[side[a + rest] != side[a + i]]
            if len(rest):
                hit = rest[(s[rest] == s[i]).sum(1) >= agree]
                if len(hit):
                    forest.link(i, hit)
                    u.append(np.full(len(hit), ids[a + i]))
                    v.append(ids[a + hit])
    return np.concatenate(u), np.concatenate(v)


def _pairs(u, v) -> pa.RecordBatch:
    differ = u != v
    return pa.RecordBatch.from_arrays([pa.array(u[differ], pa.int64()), pa.array(v[differ], pa.int64())], names=["u", "v"])


def _sketch_table(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, COORDINATES)


def compare_nodes(rows: DataFrame) -> DataFrame:
    """Links within nodes: ``rows`` (node, doc_id, sketch[, side]) with bounded nodes."""
    ship(rows.sparkSession)
    two_sided = "side" in rows.columns

    def run(batches):
        from reviewflow.llm import minhash
        agree = int(np.ceil(minhash.MIN_AGREE * minhash.COORDINATES))
        for t in minhash.whole_groups(batches, "node"):
            node, ids = t.column("node").to_numpy(), t.column("doc_id").to_numpy()
            begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            side = t.column("side").to_numpy() if two_sided else None
            yield minhash._pairs(*minhash.sketch_links(ids, minhash._sketch_table(t.column("sketch")), begin, agree, side))

    return rows.repartition("node").sortWithinPartitions("node", "doc_id").mapInArrow(run, "u long, v long")


def candidate_links(reps: DataFrame) -> DataFrame:
    """Links between representatives that may be similar, by the trees over their tokens."""
    spark = reps.sparkSession
    sketches = reps.select("doc_id", "sketch")
    nodes = reps.select("doc_id", F.posexplode("tokens").alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("node"), "doc_id")
    found, depth = [], 0
    while True:
        sizes = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        shared = written(nodes.join(sizes, "node").join(sketches, "doc_id"), "nodes")
        found.append(compare_nodes(shared.where(f"n <= {NODE}").select("node", "doc_id", "sketch")))
        large = shared.where(f"n > {NODE}")
        if large.isEmpty():
            break
        pivots = large.groupBy("node").agg(F.min(F.struct("doc_id", "sketch")).alias("p")).select(
            "node", F.col("p.doc_id").alias("pivot"), F.col("p.sketch").alias("pivot_sketch"))
        against = written(_against(large.join(pivots, "node")), "pivots")
        found.append(against.where("agree >= near").select(F.col("pivot").alias("u"), F.col("doc_id").alias("v")))
        between = against.groupBy("node").agg(F.max((F.col("agree") < F.col("near")) & (F.col("agree") >= F.col("border"))).alias("between"))
        # both are read several times below: written once, so the joins run once
        on = written(against.join(between, "node").where("between or agree < border").select("node", "doc_id"), "on")
        sizes = on.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        large = written(large.drop("n").join(on, ["node", "doc_id"]).join(sizes, "node"), "large")
        if large.isEmpty():
            break
        depth += 1
        if depth > DEPTH:
            blocks = F.ceil(F.col("n") / F.lit(NODE // 2)).cast("int")
            mine = F.pmod(F.xxhash64("doc_id"), blocks)
            cells = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(
                F.xxhash64("node", F.least(o, F.col("mine")), F.greatest(o, F.col("mine"))).alias("node"), (o < F.col("mine")).cast("int").alias("side")))
            cells = large.withColumn("mine", mine).select("doc_id", "sketch", F.col("mine"), F.explode(cells).alias("c"), "node")
            apart = cells.select(F.col("c.node").alias("node"), "doc_id", "sketch", F.col("c.side").alias("side"),
                                 (F.col("c.side") == 1).alias("x"))
            found.append(compare_nodes(apart.select("node", "doc_id", "sketch", "side")))
            within = large.select(F.xxhash64("node", mine, F.lit("within")).alias("node"), "doc_id", "sketch")
            found.append(compare_nodes(within))
            break
        along = F.pmod(F.xxhash64("node"), F.lit(COORDINATES)).cast("int")
        nodes = large.select("doc_id", "node", "sketch", along.alias("along")).select(
            F.xxhash64("node", "along", F.substring(F.col("sketch"), F.col("along") * 2 + 1, F.lit(2))).alias("node"), "doc_id")
    links = found[0]
    for f in found[1:]:
        links = links.unionByName(f)
    return links


def _against(rows: DataFrame) -> DataFrame:
    ship(rows.sparkSession)

    def run(batches):
        from reviewflow.llm import minhash
        for b in batches:
            if b.num_rows:
                at = b.schema.get_field_index
                agree = (minhash._sketch_table(b.column(at("sketch"))) == minhash._sketch_table(b.column(at("pivot_sketch")))).sum(1)
                yield pa.RecordBatch.from_arrays([b.column(at("node")), b.column(at("pivot")), b.column(at("doc_id")), pa.array(agree, pa.int32())],
                                                 names=["node", "pivot", "doc_id", "agree"])

    near = int(np.ceil(MIN_AGREE * COORDINATES))
    out = rows.select("node", "pivot", "doc_id", "sketch", "pivot_sketch").mapInArrow(run, "node long, pivot long, doc_id long, agree int")
    return out.withColumns({"near": F.lit(near), "border": F.lit(2 * near - COORDINATES)})


def set_links(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets that are similar enough, exactly. With
    ``side``, only pairs of different sides are compared."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(size) - size
    mark = np.zeros(int(flat.max()) + 1, bool)
    forest, out = Forest(n), []
    for i in range(n - 1):
        rest = np.flatnonzero(forest.root[i + 1:] != forest.root[i]) + i + 1
        if side is not None:
            rest = rest[side[rest] != side[i]]
        # sizes alone rule a pair out
        rest = rest[100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])]
        if not len(rest):
            continue
        own = flat[begin[i]:begin[i] + size[i]]
        mark[own] = True
        shared = np.add.reduceat(mark[flat[begin[rest[0]]:]].astype(np.int64), begin[rest[0]:] - begin[rest[0]])[rest - rest[0]]
        mark[own] = False
        hit = rest[100 * shared >= percent * (size[rest] + size[i] - shared)]
        if len(hit):
            forest.link(i, hit)
            out += [(i, int(j)) for j in hit]
    return out


def confirm(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that the full sets confirm, within each bounded ``cell`` of ``rows`` (cell,
    doc_id, text, side). Sides: equal ones aren't compared, -1 is compared with all."""
    ship(rows.sparkSession)

    def run(batches):
        from reviewflow.llm import minhash
        for t in minhash.whole_groups(batches, "cell", 256):
            cell, ids, sides = (t.column(c).to_numpy() for c in ("cell", "doc_id", "side"))
            texts = t.column("text").to_pylist()
            begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]).tolist()
            u, v = [], []
            for a, b in zip(begin, [*begin[1:], len(ids)]):
                if b - a > 1:
                    sets = []
                    for k in range(a, b, 64):
                        sets += minhash.shingle_sets(texts[k:min(b, k + 64)], words)
                    side = None if (sides[a:b] < 0).all() else sides[a:b]
                    for i, j in minhash.set_links(sets, percent, side):
                        u.append(ids[a + i])
                        v.append(ids[a + j])
            yield minhash._pairs(np.array(u, np.int64), np.array(v, np.int64))

    return rows.select("cell", "doc_id", "text", "side").repartition("cell").sortWithinPartitions("cell", "doc_id").mapInArrow(run, "u long, v long")


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document."""
    signed = written(signatures(docs, words, doc_id, text), "signatures")
    digest = ["n_shingles", "digest1", "digest2"]
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy(*digest).agg(F.min(F.struct("doc_id", "tokens", "sketch")).alias("r"))
    reps = written(classes.select(*digest, "r.doc_id", "r.tokens", "r.sketch"), "representatives")
    cells = connected(candidate_links(reps)).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "cell")
    # each representative's text, once; of an id with different texts, all of them
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    # merge: a broadcast would pass the ids of all near-duplicates through the driver
    texts = texts.join(cells.hint("merge"), "doc_id").withColumn("content", F.xxhash64("text")).dropDuplicates(["doc_id", "content"])
    texts = written(texts.join(sizes, "cell").drop("content"), "candidates")
    links = confirm(texts.where(f"n <= {BLOCK}").withColumn("side", F.lit(-1)), words, percent)
    large = texts.where(f"n > {BLOCK}")
    if not large.isEmpty():
        links = links.unionByName(large_group_links(large, words, percent))
    own = signed.select("doc_id", *digest).distinct()
    repeated = own.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1")
    if not repeated.isEmpty():  # an id with several texts ties their classes together
        tied = own.join(repeated, "doc_id").join(reps.select(*digest, F.col("doc_id").alias("rep")), digest).select("doc_id", "rep")
        links = links.unionByName(tied.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    parts = connected(links)
    # a class without links has its least id
    by_rep = reps.select(*digest, F.col("doc_id").alias("rep")).join(parts, F.col("rep") == F.col("node"), "left").select(
        *digest, F.coalesce("component", "rep").alias("component_id"))
    out = own.join(by_rep, digest, "left").withColumn("component_id", F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the row with the least id (of repeated
    rows one), and every row with a null id."""
    own = free_name(docs, "_id")
    key = F.col(doc_id).cast("long")
    gone = groups(docs, words, percent, doc_id, text).where("doc_id is not null and not kept").select(F.col("doc_id").alias(own)).distinct()
    rest = docs.join(gone.hint("merge"), key == F.col(own), "left_anti")
    repeated = docs.select(key.alias(own)).where(F.col(own).isNotNull()).groupBy(own).agg(F.count("*").alias("n")).where("n > 1").select(own)
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated.hint("merge"), key == F.col(own), "left_semi").dropDuplicates([doc_id])
    return rest.join(repeated.hint("merge"), key == F.col(own), "left_anti").unionByName(once)


def large_group_links(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links of candidate groups above BLOCK texts, in bounded cells."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    placed = texts.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    heads = placed.groupBy("cell").agg(F.min("doc_id").alias("least"))
    pivots = placed.join(heads, "cell").where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.ceil(F.col("n") / F.lit(PIVOTS))) == 0)
    first = F.xxhash64("cell", "block", F.lit("within"))
    within = placed.select(first.alias("cell"), "doc_id", "text").unionByName(
        pivots.select("cell", "doc_id", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select(F.xxhash64("cell", F.col("block").cast("long"), F.lit("within")).alias("cell"), "doc_id", "text")).dropDuplicates(["cell", "doc_id"])
    links = written(confirm(within.withColumn("side", F.lit(-1)), words, percent), "links")
    parts = connected(links)
    placed = placed.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component")
    counts = placed.groupBy("cell", "part").agg(F.count("*").alias("m"))
    main = counts.groupBy("cell").agg(F.max(F.struct("m", "part")).alias("x")).select("cell", F.col("x.part").alias("main"))
    placed = placed.join(main, "cell")
    apart = placed.where("part != main")
    odd = apart.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("odd_blocks"))
    # every text outside the main part meets every block
    mine = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("odd_blocks"))
    rest = apart.join(odd, "cell").withColumn("odd", mine).select(
        "cell", "doc_id", "text", "odd", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"))
    all_ = placed.join(odd, "cell").select(
        "cell", "doc_id", "text", F.explode(F.sequence(F.lit(0), F.col("odd_blocks") - 1)).alias("odd"), "block", F.lit(1).alias("side"))
    cells = rest.unionByName(all_.select(*rest.columns)).withColumn("cell", F.xxhash64("cell", F.col("odd").cast("long"), F.col("block").cast("long"), F.lit("across")))
    return links.unionByName(confirm(cells, words, percent))
