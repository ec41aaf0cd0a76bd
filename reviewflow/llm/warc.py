"""Merkle fixity audit of WARC collections, in DataFrame functions.

``records`` gives each page's WARC response record: headers, block, length, SHA-256, and its place in the
collection: a given column, or its id. Records are ordered by place (ties: by id, then digest) and dealt to files by
ranges of places, ``RANGE`` places each; a file that has more than ``MOST`` records, because places repeat, is
split by digest. Within a file (and part) every record has its offset. A file's tree has the places as leaves, which
hash their records' ids, digests and lengths; a node covers ``FANOUT`` neighbouring nodes, an ordered offset range,
and hashes their hashes and lengths in bytes in order, so it fixes every record's offset in the range. ``audit`` compares
the trees of two replicas from the roots down: only children of nodes that differ are looked at, and at
the leaves the records that differ are named. A lost or extra record changes its own branch only; one that moved changes
two, and is called moved.

Results, by case: null html is an empty block, a null url an empty target; a null id is an id of its
own and a null place a place of its own (before the least value of each); equal repeated records at one place are one leaf
with a count; an empty replica has no roots, so all records of the other are missing (or extra); texts
of any length are hashed whole; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import written

RANGE = 4096
MOST = 4096
FANOUT = 16
LEVELS = 3  # FANOUT ** LEVELS == RANGE
KEYS = ["page_id", "place", "digest", "copies"]


def record(url, block):
    """The bytes of a WARC response record, as text in UTF-8."""
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(block).cast("string"),
                    F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", place: str | None = None) -> DataFrame:
    """(page_id, place, length, digest, copies): a row for each different record."""
    whole = record(F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(html), F.lit("")))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(place or page_id).cast("long").alias("place"),
                        F.octet_length(whole).cast("long").alias("length"), F.sha2(whole, 256).alias("digest"))
    return rows.groupBy("page_id", "place", "digest", "length").agg(F.count("*").alias("copies"))


def leaves(found: DataFrame) -> DataFrame:
    """Records with their file and slot in it (0 .. RANGE - 1). Those without a place have a file of their own, the
    one before the least."""
    lowest = -(2**63) // RANGE - 1
    return found.withColumns({
        "file": F.coalesce(F.expr(f"(place - pmod(place, {RANGE}L)) div {RANGE}L"), F.lit(lowest)),
        "slot": F.coalesce(F.pmod("place", F.lit(RANGE)).cast("int"), F.lit(0))})


def offsets(found: DataFrame) -> DataFrame:
    """Records with file, part and offset: the bytes of the part's records before them. Files are
    ranges of places; where places repeat beyond MOST records a file, digests part it."""
    from pyspark.sql import Window
    placed = leaves(found)
    sizes = placed.groupBy("file").agg(F.ceil(F.count("*") / F.lit(MOST)).cast("int").alias("parts"))
    placed = placed.join(sizes, "file").withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    before = (Window.partitionBy("file", "part").orderBy("place", F.asc_nulls_first("page_id"), "digest")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)))


def tree(found: DataFrame) -> list[DataFrame]:
    """Nodes by level, the places first, the root of each file last: (file, node, hash, records, bytes)."""
    # one leaf for each place: an order-free sum of its records' hashes, as a place may have many
    named = F.sha2(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), "digest", F.col("length").cast("string")), 256)
    leaf = leaves(found).withColumn("name", named).groupBy("file", "slot").agg(
        F.count("*").alias("different"), F.sum("copies").alias("records"), F.sum(F.col("length") * F.col("copies")).alias("bytes"),
        F.min("name").alias("low"), F.max("name").alias("high"),
        *(F.sum(F.conv(F.substring("name", 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)") * F.col("copies")).alias(f"s{k}") for k in range(8)))
    level = leaf.select("file", F.col("slot").alias("node"), F.sha2(F.concat_ws(
        " ", "low", "high", *(F.col(c).cast("string") for c in ("different", "records", "bytes", *(f"s{k}" for k in range(8))))), 256).alias("hash"),
        "records", "bytes")
    out = [level]
    for _ in range(LEVELS):
        level = level.groupBy("file", F.floor(F.col("node") / F.lit(FANOUT)).cast("int").alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("node", "hash", "bytes"))).alias("children"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))
        level = level.select("file", F.col("parent").alias("node"), F.sha2(F.array_join(F.transform(
            "children", lambda c: F.concat_ws(":", c.node.cast("string"), c.bytes.cast("string"), c.hash)), " "), 256).alias("hash"), "records", "bytes")
        out.append(level)
    return out


def descend(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """(file, node) of the leaves that differ, found from the roots down."""
    suspects = None
    for a, b in zip(reversed(ours), reversed(theirs)):
        if suspects is not None:
            inside = F.floor(F.col("node") / F.lit(FANOUT)).cast("int")
            a, b = (x.withColumn("parent", inside).join(suspects, ["file", "parent"], "left_semi") for x in (a, b))
        both = a.select("file", "node", F.col("hash").alias("ours")).join(b.select("file", "node", F.col("hash").alias("theirs")), ["file", "node"], "full")
        differing = both.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("file", "node")
        suspects = differing.withColumnRenamed("node", "parent")
    return suspects.select("file", F.col("parent").alias("node"))


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(page_id, file, part, offset, length, digest, status): every record of the first replica, ``intact``,
    ``moved`` (the other has it as often, elsewhere), ``changed`` (it has its id with another record or count) or ``missing``, and the
    ``extra`` ids of the other, without a place."""
    ours, theirs = written(ours, "records"), written(theirs, "records")
    bad = written(descend([written(x, "tree") for x in tree(ours)], [written(x, "tree") for x in tree(theirs)]), "differing")
    bad = bad.select("file", F.col("node").alias("slot"))
    there = leaves(theirs).join(bad, ["file", "slot"], "left_semi")
    same = there.select(*KEYS, F.lit(True).alias("same"))
    elsewhere = there.select("page_id", "digest", "copies").distinct().withColumn("elsewhere", F.lit(True))
    held = there.select("page_id").distinct().withColumn("held", F.lit(True))
    checked = offsets(ours).join(bad.withColumn("bad", F.lit(True)), ["file", "slot"], "left")
    for marks, keys in ((same, KEYS), (elsewhere, ["page_id", "digest", "copies"]), (held, ["page_id"])):
        checked = _marked(checked, marks, keys)
    status = (F.when(F.col("bad").isNull() | F.col("same").isNotNull(), "intact").when(F.col("elsewhere").isNotNull(), "moved")
              .when(F.col("held").isNotNull(), "changed").otherwise("missing"))
    listed = checked.select("page_id", "file", "part", "offset", "length", "digest", status.alias("status"))
    known = ours.select("page_id").distinct().withColumn("known", F.lit(True))
    extra = _marked(held, known, ["page_id"]).where("known is null").select(
        "page_id", F.lit(None).cast("long").alias("file"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("length"), F.lit(None).cast("string").alias("digest"), F.lit("extra").alias("status"))
    return listed.unionByName(extra)


def _marked(rows: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    """A left join on keys that may be null."""
    other = marks.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in marks.columns if c not in keys))
    on = [rows[k].eqNullSafe(other[f"_{k}"]) for k in keys]
    return rows.join(other, on, "left").drop(*(f"_{k}" for k in keys))
