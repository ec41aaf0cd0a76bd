"""Token ids in binary files: one zstandard frame for each document (or for each
``frame_tokens`` ids of a long one), a seek table at the end, a checksum for each frame.

A file holds, in this order: the frames, each the ids as little-endian unsigned 32-bit
integers, compressed on its own; a skippable frame with every frame's document id (signed 64-bit; a
null id is the least value) and a byte that is 1 if it continues the document of the frame
before it; the seek table of the public seekable
zstandard format: compressed size, content size and the low 32 bits of the content's XXH64
for every frame. A reader takes the table from the end and fetches only the frames asked for.

Documents are dealt to files by ranges of ids (quantiles of the id column alone), so what
the shuffle moves are compressed frames, not texts, and equal ids that fill several ranges
are spread over them. A file appears under its final name only when complete, with the
same content on every attempt, so lost tasks may run again.

Results, by case: null and empty texts have the end id only; null ids come first; repeated
rows are kept, in the order of their content; an empty table gives no files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import scratch, ship, written

# Fixed values of the public formats: skippable frames and the seek table's footer.
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
NULL_ID = -(2**63)
FRAME_TOKENS = 1 << 20
LEVEL = 3
# One Python worker a task here, so its cache and slices may be larger than the encoder's defaults.
CACHE_UNITS, SLICE = 600_000, 4_000_000

FRAMES = "shard int, doc_id long, order_key long, part int, n_tokens long, checksum long, frame binary"
MANIFEST = "shard int, path string, frames long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def filesystem(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def file_tail(ids: list[int], more: list[bool], sizes: list[tuple[int, int, int]]) -> bytes:
    keys = struct.pack(f"<{len(ids)}q", *ids) + bytes(more)
    table = b"".join(struct.pack("<III", *s) for s in sizes) + struct.pack("<IBI", len(sizes), HAS_CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE_IDS, len(keys)) + keys + struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table


def read_tail(f, size: int) -> list[tuple[int, bool, int, int, int, int]]:
    """Per frame: document id, whether it continues the one before, offset, compressed
    size, content size, checksum."""
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE or flags != HAS_CHECKSUMS:
        raise ValueError("no seek table")
    start = size - (8 + 12 * n + 9) - (8 + 9 * n)
    f.seek(start)
    tail = f.read(size - start)
    magic, length = struct.unpack_from("<II", tail)
    if magic != SKIPPABLE_IDS or length != 9 * n:
        raise ValueError("no table of document ids")
    ids = struct.unpack_from(f"<{n}q", tail, 8)
    out, offset = [], 0
    for k in range(n):
        packed, content, check = struct.unpack_from("<III", tail, 8 + 9 * n + 8 + 12 * k)
        out.append((ids[k], bool(tail[8 + 8 * n + k]), offset, packed, content, check))
        offset += packed
    return out


def read_frame(f, offset: int, packed: int, content: int, check: int) -> bytes:
    """The content of one frame, checked."""
    f.seek(offset)
    data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=content)
    if len(data) != content or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError(f"damaged frame at {offset}")
    return data


def frames(docs: DataFrame, tokenizer: str, bounds: list[int], end_id: int, doc_id: str, text: str,
           frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """A row for each frame, with the file (shard) that it belongs to."""
    ship(docs.sparkSession)

    def run(batches):
        from reviewflow.llm import bpe, runtime, token_files
        enc, pack = bpe.encoder(tokenizer, token_files.CACHE_UNITS), zstandard.ZstdCompressor(level=token_files.LEVEL)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "text", chars=token_files.SLICE):
                rows = [[] for _ in range(7)]
                for key, ids in zip(part.column(0).to_pylist(), enc.encode(texts)):
                    whole = ids.tobytes() + end  # ids below 2^31 look alike signed and unsigned
                    digest = xxhash.xxh64_intdigest(whole)
                    content = digest >> 1
                    low, high = (0, 0) if key is None else (bisect_left(bounds, key), bisect_right(bounds, key))
                    shard = low + content % (high - low + 1)
                    one = len(whole) <= 4 * frame_tokens
                    for k in range(0, len(whole), 4 * frame_tokens):
                        data = whole if one else whole[k:k + 4 * frame_tokens]
                        check = digest if one else xxhash.xxh64_intdigest(data)
                        for column, value in zip(rows, (shard, key, content, k // (4 * frame_tokens), len(data) // 4,
                                                        check & 0xFFFFFFFF, pack.compress(data))):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds)],
                                                 names=["shard", "doc_id", "order_key", "part", "n_tokens", "checksum", "frame"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, FRAMES)


def id_bounds(docs: DataFrame, doc_id: str, files: int) -> list[int]:
    """Ids that part the documents into ``files`` ranges of about equal rows."""
    if files < 2:
        return []
    at = [k / files for k in range(1, files)]
    row = docs.agg(F.percentile_approx(F.col(doc_id).cast("long"), at, 20 * files).alias("q")).first()
    return list(row.q or [])


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, files: int | None = None, end_id: int = 0,
          doc_id: str = "doc_id", text: str = "text", frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Write the token files of ``docs`` and return their manifest (a row for each file).

    ``files``: how many (the session's shuffle partitions if unset). ``folder``: a URI that
    every executor can write to (a new one in the shared folder if unset)."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(docs, doc_id, files)
    dealt = (frames(docs, tokenizer, bounds, end_id, doc_id, text, frame_tokens)
             .repartition(files, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "order_key", "part"))

    def run(batches):
        from reviewflow.llm import token_files
        fs, base = token_files.filesystem(folder)
        fs.create_dir(base, recursive=True)
        shard = out = None

        def close():
            out.write(token_files.file_tail(ids, more, sizes))
            out.close()
            final = f"{base}/part-ids-{shard:06d}.zst"
            fs.move(temporary, final)
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [final], "frames": [len(ids)], "tokens": [tokens]})

        for batch in batches:
            for row in batch.select(["shard", "doc_id", "part", "n_tokens", "checksum", "frame"]).to_pylist():
                if row["shard"] != shard:
                    if out is not None:
                        yield close()
                    shard, ids, more, sizes, tokens = row["shard"], [], [], [], 0
                    temporary = f"{base}/unfinished-{shard:06d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(temporary)
                out.write(row["frame"])
                ids.append(token_files.NULL_ID if row["doc_id"] is None else row["doc_id"])
                more.append(row["part"] > 0)
                sizes.append((len(row["frame"]), 4 * row["n_tokens"], row["checksum"]))
                tokens += row["n_tokens"]
        if out is not None:
            yield close()

    made = written(dealt.mapInArrow(run, MANIFEST), "manifest")
    # a row for each file only
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return made.select("shard", F.concat(F.lit(folder), F.regexp_extract("path", "(/[^/]*)$", 1)).alias("path"), "frames", "tokens",
                       F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))


def read(manifest: DataFrame, only: list[int] | None = None) -> DataFrame:
    """Per document, from the files: id, the ids before it, its number of ids and their
    CRC-32. With ``only``, a bounded list of ids, no other frames are fetched."""
    spark = manifest.sparkSession
    ship(spark)
    wanted = None if only is None else frozenset(token_files_key(k) for k in only)

    def run(batches):
        from reviewflow.llm import token_files
        for batch in batches:
            for row in batch.to_pylist():
                for chunk in token_files.documents(row["path"], row["start"], wanted):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if d[0] == token_files.NULL_ID else d[0] for d in chunk], pa.int64()),
                         *(pa.array([d[k] for d in chunk], pa.int64()) for k in (1, 2, 3))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("shard", "path", "start").repartition(files, "shard").mapInArrow(run, DOCUMENTS)


def token_files_key(doc_id: int | None) -> int:
    return NULL_ID if doc_id is None else doc_id


def documents(uri: str, start: int, wanted: frozenset | None = None, rows: int = 5_000):
    """Lists of (id, start, number of ids, CRC-32) of one file's documents."""
    fs, path = filesystem(uri)
    out, keep = [], False
    with fs.open_input_file(path) as f:
        for key, more, offset, packed, content, check in read_tail(f, f.size()):
            if not more:
                if len(out) >= rows:
                    yield out
                    out = []
                keep = wanted is None or key in wanted
                if keep:
                    out.append((key, start, 0, 0))
            if keep:
                key, first, n, crc = out[-1]
                out[-1] = (key, first, n + content // 4, zlib.crc32(read_frame(f, offset, packed, content, check), crc))
            start += content // 4
    if out:
        yield out
