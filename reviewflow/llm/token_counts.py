"""Exact token counts of every prefix of a text, by dynamic programming.

Within one pre-token, a byte prefix has exactly one last token: the token ending there
that the pair rule allows behind the last token of the prefix before it (a pair is allowed
when byte-pair encoding of its bytes gives the pair back). ``count[end] = count[start] + 1``
along these last tokens, so one pass gives the counts of all prefixes. Pre-tokens that a
cut changes (white-space runs before a word, contractions, added tokens) are set right.
The table of a text is kept as compressed differences; truncation and budget questions are
answered from it, without encoding again.

Results, by case: null and empty text have 0 bytes, 0 tokens and a table of one entry; an
added token's string counts 1 once complete, its proper prefixes count as ordinary text;
each input row gives one output row with all its columns.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import bpe
from .runtime import Generations, free_name, ship

RUNS = re.compile(rf"[{bpe.SPACE}]{{2,}}(?=[^{bpe.SPACE}])")
CACHE_UNITS = 150_000
# Multiplier of the hash of token prefixes, modulo 2**64.
HASH, MASK = 0x9E3779B97F4A7C15, 2**64 - 1
#: Contractions of the pattern that a cut can end inside.
OPEN_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, vocabulary: bpe.Vocabulary):
        v = self.v = vocabulary
        added = set(v.added.values())
        ids = [i for i, b in enumerate(v.bytes_of) if b and i not in added]
        # tokens that their own bytes encode to
        sound = {v.bytes_of[i]: i for i, got in zip(ids, v.merge_rounds([v.bytes_of[i] for i in ids]))
                 if got == np.int32(i).astype("<i4").tobytes()}
        starts: list[dict] = [{} for _ in range(max(map(len, sound)) + 1)]
        for b, i in sound.items():
            h = 0
            for k, x in enumerate(b):
                h = (h * HASH + x + 1) & MASK
                starts[k + 1].setdefault(h, -1)
            starts[len(b)][h] = i
        self.starts = []  # by length: sorted hashes of token prefixes, the token's id or -1
        for d in starts:
            keys = np.array(sorted(d), np.uint64)
            self.starts.append((keys, np.array([d[k] for k in keys.tolist()], np.int64)))
        left, right = np.divmod(v.pair_keys, v.size)
        halves = {i: (a, b, r) for i, a, b, r in zip(v.pair_id.tolist(), left.tolist(), right.tolist(), v.pair_rank.tolist())}
        self.right_edge = self._edges(halves, 1)
        self.left_edge = self._edges(halves, 0)
        self.units = Generations(CACHE_UNITS)
        self.leading = Generations(20_000)
        self.pieces = Generations(CACHE_UNITS)

    def _edges(self, halves: dict, side: int):
        """Per token, the symbols that lie at one edge of it while its merges run, and the
        rank of the merge that ends each (the token itself: never): offsets, symbols, ranks."""
        ends, symbols, ranks = [0], [], []
        for t in range(self.v.size):
            until = int(bpe.NO_RANK)
            while True:
                symbols.append(t)
                ranks.append(until)
                if t not in halves:
                    break
                until, t = halves[t][2], halves[t][side]
            ends.append(len(symbols))
        return np.array(ends), np.array(symbols), np.array(ranks)

    def allowed(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether encoding keeps each token apart behind the one before it. It doesn't if
        a pair across the border merges before either side's symbol is used up inside its
        own token; of equal ranks, the pair further left merges first."""
        ends, left, left_until = self.right_edge
        first, right, right_until = self.left_edge
        n_left, n_right = ends[last + 1] - ends[last], first[token + 1] - first[token]
        n = n_left * n_right
        row = np.repeat(np.arange(len(last)), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        a = ends[last][row] + k // n_right[row]
        b = first[token][row] + k % n_right[row]
        rank, _ = self.v._ranked(left[a], right[b])
        crossing = (rank < left_until[a]) & (rank <= right_until[b]) & (rank < bpe.NO_RANK)
        ok = np.ones(len(last), bool)
        ok[row[crossing]] = False
        return ok

    def byte_counts(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of the byte prefixes of each pre-token, by one flat array with an
        entry for length 0 of each piece, and the place of that entry."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64) + np.uint64(1)
        begin = np.cumsum(size) - size
        offset = np.arange(len(flat)) - np.repeat(begin, size)
        left_over = np.repeat(size, size) - offset
        entry = np.arange(len(flat)) + np.repeat(np.arange(len(pieces)), size)  # of the prefix that ends before the byte
        # tokens that start at each byte: walk along token prefixes, one byte longer a round
        at, h, found = np.arange(len(flat)), np.zeros(len(flat), np.uint64), []
        for k in range(1, len(self.starts)):
            alive = left_over[at] >= k
            at = at[alive]
            if not len(at):
                break
            h = h[alive] * np.uint64(HASH) + flat[at + (k - 1)]
            keys, ids = self.starts[k]
            i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[i] == h
            at, h, i = at[hit], h[hit], ids[i[hit]]
            token = i >= 0
            found.append((at[token], np.full(int(token.sum()), k), i[token]))
        count = np.zeros(len(flat) + len(pieces), np.int32)
        last = np.full(len(count), -1)
        if found:
            at, k, token = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(offset[at], kind="stable")
            at, k, token = at[order], k[order], token[order]
            rounds = np.searchsorted(offset[at], np.arange(int(size.max()) + 1))
            for a, b in zip(rounds[:-1], rounds[1:]):
                if a == b:
                    continue
                start, t = entry[at[a:b]], token[a:b]
                end = start + k[a:b]
                before = last[start]
                ok = before < 0
                pair = np.nonzero(~ok & (last[end] < 0))[0]
                keys, back = np.unique(before[pair] * self.v.size + t[pair], return_inverse=True)
                ok[pair] = self.allowed(keys // self.v.size, keys % self.v.size)[back]
                last[end[ok]] = t[ok]
                count[end[ok]] = count[start[ok]] + 1
        return count, begin + np.arange(len(pieces))

    def learn(self, pieces: set) -> None:
        """Differences of the prefix counts, by code points, of pre-tokens that are new."""
        new = self.pieces.unknown(pieces)
        if not new:
            return
        data = [p.encode("utf-8", "surrogatepass") for p in new]
        count, begin = self.byte_counts(data)
        # the last byte of each code point is where a count is read
        flat = np.frombuffer(b"".join(data), np.uint8)
        size = np.fromiter(map(len, data), np.int64, len(data))
        piece = np.repeat(np.arange(len(data)), size)
        closes = np.r_[(flat[1:] & 0xC0) != 0x80, True] if len(flat) else np.zeros(0, bool)
        places = np.nonzero(closes)[0]
        values = count[places + piece[places] + 1]
        heads = np.r_[True, piece[places][1:] != piece[places][:-1]] if len(places) else np.zeros(0, bool)
        delta = np.where(heads, values, values - np.r_[0, values[:-1]]).astype("<i2").tobytes() if len(places) else b""
        ends = (2 * np.cumsum([len(p) for p in new])).tolist()
        self.pieces.update((p, delta[a:b]) for p, a, b in zip(new, [0, *ends], ends))
        for p in OPEN_CONTRACTIONS:
            if p in self.pieces:
                whole = int(count[begin[new.index(p)] + 3]) if p in new else None
                if whole is not None:
                    self.pieces[p] = np.array([1, 1, whole - 2], "<i2").tobytes()

    def _learn_units(self, cache: Generations, units: set, prefix: str) -> None:
        new = cache.unknown(units)
        split = [bpe.unit_pieces(prefix, u) for u in new]
        self.learn(set().union(*split))
        of = self.pieces.__getitem__
        cache.update((u, b"".join(map(of, s))) for u, s in zip(new, split))

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts of all prefixes (from length 0) of texts without added tokens."""
        for cache in (self.units, self.leading, self.pieces):
            cache.turn()
        parts, whole, runs = {}, {}, {}
        for i, t in enumerate(texts):
            if r := [m.span() for m in RUNS.finditer(t)]:
                runs[i] = r
            if bpe.spans_units(t):
                whole[i] = bpe.PIECES.findall(t)
            else:
                parts[i] = t.split(" ")
        head = {i: p.pop(0) for i, p in parts.items()}
        self._learn_units(self.units, set().union(*parts.values()), " ")
        self._learn_units(self.leading, set(head.values()), "")
        self.learn(set().union(*whole.values(), *({texts[i][a:b] for a, b in r} for i, r in runs.items())))
        of, piece, out = self.units.__getitem__, self.pieces.__getitem__, []
        for i, t in enumerate(texts):
            deltas = b"".join(map(piece, whole[i])) if i in whole else self.leading[head[i]] + b"".join(map(of, parts[i]))
            counts = np.zeros(len(t) + 1, np.int32)
            np.cumsum(np.frombuffer(deltas, "<i2"), dtype=np.int32, out=counts[1:])
            for a, b in runs.get(i, ()):  # cut behind a run of white space, the run is one pre-token
                counts[b] = counts[a] + int(np.frombuffer(piece(t[a:b]), "<i2").sum())
            out.append(counts)
        return out

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """Token counts of the prefixes of each text: entry i is that of the first i code points."""
        special, plain, layout = self.v.specials, [], []
        for t in texts:
            row, end = [], 0
            if special and any(s in t for s in self.v.added):
                for m in special.finditer(t):
                    # up to its last character, an added token's string is ordinary text
                    row.append((len(plain), m.start() - end))
                    plain.append(t[end:m.end()])
                    end = m.end()
            row.append((len(plain), None))
            plain.append(t[end:])
            layout.append(row)
        done, out = self.plain(plain), []
        for row in layout:
            parts, base = [np.zeros(1, np.int32)], 0
            for k, cut in row:
                c = done[k]
                if cut is not None:
                    c[-1] = c[cut] + 1
                parts.append(c[1:] + base)
                base += int(c[-1])
            out.append(np.concatenate(parts))
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(bpe.vocabulary(path))


def packed(counts: np.ndarray) -> bytes:
    """The table of a text: differences of its prefix counts, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(counts).astype("<i2").tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    d = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(blob), "<i2")
    return np.r_[np.int32(0), np.cumsum(d, dtype=np.int32)]


def prefix_counts(df: DataFrame, path: str, text: str = "text", into: str = "prefix_table",
                  n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the bytes and tokens of the whole text and the table of all its prefixes."""
    ship(df.sparkSession)
    into, n_bytes, n_tokens = (free_name(df, c) for c in (into, n_bytes, n_tokens))
    schema = T.StructType([*df.schema.fields, T.StructField(n_bytes, T.LongType()),
                           T.StructField(n_tokens, T.LongType()), T.StructField(into, T.BinaryType())])

    def run(batches):
        from reviewflow.llm import bpe, runtime, token_counts
        count = token_counts.counter(path)
        for batch in batches:
            for part, texts in runtime.text_slices(batch, text):
                sizes, totals, tables = [], [], []
                for t, c in zip(texts, count.counts(texts)):
                    sizes.append(len(t.encode("utf-8", "surrogatepass")))
                    totals.append(int(c[-1]))
                    tables.append(token_counts.packed(c))
                part = bpe.append_column(part, n_bytes, pa.array(sizes, pa.int64()))
                part = bpe.append_column(part, n_tokens, pa.array(totals, pa.int64()))
                yield bpe.append_column(part, into, pa.array(tables, pa.binary()))

    return df.mapInArrow(run, schema)


def longest_prefix(df: DataFrame, budget: int, table: str = "prefix_table", into: str = "chars_within") -> DataFrame:
    """``df`` with the length, in code points, of the longest prefix that has at most
    ``budget`` tokens, read from the stored tables (null table: null)."""
    into = free_name(df, into)
    ship(df.sparkSession)

    def run(batches):
        from reviewflow.llm import bpe, token_counts
        for batch in batches:
            tables = batch.column(batch.schema.get_field_index(table)).to_pylist()
            cut = [None if b is None else int(np.nonzero(token_counts.unpacked(b) <= budget)[0][-1]) for b in tables]
            yield bpe.append_column(batch, into, pa.array(cut, pa.int64()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.LongType())]))
