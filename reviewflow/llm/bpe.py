"""Byte-pair encoding and decoding for byte-level BPE vocabularies (``tokenizer.json``).

Encoding works on distinct white-space units, which Arrow splits off and numbers. The
pre-tokenisation pattern never joins characters across a unit border, except inside
white-space runs, which take the plain pattern over the whole text. Units that are not in
the worker's cache are split by the pattern, and their distinct pieces go through batched
merge rounds: the symbols of all pieces lie in one flat array; each round finds the
lowest-ranked pair of every piece by binary search over the sorted pair keys (the answers for
pairs of single bytes are kept) and merges all its occurrences, left to right.

Results, by case: null text is the empty text; empty text has no ids; strings of added
(special) tokens become their id, as the library does by default; repeated rows, ties and
extra columns pass through (one output row per input row).
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .runtime import Generations, free_name, ship, text_slices

# White space as Unicode defines it, and the byte-level pattern of the
# vocabulary's pre-tokeniser.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
           rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PIECES = regex.compile(PATTERN)
# A space behind white space and before white space or the end: only there a run of white
# space spans more than one unit.
SPANNING = re.compile(rf"[{SPACE}] (?:[{SPACE}]|\Z)")
OTHER_SPACE = re.compile(rf"[^\S \n]|[\x85]")

CLOSING = frozenset(".,;:!?")

CACHE_UNITS = 60_000
CACHE_PIECES = 40_000
NO_RANK = np.int32(2**31 - 1)


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1
    stands for itself, the rest follows from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + n)] = b
    return out


class Vocabulary:
    """Merge table and byte strings of a byte-level BPE ``tokenizer.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for s, i in ids.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in s)
        for s, i in self.added.items():
            self.bytes_of[i] = s.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_id[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_rank, self.pair_id = keys[order], order.astype(np.int32), merged[order].astype(np.int32)
        left, right = (self.byte_id[h.ravel()] for h in np.indices((256, 256)))
        self.byte_rank, self.byte_into = self._ranked(left, right)   # of pairs of bytes, the first round's
        self.specials = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that aren't UTF-8 become U+FFFD, special strings stay."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair, by binary search; NO_RANK where none merges."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = self.pair_keys[at] == keys
        return np.where(known, self.pair_rank[at], NO_RANK), self.pair_id[at]

    def merge_rounds(self, words: list[bytes]) -> list[bytes]:
        """Ids of each byte string, as one piece each, in little-endian int32 bytes."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.byte_id[raw]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        done_symbols, done_words = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        rank = np.full(len(symbols), NO_RANK)
        into = np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            inside = np.nonzero(word[:-1] == word[1:])[0]
            pair = raw[inside].astype(np.int32) * 256 + raw[inside + 1]
            rank[inside], into[inside] = self.byte_rank[pair], self.byte_into[pair]
        while len(symbols):
            first = np.nonzero(np.r_[True, word[1:] != word[:-1]])[0]
            counts = np.diff(np.r_[first, len(symbols)])
            least = np.repeat(np.minimum.reduceat(rank, first), counts)
            keep = least < NO_RANK
            closed = ~keep
            done_symbols.append(symbols[closed])
            done_words.append(word[closed])
            pos = np.nonzero(keep & (rank == least))[0]
            if not len(pos):
                break
            # overlapping occurrences (a a a): every second one from the left
            if (pos[1:] - pos[:-1] == 1).any():
                run = np.cumsum(np.r_[0, np.diff(pos) != 1])
                pos = pos[(np.arange(len(pos)) - np.searchsorted(run, run)) % 2 == 0]
            symbols[pos] = into[pos]
            keep[pos + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[pos] = True
            symbols, word, rank, into, changed = symbols[keep], word[keep], rank[keep], into[keep], changed[keep]
            # only pairs beside a new symbol have a new rank
            changed[:-1] |= changed[1:].copy()
            at = np.nonzero(changed)[0]
            rank[at] = NO_RANK
            at = at[at < len(symbols) - 1]
            at = at[word[at] == word[at + 1]]
            rank[at], into[at] = self._ranked(symbols[at], symbols[at + 1])
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        flat = symbols[np.argsort(word, kind="stable")].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


def spans_units(text: str) -> bool:
    """Whether a run of white space in the text lies across the borders of its units."""
    if text.isascii():
        odd = "  " in text or "\n " in text or " \n" in text or text.endswith(" ") or any(c in text for c in "\t\r\x0b\x0c")
    else:
        odd = "  " in text or "\n " in text or " \n" in text or text.endswith(" ") or OTHER_SPACE.search(text)
    return bool(odd and SPANNING.search(text))


def unit_pieces(prefix: str, unit: str) -> list[str]:
    """Pre-tokens of one unit; the two common forms need no pattern."""
    if unit.isalpha():
        return [prefix + unit]
    if unit[-1:] in CLOSING and unit[:-1].isalpha():
        return [prefix + unit[:-1], unit[-1]]
    return PIECES.findall(prefix + unit)


def split_units(units: list[str]) -> list[list[str]]:
    """Pre-tokens of different units, each behind a space. Units without white space at their
    edges go through the pattern together: it starts a piece with a space at each of them and
    nowhere else."""
    out = {}
    inner = [u for u in units if u and u == u.strip()]
    if inner:
        pieces = PIECES.findall(" " + " ".join(inner))
        at = [k for k, p in enumerate(pieces) if p[0] == " "]
        out = {u: pieces[a:b] for u, a, b in zip(inner, at, [*at[1:], len(pieces)])}
    return [out[u] if u in out else unit_pieces(" ", u) for u in units]


class Encoder:
    """Encodes texts with caches of pieces and units that live as long as the worker."""

    def __init__(self, vocabulary: Vocabulary, units: int = CACHE_UNITS):
        self.v = vocabulary
        self.pieces = Generations(units * CACHE_PIECES // CACHE_UNITS)
        self.units = Generations(units)           # unit behind a space
        self.leading = Generations(20_000)        # first unit of a text

    def learn_pieces(self, pieces) -> None:
        new = self.pieces.unknown(pieces)
        self.pieces.update(zip(new, self.v.merge_rounds([p.encode("utf-8", "surrogatepass") for p in new])))

    def _ids_of(self, cache: Generations, units: list, prefix: str) -> list[bytes]:
        """Ids of different units, as little-endian int32 bytes."""
        out = cache.known(units)
        at = [i for i, ids in enumerate(out) if ids is None]
        new = [units[i] for i in at]
        # a unit of letters only is one piece
        letters = [u for u in new if u.isalpha()]
        cache.update(zip(letters, self.v.merge_rounds([(prefix + u).encode("utf-8", "surrogatepass") for u in letters])))
        mixed = [u for u in new if not u.isalpha()]
        split = split_units(mixed) if prefix else [unit_pieces(prefix, u) for u in mixed]
        self.learn_pieces(set().union(*split))
        of = self.pieces.__getitem__
        cache.update((u, b"".join(map(of, s))) for u, s in zip(mixed, split))
        for i, u in zip(at, new):
            out[i] = cache[u]
        return out

    def _by_units(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts whose pieces lie within their units: Arrow splits the texts and numbers
        their different units, only those meet the caches, and Arrow puts the ids in place."""
        units = pc.split_pattern(texts, " ")
        ends = units.offsets.to_numpy()
        coded = units.flatten().dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        heads = code[ends[:-1]]
        times, as_head = (np.bincount(c, minlength=len(distinct)) for c in (code, heads))
        behind, leading = np.nonzero(times > as_head)[0], np.nonzero(as_head)[0]
        blobs = self._ids_of(self.units, distinct[behind].tolist(), " ")
        blobs += self._ids_of(self.leading, distinct[leading].tolist(), "")
        place = np.zeros(len(distinct), np.int32)
        place[behind] = np.arange(len(behind))
        at = place[code]
        place[leading] = len(behind) + np.arange(len(leading))
        at[ends[:-1]] = place[heads]
        # Arrow lays the units' ids side by side
        laid = pa.array(blobs, pa.large_binary()).take(pa.array(at))
        until = np.frombuffer(laid.buffers()[1], "<i8")[ends] // 4
        out = np.frombuffer(laid.buffers()[2], "<i4") if until[-1] else np.zeros(0, "<i4")
        rows = until.tolist()
        return [out[a:b] for a, b in zip(rows, rows[1:])]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens."""
        for cache in (self.pieces, self.units, self.leading):
            cache.turn()
        whole = {i: PIECES.findall(t) for i, t in enumerate(texts) if spans_units(t)}
        self.learn_pieces(set().union(*whole.values()))
        piece = self.pieces.__getitem__
        out = [np.frombuffer(b"".join(map(piece, whole[i])), "<i4") if i in whole else None for i in range(len(texts))]
        rest = [i for i in range(len(texts)) if i not in whole]
        if rest:
            for i, ids in zip(rest, self._by_units(pa.array([texts[i] for i in rest], pa.large_string()))):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (int32)."""
        special = self.v.specials
        plain, layout = [], []
        for t in texts:
            row: list = []
            if special and any(s in t for s in self.v.added):
                end = 0
                for m in special.finditer(t):
                    row += [len(plain), m.group()]
                    plain.append(t[end:m.start()])
                    end = m.end()
                t = t[end:]
            row.append(len(plain))
            plain.append(t)
            layout.append(row)
        done = self._plain(plain)
        out = []
        for row in layout:
            ids = [done[x] if isinstance(x, int) else np.array([self.v.added[x]], "<i4") for x in row]
            out.append(ids[0] if len(ids) == 1 else np.concatenate(ids))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.v.decode(ids)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder(path: str, units: int = CACHE_UNITS) -> Encoder:
    """The worker's encoder; ``units`` trades its memory for time."""
    return Encoder(vocabulary(path), units)


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def append_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def list_array(rows: list[np.ndarray], kind=pa.int32()) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, kind))


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with a column of token ids (``array<int>``) of the whole texts. Where a column has that
    name already, in any case, the new one gets underscores before it."""
    ship(df.sparkSession)
    into = free_name(df, into)

    def run(batches):
        from reviewflow.llm import bpe, runtime
        enc = bpe.encoder(path)
        for batch in batches:
            for part, texts in runtime.text_slices(batch, text):
                yield bpe.append_column(part, into, bpe.list_array(enc.encode(texts)))

    return df.mapInArrow(run, _with(df.schema, into, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text that a column of ids stands for (null ids: null). Ids outside
    the vocabulary raise an error. Names as in ``encode``."""
    ship(df.sparkSession)
    into = free_name(df, into)

    def run(batches):
        from reviewflow.llm import bpe
        enc = bpe.vocabulary(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 250):
                part = batch.slice(start, 250)
                lists = part.column(part.schema.get_field_index(ids))
                flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                missing = lists.is_null().to_pylist()
                texts = [None if m else enc.decode(flat[a:b]) for m, a, b in zip(missing, ends[:-1], ends[1:])]
                yield bpe.append_column(part, into, pa.array(texts, pa.string()))

    return df.mapInArrow(run, _with(df.schema, into, T.StringType()))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the ids of the whole texts and the texts that those ids decode to, by one
    Python worker a task (``encode`` and ``decode`` after each other take two). Names as in ``encode``."""
    ship(df.sparkSession)
    ids, decoded = free_name(df, ids), free_name(df, decoded)

    def run(batches):
        from reviewflow.llm import bpe, runtime
        enc = bpe.encoder(path)
        for batch in batches:
            for part, texts in runtime.text_slices(batch, text):
                rows = enc.encode(texts)
                part = bpe.append_column(part, ids, bpe.list_array(rows))
                yield bpe.append_column(part, decoded, pa.array([enc.decode(r) for r in rows], pa.string()))

    return df.mapInArrow(run, _with(_with(df.schema, ids, T.ArrayType(T.IntegerType())), decoded, T.StringType()))
