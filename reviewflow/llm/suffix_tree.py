"""Language-model scores of texts by a probabilistic suffix tree over words.

1. Tokens are words (A-Z lower-cased, parted by ASCII white space) as 64-bit hashes, and one end
   token a text, which also stands before every text as its first context. Texts are packed into
   slices of about ``TOKENS`` tokens: the slice's distinct words and, for each token, its place
   among them. They are written once; no later step reads the texts.
2. The tree holds every context of up to ``DEPTH`` words and every transition (context, next word) that occurs
   ``LEAST`` times in the training texts, however small its share of the corpus. It is nowhere whole: a gram's key is a
   hash, the range of keys is parted into shards, and a slice knows the part of the tree that its own texts touch.
3. That part grows by rounds. In a round every slice sends, for each of its different keys, its own sum
   (occurrences, kept transitions, divergence) to the key's shard, packed; the shard adds up what the slices sent
   and returns the total to each of them; slices stay in their buckets. A key comes at most once from a slice, so a frequent word or
   phrase weighs as much as a rare one in a shard. Longer grams are asked for only where both their parts occur ``LEAST`` times.
   With its total a gram that does gets its number in the shard, by which later rounds ask; so a gram's hash is sent to its shard once.
4. A state s with n occurrences gives its next word by
   P(t|s) = n(s,t) / (n + PRIOR) + (n - kept + PRIOR) / (n + PRIOR) * P(t|parent),
   ``kept`` being the sum of its kept transitions and the parent its suffix without the first word; at
   the root P is the add-0.1 estimate over all words. Each is a whole distribution. A state stays
   if its divergence from the parent, n times the relative entropy in nats, is above half the logarithm
   of the training tokens for each of its transitions; suffixes of states that stay, stay.
5. Every token is scored by the longest suffix of what stands before it that is a state.

Results, by case: null and empty texts are one end token; a null id is trained on and keeps its row;
repeated rows are trained on and scored each; without training tokens every probability is the root's
(1 for any token); ties can't matter (states are chosen by count and divergence alone); very long texts are
hashed in pieces cut at white space and are whole within a slice; an empty table gives no rows. Two words or grams with
one 64-bit hash count as one. Only the id and text columns are read, whatever others are called.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .minhash import mixed
from .runtime import ship, text_slices, written, written_by

DEPTH = 3
SHARE = 0.0  # above 0: only contexts and transitions of at least this share of the training tokens
LEAST = 2
PRIOR = 8.0
ADDED = 0.1
TOKENS = 1_000_000
PIECE = 1_000_000
BLOCK = 1 << 15
SHARD = 40  # bits of a gram's number in its shard
END = np.uint64(0x5DEECE66D1234567)

_SPACES = b"\t\n\v\f\r "
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of every word in ``data``."""
    a = np.frombuffer(data.lower() + b"\n", np.uint8)
    space = _IS_SPACE[a]
    inner = ~space
    begin = np.flatnonzero(inner & np.r_[True, space[:-1]])
    end = np.flatnonzero(inner & np.r_[space[1:], True]) + 1
    power, inverse = np.full(len(a), _BASE), np.full(len(a), _INVERSE)
    power[0] = inverse[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    sums = np.r_[np.uint64(0), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)]
    return mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)), begin


def text_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end token after each, and the number of tokens of each."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    if sum(map(len, data)) > 2 * PIECE:  # long texts: piece by piece, cut at white space
        parts, sizes = [], []
        for d in data:
            start, size = 0, 1
            while start < len(d):
                stop = start + PIECE
                if stop < len(d):
                    ahead = [x for x in (d.find(bytes([s]), stop) for s in _SPACES) if x >= 0]
                    stop = min(ahead, default=len(d))
                h, _ = _hashes(d[start:stop])
                parts.append(h)
                size += len(h)
                start = stop
            parts.append(np.array([END]))
            sizes.append(size)
        return np.concatenate([*parts, np.zeros(0, np.uint64)]), np.array(sizes, np.int64)
    h, begin = _hashes(b"\n".join(data))
    stops = np.searchsorted(begin, np.cumsum([len(d) + 1 for d in data]))
    sizes = np.diff(np.r_[0, stops]) + 1
    return np.insert(h, stops, END), sizes


@lru_cache(None)
def _zstd():
    import zstandard
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(a: np.ndarray, signed: bool = False) -> bytes:
    """Integers of 64 bits: their byte planes that aren't all zero, one after another, compressed. ``signed``: the sign in the last bit,
    so that small negative numbers have few planes too."""
    a = a.astype("<i8", copy=False)
    if signed:
        a = a << 1 ^ a >> 63
    a = a.view("<u8")
    planes = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([planes | 16 * signed]) + _zstd()[0].compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :planes].T))


def unpacked(b: bytes) -> np.ndarray:
    planes = b[0] & 15
    raw = np.frombuffer(_zstd()[1].decompress(b[1:]), np.uint8).reshape(planes, -1)
    if planes == 1:
        out = raw[0].astype("<i8")
    else:
        out = np.zeros((raw.shape[1], 8), np.uint8)
        for k in range(planes):
            out[:, k] = raw[k]
        out = out.view("<i8").ravel()
    return out.view("<u8").__rshift__(np.uint64(1)).view("<i8") ^ -(out & 1) if b[0] & 16 else out


def in_order(h: np.ndarray, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes (those at ``places``, if given) sorted, and their places. Their leading bits are sorted with the places in the last
    ones, which is several times as fast as an argsort; where that isn't enough to tell two hashes apart, all is sorted again."""
    bits = np.uint64(len(h).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    if places is None:
        x = h & ~low
        x |= np.arange(len(h), dtype=np.uint64)
    else:
        x = places  # leading bits and places already
    x.sort()
    x &= low
    order = x.view(np.int64)
    x = h[order]
    if not (x[1:] >= x[:-1]).all():
        again = np.argsort(x, kind="stable")
        order, x = order[again], x[again]
    return x, order


def firsts(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def different(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes, sorted, and each one's place among them."""
    x, order = in_order(h)
    new = firsts(x)
    place = np.empty(len(x), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return x[new], place


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return packed(steps.view(np.int64))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b).view(np.uint64), dtype=np.uint64)


SLICES = "slice long, doc_id array<long>, held_out array<boolean>, sizes binary, words binary, tokens binary"


def slices(docs: DataFrame, tokens: int = TOKENS) -> DataFrame:
    """Slices of the rows (doc_id, held_out, text)."""
    ship(docs.sparkSession)

    def pack(number, ids, held, sizes, hashes):
        from reviewflow.llm.suffix_tree import different, packed
        h = np.concatenate([np.array([END]), *hashes])
        sizes = np.concatenate(sizes)
        words, place = different(h)
        count = np.bincount(place)
        order = np.argsort(-count, kind="stable")  # common words get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        place = rank[place]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             *(pa.array([x], pa.binary()) for x in (packed(sizes), words[order].astype("<u8").tobytes(), packed(place)))],
            names=["slice", "doc_id", "held_out", "sizes", "words", "tokens"])

    def run(batches):
        from reviewflow.llm import suffix_tree as s
        number, n = TaskContext.get().partitionId() << 32, 0
        ids, held, sizes, hashes = [], [], [], []
        for batch in batches:
            for part, texts in text_slices(batch, "text", chars=s.PIECE):
                h, size = s.text_tokens(texts)
                ids += part.column(0).to_pylist()
                held += part.column(1).to_pylist()
                sizes.append(size)
                hashes.append(h)
                n += len(h)
                if n >= tokens:
                    yield pack(number, ids, held, sizes, hashes)
                    number, n = number + 1, 0
                    ids, held, sizes, hashes = [], [], [], []
        if ids:
            yield pack(number, ids, held, sizes, hashes)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SLICES)


class Tree:
    """The model in one process, from its counted levels; ``score`` spreads the same over slices. Level 1 is the words
    (sorted hashes), level k > 1 the sorted keys context * words + word, a context being a place in level k - 1."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray):
        self.hashes, self.n, self.keys, self.low = hashes, [n], [hashes], [None]

    def add(self, keys: np.ndarray, low: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.low.append(low)
        self.n.append(n)

    def choose(self, total: int, distinct: int) -> None:
        """``stays`` and ``escape`` of each level's contexts, ``share`` of each transition."""
        root = (self.n[0] + ADDED) / (total + ADDED * (distinct + 1))
        chance, self.share, self.escape, passed = root, [None], [], []
        for k in range(1, len(self.keys)):
            context = self.keys[k] // max(1, len(self.hashes))
            size = self.n[k - 1].astype(float)
            kept = np.bincount(context, self.n[k], minlength=len(size))
            escape = (size - kept + PRIOR) / (size + PRIOR)
            share = self.n[k] / (size[context] + PRIOR)
            parent = chance[self.low[k]]
            chance = share + escape[context] * parent
            gain = np.bincount(context, self.n[k] * np.log(chance / parent), minlength=len(size)) + (size - kept) * np.log(escape)
            symbols = np.bincount(context, minlength=len(size))
            passed.append((gain > 0.5 * math.log(max(total, 2)) * symbols) & (symbols > 0))
            self.share.append(share)
            self.escape.append(escape)
        for k in range(len(passed) - 1, 0, -1):  # suffixes of states that stay, stay
            passed[k - 1][self.low[k][passed[k]]] = True
        self.stays = passed


class Part:
    """The part of the tree that a slice's texts touch, as far as ``answers`` (a total for each key asked for, by kind) tell.

    Kinds: n1, n2, ...: occurrences of grams; k1, ...: occurrences of a context's kept transitions; g1, ...: whether a context passes
    the divergence test; s1, ...: whether a longer context that passes ends in this one. The keys of the latter are
    contexts; those of level j are chosen among the grams of j words that occur often enough.

    Every round builds the levels anew from the tokens, which costs less memory and disk than to keep them. Tokens are walked through
    ``BLOCK`` at a time, so that what is computed for each stays in the processor's cache. Chances are computed once for each gram
    and context, not for each token."""

    def __init__(self, row: dict, answers: dict[str, np.ndarray], ids: dict[str, np.ndarray], depth: int, share: float, total: int, distinct: int):
        self.row, self.depth, self.total, self.distinct = row, depth, total, distinct
        self.least, self.answers, self.told_ids = max(LEAST, math.ceil(share * total)), answers, ids
        self.words, self.tokens, self.sizes = np.frombuffer(row["words"], "<u8"), unpacked(row["tokens"]).astype(np.int32), unpacked(row["sizes"])
        self.learnt = np.r_[False, np.repeat(~np.array(row["held_out"], bool), self.sizes)]
        self.ends = np.r_[0, np.cumsum(self.sizes)]
        self.levels, self.ids, self.contexts, self.places, self.totals, self.parts_of = {}, {}, {}, {}, {}, {}
        self.word_order = in_order(self.words)[1]

    def word_n(self) -> np.ndarray:
        """Occurrences of the slice's words, by their numbers."""
        n = np.empty(len(self.words), np.int64)
        n[self.word_order] = self.answers["n1"]
        return n

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different keys, sorted, of grams of k > 1 words of which both parts occur often enough; the places of the tokens
        that end them, by key; and where each key's places begin."""
        at, keys, _ = self.level(k - 1)
        context, keys = self.context(k - 1), keys * _BASE
        h, x, m = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64), 0
        bits = np.uint64(len(at).bit_length())
        for b in blocks(len(at)):
            ok = np.flatnonzero((at[b] >= 0) & (context[b] >= 0))
            if len(ok):
                key = mixed(keys[context[b][ok]] + self.words[self.tokens[b][ok]])
                ok += b.start
                h[ok] = key
                x[m:m + len(ok)] = key >> bits << bits | ok.view(np.uint64)
                m += len(ok)
        x, places = in_order(h, x[:m])
        begin = np.flatnonzero(firsts(x))
        return x[begin], places, begin

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The grams of k words that occur often enough: for each token the number of the one it ends, or -1; their keys
        and occurrences. Words are numbered as in the slice, common ones first, others by key. ``ids`` has the numbers that shards
        gave them."""
        if k not in self.levels:
            if k == 1:
                keys, n = self.words, self.word_n()
            else:
                keys, places, begin = self.grams(k)
                n = self.answers[f"n{k}"]
            kept = n >= self.least
            number = np.where(kept, np.cumsum(kept, dtype=np.int32) - np.int32(1), np.int32(-1))
            told = self.told_ids.get(f"n{k}", np.zeros(0, np.int64))
            if k == 1:
                at, ids = number[self.tokens], np.empty(len(n), np.int64)
                ids[self.word_order[n[self.word_order] >= LEAST]] = told
                self.ids[k] = ids[kept]
            else:
                self.ids[k] = told[kept[n >= LEAST]] if len(told) else told
                at = np.full(len(self.tokens), -1, np.int32)
                at[places] = np.repeat(number, np.diff(begin, append=len(places)))
            self.levels[k] = at, keys[kept], n[kept]
        return self.levels[k]

    def at(self, k: int) -> np.ndarray:
        return self.level(k)[0]

    def context(self, j: int) -> np.ndarray:
        """The context of j words before each token, or -1. It reaches back to the end token before the text, not beyond it."""
        if j not in self.contexts:
            self.contexts[j] = out = np.r_[np.int32(-1), self.at(j)[:-1]]
            if j > 1:
                out[self.ends[:-1] + 1] = -1
        return self.contexts[j]

    def chosen(self, kind: str) -> np.ndarray:
        """The contexts that a question of this kind is about, ordered by key."""
        if kind not in self.places:
            j, n = int(kind[1:]), self.level(int(kind[1:]))[2]
            if kind[0] == "k":
                self.places[kind] = np.arange(len(n)) if j > 1 else np.argsort(self.ids[1], kind="stable")
            else:
                yes = self.known("k", j) > 0
                if kind[0] == "s":
                    yes &= self.known("g", j) == 0
                every = self.chosen(f"k{j}")
                self.places[kind] = every[yes[every]]
        return self.places[kind]

    def known(self, kind: str, j: int) -> np.ndarray:
        """The answer to a question, for every context of j words; 0 where it wasn't asked."""
        name = f"{kind}{j}"
        if name not in self.totals:
            self.totals[name] = out = np.zeros(len(self.level(j)[2]), np.int64)
            out[self.chosen(name)] = self.answers[name]
        return self.totals[name]

    def root(self, n: np.ndarray) -> np.ndarray:
        return (n + ADDED) / (self.total + ADDED * (self.distinct + 1))

    def parts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each gram of k > 1 words the numbers of its context (without the last word) and of its suffix (without the first)."""
        if k not in self.parts_of:
            at, _, n = self.level(k)
            there = np.flatnonzero(at >= 0)
            end = np.empty(len(n), np.int64)  # a token that ends the gram
            end[at[there]] = there
            self.parts_of[k] = self.context(k - 1)[end], self.at(k - 1)[end]
        return self.parts_of[k]

    def chances(self, top: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """By level: the chance of each gram's last word after the words before it (of words: the root's), and the escape of each
        context of j words up to ``top``; a context without kept transitions leaves every chance as it is."""
        chance, escape = [self.root(self.level(1)[2])], [None]
        for j in range(1, top + 1):
            size = self.level(j)[2] + PRIOR
            escape.append((size - self.known("k", j)) / size)
            context, low = self.parts(j + 1)
            chance.append(self.level(j + 1)[2] / size[context] + escape[j][context] * chance[j - 1][low])
        return chance, escape

    def gains(self, asked: list[int]) -> dict[int, np.ndarray]:
        """This slice's part of the divergences of all contexts of the levels ``asked``, less what their transitions cost, in 2^-24 nats."""
        chance, escape = self.chances(max(asked))
        out = {}
        for j in asked:
            (context, low), n, size = self.parts(j + 1), self.level(j + 1)[2], len(self.level(j)[2])
            seen = np.bincount(self.at(j + 1)[self.learnt] + 1, minlength=len(n) + 1)[1:]  # here, of each gram
            left = np.bincount(self.context(j)[self.learnt] + 1, minlength=size + 1)[1:] - np.bincount(context, seen, minlength=size)
            # a transition costs half the logarithm of the tokens, spread over its occurrences
            gain = np.log(chance[j] / chance[j - 1][low]) - 0.5 * math.log(max(self.total, 2)) / n
            gain = np.bincount(context, seen * gain, minlength=size) + left * np.log(escape[j])
            out[j] = np.rint(gain * 2**24).astype(np.int64)
        return out

    def own(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """The keys asked for, sorted (of counted grams their shards' numbers), and what this slice adds to the total of each."""
        j = int(kind[1:])
        if kind == "n1":
            sums = np.bincount(self.tokens[self.learnt], minlength=len(self.words))
            return self.words[self.word_order], sums[self.word_order]
        if kind[0] == "n":
            keys, places, begin = self.grams(j)
            return keys, np.add.reduceat(self.learnt[places], begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
        ids, context = self.level(j) and self.ids[j], self.context(j)
        if kind[0] == "k":
            sums = np.bincount(context[self.learnt & (context >= 0) & (self.at(j + 1) >= 0)], minlength=len(ids))
        elif kind[0] == "g":
            sums = self.gain[j]
        else:
            covered = np.zeros(len(context), bool)
            for i in range(j + 1, self.depth + 1):
                covered |= np.r_[self.known("g", i) > 0, False][self.context(i)]
            sums = np.zeros(len(ids), np.int64)
            sums[context[covered]] = 1
        at = self.chosen(kind)
        return ids[at], sums[at]

    def questions(self, kinds: list[str], shards: int):
        """(kind, shard, slice, keys, sums): this slice's sums, parted by the keys' shards."""
        if asked := [int(kind[1:]) for kind in kinds if kind[0] == "g"]:
            self.gain = self.gains(asked)
        for kind in kinds:
            keys, sums = self.own(kind)
            if kind[0] == "n":
                shard = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
                cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            else:
                cuts = np.searchsorted(keys, np.arange(shards + 1) << SHARD)
                keys = (keys & (1 << SHARD) - 1).view(np.uint64)
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[k], cuts[k + 1])
                yield kind, k, self.row["slice"], packed_keys(keys[part]), packed(sums[part], kind[0] == "g")

    def scores(self) -> pa.Table:
        n = self.word_n()
        root = self.root(n)
        chance, escape = self.chances(self.depth)
        logs = np.log10(root)[self.tokens]
        for j in range(1, self.depth + 1):
            states = self.known("g", j) > 0
            if j < self.depth:
                states |= self.known("s", j) > 0
            context = self.context(j)
            on = np.flatnonzero(np.r_[states, False][context])  # -1, no context or gram, takes the last entry
            gram = self.at(j + 1)[on]
            # suffixes of states are states, so a kept transition has its whole chance; others escape from level to level
            logs[on] = np.where(gram >= 0, np.r_[np.log10(chance[j]), 0][gram], np.log10(escape[j])[context[on]] + logs[on])
        begin = np.cumsum(self.sizes) - self.sizes
        add = lambda x: np.add.reduceat(x[1:], begin)
        return pa.table({
            "doc_id": pa.array(self.row["doc_id"], pa.int64()), "held_out": pa.array(self.row["held_out"], pa.bool_()),
            "n_tokens": pa.array(self.sizes, pa.int64()), "n_known": pa.array(add((n > 0).astype(np.int64)[self.tokens])),
            "train_tokens": pa.array(np.full(len(self.sizes), self.total), pa.int64()),
            "base_score": pa.array(add(np.log10(root)[self.tokens])), "score": pa.array(add(logs))})


def blocks(n: int) -> list[slice]:
    return [slice(k, min(k + BLOCK, n)) for k in range(0, n, BLOCK)]


def rounds(depth: int) -> list[list[str]]:
    """The kinds asked for in each round; each depends on earlier ones only. Every round builds the levels anew, so there are as few
    as their order allows. The first level's divergences are asked for a round before the others, so that no round sends much more than another."""
    out = [[] for _ in range(depth + 4)]
    for k in range(1, depth + 2):
        out[k - 1].append(f"n{k}")
    for j in range(1, depth + 1):
        out[j + 1].append(f"k{j}")
        out[depth + 1 + (j == depth or j > 1)].append(f"g{j}")
        if j < depth:
            out[depth + 3].append(f"s{j}")
    return [kinds for kinds in out if kinds]


ASKED = "kind string, shard int, slice long, keys binary, sums binary"
ANSWERED = "kind string, shard int, slice long, totals binary, ids binary, n long, v long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({name: pa.array(column, types[kind]) for (name, kind), column in zip(names, columns)})


def totals(asked: pa.Table, depth: int) -> pa.Table:
    """A shard's answers: each key's total (of a test: whether it is above 0), as the slices sent their keys. Grams of up to ``depth``
    words that occur ``LEAST`` times are numbered; the slices get their numbers too. The first row bears the sum of the totals and the
    number of keys above 0."""
    asked = asked.to_pydict()
    kind = asked["kind"][0]
    keys = [unpacked_keys(b) for b in asked["keys"]]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    sums, keys = np.concatenate([unpacked(b) for b in asked["sums"]]), np.concatenate(keys)
    ids = [None] * len(asked["keys"])
    if kind[0] == "n":
        keys, order = in_order(keys)
        begin = np.flatnonzero(firsts(keys))
        total, times = np.add.reduceat(sums[order], begin), np.diff(begin, append=len(order))
        every = np.empty_like(sums)
        every[order] = np.repeat(total, times)
        if int(kind[1:]) <= depth:
            number = np.empty_like(sums)
            number[order] = np.repeat(np.cumsum(total >= LEAST) - 1, times)
            ids = [packed_keys(n[t >= LEAST].view(np.uint64)) for n, t in zip(np.split(number, cuts), np.split(every, cuts))]
    else:
        keys = keys.view(np.int64)
        total = np.zeros(int(keys.max()) + 1, np.int64)
        np.add.at(total, keys, sums)
        every = ((total > 0).astype(np.int64) if kind[0] in "gs" else total)[keys]
    parts = np.split(every, cuts)
    first = [(int(total.sum()), int((total > 0).sum()))] + [(0, 0)] * (len(parts) - 1)
    return table_of([(*head, packed(part), number, *more) for *head, part, number, more
                     in zip(asked["kind"], asked["shard"], asked["slice"], parts, ids, first)], ANSWERED)


def part_of(own: pa.Table, told: pa.Table | None, kinds: list[str], model: tuple) -> Part:
    """A slice's part of the tree, given all answers to the ``kinds``; without any row an answer is empty."""
    answers, ids = {kind: [] for kind in kinds}, {kind: [] for kind in kinds}
    if told is not None:
        for kind, shard, totals, numbers in sorted(zip(*(told.column(c).to_pylist() for c in ("kind", "shard", "totals", "ids")))):
            answers[kind].append(unpacked(totals))
            if numbers is not None:
                ids[kind].append((shard << SHARD) + unpacked_keys(numbers).view(np.int64))
    joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return Part({c: own.column(c)[0].as_py() for c in own.column_names},
                *({kind: joined(parts) for kind, parts in found.items()} for found in (answers, ids)), *model)


@contextmanager
def swept(spark: SparkSession):
    """Shuffle files go when the job that made them has ended, not when the driver happens to collect its garbage: every
    round shuffles all answers once more, and its results are written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_answers(state: DataFrame, answers: list[DataFrame], told: list[str], model: tuple, run, schema: str) -> DataFrame:
    """``run`` of every slice's part of the tree."""
    def each(own: pa.Table, rows: pa.Table) -> pa.Table:
        from reviewflow.llm import suffix_tree as s
        return run(s.part_of(own, rows, told, model))

    rows = reduce(DataFrame.unionAll, [a.select("slice", "kind", "shard", "totals", "ids") for a in answers])
    return state.groupBy("slice").cogroup(rows.groupBy("slice")).applyInArrow(each, schema)


def score(docs: DataFrame, depth: int = DEPTH, share: float = SHARE, tokens: int = TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text, learnt from
    those that aren't held out; scores are base-10 logarithms of the text's probability."""
    spark = docs.sparkSession
    key = F.col(doc_id).cast("long")
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))

    def answered(asked: pa.Table) -> pa.Table:
        from reviewflow.llm import suffix_tree as s
        return s.totals(asked, depth)

    with swept(spark):
        state = written_by(slices(rows, tokens), "slice", "slices")
        number = state.count()
        shards = max(min(number, 64), math.ceil(number / 4), 1)  # of some million keys at most
        answers, told, model = [], [], (depth, share, 0, 0)
        for kinds in rounds(depth):
            asked = questions(state, answers, told, model, kinds, shards)
            answers.append(written(asked.groupBy("kind", "shard").applyInArrow(answered, ANSWERED), "answers"))
            if not told:
                sums = answers[0].agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
                model = (depth, share, sums.n or 0, sums.v or 0)
            told = told + kinds

    def run(part):
        return part.scores()

    return with_answers(state, answers, told, model, run, SCORES)


def questions(state: DataFrame, answers: list[DataFrame], told: list[str], model: tuple, kinds: list[str], shards: int) -> DataFrame:
    """What all slices ask in a round."""
    def ask(part):
        from reviewflow.llm import suffix_tree as s
        return s.table_of(list(part.questions(kinds, shards)), s.ASKED)

    if answers:
        return with_answers(state, answers, told, model, ask, ASKED)

    def run(batches):
        from reviewflow.llm import suffix_tree as s
        for batch in batches:
            for k in range(batch.num_rows):
                yield from ask(s.part_of(pa.Table.from_batches([batch.slice(k, 1)]), None, [], model)).to_batches()

    return state.mapInArrow(run, ASKED)
