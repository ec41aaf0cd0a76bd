"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are compared in a normal form: lower case, everything in ASCII but letters and
digits as one space; what is counted and edited are characters. If a region of a text is within ``k`` edits of an
item of ``m`` characters, the two share at least ``m + 1 - q * (k + 1)`` q-grams, and the alignment's diagonals
lie at most ``k`` apart. So: hash every q-gram of a text and keep those in the items' table. Then, each step
with what the one before left over:

1. in overlapping windows of the text, count each item's positions whose gram occurs (a gram that a window
   repeats counts once, so a stock phrase of many items costs its postings once a window);
2. the same lemma with short grams, which an item that shares a stock phrase only doesn't meet;
3. count the item's positions in overlapping diagonal bands (width ``2 * k``, one starting every ``k``);
4. verify the bands that meet the bound, many at once, by edit distance inside the band.

An item matches a text if some region is within ``k = share * m`` edits, lowered where the bound would vanish.

The items are a query set against all texts, in blocks of at most ``BLOCK_BYTES``: each block's
table goes to every task, each block is one pass.

Results, by case: null and empty texts match nothing; an item's null id is carried as null; null items, items without a
letter or digit and repeated item rows (same id and text) count once or not at all; items shorter than
``2 * q`` characters match exactly, as whole words; a text with several regions of an item gives the nearest one
(ties: the first, then the shortest); very long texts are hashed in pieces and matched whole; an empty table on either side
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship, written

Q = 10
SHORT_Q = 3
SHARE = 0.08
BLOCK_BYTES = 4_000_000
_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_A, _P = np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F
TABLE_BITS = 22
WINDOW = 1024  # at least; an item's longest region where that is more
POSTINGS = 2_000_000  # listed at a time
CELLS = 500_000  # of the bands that are aligned at a time
_EDIT, _FAR = np.int64(1 << 32), np.int64(1 << 60)

MATCHES = "doc_id long, item_id long, edits int, begin int, length int"


def normal(text: str) -> str:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()).decode("utf-8", "surrogatepass")


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(a: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q characters that start at each position."""
    n = len(a) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    block, width, out, held = a.astype(np.uint64), 1, None, 0
    while True:
        factor = np.uint64(pow(_P, width, 1 << 64))
        if q & width:
            size = len(a) - held - width + 1
            out = block if out is None else out[:size] * factor + block[held:held + size]
            held += width
        if 2 * width > q:
            return out[:n] * _A
        block = block[:-width] * factor + block[width:]
        width *= 2


def budget(m: int, q: int = Q, share: float = SHARE) -> int:
    """Edits allowed for an item of m characters: the share, while the lemma's bound is positive."""
    return max(0, min(int(share * m), m // q - 1))


def expanded(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices first .. first + many of every row, one after another, and their rows."""
    row = np.repeat(np.arange(len(many)), many)
    return first[row] + np.arange(len(row)) - (np.cumsum(many) - many)[row], row


class Items:
    """The q-gram tables of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, share: float = SHARE):
        self.q = q
        self.short = [(i, f" {t} ") for i, t in items if len(t) < 2 * q]
        long = [(i, t) for i, t in items if len(t) >= 2 * q]
        self.ids = [i for i, _ in long]
        self.size = size = np.array([len(t) for _, t in long], np.int64)
        self.edits = np.array([budget(m, q, share) for m in size.tolist()], np.int64)
        self.width = np.maximum(self.edits, 1)
        self.bound = size + 1 - q * (self.edits + 1)
        self.flat = characters("".join(t for _, t in long))
        self.begin = np.cumsum(size) - size
        self.window = max(WINDOW, int((size + self.edits).max(initial=0)))
        self.reach = int((size + self.edits).max(initial=0))
        # (gram, item, position) by gram, and by item and gram
        at, item = expanded(self.begin, np.maximum(size - q + 1, 0))
        hashes = grams(self.flat, q)[at]
        place = at - self.begin[item]
        self.keys, gram = np.unique(hashes, return_inverse=True)
        pairs, times = np.unique(gram * max(len(long), 1) + item, return_counts=True)
        self.post_item, self.post_times = pairs % max(len(long), 1), times
        edge = np.searchsorted(pairs // max(len(long), 1), np.arange(len(self.keys) + 1))
        self.post_first, self.post_many = edge[:-1], np.diff(edge)
        order = np.lexsort((place, gram, item))
        self.own_gram, self.own_place = gram[order], place[order]
        self.own_edge = np.searchsorted(item[order], np.arange(len(long) + 1))
        # short grams of every item, as 16-bit numbers
        at, item = expanded(self.begin, size - SHORT_Q + 1)
        self.small = (grams(self.flat, SHORT_Q)[at] >> np.uint64(48)).astype(np.int64)
        self.small_first, self.small_many = np.cumsum(size - SHORT_Q + 1) - (size - SHORT_Q + 1), size - SHORT_Q + 1
        self.small_bound = size + 1 - SHORT_Q * (self.edits + 1)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item id, edits, begin, length) of the items in each normal text."""
        out = []
        for k, t in enumerate(texts):
            for i, s in self.short:
                at = f" {t} ".find(s)
                if at >= 0:
                    out.append((k, i, 0, at, len(s) - 2))
        if not len(self.keys):
            return out
        length = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(length + self.q) - length - self.q
        gap = "\0" * self.q  # no q-gram of an item holds a zero
        flat = characters(gap.join(texts) + gap)
        pos, gram = self.shared(flat)
        regions = [self.bands(w, i, pos, gram, begin, length) for w, i in self.candidates(flat, pos, gram)]
        if not regions:
            return out
        found = np.unique(np.concatenate(regions), axis=0)  # (item, text, band)
        if len(found):
            item, doc = found[:, 0], found[:, 1]
            edits, first, size = self.align(flat, item, found[:, 2] * self.width[item], begin[doc], length[doc])
            best: dict = {}
            for d, i, *hit in zip(doc.tolist(), item.tolist(), edits.tolist(), first.tolist(), size.tolist()):
                if hit[0] >= 0 and ((d, i) not in best or hit < best[d, i]):
                    best[d, i] = hit
            out += [(d, self.ids[i], *hit) for (d, i), hit in sorted(best.items())]
        return out

    def shared(self, flat: np.ndarray, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the text whose gram some item has, in order, with the gram's number."""
        places, numbers = [], []
        for a in range(0, len(flat), piece):
            h = grams(flat[a:a + piece + self.q - 1], self.q)
            pos = np.flatnonzero(self.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, h[pos]), len(self.keys) - 1)
            known = self.keys[at] == h[pos]
            places.append(pos[known] + a)
            numbers.append(at[known])
        return np.concatenate(places), np.concatenate(numbers)

    def candidates(self, flat: np.ndarray, pos: np.ndarray, gram: np.ndarray):
        """(window, item) pairs that meet the lemma's bound with both lengths of grams. Window w
        holds the positions from w * window on, as many more as the longest region needs."""
        w = pos // self.window
        also = (pos % self.window < self.reach) & (w > 0)
        n = len(self.keys)
        cells = np.unique(np.concatenate([w * n + gram, (w[also] - 1) * n + gram[also]]))
        w, gram = cells // n, cells % n
        listed = np.cumsum(self.post_many[gram])
        edges = np.flatnonzero(np.r_[True, w[1:] != w[:-1], True]) if len(w) else np.zeros(1, np.int64)
        at = 0
        while at < len(edges) - 1:
            # whole windows, as many as make up POSTINGS; at least one
            start = edges[at]
            before = listed[start - 1] if start else 0
            stop = max(at + 1, int(np.searchsorted(listed[edges[at + 1:] - 1], before + POSTINGS, "right")) + at)
            yield from self._counted(flat, w[start:edges[stop]], gram[start:edges[stop]])
            at = stop

    def _counted(self, flat, w, gram):
        items = len(self.ids)
        if w[0] == w[-1]:  # one window, however many postings it has
            count = np.zeros(items, np.int64)
            for a in range(0, len(gram), 256):
                entry, _ = expanded(self.post_first[gram[a:a + 256]], self.post_many[gram[a:a + 256]])
                count += np.bincount(self.post_item[entry], self.post_times[entry], items).astype(np.int64)
            item = np.flatnonzero(count >= self.bound)
            window = np.full(len(item), w[0])
        else:
            entry, row = expanded(self.post_first[gram], self.post_many[gram])
            cells, back = np.unique(w[row] * items + self.post_item[entry], return_inverse=True)
            enough = np.bincount(back, self.post_times[entry]) >= self.bound[cells % items]
            window, item = cells[enough] // items, cells[enough] % items
        edges = np.flatnonzero(np.r_[True, window[1:] != window[:-1], True]) if len(window) else ()
        for a, b in zip(edges[:-1], edges[1:]):
            start = int(window[a]) * self.window
            seen = np.zeros(1 << 16, bool)
            seen[(grams(flat[start:start + self.window + self.reach], SHORT_Q) >> np.uint64(48)).astype(np.int64)] = True
            for c in range(a, b, 10_000):
                some = item[c:min(c + 10_000, b)]
                entry, row = expanded(self.small_first[some], self.small_many[some])
                met = np.bincount(row, seen[self.small[entry]], len(some)) >= self.small_bound[some]
                for i in some[met].tolist():
                    yield int(window[a]), i

    def bands(self, w: int, i: int, pos: np.ndarray, gram: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(item, text, band) rows of the bands in window w that hold enough of the item's positions."""
        width, start = int(self.width[i]), w * self.window
        a, b = np.searchsorted(pos, (start, start + self.window + self.reach))
        own = slice(self.own_edge[i], self.own_edge[i + 1])
        low, high = (np.searchsorted(self.own_gram[own], gram[a:b], side) for side in ("left", "right"))
        if (high - low).sum() > POSTINGS:
            # item and text repeat themselves: every band of the window's texts is aligned
            first, last = (int(np.searchsorted(begin, x, "right")) - 1 for x in (start, start + self.window + self.reach))
            rows = []
            for d in range(max(first, 0), last + 1):
                lowest = max(start - int(begin[d]), 0) - int(self.size[i])
                highest = min(start + self.window + self.reach - int(begin[d]), int(length[d]))
                rows += [(i, d, k) for k in range(lowest // width - 1, highest // width + 1)]
            return np.array(rows, np.int64).reshape(-1, 3)
        entry, row = expanded(low, high - low)
        place, p = self.own_place[own][entry], pos[a:b][row]
        doc = np.searchsorted(begin, p, "right") - 1
        band = (p - begin[doc] - place) // width
        rows = np.stack([np.r_[doc, doc], np.r_[band, band - 1], np.r_[place, place]], 1)
        rows = np.unique(rows, axis=0)  # a position of the item counts once in a band
        cells, count = np.unique(rows[:, :2], axis=0, return_counts=True)
        cells = cells[count >= self.bound[i]]
        return np.column_stack([np.full(len(cells), i), cells])

    def align(self, flat: np.ndarray, item: np.ndarray, low: np.ndarray, begin: np.ndarray, length: np.ndarray):
        """Least (edits, begin, length) of each item against the text at ``begin`` with the diagonals
        low .. low + 2 * width; edits -1 where its budget is exceeded."""
        out = np.full((3, len(item)), -1, np.int64)
        order = np.lexsort((self.size[item], self.width[item]))
        at = 0
        while at < len(order):
            width = int(self.width[item[order[at]]])
            same = int(np.searchsorted(self.width[item[order]], width, "right"))
            stop = min(same, at + max(CELLS // (2 * width), 1))
            rows = order[at:stop]
            at = stop
            self._aligned(flat, rows, item[rows], low[rows], begin[rows], length[rows], 2 * width, out)
        return out

    def _aligned(self, flat, rows, item, low, begin, length, band, out):
        steps = np.arange(band)
        run = steps * _EDIT  # insertions run along the text
        j = low[:, None] + steps  # characters of the text before each cell; a path starts anywhere
        v = np.where((j >= 0) & (j <= length[:, None]), j, _FAR)  # edits, then where the path began
        i = 0
        while len(rows):
            ended = self.size[item] == i
            if ended.any() or i % 8 == 0:
                least = v.min(1)
                good = least < (self.edits[item] + 1) * _EDIT
                done = ended & good
                first = least[done] % _EDIT
                out[0, rows[done]], out[1, rows[done]] = least[done] // _EDIT, first
                out[2, rows[done]] = low[done] + i + v[done].argmin(1) - first
                keep = good & ~ended
                rows, item, low, begin, length, v = (x[keep] for x in (rows, item, low, begin, length, v))
                if not len(rows):
                    return
            j = low[:, None] + (i + steps)
            said = flat[np.clip(begin[:, None] + j, 0, len(flat) - 1)]
            new = v + (said != self.flat[self.begin[item] + i][:, None]) * _EDIT
            np.minimum(new[:, :-1], v[:, 1:] + _EDIT, out=new[:, :-1])
            outside = (j < -1) | (j >= length[:, None])
            new[outside] = _FAR
            v = np.minimum.accumulate(new - run, 1) + run
            v[outside] = _FAR
            i += 1


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items in normal form, in lists of bounded size."""
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null").distinct().orderBy("i", "t")
    block, held = [], 0
    for r in rows.toLocalIterator():
        t = normal(r.t)
        if not t:
            continue
        if block and held + len(t) > block_bytes:
            yield block
            block, held = [], 0
        block.append((r.i, t))
        held += len(t)
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", q: int = Q, share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, begin, length): a row for each text and item that match;
    begin and length are characters of the text's normal form."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    out = None
    for block in item_blocks(items, item_id, item_text, block_bytes):
        found = source.mapInArrow(_finder(spark.sparkContext.broadcast(block), q, share), MATCHES)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCHES) if out is None else out


def _finder(block, q: int, share: float):
    def run(batches):
        from reviewflow.llm import decontaminate, runtime
        items = decontaminate.Items(block.value, q, share)
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "text", chars=1_000_000):
                rows = items.matches([decontaminate.normal(t) for t in texts])
                if rows:
                    k = pa.array([r[0] for r in rows])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(k), pa.array([r[1] for r in rows], pa.int64()),
                         *(pa.array([r[c] for r in rows], pa.int32()) for c in (2, 3, 4))],
                        names=["doc_id", "item_id", "edits", "begin", "length"])
    return run


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          q: int = Q, share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, unchanged."""
    spark = docs.sparkSession
    ship(spark)
    out = docs
    for block in item_blocks(items, item_id, item_text, block_bytes):
        out = out.mapInArrow(_filter(spark.sparkContext.broadcast(block), text, q, share), docs.schema)
    return out


def _filter(block, text: str, q: int, share: float):
    def run(batches):
        from reviewflow.llm import decontaminate, runtime
        items = decontaminate.Items(block.value, q, share)
        for batch in batches:
            for part, texts in runtime.text_slices(batch, text, chars=1_000_000):
                bad = {r[0] for r in items.matches([decontaminate.normal(t) for t in texts])}
                yield part.filter(pa.array([k not in bad for k in range(part.num_rows)], pa.bool_())) if bad else part
    return run
