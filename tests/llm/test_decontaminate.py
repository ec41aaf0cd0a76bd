"""Decontamination against a plain edit distance over every region."""

import random

from reviewflow.llm import decontaminate as dc


def nearest(item: str, text: str) -> tuple[int, int, int]:
    """Least (edits, begin, length) of the item in the text."""
    edit = 1 << 20  # a path is its edits and its begin in one number
    row = list(range(len(text) + 1))
    for x in item:
        new = [row[0] + edit]
        for y, here, after in zip(text, row, row[1:]):
            new.append(min(min(after, new[-1]) + edit, here if x == y else here + edit))
        row = new
    best = min(row)
    return best // edit, best % edit, row.index(best) - best % edit


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(n))


def edited(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        at, what = rng.randrange(len(t)), rng.random()
        if what < 0.4:
            t[at] = rng.choice("abcd")
        elif what < 0.7:
            del t[at]
        else:
            t.insert(at, rng.choice("abcd"))
    return "".join(t)


def case(rng):
    items = [(k, words(rng, rng.randint(6, 50))) for k in range(12)]
    docs = []
    for k in range(40):
        t = words(rng, rng.randint(0, 60))
        if rng.random() < 0.7:
            i, s = rng.choice(items)
            planted = edited(rng, s.upper() if rng.random() < 0.3 else s, rng.randint(0, max(1, len(s) // 9)))
            t = f"{t} {planted}. {words(rng, rng.randint(0, 30))}"
        docs.append((k, t))
    return items, docs


def expected(items, docs):
    out = set()
    for d, t in docs:
        n = dc.normal(t)
        for i, s in items:
            m = dc.normal(s)
            if len(m) < 2 * dc.Q:
                if f" {m} " in f" {n} ":
                    out.add((d, i, 0, f" {n} ".index(f" {m} "), len(m)))
            elif (found := nearest(m, n))[0] <= dc.budget(len(m)):
                out.add((d, i, *found))
    return out


def test_matches_brute_force(spark):
    for seed in (1, 2):
        items, docs = case(random.Random(seed))
        want = expected(items, docs)
        assert len(want) > 5
        frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        assert {tuple(r) for r in dc.matches(*frames).collect()} == want
        assert {tuple(r) for r in dc.matches(*frames, block_bytes=200).collect()} == want  # many blocks
        kept = {r.doc_id for r in dc.clean(*frames, block_bytes=200).collect()}
        assert kept == {d for d, _ in docs} - {w[0] for w in want}


def test_small_steps_match_brute_force(monkeypatch):
    # windows, lists and batches far below their usual sizes; repeats that fill a band's lists
    monkeypatch.setattr(dc, "WINDOW", 64)
    monkeypatch.setattr(dc, "POSTINGS", 300)
    monkeypatch.setattr(dc, "CELLS", 40)
    for seed in (5, 6):
        items, docs = case(random.Random(seed))
        items += [(20, "abc " * 15), (21, "d" * 70), (22, "no " * 40)]
        docs += [(50, "abc " * 40), (51, "x" + "d" * 66 + "x" + "d" * 90), (52, "no " * 30 + "on " * 12)]
        block = dc.Items([(i, dc.normal(t)) for i, t in items])
        assert set(block.matches([dc.normal(t) for _, t in docs])) == {
            ([d for d, _ in docs].index(m[0]), *m[1:]) for m in expected(items, docs)}


def test_stock_phrase_of_many_items(monkeypatch):
    rng = random.Random(3)
    phrase = "which of the following statements is correct "
    items = [(k, dc.normal(phrase + words(rng, 25))) for k in range(3000)]
    block = dc.Items(items)
    aligned = []
    plain = dc.Items.align
    monkeypatch.setattr(dc.Items, "align", lambda self, flat, item, *rest: aligned.append(len(item)) or plain(self, flat, item, *rest))
    text = dc.normal(phrase * 50)
    assert block.matches([text]) == [] and sum(aligned) == 0
    got = block.matches([f"{text} {items[7][1]} {text}", text])
    assert got == [(0, 7, 0, len(text) + 1, len(items[7][1]))] and sum(aligned) < 50


def test_alignment_stays_in_its_band():
    block = dc.Items([(1, "the quick brown fox jumps over the lazy dog again")])
    m, w = int(block.size[0]), int(block.width[0])
    flat = dc.characters("x" * 40 + "the quick brown fox jumps over the lazy dog again" + "y" * 40)
    for low in range(-m, 100):
        got = [int(x[0]) for x in block.align(flat, *(dc.np.array([x]) for x in (0, low, 0, len(flat))))]
        if low <= 40 < low + 2 * w:
            assert got == [0, 40, m]
        elif 40 < low - w or 40 >= low + 3 * w:
            assert got[0] == -1


def test_long_texts(spark):
    rng = random.Random(4)
    item = words(rng, 30)
    far = words(rng, 40_000)
    assert len(far) > 150_000
    docs = spark.createDataFrame([(1, far + " " + item), (2, far), (3, "a" * 200_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "a" * 60)], "item_id long, text string")
    got = sorted(tuple(r) for r in dc.matches(docs, items).collect())
    assert got == [(1, 1, 0, len(dc.normal(far)) + 1, len(dc.normal(item))), (3, 2, 0, 0, 60)]


def test_edge_cases(spark):
    item = "a passage of many words that nobody writes twice by chance"
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, f"before {item.upper()}! after " * 3, 7), (None, item, 7),
                                  (4, "tiny", 7), (4, "tiny", 7)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "?!"), (4, "Tiny!"), (None, "unseen words are these and more")],
                                  "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.edits) for r in dc.matches(docs, items).collect())
    assert got == [("3", 1, 0), ("4", 4, 0), ("4", 4, 0), ("None", 1, 0)]
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    none = items.where("false")
    assert dc.matches(docs, none).count() == 0 and dc.clean(docs, none).count() == 6
    assert dc.matches(docs.where("false"), items).count() == 0


def test_registered_query_finds_all_verbatim_items(spark):
    from reviewflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, d).collect()}
    assert got >= {(k, i) for k, t in docs for i, s in items if s in t}
