"""Near-duplicate groups against brute force."""

import random

import numpy as np
import pytest

from reviewflow.llm import components, minhash


def sets_of(text, words=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute_force(rows, words=4, percent=80):
    ids = sorted({d for d, _ in rows if d is not None})
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    named = [(d, sets_of(t, words)) for d, t in rows if d is not None]
    for a in range(len(named)):
        for b in range(a):
            (x, s), (y, t) = named[a], named[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    return {(d, len(s), find(d), find(d) == d) for d, s in named}


def corpus(rng, groups=25):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    common = [word() for _ in range(12)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(3, 150))]
        if rng.random() < 0.4:
            base = common + base
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            texts.append((" \n"[rng.random() < 0.1]).join(copy))
    texts += [None, "", " \t\n", "One two", "one  TWO", "one two three", "x\x1cy z\x85w é É q r"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def result(df):
    return {tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()}


def test_matches_brute_force(spark):
    rows = corpus(random.Random(1))
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, component_id int, sketch int").repartition(3)
    assert result(minhash.groups(df)) == brute_force(rows)


def test_large_nodes_and_large_groups(spark, monkeypatch):
    """Small bounds take every path: pivots, branches, blocks, split groups."""
    for name, value in (("NODE", 6), ("BLOCK", 5), ("DEPTH", 1), ("PIVOTS", 2)):
        monkeypatch.setattr(minhash, name, value)
    rng = random.Random(7)
    rows = corpus(rng, 8)
    base = [f"w{k}" for k in range(90)]
    for k in range(25):  # a chain-like group around one text
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(90)] = f"v{rng.random()}"
        rows.append((1000 + k, " ".join(copy)))
    assert result(minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)


def test_rows_that_go_on_are_joined_once(spark, monkeypatch):
    """What reads the rows of large nodes reads a table: none of its plans runs their joins again."""
    for name, value in (("NODE", 6), ("DEPTH", 0)):
        monkeypatch.setattr(minhash, name, value)
    plans, compare = [], minhash.compare_nodes

    def seen(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return compare(rows)

    monkeypatch.setattr(minhash, "compare_nodes", seen)
    rng = random.Random(6)
    rows = [(k, "the same opening " + " ".join(rng.choice("abcdefgh") * 3 for _ in range(4 + k % 5)) + f" {k % 30}") for k in range(90)]
    assert result(minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)
    assert len(plans) > 1 and not any("Join" in p for p in plans)


def test_repeated_and_null_ids(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(5, long), (5, long), (3, "other words are in here"), (5, "other words are in here"), (None, long), (9, long + " more")]
    got = result(minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {(5, 37, 3, False), (5, 2, 3, False), (3, 2, 3, True), (None, 37, None, True), (9, 38, 3, False)}


def test_keep_one(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(5, long, "a"), (5, long, "a"), (4, long, "b"), (7, "alone", "c"), (None, long, "d"), (8, None, "e"), (7, "alone", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    kept = minhash.keep_one(df, words=5)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.where("doc_id is null or doc_id in (4, 8)").unionByName(
        df.where("doc_id = 7").limit(1)).collect())


def test_empty_table(spark):
    assert minhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(k, k + 1) for k in range(100, 130)] + [(3, 3), (None, 4)]
    parent = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


@pytest.mark.parametrize("words", [4, 5])
def test_shingle_sets(words):
    texts = [t or "" for _, t in corpus(random.Random(3))]
    got = minhash.shingle_sets(texts, words)
    assert [len(g) for g in got] == [len(sets_of(t, words)) for t in texts]
    for a in range(0, len(texts), 5):
        for b in range(a):
            assert len(np.intersect1d(got[a], got[b])) == len(sets_of(texts[a], words) & sets_of(texts[b], words))


@pytest.mark.parametrize("width", [4, 5])
def test_slices_of_few_words(width):
    """A slice may hold fewer words than a shingle."""
    for n in range(5):
        text = " ".join("abcd"[:n])
        got = minhash.shingle_sets([text], width)
        among = minhash.shingle_sets([text, "some more words that come after it"], width)
        assert len(got) == 1 and len(got[0]) == min(n, 1) and got[0].tolist() == among[0].tolist()


def test_table_of_few_words(spark):
    for text in ("a", "a b", "a b c", "a b c d"):
        assert result(minhash.groups(spark.createDataFrame([(1, text)], "doc_id long, text string"))) == {(1, 1, 1, True)}


def test_recall_of_planted_pairs_in_a_hot_group(spark, monkeypatch):
    """Pairs at 0.80 to 0.85 among texts that all share a third of their shingles, with nodes far above the
    bound, so that trees branch to their depth: at least 99 % share a candidate component."""
    monkeypatch.setattr(minhash, "NODE", 60)
    rng = np.random.default_rng(8)
    common = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets, pairs = [], []
    for k in range(400):
        own = rng.integers(0, 2**63, 120, dtype=np.uint64)
        n = int(rng.integers(15, 20))
        changed = own.copy()
        changed[:n] = rng.integers(0, 2**63, n, dtype=np.uint64)
        pairs.append((len(sets), len(sets) + 1))
        sets += [np.unique(np.r_[common, own]), np.unique(np.r_[common, changed])]
    close = [len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in pairs]
    assert 0.79 < min(close) and max(close) < 0.86
    low = minhash.minwise(sets)
    tokens = low[:, :minhash.TREES].view(np.int64).tolist()
    sketches = (low >> np.uint64(20)).astype("<u2")
    reps = spark.createDataFrame([(k, tokens[k], bytearray(sketches[k].tobytes())) for k in range(len(sets))],
                                 "doc_id long, tokens array<long>, sketch binary")
    part = {r.node: r.component for r in components.connected(minhash.candidate_links(reps)).collect()}
    found = [part.get(a) is not None and part.get(a) == part.get(b) for a, b in pairs]
    assert np.mean(found) >= 0.99
    assert max(np.unique(list(part.values()), return_counts=True)[1]) < 40  # and the group itself isn't one component


def test_contraction_in_several_tasks(spark, monkeypatch):
    """Cells smaller than the edge table: contracted in tasks, joined by star steps."""
    monkeypatch.setattr(components, "CELL", 40)
    rng = random.Random(3)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(60)] + [(k, k + 1) for k in range(1000, 1200)] + [(5, 5), (7, None)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    got = {r.node: r.component for r in components.connected(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}
