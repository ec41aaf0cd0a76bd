import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewflow.llm import suffix_tree as st

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def brute(rows, depth, share):
    """The docstring's model with dictionaries over word tuples; contexts begin at the end token before a text."""
    texts = [(i, ["$", *words(t), "$"]) for i, t in rows]
    n = collections.Counter(w for i, t in texts if not is_held(i) for w in t[1:])
    total, distinct = sum(n.values()), len(n)
    least = max(2, math.ceil(share * total))
    levels = [{(w,): c for w, c in n.items() if c >= least}]
    for k in range(2, depth + 2):
        found = collections.Counter(tuple(t[j - k + 1:j + 1]) for i, t in texts if not is_held(i) for j in range(k - 1, len(t)))
        levels.append({g: c for g, c in found.items() if c >= least})
    root = lambda w: (n[w] + st.ADDED) / (total + st.ADDED * (distinct + 1))
    count = {g: c for level in levels for g, c in level.items()}
    after = collections.defaultdict(list)
    for g in count:
        if len(g) > 1:
            after[g[:-1]].append(g[-1])

    def escape(s):
        kept = sum(count[s + (t,)] for t in after[s])
        return (count[s] - kept + st.PRIOR) / (count[s] + st.PRIOR)

    def chance(s, t):
        if not s:
            return root(t)
        seen = count[s + (t,)] / (count[s] + st.PRIOR) if s + (t,) in count else 0
        return seen + escape(s) * chance(s[1:], t)
    stays = set()
    for s in after:
        gain = sum(count[s + (t,)] * math.log(chance(s, t) / chance(s[1:], t)) for t in after[s])
        gain += (count[s] - sum(count[s + (t,)] for t in after[s])) * math.log(escape(s))
        if gain > 0.5 * math.log(max(total, 2)) * len(after[s]):
            stays |= {s[j:] for j in range(len(s))}
    out = []
    for i, t in texts:
        base = score = 0
        for j in range(1, len(t)):
            base += math.log10(root(t[j]))
            state = max((tuple(t[a:j]) for a in range(max(0, j - depth), j) if tuple(t[a:j]) in stays), key=len, default=())
            score += math.log10(chance(state, t[j]))
        out.append((i, is_held(i), len(t) - 1, sum(n[w] > 0 for w in t[1:]), total, base, score))
    return out, stays


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-9)


def corpus(n=300):
    rng = random.Random(9)
    phrases = ["the cat sat on the mat .", "a dog ran in the Park", "the end of the day", "once upon a time the cat ran"]
    rows = []
    for i in range(n):
        said = []
        for _ in range(rng.randint(0, 12)):
            said.append(rng.choice(phrases) if rng.random() < .6 else " ".join(rng.choice(["the", "cat", "Éa", "x", f"w{rng.randint(0, 99)}"]) for _ in range(4)))
        rows.append((i, rng.choice([" ", "\n", "\t \v"]).join(said)))
    return rows + [(None, "the cat sat"), (1000, None), (1001, ""), (1002, " \n"), (5, "the mat"), (5, "the mat")]


def test_against_brute_force(spark):
    rows = corpus()
    for tokens in (10**6, 300):
        got = st.score(spark.createDataFrame(rows, SCHEMA).repartition(3), share=2e-3, tokens=tokens).collect()
        want, stays = brute(rows, st.DEPTH, 2e-3)
        same(got, want)
    assert {len(s) for s in stays} == {1, 2, 3}
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than words alone on unseen texts


def test_states_are_distributions():
    rows = corpus(80)
    _, stays = brute(rows, 2, 1e-3)
    assert stays
    texts = [t for _, t in rows]
    hashes, sizes = st.text_tokens([t or "" for t in texts])
    assert sizes.tolist() == [len(words(t)) + 1 for t in texts]
    vocabulary, counts = np.unique(hashes, return_counts=True)
    tree = st.Tree(vocabulary, counts)
    pairs = collections.Counter(zip(hashes[:-1].tolist(), hashes[1:].tolist()))
    at = {h: k for k, h in enumerate(vocabulary.tolist())}
    kept = sorted((at[a] * len(at) + at[b], at[b], n) for (a, b), n in pairs.items() if n > 1)
    tree.add(*(np.array(x) for x in zip(*kept)))
    tree.choose(int(counts.sum()), len(vocabulary))
    root = (counts + st.ADDED) / (counts.sum() + st.ADDED * (len(counts) + 1))
    unseen = st.ADDED / (counts.sum() + st.ADDED * (len(counts) + 1))
    assert abs(root.sum() + unseen - 1) < 1e-12
    shares = np.bincount(tree.keys[1] // len(at), tree.share[1], minlength=len(at))
    assert np.abs(shares + tree.escape[0] - 1)[counts > 1].max() < 1e-12


def test_edges(spark):
    assert st.score(spark.createDataFrame([], SCHEMA)).collect() == []
    held = next(i for i in range(100) if is_held(i))
    rows = [(held, "only held out")]  # nothing to learn from: every probability is 1
    same(st.score(spark.createDataFrame(rows, SCHEMA)).collect(), [(held, True, 4, 0, 0, 0.0, 0.0)])
    clash = spark.createDataFrame([(1, "a b a b", 1, 2)], SCHEMA + ", score int, Slice int")
    assert st.score(clash).count() == 1


def test_long_texts(spark, monkeypatch):
    long = " ".join(f"word{k % 5000}" for k in range(700_000)) + " " + "x" * 2_500_000 + " tail"
    assert len(long) > 3 * st.PIECE
    pieces, sizes = st.text_tokens([long, "a b", ""])
    monkeypatch.setattr(st, "PIECE", 1 << 40)
    at_once, same_sizes = st.text_tokens([long, "a b", ""])
    assert sizes.tolist() == same_sizes.tolist() == [700_003, 3, 1] and (pieces == at_once).all()


def test_rare_contexts_of_a_large_corpus(spark):
    """What occurs twice among 200,000 tokens is below 1e-5 of them, and still a state."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randint(0, 2999)}" for _ in range(100))) for i in range(2400)]
    said = [" ".join(f"w{rng.randint(0, 2999)}" for _ in range(100)) for _ in range(6)]
    rows += [(10_000 + 10 * k + j, t) for k, t in enumerate(said) for j in (1, 2)]
    want, stays = brute(rows, st.DEPTH, 0)
    assert want[0][4] > 200_000 and stays
    got = st.score(spark.createDataFrame(rows, SCHEMA).repartition(4), tokens=40_000).collect()
    same(got, want)
    twice = [k for k in range(len(said)) if not any(is_held(10_000 + 10 * k + j) for j in (1, 2))]
    by = {r.doc_id: (r.score - r.base_score) / r.n_tokens for r in got}
    assert twice and min(by[10_000 + 10 * k + 1] for k in twice) > 1 > 0.2 > sum(by[i] for i in range(2400)) / 2400


def test_order_of_hashes():
    rng = np.random.default_rng(3)
    for h in (rng.integers(0, 2**64, 5000, np.uint64, endpoint=False), rng.integers(0, 50, 5000).astype(np.uint64), np.zeros(0, np.uint64), np.arange(9, dtype=np.uint64)[::-1].copy()):
        keys, place = st.different(h)
        want, at = np.unique(h, return_inverse=True)
        assert (keys == want).all() and (place == at).all()
        assert (st.unpacked_keys(st.packed_keys(keys)) == keys).all() and (st.unpacked(st.packed(place)) == place).all()
    assert (st.unpacked(st.packed(np.array([-1, 0, 2**40]))) == [-1, 0, 2**40]).all()


def test_rounds_leave_the_slices_where_they_are(spark):
    """Levels are built in seven rounds, no kind before those it needs, and only answers are shuffled to the slices."""
    for depth in (1, 2, 3, 4):
        at = {kind: k for k, kinds in enumerate(st.rounds(depth)) for kind in kinds}
        assert len(at) == (depth + 1) + depth + depth + (depth - 1) and at["n1"] == 0
        for j in range(1, depth + 1):
            assert at[f"n{j}"] < at[f"n{j + 1}"] < at[f"k{j}"] < at[f"g{j}"]
            assert all(at[f"k{i}"] < at[f"g{j}"] for i in range(1, j)) and (j == depth or max(at[f"g{i}"] for i in range(j, depth + 1)) < at[f"s{j}"])
    assert len(st.rounds(3)) == 7
    before = {t.name for t in spark.catalog.listTables()}
    got = st.score(spark.createDataFrame(corpus(40), SCHEMA).repartition(3), tokens=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == before
    same(got.collect(), brute(corpus(40), st.DEPTH, 0)[0])


def test_small_negative_sums_are_packed_small():
    a = np.array([-3, 0, 100, -128, 127])
    assert st.packed(a, True)[0] & 15 == 1 and (st.unpacked(st.packed(a, True)) == a).all()
    far = np.array([-2**62, 2**62, -1])
    assert (st.unpacked(st.packed(far, True)) == far).all() and len(st.unpacked(st.packed(a[:0], True))) == 0


def test_counted_grams_are_asked_for_by_number():
    """A gram's hash is sent to be counted; whatever is asked about it later goes by its number in the shard."""
    rows = [r for r in corpus() if r[0] is not None]
    owns = []
    for k in range(2):
        part = rows[k::2]
        h, sizes = st.text_tokens([t or "" for _, t in part])
        words, place = st.different(np.concatenate([np.array([st.END]), h]))
        owns.append(pa.table({
            "slice": pa.array([k]), "doc_id": pa.array([[i for i, _ in part]]), "held_out": pa.array([[is_held(i) for i, _ in part]]), "sizes": pa.array([st.packed(sizes)]),
            "words": pa.array([words.tobytes()]), "tokens": pa.array([st.packed(place)])}))
    depth, shards, told, model, answers, kept = 3, 5, [], (3, 0.0, 0, 0), [None, None], {}
    for kinds in st.rounds(depth):
        asked = collections.defaultdict(list)
        for own, answer in zip(owns, answers):
            for q in st.part_of(own, answer, told, model).questions(kinds, shards):
                asked[q[:2]].append(q)
                if q[0][0] != "n":
                    keys = st.unpacked_keys(q[3])
                    assert (np.diff(keys.view(np.int64)) > 0).all() and keys.max() < kept["n" + q[0][1:], q[1]]
        found = pa.concat_tables(st.totals(st.table_of(qs, st.ASKED), depth) for qs in asked.values())
        for kind, shard, ids in zip(*(found.column(c).to_pylist() for c in ("kind", "shard", "ids"))):
            assert (ids is not None) == (kind in ("n1", "n2", "n3"))
            if ids is not None and len(numbers := st.unpacked_keys(ids)):
                kept[kind, shard] = max(kept.get((kind, shard), 0), int(numbers.max()) + 1)
        if not told:
            model = (depth, 0.0, sum(found.column("n").to_pylist()), sum(found.column("v").to_pylist()))
        told = told + kinds
        answers = [pa.concat_tables([*([a] if a else []), found.filter(pc.equal(found["slice"], k))]) for k, a in enumerate(answers)]
    assert kept
    last = [st.part_of(own, a, told, model) for own, a in zip(owns, answers)]
    got = [tuple(r.values()) for part in last for r in part.scores().to_pylist()]
    same(got, brute(rows, depth, 0)[0])
