import hashlib
import itertools
import random
import re
import zlib
from heapq import heappop, heappush

from reviewflow.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract read literally: faults, then a search over (rows done, role initials so far by state)
    with insertions at any place."""
    seen, facts = set(), []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        facts.append((role, text, fault))
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, said = heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))

        def put(weight, letter, step, new, turn):
            heappush(heap, (cost + weight, audit + letter, i + step, new, said + ((turn,) if turn is not None else ())))
        for name in ("user", "assistant"):
            if name[0] in grammar[last]:
                put(2, "I", 0, name[0], name + ":")
        if i < len(rows):
            role, text, fault = facts[i]
            put(3, "D", 1, last, None)
            if fault in (None, "truncated"):
                more = fault == "truncated"
                if role[:1] and role[:1] in grammar[last]:
                    put(more, "K", 1, role[:1], f"{role}:{text}")
                for name in ("user", "assistant"):
                    if name[0] in grammar[last]:
                        put(2 + more, "R", 1, name[0], f"{name}:{text}")
    return (*counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(), said)


def test_every_short_sequence():
    """All code sequences up to five rows, against a search with free insertions."""
    text = {"s": "ok.", "u": "ok.", "a": "ok.", "x": "ok.", "S": "cut", "U": "cut", "A": "cut", "X": "cut", "d": " "}
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    for n in range(6):
        for codes in itertools.product("suaxSUXd" if n < 5 else "suxUd", repeat=n):
            rows = [(role[c.lower()], f"{k} {text[c]}" if c != "d" else " ") for k, c in enumerate(codes)]
            cost, _, tail = cr.whole(*cr.row_derivations("".join(codes)))
            costs, audits = cr.row_derivations("".join(codes))
            goal = min((costs[q] + cr.TAIL[q][0], audits[q] + cr.TAIL[q][1]) for q in cr.STATES if audits[q] is not None)
            want = brute(rows)
            assert goal == (want[4], want[5]), codes
            assert cost == want[4] and goal[1].endswith(tail)


def test_composition_equals_one_agenda():
    rng = random.Random(3)
    for _ in range(200):
        codes = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(1, 40)))
        cuts = sorted(rng.sample(range(len(codes) + 1), min(4, len(codes))))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        own = [cr.row_derivations(p) for p in parts]
        costs, ways = cr.derivations([cr.piece_moves(*m) for m in own])
        whole_costs, whole_audits = cr.row_derivations(codes)
        assert costs == whole_costs
        for at, way in enumerate(ways):
            if way is not None:
                p, audit = at // 4, ""
                for letter, (_, audits) in zip(way, own):
                    q = (ord(letter) - 48) % 4
                    audit += audits[4 * p + q]
                    p = q
                assert audit == whole_audits[at]


def expected(turns):
    """Damage, order and repair of a list of rows (conv_id, turn, role, text), in plain Python."""
    said = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in turns:
        own = out.setdefault(conv, [])
        role, text = said(role), said(text)
        salt = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        if salt == 1:
            text = ""
        if salt == 2:
            text = re.sub("[.!?]", "", text)
        if salt == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if salt == 0 else 2 if salt == 3 else 1)
    answer = {}
    for conv, own in out.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        answer[conv] = (gaps, *brute([r[1:] for r in own])[:7])
    return answer


def repaired(spark, turns, schema=SCHEMA):
    df = spark.createDataFrame(turns, schema)
    return {r[0]: tuple(r[1:]) for r in cr.repair(cr.damaged(df), df).collect()}




def test_against_brute_force(spark):
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", None, "", "usher"]
    texts = ["ok.", "well", "Yes!\n", " ", "", None, "é?", "no.  ", "a\nb"]
    turns = []
    for conv in [None, *range(60)]:
        for k in range(rng.randint(0, 9)):
            turns.append((conv, rng.choice([k, k, k, None, 0]), rng.choice(roles[:3] + roles), f"{rng.choice(texts) or ''}{rng.choice(['', '', k])}." if rng.random() < .5 else rng.choice(texts)))
    assert repaired(spark, turns) == expected(turns)


def test_long_conversation_in_pieces(spark):
    """One conversation of many rows lies in several tasks and several pieces; a row repeated often is counted."""
    rng = random.Random(2)
    turns = [(7, k, rng.choice(["user", "assistant", "assistant", "system"]), f"{k} words{rng.choice(['.', '', '!'])}") for k in range(1500)]
    turns += [(7, 40, "user", "again.")] * 700 + [(8, 0, "user", "hi."), (8, 1, "assistant", "ho.")]
    assert repaired(spark, turns) == expected(turns)


def test_edges(spark):
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, []) == {}
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4 and zlib.crc32(f"{c}:1".encode()) % 20 > 4)
    long = "word " * 40_000 + "end."
    turns = [(dropped, 0, "user", "gone."), (kept, 0, "user", long), (kept, 1, "assistant", long)]
    got = repaired(spark, turns)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert got == expected(turns)
    far = [(kept, -2**63, "user", "a."), (kept, 2**63 - 1, "assistant", "b.")]
    assert repaired(spark, far)[kept][0] is None
    extra = spark.createDataFrame([(kept, 0, "user", "a.", 1, "x")], SCHEMA + ", audit int, Cost string")
    assert cr.repair(cr.damaged(extra), extra).count() == 1


def test_only_white_space_is_trimmed(spark):
    """Letters and digits at a text's end count, whichever they are; all six white-space characters don't."""
    texts = ["web", "done.bc", "cb0x", "Is it 0", "end.\x0b", "end!\x0c\r", "\x0b\x0c", "cut\x0c", "why?\t\n ", "tax", "x", "b", "c", "0", "no.\\", "v"]
    turns = [(conv, k, ["user", "assistant"][k % 2], text) for conv in range(6) for k, text in enumerate(texts)]
    assert repaired(spark, turns) == expected(turns)
