"""Repair of conversation structure by lightest derivations.

A repaired conversation's roles read ``(s?(ua)+)?`` (initials of an optional system turn, then user and
assistant in turn). Edits: Keep a row (cost 0), Rerole it to user or assistant (2), Delete it (3; blank
and duplicate rows must go), Insert an empty turn anywhere (2); a truncated row that stays costs 1 more.
The result is the cheapest edit sequence, ties to the ASCII-least string of edit initials.

1. An item [i, q] says that the first i rows can be repaired so that the grammar's state is q. A deduction takes an
   item, the fact of row i and an edit of it (an inserted turn goes in front of a row that stays) to
   [i + 1, q']; its weight adds to the cost and its letters to the audit. Values are (cost, audit), compared in that
   order: a deduction never makes one smaller and never turns two around, because two audits of equal cost
   over the same rows can't be one the other's beginning. So Knuth's agenda pops items by value, each
   final when popped, until the goal items are.
2. Conversations of any length: rows are ordered by a range partitioning (one conversation may lie in many tasks) and cut into
   pieces of ``PIECE`` rows. A piece gives its lightest derivations between any two states. Pieces are
   composed by the same agenda, a deduction now having two antecedents: [first pieces, p] and the piece's [p, q].
   Of a piece's derivations from one state only their order matters above, one letter each. ``PIECE`` pieces
   make a piece of the next level, until a conversation is one piece; its derivation is then read
   downwards. Identical rows are counted first, so a row repeated without end is one row with a count.
3. The repaired text is hashed as it streams by, in order; only that is one task a conversation, as
   the digest of the whole is asked for, and it holds the audit and one row.

Results, by case: null role and text are one space, a null conv_id is a conversation of its own, null turns come
first; rows of one turn go by role, then by the text's SHA-256, repeated ones side by side; a role without
letters can't be kept; roles count by their first character; very long texts are read by row; a conversation without
rows gives zeros, an empty audit and the empty string's hash; ``gaps`` beyond a long is null; an empty
table gives no rows. Only the four columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import ship, written

PIECE = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"

# states: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
TAIL = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}


def _row_moves(code: str) -> list[list[tuple[int, int, str]]]:
    """For each state the deductions over a row: (state, weight, letters). ``code`` is the role's
    initial (x: none of the grammar's), a capital if truncated, d if the row must go."""
    moves = []
    for p in STATES:
        out = [(p, DELETE, "D")]
        if code != "d":
            more = TRUNCATED if code.isupper() else 0
            initial = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(code.lower())
            for q, weight, letters in ((p, 0, ""), (NEXT[p], INSERT, "I")):
                if initial == NEXT[q] or initial == SYSTEM and q == START:
                    out.append((initial, weight + KEEP + more, letters + "K"))
                out.append((NEXT[q], weight + REROLE + more, letters + "R"))
        moves.append(out)
    return moves


ROW_MOVES = {code: _row_moves(code) for code in "suaxSUAXd"}


def lightest(steps: list, entry: int) -> dict[int, tuple[int, str]]:
    """For every state that can be reached past all steps, the lightest (cost, audit) from ``entry``."""
    agenda, final, goals, n = [(0, "", 0, entry)], set(), {}, len(steps)
    while agenda:
        cost, audit, i, p = heappop(agenda)
        if (i, p) in final:
            continue
        final.add((i, p))
        if i == n:
            goals[p] = (cost, audit)
            continue
        for q, weight, letters in steps[i][p]:
            if (i + 1, q) not in final:
                heappush(agenda, (cost + weight, audit + letters, i + 1, q))
    return goals


def derivations(steps: list) -> tuple[list, list]:
    """Costs and audits between any two states, at 4 * entry + exit (None where there is none)."""
    costs, audits = [None] * 16, [None] * 16
    for p in STATES:
        for q, (cost, audit) in lightest(steps, p).items():
            costs[4 * p + q], audits[4 * p + q] = cost, audit
    return costs, audits


@lru_cache(maxsize=1 << 14)
def row_derivations(codes: str) -> tuple[list, list]:
    return derivations([ROW_MOVES[c] for c in codes])


def piece_moves(costs: list, audits: list) -> list[list[tuple[int, int, str]]]:
    """The moves of a composed step: the letter is the derivation's rank among those from one
    state (times 4, plus the exit, so that it can be read back)."""
    moves = []
    for p in STATES:
        exits = sorted((audits[4 * p + q], q) for q in STATES if audits[4 * p + q] is not None)
        moves.append([(q, costs[4 * p + q], chr(48 + 4 * rank + q)) for rank, (_, q) in enumerate(exits)])
    return moves


def whole(costs: list, audits: list) -> tuple[int, int, str]:
    """(cost, exit, inserted tail) of the goal: a conversation from its start to an accepting state."""
    goals = sorted((costs[q] + TAIL[q][0], audits[q] + TAIL[q][1], q) for q in STATES if audits[q] is not None)
    return goals[0][0], goals[0][2], TAIL[goals[0][2]][1]


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with rows dropped, emptied, cut, repeated or reroled by a
    checksum of ``conv_id:turn``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    salt = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"),
                        said("text").alias("text"), salt.alias("salt")).where("salt <> 0")
    text = F.when(F.col("salt") == 1, "").when(F.col("salt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("salt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("salt") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       copies.alias("_copy")).drop("_copy")


def _same(names, a: str, b: str):
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names))


PIECES = "conv_id long, part int, number int, costs array<int>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string"
COUNTS = ["blank", "duplicate", "truncated", "illegal"]
MAPS = "conv_id long, place long, costs array<int>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string"
LEGAL = {"su", "ua", "au"}


def pieces(rows: DataFrame) -> DataFrame:
    """Every conversation's rows in order, as pieces with their derivations and counts."""
    ship(rows.sparkSession)
    key = ["conv_id", "turn", "role", "digest"]
    bare = F.rtrim("text", F.lit(SPACES))
    narrow = rows.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), (F.length(bare) == 0).alias("blank"),
                         (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # identical rows are one row with a count, whichever conversation holds them
    once = narrow.groupBy(*key).agg(F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = once.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("at")).select("conv_id", F.col("at.turn").alias("turn"), "role", "digest")
    flagged = once.alias("a").join(firsts.alias("b"), _same(key, "a", "b"), "left").select(
        *(f"a.{c}" for c in [*key, "copies", "blank", "cut"]), F.col("b.role").isNotNull().alias("new"))
    ordered = flagged.repartitionByRange(*key).sortWithinPartitions(*key)

    def run(batches):
        from reviewflow.llm import conversation_repair as r
        part = TaskContext.get().partitionId()
        made = {}
        held, number, codes, counts, initials = False, 0, [], [0, 0, 0, 0], ["", ""]

        def close():
            nonlocal codes, counts, initials, number
            costs, audits = r.row_derivations("".join(codes))
            for c, v in zip(r.PIECES.split(", "), [conv, part, number, costs, audits, *counts, *initials]):
                made.setdefault(c.split()[0], []).append(v)
            number, codes, counts, initials = number + 1, [], [0, 0, 0, 0], ["", ""]

        conv = None
        for batch in batches:
            for new_conv, role, copies, blank, cut, new in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "copies", "blank", "cut", "new"))):
                if not held or new_conv != conv:
                    if codes:
                        close()
                    conv, held, number = new_conv, True, 0
                initial = role[:1]
                for k in range(copies):
                    if blank:
                        counts[0] += 1
                    elif k or not new:
                        counts[1] += 1
                    elif cut:
                        counts[2] += 1
                    gone = blank or k or not new
                    code = initial if initial and initial in "sua" else "x"
                    if codes:
                        counts[3] += initials[1] + initial not in r.LEGAL
                    else:
                        initials[0] = initial
                    initials[1] = initial
                    codes.append("d" if gone else code.upper() if cut else code)
                    if len(codes) == r.PIECE:
                        close()
            if len(made.get("number", ())) > 1000:
                yield pa.RecordBatch.from_pydict(made, schema=schema)
                made = {}
        if codes:
            close()
        if made:
            yield pa.RecordBatch.from_pydict(made, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int32()), ("costs", pa.list_(pa.int32())),
                        ("audits", pa.list_(pa.string())), *((c, pa.int64()) for c in COUNTS), ("first", pa.string()), ("last", pa.string())])
    found = written(ordered.mapInArrow(run, PIECES), "pieces")
    # places within a conversation: a row for each partition that it lies in
    before = found.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select(
        "conv_id", "part", (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("before"))
    placed = found.alias("a").join(before.alias("b"), _same(["conv_id", "part"], "a", "b"))
    return placed.select("a.conv_id", (F.col("number") + F.col("before")).alias("place"), "costs", "audits", *COUNTS, "first", "last")


def composed(maps: DataFrame) -> DataFrame:
    """Every ``PIECE`` neighbouring pieces of a conversation as one."""
    def run(batches):
        from reviewflow.llm import conversation_repair as r
        made = {c.split()[0]: [] for c in r.MAPS.split(", ")}
        key, steps, sums, ends = None, [], [], []

        def close():
            costs, audits = r.derivations(steps)
            for c, v in zip(made, [*key, costs, audits, *sums, *ends]):
                made[c].append(v)

        for batch in batches:
            for conv, place, costs, audits, *counts, first, last in zip(*(batch.column(c).to_pylist() for c in made)):
                if key != (conv, place // r.PIECE):
                    if key:
                        close()
                    key, steps, sums, ends = (conv, place // r.PIECE), [], [0, 0, 0, 0], [first, last]
                else:
                    sums[3] += ends[1] + first not in r.LEGAL
                    ends[1] = last
                sums = [a + b for a, b in zip(sums, counts)]
                steps.append(r.piece_moves(costs, audits))
            if len(made["place"]) > 1000:
                yield pa.RecordBatch.from_pydict(made, schema=schema)
                made = {c: [] for c in made}
        if key:
            close()
            yield pa.RecordBatch.from_pydict(made, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
                        *((c, pa.int64()) for c in COUNTS), ("first", pa.string()), ("last", pa.string())])
    parent = F.floor(F.col("place") / F.lit(PIECE))
    return maps.repartition(F.col("conv_id"), parent).sortWithinPartitions("conv_id", "place").mapInArrow(run, MAPS)


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of the conversations in ``rows``."""
    levels = [written(pieces(rows), "level")]
    while not levels[-1].where("place > 0").isEmpty():
        levels.append(written(composed(levels[-1]), "level"))
    ends = ", ".join(f"{cost}" for cost, _ in (TAIL[q] for q in STATES))
    tails = ", ".join(f"'{tail}'" for _, tail in (TAIL[q] for q in STATES))
    # the goal: least (cost, audit) over the exits from the start, tails included
    goals = F.expr(f"""array_min(transform(filter(sequence(0, 3), q -> audits[q] is not null), q -> struct(
        costs[q] + array({ends})[q] as cost, concat(audits[q], array({tails})[q]) as audit, q as q, array({tails})[q] as tail)))""")
    top = levels[-1].withColumn("goal", goals)
    plan = top.select("conv_id", F.col("place"), F.lit(START).alias("p"), F.col("goal.q").alias("q"))
    for level in reversed(levels[1:]):
        joined = level.alias("a").join(plan.alias("b"), _same(["conv_id", "place"], "a", "b")).select(
            "a.conv_id", "a.place", "p", F.expr("audits[4 * p + q]").alias("way"))
        exits = F.expr("transform(split(way, ''), x -> (ascii(x) - 48) % 4)")
        plan = joined.withColumn("exits", exits).select("conv_id", "place", "p", "exits", F.posexplode("exits").alias("k", "q")).select(
            "conv_id", (F.col("place") * PIECE + F.col("k")).alias("place"),
            F.when(F.col("k") == 0, F.col("p")).otherwise(F.get("exits", F.col("k") - 1)).alias("p"), "q")
    ways = levels[0].alias("a").join(plan.alias("b"), _same(["conv_id", "place"], "a", "b")).select(
        "a.conv_id", F.struct("a.place", F.expr("audits[4 * p + q]").alias("way")).alias("way"))
    said = ways.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("way")), lambda w: w.way), "").alias("audit"))
    counts = top.select("conv_id", *COUNTS, F.col("goal.cost").cast("long").alias("cost"), F.col("goal.tail").alias("tail"))
    return counts.alias("a").join(said.alias("b"), _same(["conv_id"], "a", "b")).select(
        "a.conv_id", *COUNTS, "cost", F.concat("audit", "tail").alias("audit"))


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def applied(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """``heads`` (a row for each conversation, with its audit) and the SHA-256 of the repaired text."""
    ship(rows.sparkSession)
    names = [c.split()[0] for c in REPAIRED.split(", ")[:-1]]
    body = rows.select("conv_id", F.lit(1).alias("body"), "turn", "role", "text", F.sha2("text", 256).alias("digest"))
    both = heads.select("conv_id", F.lit(0).alias("body"), *names[1:]).unionByName(body, allowMissingColumns=True)

    def run(batches):
        from reviewflow.llm import conversation_repair as r
        made, head, repair = {c.split()[0]: [] for c in r.REPAIRED.split(", ")}, None, None

        def close():
            for c, v in zip(made, [*head, repair.digest()]):
                made[c].append(v)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("body", "role", "text", *names)]
            for body, role, text, *new in zip(*columns):
                if body:
                    repair.row(role, text)
                else:
                    if head:
                        close()
                    head, repair = new, r.Repair(new[-1])
            if len(made["conv_id"]) > 1000:
                yield pa.RecordBatch.from_pydict(made, schema=schema)
                made = {c: [] for c in made}
        if head:
            close()
            yield pa.RecordBatch.from_pydict(made, schema=schema)

    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in REPAIRED.split(", ")])
    # a plain scan order would do but for the order of turns; rows stream, none is held
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "body", "turn", "role", "digest").mapInArrow(run, REPAIRED)


class Repair:
    """An audit applied to rows as they come; the repaired turns go into a digest."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.turns = audit, 0, START, hashlib.sha256(), 0

    def _say(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.turns else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.turns += 1

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._next("")
            self.at += 1

    def _next(self, text: str) -> None:
        self.state = NEXT[self.state]
        self._say("user" if self.state == USER else "assistant", text)

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            self._say(role, text)
        elif letter == "R":
            self._next(text)

    def digest(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the repair of its ``rows`` (conv_id, turn, role, text)."""
    found = audits(rows).alias("b")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    turns = rows.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max(wide("turn")) - F.min(wide("turn")) + 1 - F.count("*")).alias("gaps")).alias("c")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("a")
    heads = ids.join(found, _same(["conv_id"], "a", "b"), "left").join(turns, F.col("a.conv_id").eqNullSafe(F.col("c.conv_id")), "left")
    zero = F.lit(0).cast("long")
    gaps = F.when(F.col("c.gaps").isNull(), zero).otherwise(F.expr("try_cast(c.gaps as bigint)")).alias("gaps")
    return applied(heads.select("a.conv_id", gaps, *(F.coalesce(f"b.{c}", zero).alias(c) for c in [*COUNTS, "cost"]),
                                F.coalesce("b.audit", F.lit("")).alias("audit")), rows)
