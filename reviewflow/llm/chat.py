"""Chat formatting from an event log, in DataFrame functions only.

The log has a row per event: ``conv_id``, ``seq``, ``message_id``, ``kind``, ``role`` and
``payload``. A ``start`` opens a message, a ``delta`` appends to it, an ``edit`` replaces
what it holds so far, a ``regenerate`` empties it for a new answer, a ``delete`` takes it
away. Events are partitioned by conversation and message, sorted by ``seq`` and folded;
messages are then sorted by their first ``seq`` and rendered.

In the rendered text a turn is ``<s>role`` + newline + text + ``</s>`` + newline. Texts and roles are
escaped: ``\\\\`` becomes ``\\\\\\\\`` and ``<`` becomes ``\\\\l``, so no control string can come from
a text, and unescaping gives it back exactly; a line break in a role, which would end it, becomes ``\\\\n``. ``parse`` reads turns from the rendered text.

Results, by case: a null payload is empty; a null role is an empty role; conversations with a
null id are one conversation of their own; events with equal ``seq`` are taken in the order of
kind and payload; a message that has no event left is not rendered; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>\n"
DELTA_CHARS = 512
#: What an event does to the text so far: rank within equal ``seq``.
KINDS = ("start", "regenerate", "edit", "delta", "delete")


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    # between escaped backslashes no "\\l" can arise by accident
    parts = F.split(c, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))), "\\")


def events_of_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", delta_chars: int = DELTA_CHARS, revised: bool = False) -> DataFrame:
    """The event log that a table of turns stands for: each row starts a message and
    streams its text in deltas of ``delta_chars`` code points. Repeated rows are messages of
    their own; equal turns are taken in the order of role and text. ``revised``: the log also holds
    a first try that didn't last: of an assistant's message an answer that is then regenerated, of another
    message a text that is edited to its first part, and with each turn's first message one that is deleted."""
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    in_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    t = t.withColumn("copy", F.row_number().over(in_turn))
    deltas = F.greatest(F.ceil(F.char_length("text") / F.lit(delta_chars)), F.lit(1))
    payloads = F.transform(F.sequence(F.lit(0), deltas - 1),
                           lambda i: F.substring(F.col("text"), i.cast("int") * delta_chars + 1, F.lit(delta_chars)))
    lit, answers = F.lit, F.col("role") == "assistant"
    event = lambda kind, payload, copy=F.col("copy"): F.struct(copy.alias("copy"), kind.alias("kind"), payload.alias("payload"))
    first, last = F.array(event(lit("start"), lit(""))), F.transform(payloads, lambda p: event(lit("delta"), p))
    if revised:
        first = F.array(event(lit("start"), lit("")), event(lit("delta"), F.concat(lit("not "), F.substring("text", 1, 40))),
                        event(F.when(answers, "regenerate").otherwise("edit"), F.when(answers, "").otherwise(payloads[0])))
        last = F.when(answers, last).otherwise(F.slice(last, 2, F.greatest(F.size(last) - 1, lit(0))))
        gone = F.array(*(event(lit(kind), F.col("role"), lit(0)) for kind in ("start", "delta", "delete")))
        first = F.when(F.col("copy") == 1, F.concat(gone, first)).otherwise(first)
    return (t.select("conv_id", "turn", "role", F.posexplode(F.concat(first, last)).alias("step", "event"))
            .select("conv_id", F.struct("turn", "event.copy", "step").alias("seq"),
                    F.struct("turn", "event.copy").alias("message_id"), F.col("event.kind").alias("kind"),
                    "role", F.col("event.payload").alias("payload")))


def messages(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``first_seq``, ``role`` (the first), ``text``."""
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    log = events.select("conv_id", "message_id", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("payload", F.lit("")).alias("payload"), kind.alias("rank"))
    sorted_log = F.array_sort(F.collect_list(F.struct("seq", "rank", "payload", "kind", "role")))
    folded = (log.groupBy("conv_id", "message_id").agg(sorted_log.alias("log"))
              .withColumn("from", F.array_max(F.transform(F.col("log"), lambda e, i: F.when(
                  e.kind.isin("start", "regenerate", "edit"), i).otherwise(0)))))
    live = F.slice("log", F.col("from") + 1, F.size("log"))
    payloads = F.transform(F.filter(live, lambda e: e.kind.isin("edit", "delta")), lambda e: e.payload)
    return (folded.where(F.element_at("log", -1).kind != "delete")
            .select("conv_id", F.col("log")[0].seq.alias("first_seq"), F.col("log")[0].role.alias("role"),
                    F.array_join(payloads, "").alias("text")))


def render(final: DataFrame) -> DataFrame:
    """One formatted text for each conversation."""
    turn = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE))
    whole = final.select("conv_id", "first_seq", turn.alias("turn"))
    return (whole.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first_seq", "turn"))).alias("turns"))
            .select("conv_id", F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, read back: an array of (role, text)."""
    pieces = F.split(formatted, CLOSE, -1)
    full = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(full, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))


def loss_text(turns: Column) -> Column:
    """What a loss mask on assistant turns covers: their texts, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t.role == "assistant"), lambda t: t.text), "")
