"""Tokens, vocabulary and fixed-length encoding of review text.

Tokens are lower-case runs of ``[a-z0-9]``. Counting explodes tokens and
aggregates with a map-side partial aggregate, so a very common token is combined
inside each task before the shuffle. The encoder tokenises the whole text (its full
token count is kept), looks the first ``length`` tokens up in the whole vocabulary by a
join and emits their ids, padded.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

# Token pattern, padding and unknown ids, the model's input length (the
# truncation is its feature), size of the top-k vocabulary report.
TOKEN_PATTERN = "[a-z0-9]+"
PAD_ID = 0
UNKNOWN_ID = 1
ENCODED_LENGTH = 512
VOCABULARY_SIZE = 1000


# the complement of TOKEN_PATTERN: splitting on it yields the same maximal runs
_SEPARATOR = "[^a-z0-9]+"


def tokens(text: Column | str) -> Column:
    """Maximal runs of ``[a-z0-9]`` in the lower-cased text, in order (a split on the
    separator runs, empty edge pieces dropped; measurably cheaper than extracting)."""
    return F.filter(_split(text), lambda x: x != "")


def _split(text: Column | str) -> Column:
    """The tokens, with an empty piece at an edge where the text begins or ends otherwise."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(F.coalesce(t, F.lit(""))), _SEPARATOR)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``token, n_occurrences, n_docs`` over the whole of every text.

    One shuffle: each text gives a row for every token and one for every distinct token,
    from one tokenisation, summed by a single aggregate with a map-side combine, so a very
    common token is folded inside each task before anything is sent. The two lists are exploded
    in turn; no expression is evaluated for each token before that."""
    lists = F.array(*(F.struct(F.lit(kind).alias("o"), ts.alias("ts")) for kind, ts in ((1, F.col("__t")), (0, F.array_distinct("__t")))))
    # explode_outer: a plain explode makes Catalyst add a size filter below it, which
    # would tokenise every whole text a second time
    rows = (docs.select(_split(text_col).alias("__t")).select(F.explode_outer(lists).alias("e"))
            .select("e.o", F.explode_outer("e.ts").alias("token")).where(F.col("token") != ""))
    return rows.groupBy("token").agg(F.sum("o").cast("long").alias("n_occurrences"),
                                     F.sum(1 - F.col("o")).cast("long").alias("n_docs"))


def vocabulary(counts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Top ``size`` tokens by occurrences (ties by token) with ids from 2 upward
    (0 pads, 1 marks an unknown token)."""
    top = counts.orderBy(F.col("n_occurrences").desc(), F.col("token")).limit(size)
    w = Window.orderBy(F.col("n_occurrences").desc(), F.col("token"))  # at most `size` rows
    return top.select("token", "n_occurrences",
                      (F.row_number().over(w) + UNKNOWN_ID).cast("int").alias("token_id"))


def full_vocabulary(counts: DataFrame) -> DataFrame:
    """Every token with its id: the rank by occurrences (ties by token) from 2 upward.

    The ranks come from a range partitioning and each partition's row numbers; only one
    row for each partition goes through a single task."""
    order = (F.col("n_occurrences").desc(), F.col("token").asc())
    part = F.spark_partition_id()
    placed = checkpointed(counts.select("token", "n_occurrences").repartitionByRange(*order).sortWithinPartitions(*order)
                          .select("token", "n_occurrences", part.alias("part"),
                                  (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("row")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "part").select(
        "token", "n_occurrences", (F.col("start") + F.col("row") + UNKNOWN_ID + 1).cast("int").alias("token_id"))


def encode(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length: int = ENCODED_LENGTH) -> DataFrame:
    """``input_ids`` / ``attention_mask`` of exactly ``length`` entries plus the full
    token count of the whole text; unknown tokens get ``UNKNOWN_ID``, missing
    positions ``PAD_ID``. One output row for each input row, repeated and null ids too.

    One plan at every size: at most ``length`` rows per document meet the vocabulary in an
    unhinted join (common tokens are a skewed key, which AQE splits) and are regrouped by
    input row. Place and id travel as one long, so that the regrouped list is sorted without
    a comparator."""
    heads = (docs.select(id_col, F.monotonically_increasing_id().alias("__row"), tokens(text_col).alias("__toks"))
             .select(id_col, "__row", F.size("__toks").alias("n_tokens"),
                     F.posexplode_outer(F.slice("__toks", 1, length)).alias("pos", "token")))
    looked = heads.join(vocab.select("token", "token_id"), "token", "left")
    # null for a text without tokens, which collect_list leaves out
    entry = F.shiftleft(F.col("pos").cast("long"), 32) + F.coalesce("token_id", F.lit(UNKNOWN_ID))
    grouped = looked.groupBy("__row", id_col, "n_tokens").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    ids = F.transform("e", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))

    def filled(values: Column, rest: int) -> Column:
        return F.slice(F.concat(values, F.array_repeat(F.lit(rest), length)), 1, length)

    return grouped.select(id_col, "n_tokens", filled(ids, PAD_ID).alias("input_ids"),
                          filled(F.array_repeat(F.lit(1), F.size("e")), 0).alias("attention_mask"))


def encode_with(docs: DataFrame, tokenize, id_col: str = "doc_id", text_col: str = "text",
                length: int = ENCODED_LENGTH, pad_id: int = PAD_ID) -> DataFrame:
    """Fixed-length encoding with a plug-in tokenizer ``tokenize(str) -> list[int]``
    (e.g. a trained sub-word tokenizer) applied in Arrow batches through a Pandas UDF.
    The built-in ``encode`` stays the default; this is the path for tokenizers Spark
    cannot express. Returns ``input_ids``, ``attention_mask`` and the full token count."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    out_type = StructType([StructField("n_tokens", IntegerType()),
                           StructField("input_ids", ArrayType(IntegerType())),
                           StructField("attention_mask", ArrayType(IntegerType()))])

    @F.pandas_udf(out_type)
    def run(texts: pd.Series) -> pd.DataFrame:
        n, ids, mask = [], [], []
        for t in texts:
            toks = list(tokenize(t if isinstance(t, str) else ""))
            head = toks[:length]
            n.append(len(toks))
            ids.append(head + [pad_id] * (length - len(head)))
            mask.append([1] * len(head) + [0] * (length - len(head)))
        return pd.DataFrame({"n_tokens": n, "input_ids": ids, "attention_mask": mask})

    return docs.select(id_col, run(F.col(text_col)).alias("e")).select(id_col, "e.*")
