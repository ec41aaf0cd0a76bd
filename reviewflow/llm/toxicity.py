"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents whose label says toxic, the rest of the corpus counts as unlabelled.
A linear model over the presence of word features (a word, its first four and five letters,
and such a beginning shared by several words) minimises the class-prior-corrected risk

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

with logistic loss; while the second part is negative, its gradient is taken the other way.
The prior is the toxic share of the labelled training rows.

The fit takes bounded samples, chosen by a hash of the id: at most ``POSITIVES`` and
``UNLABELLED`` documents (whole texts), and of their features at most ``FEATURES`` that are
far more frequent in positives than chance would make them. Only per-feature counts and
the sample's selected features come to the driver. Scoring covers every whole text.

Results, by case: null and empty texts have no feature and get the score of the bias; without
positive training labels every score is 0; rows with a null id are scored like others and are not
held out; repeated rows are scored each; ids that are repeated in the labels count as toxic if any
row says so; null labels are no labels; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import Generations, free_name, ship, written

POSITIVES = 3_000
UNLABELLED = 8_000
FEATURES = 20_000
MIN_POSITIVES = 4
MIN_EVIDENCE = 12.0
STEPS = 400
TWICE = 0x2545F4914F6CDD1D
PENALTY = 1e-4
SCORE_CUT = 0.7

_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def word_features(word: bytes) -> list[int]:
    """Signed 64-bit hashes of a word's features."""
    w = word.decode("utf-8", "replace")
    names = ["w " + w, *(f"{n} {w[:n]}" for n in (4, 5) if len(w) > n)]
    return [xxhash.xxh3_64_intdigest(s) - 2**63 for s in names]


def document_features(texts_words: set[bytes]) -> set[int]:
    seen, out = set(), set()
    for w in texts_words:
        for f in word_features(w):
            out.add(f ^ TWICE if f in seen else f)
            seen.add(f)
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Model:
    weights: dict
    bias: float
    prior: float

    def scorer(self):
        cache = Generations(60_000)
        weights, bias = self.weights, self.bias

        def score(text: str) -> float:
            if not weights:
                return 0.0
            words = words_of(text)
            cache.turn()
            for w in cache.unknown(words):
                cache[w] = tuple(f for f in word_features(w) if f in weights or f ^ TWICE in weights)
            seen, found = set(), set()
            for t in map(cache.__getitem__, words):
                for f in t:
                    found.add(f ^ TWICE if f in seen else f)
                    seen.add(f)
            return 1 / (1 + float(np.exp(-np.clip(bias + sum(weights.get(f, 0.0) for f in sorted(found)), -50, 50))))
        return score


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int, prior: float,
          steps: int = STEPS, penalty: float = PENALTY, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk; rows are arrays of feature numbers."""
    def matrix(rows):
        size = np.array([len(r) for r in rows])
        return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), size), len(rows)

    p, u = matrix(positive), matrix(unlabelled)
    value = lambda m, w: np.bincount(m[1], w[m[0]], m[2]) + w[-1]
    gradient = lambda m, g: np.r_[np.bincount(m[0], g[m[1]], n_features), g.sum()] / m[2]
    down = lambda f: 1 / (1 + np.exp(np.clip(f, -50, 50)))  # noqa: E731  minus the slope of loss(f)
    loss = lambda f: np.logaddexp(0, -f)
    w, first, second = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        fp, fu = value(p, w), value(u, w)
        rest = loss(-fu).mean() - prior * loss(-fp).mean()
        toward = gradient(u, down(-fu)) - prior * gradient(p, down(-fp))
        g = -prior * gradient(p, down(fp)) + toward if rest >= 0 else -toward
        g = g + penalty * np.r_[w[:-1], 0]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - rate / (1 + step / 100) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model from the labels outside the held-out rows and a sample of the texts there."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    if not prior:
        return Model({}, 0.0, 0.0)
    by_hash = F.xxhash64("doc_id")
    chosen_p = known.where("toxic = 1").select("doc_id").orderBy(by_hash).limit(POSITIVES)
    ids = docs.select(F.col(doc_id).alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen_u = ids.orderBy(by_hash).limit(UNLABELLED).distinct()
    chosen = chosen_p.withColumn("p", F.lit(1)).unionByName(chosen_u.withColumn("p", F.lit(0)))
    chosen = chosen.groupBy("doc_id").agg(F.max("p").alias("p"), (F.min("p") == 0).alias("u"))
    # at most POSITIVES + UNLABELLED ids
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")

    def extract(batches):
        from reviewflow.llm import runtime, toxicity
        for batch in batches:
            for part, texts in runtime.text_slices(batch, "text", chars=1_000_000):
                rows = [sorted(toxicity.document_features(toxicity.words_of(t))) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(rows, pa.list_(pa.int64()))], names=["p", "u", "features"])

    features = sample.select("text", "p", "u").mapInArrow(extract, "p int, u boolean, features array<long>")
    features = features.groupBy(F.xxhash64("features").alias("digest"), "p").agg(
        F.max("u").alias("u"), F.min("features").alias("features")).select("p", "u", "features")  # the same rows at every run
    features = written(features, "toxicity-sample")
    total = features.agg(F.sum("p").alias("p"), F.sum(F.col("u").cast("int")).alias("u")).first()
    if not total.p or not total.u:
        return Model({}, 0.0, float(prior))
    counts = features.select("p", F.col("u").cast("int").alias("u"), F.explode("features").alias("f")).groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    # log-likelihood ratio of the positives' count against the corpus rate
    chance = (F.col("u") + 0.5) * (total.p / total.u)
    evidence = F.col("p") * F.log(F.col("p") / chance) - (F.col("p") - chance)
    picked = (counts.where((F.col("p") >= MIN_POSITIVES) & (F.col("p") > chance)).where(evidence >= MIN_EVIDENCE)
              .orderBy(F.desc("p"), "f").limit(FEATURES).select("f").collect())
    names = np.array(sorted(r.f for r in picked), np.int64)

    def narrow(batches):
        for batch in batches:
            rows = [np.searchsorted(names, np.intersect1d(np.array(r, np.int64), names)) for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))], names=["p", "u", "features"])

    rows = features.mapInArrow(narrow, features.schema).collect()
    arrays = [(r.p, r.u, np.array(r.features, np.int64)) for r in sorted(rows, key=lambda r: (r.p, r.features))]
    weights, bias = train([a for p, _, a in arrays if p], [a for _, u, a in arrays if u], len(names), prior)
    return Model(dict(zip(names.tolist(), weights.tolist())), bias, float(prior))


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with the score of each whole text, 0 to 1. Where a column has that name already, in
    any case, the new one gets underscores before it."""
    into = free_name(df, into)
    ship(df.sparkSession)
    weights, bias, prior = model.weights, model.bias, model.prior

    def run(batches):
        from reviewflow.llm import bpe, runtime, toxicity
        of = toxicity.Model(weights, bias, prior).scorer()
        for batch in batches:
            for part, texts in runtime.text_slices(batch, text):
                yield bpe.append_column(part, into, pa.array([of(t) for t in texts], pa.float64()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType())]))
