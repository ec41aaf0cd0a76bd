"""Text and model queries: token counts, vocabulary, fixed-length encoding, the
classifier (fit / metrics / save-load / batch and stream scoring), evaluation and
prediction display."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import epochs, sampling, text
from ..operators import model as mdl
from ..operators import prepare as prep
from ..session import scratch_path, table_path
from ..streaming import staging
from ..tables import read_table, reviews
from .registry import query

_TOKENS_SQL = """
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS token
  FROM documents),
per_doc AS (SELECT token, doc_id, count(*) AS n FROM t GROUP BY token, doc_id),
counts AS (
  SELECT token, CAST(sum(n) AS BIGINT) AS n_occurrences, count(*) AS n_docs
  FROM per_doc GROUP BY token),
vocab AS (
  SELECT token, n_occurrences,
         CAST(row_number() OVER (ORDER BY n_occurrences DESC, token) + 1 AS INTEGER) AS token_id
  FROM counts ORDER BY n_occurrences DESC, token LIMIT 1000)"""


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


@query("token_counts", _TOKENS_SQL + """
SELECT token, n_occurrences, n_docs FROM counts""")
def token_counts(spark, sf_dir):
    return text.token_counts(_docs(spark, sf_dir))


@query("vocabulary_topk", _TOKENS_SQL + """
SELECT token, n_occurrences, token_id FROM vocab""")
def vocabulary_topk(spark, sf_dir):
    return text.vocabulary(text.token_counts(_docs(spark, sf_dir)), text.VOCABULARY_SIZE)


@query("encode_fixed", _TOKENS_SQL + """,
ranked AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n_occurrences DESC, token) + 1 AS INTEGER) AS token_id FROM counts),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS tk FROM documents),
p AS (SELECT doc_id, unnest(tk[1:512]) AS token, generate_subscripts(tk[1:512], 1) AS pos FROM d),
e AS (SELECT doc_id, list(token_id ORDER BY pos) AS ids FROM p JOIN ranked USING (token) GROUP BY doc_id)
SELECT d.doc_id, len(d.tk) AS n_tokens,
       list_resize(coalesce(e.ids, []), 512, 0) AS input_ids,
       list_resize(list_transform(d.tk[1:512], lambda x: 1), 512, 0) AS attention_mask
FROM d LEFT JOIN e USING (doc_id)""")
def encode_fixed(spark, sf_dir):
    """Ids of the first 512 tokens (the model's input length) over the whole vocabulary."""
    docs = _docs(spark, sf_dir)
    return text.encode(docs, text.full_vocabulary(text.token_counts(docs)), length=text.ENCODED_LENGTH)


# ---- classifier -------------------------------------------------------------------

_MODEL_PATHS: dict = {}


def _training(spark, sf_dir):
    """Labelled rows, split 90/10 by hash."""
    rows = prep.training_rows(prep.prepare(reviews(spark, sf_dir))).select("doc_id", "label", "review_full_text")
    return sampling.split_exact(rows, "doc_id", 0.1, 42)


def _files_digest(spark, *folders: str) -> int:
    """A digest of the tables' files (path, size, time of change), without reading them."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
             .select(F.xxhash64("path", "length", "modificationTime").alias("h")))
    return files.agg(F.bit_xor("h").alias("h")).first()["h"]


def _model(spark, sf_dir):
    """The model of a table set, fitted once per application and state of its files, and saved
    below the scratch folder."""
    digest = _files_digest(spark, *(table_path(sf_dir, t) for t in ("documents", "labels")))
    key = (spark.sparkContext.applicationId, sf_dir, digest)
    if key not in _MODEL_PATHS:
        path = scratch_path(spark, "model")
        mdl.save(mdl.fit(_training(spark, sf_dir)[0]), path)
        _MODEL_PATHS[key] = path
    return mdl.load(_MODEL_PATHS[key])


_TRAINING_SQL = """
WITH labelled AS (
  SELECT title || '. ' || text AS full_text FROM reviews WHERE rating IS NOT NULL AND NOT isnan(rating)),
n AS (
  SELECT count(full_text) AS usable, count(*) - count(full_text) AS skipped,
         CAST(ceil(count(full_text) * 0.1) AS BIGINT) AS test FROM labelled)"""


@query("train_model_metrics", _TRAINING_SQL + """
SELECT 'n_train' AS metric, usable - test AS n, true AS in_range FROM n
UNION ALL SELECT 'n_test', test, true FROM n
UNION ALL SELECT 'n_skipped_null_text', skipped, true FROM n
UNION ALL SELECT metric, NULL, true FROM (VALUES ('accuracy'), ('f1'), ('auc'), ('cross_entropy')) m(metric)""", ("reviews",))
def train_model_metrics(spark, sf_dir):
    """Rows learnt from, tested on and left out (a missing title leaves no full text), and
    whether each metric of the test split lies in its range."""
    train, test = _training(spark, sf_dir)
    m = mdl.metrics(mdl.score(_model(spark, sf_dir), test))
    prepared = prep.prepare(reviews(spark, sf_dir))
    skipped = prepared.where(F.col("sentiment").isNotNull() & F.col("review_full_text").isNull()).count()
    top = {"cross_entropy": 35.0}     # -ln of the least probability counted
    rows = [("n_train", train.count(), True), ("n_test", test.count(), True), ("n_skipped_null_text", skipped, True)]
    rows += [(k, None, bool(0.0 <= v <= top.get(k, 1.0))) for k, v in m.items()]
    return spark.createDataFrame(rows, "metric string, n long, in_range boolean")


@query("model_roundtrip", _TRAINING_SQL + """
SELECT test AS n_rows, test AS n_same, CAST(0 AS DOUBLE) AS max_abs_diff FROM n""", ("reviews",))
def model_roundtrip(spark, sf_dir):
    """Save the fitted pipeline (model and tokenizer settings in one artefact), load it
    back and compare its scores with the live model on the test split."""
    train, test = _training(spark, sf_dir)
    live = mdl.fit(train)
    path = scratch_path(spark, "model-copy")
    mdl.save(live, path)
    a = mdl.score(live, test).select("doc_id", F.col("p_positive").alias("a"))
    b = mdl.score(mdl.load(path), test).select("doc_id", F.col("p_positive").alias("b"))
    same = F.abs(F.col("a") - F.col("b"))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum((same < 1e-12).cast("long")).alias("n_same"),
                                   F.round(F.max(same), 12).alias("max_abs_diff"))


def _scorable(spark, sf_dir):
    """Every document, its missing title or text filled with the empty string."""
    return prep.prepare(reviews(spark, sf_dir, with_rating=False), fill_concat=True).select("doc_id", "review_full_text")


def _shown(scored):
    code, name, conf = mdl.display(mdl.prediction_array(F.col("label_code"), F.col("score")))
    return scored.select("doc_id", code.alias("label_code"), F.col("score"), name.alias("sentiment"),
                         conf.alias("confidence"))


def _checked(shown):
    named = F.when(F.col("label_code") == "LABEL_1", "POSITIVE").when(F.col("label_code") == "LABEL_0", "NEGATIVE")
    return shown.select("doc_id", F.col("score").between(0.5, 1.0).alias("score_in_range"),
                        (F.col("sentiment") == named).alias("name_agrees"),
                        (F.col("confidence") == F.format_string("%.2f%%", F.round(F.col("score") * 100, 2))).alias("confidence_agrees"))


@query("score_documents", """
SELECT doc_id, true AS score_in_range, true AS name_agrees, true AS confidence_agrees FROM documents""")
def score_documents(spark, sf_dir):
    """Every document scored; what is value-checked are the properties of its answer."""
    return _checked(_shown(mdl.score(_model(spark, sf_dir), _scorable(spark, sf_dir))))


@query("stream_score", """
SELECT doc_id, true AS equals_batch FROM documents""")
def stream_score(spark, sf_dir):
    """The same model applied to reviews arriving as files on a stream, against the batch answer."""
    model = _model(spark, sf_dir)
    src = scratch_path(spark, "score-in")
    docs = _scorable(spark, sf_dir)
    docs.write.mode("overwrite").parquet(src)
    out = _shown(mdl.score(model, staging.read_stream(spark, src, docs.schema)))
    sink, ckpt = scratch_path(spark, "score-out"), scratch_path(spark, "score-ckpt")
    staging.run_to_parquet(out, sink, ckpt)
    batch = _shown(mdl.score(model, docs)).select("doc_id", *(F.col(c).alias(f"b_{c}") for c in ("label_code", "score", "confidence")))
    same = F.lit(True)
    for c in ("label_code", "score", "confidence"):
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    return spark.read.parquet(sink).join(batch, "doc_id", "full").select("doc_id", F.coalesce(same, F.lit(False)).alias("equals_batch"))


# ---- evaluation with a fixed length rule (value-checked) ---------------------------

_RULE_SQL = """
WITH s AS (
  SELECT d.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 1000.0) AS p_positive
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (
  SELECT sum(CASE WHEN label = 1 AND p_positive >= 0.5 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND p_positive >= 0.5 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 0 AND p_positive < 0.5 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN label = 1 AND p_positive < 0.5 THEN 1 ELSE 0 END) AS fn
  FROM s)"""


def _rule_scored(spark, sf_dir):
    """documents with a label, scored by length: p = n_chars / (n_chars + 1000)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    l = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(l, "doc_id").select("doc_id", "label",
                                      (F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("p_positive"))


@query("eval_confusion", _RULE_SQL + """
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
       round((tp + tn) / (tp + fp + tn + fn), 4) AS accuracy,
       round(tp / nullif(tp + fp, 0), 4) AS precision,
       round(tp / nullif(tp + fn, 0), 4) AS recall,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 4) AS f1
FROM c""")
def eval_confusion(spark, sf_dir):
    s = _rule_scored(spark, sf_dir)
    pos = F.col("p_positive") >= 0.5
    lab = F.col("label") == 1
    c = s.agg(F.sum((lab & pos).cast("long")).alias("tp"), F.sum((~lab & pos).cast("long")).alias("fp"),
              F.sum((~lab & ~pos).cast("long")).alias("tn"), F.sum((lab & ~pos).cast("long")).alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))

    def ratio(a, b):
        return F.round(a / F.when(b != 0, b), 4)
    return c.select("tp", "fp", "tn", "fn", ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


@query("eval_cross_entropy", _RULE_SQL + """
SELECT count(*) AS n_rows,
       round(avg(-ln(CASE WHEN label = 1 THEN p_positive ELSE 1 - p_positive END)), 4) AS cross_entropy
FROM s""")
def eval_cross_entropy(spark, sf_dir):
    s = _rule_scored(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(mdl.cross_entropy(F.col("label"), F.col("p_positive")), 4).alias("cross_entropy"))


@query("prediction_display", _RULE_SQL + """
SELECT doc_id,
       CASE WHEN p_positive >= 0.5 THEN 'LABEL_1' ELSE 'LABEL_0' END AS label_code,
       round(greatest(p_positive, 1 - p_positive), 4) AS score,
       CASE WHEN p_positive >= 0.5 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment,
       printf('%.2f%%', round(greatest(p_positive, 1 - p_positive) * 100, 2)) AS confidence
FROM s""")
def prediction_display(spark, sf_dir):
    s = _rule_scored(spark, sf_dir)
    code = F.when(F.col("p_positive") >= 0.5, F.lit("LABEL_1")).otherwise(F.lit("LABEL_0"))
    score = F.greatest(F.col("p_positive"), 1 - F.col("p_positive"))
    shown_code, name, conf = mdl.display(mdl.prediction_array(code, score))
    return s.select("doc_id", shown_code.alias("label_code"), F.round(score, 4).alias("score"),
                    name.alias("sentiment"), conf.alias("confidence"))



# ---- training by epochs -----------------------------------------------------------------

TRAIN_PLAN = epochs.Plan(epochs=3, batch_rows=512, learning_rate=1.0, warmup_steps=2, weight_decay=1e-4)
TRAIN_FEATURES = 1 << 14


@query("train_epochs", """
WITH r AS (SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND doc_id % 7 <> 0 AND text IS NOT NULL),
n AS (SELECT count(*) AS rows, CAST(ceil(count(*) * 0.1) AS BIGINT) AS test FROM r)
SELECT e AS epoch, CAST(e * ceil((rows - test) / 512.0) AS BIGINT) AS steps, rows - test AS train_rows, test AS test_rows,
       true AS loss_fell
FROM n, range(1, 4) t(e)""")
def train_epochs(spark, sf_dir):
    """The classifier trained by epochs: one row each, with the test split measured after it. ``loss_fell``: the test
    loss is below that after the epoch before (before the first: ln 2, of a model without weights)."""
    prepared = epochs.hashed_features(
        prep.training_rows(prep.prepare(reviews(spark, sf_dir))).select("doc_id", "label", "review_full_text"),
        "doc_id", "label", "review_full_text", TRAIN_FEATURES)
    path = scratch_path(spark, "features")
    prepared.write.parquet(path)
    train, test = sampling.split_exact(spark.read.parquet(path), "key", 0.1, 42)
    paths = [scratch_path(spark, "train"), scratch_path(spark, "test")]
    for df, to in zip((train, test), paths):
        df.write.parquet(to)
    train, test = (spark.read.parquet(p) for p in paths)
    _, history = epochs.train(train, test, TRAIN_FEATURES, TRAIN_PLAN)
    n, before, rows = train.count(), math.log(2), []
    for h in history:
        rows.append((h["epoch"], h["steps"], n, h["test_rows"], h["test_loss"] < before))
        before = h["test_loss"]
    return spark.createDataFrame(rows, "epoch long, steps long, train_rows long, test_rows long, loss_fell boolean")


@query("epochs_closed_form", """
WITH r AS (
  SELECT CAST(quality AS DOUBLE) AS y, ln(1 + length(text)) AS x FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
m AS (SELECT avg(y) AS my, avg(x) AS mx, stddev_pop(x) AS sx, covar_pop(y, x) AS c, count(*) AS n FROM r)
SELECT n AS n_rows, round(my, 4) AS bias, round(c / sx / 1.25, 4) AS weight FROM m""")
def epochs_closed_form(spark, sf_dir):
    """Ridge regression of the label on the standardised log length, by full-batch steps with decoupled decay: the
    weights are those of the closed form."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.log1p(F.length("text").cast("double")).alias("x"))
    rows = d.join(read_table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", "quality"), "doc_id")
    mean, sd = rows.agg(F.avg("x"), F.stddev_pop("x")).first()
    path = scratch_path(spark, "standardised")
    rows.select(F.col("doc_id").alias("key"), F.col("quality").cast("double").alias("label"), F.array(F.lit(0)).alias("indices"),
                F.array((F.col("x") - mean) / sd).alias("values")).write.parquet(path)
    table = spark.read.parquet(path)
    plan = epochs.Plan(epochs=24, batch_rows=None, learning_rate=0.7, warmup_steps=1, final_share=1.0, weight_decay=0.25, loss="squared")
    (w, bias), history = epochs.train(table, table, 1, plan)
    return spark.createDataFrame([(history[-1]["test_rows"], round(bias, 4), round(float(w[0]), 4))], "n_rows long, bias double, weight double")
