"""Polarity classifier on Spark ML: fit, evaluate, save / load, score, display.

The fine-tuned transformer of the original is re-aimed as a TF-IDF + logistic
regression pipeline over the same text and label; everything runs as Spark ML
stages (JVM), and scoring is a plain ``transform`` that also works on a stream.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import NEGATIVE_CODE, POSITIVE_CODE, label_name, percent_text
from ..functions.text import first_element
from .text import TOKEN_PATTERN, tokens

# Hyper-parameters: one pass in the original (epochs -> iterations here), weight
# decay 0.01 (-> L2 regularisation).
DEFAULT_PARAMS = {"max_iter": 20, "reg_param": 0.01, "num_features": 1 << 18, "min_doc_freq": 2}


def build(text_col: str = "review_full_text", label_col: str = "label", **params) -> Pipeline:
    p = {**DEFAULT_PARAMS, **params}
    tok = RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True)
    stop = StopWordsRemover(inputCol="tokens", outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=p["num_features"])
    idf = IDF(inputCol="tf", outputCol="features", minDocFreq=p["min_doc_freq"])
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=p["max_iter"],
                            regParam=p["reg_param"])
    return Pipeline(stages=[tok, stop, tf, idf, lr])


def fit(train: DataFrame, **params) -> PipelineModel:
    """Fit on the train split only (IDF weights are learnt, so the test split must not
    leak into them). The input is persisted for the iterations and released after."""
    data = train.withColumn("label", F.col("label").cast("double")).persist()
    try:
        return build(**params).fit(data)
    finally:
        data.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction``, ``label_code`` (``LABEL_1`` / ``LABEL_0``), ``score`` (the
    probability of the predicted class) and ``p_positive``."""
    out = model.transform(df)
    probs = vector_to_array("probability")
    return (out.withColumn("p_positive", probs[1])
               .withColumn("score", F.array_max(probs))
               .withColumn("label_code", F.when(F.col("prediction") == 1.0, F.lit(POSITIVE_CODE))
                           .otherwise(F.lit(NEGATIVE_CODE)))
               .drop("tokens", "words", "tf", "features", "rawPrediction", "probability"))


def prediction_array(label_code: Column, score: Column) -> Column:
    """The endpoint's answer shape: ``[{label, score}]``."""
    return F.array(F.struct(label_code.alias("label"), score.alias("score")))


def display(prediction: Column) -> tuple[Column, Column, Column]:
    """(code, sentiment name, confidence text) from the first element of an answer;
    an empty answer reads as a missing label (-> NEGATIVE) and score."""
    first = first_element(prediction)
    return first["label"], label_name(first["label"]), percent_text(first["score"])


def metrics(scored: DataFrame, label_col: str = "label") -> dict:
    """Accuracy, weighted F1, area under ROC and mean cross-entropy of a scored set."""
    # scored once: the four evaluations read three numbers per row from a persisted
    # slim frame instead of each re-running the text pipeline over whole texts
    d = scored.select(F.col(label_col).cast("double").alias(label_col), "prediction",
                      F.col("p_positive").alias("rawPrediction")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        acc = MulticlassClassificationEvaluator(labelCol=label_col, metricName="accuracy").evaluate(d)
        f1 = MulticlassClassificationEvaluator(labelCol=label_col, metricName="f1").evaluate(d)
        auc = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol="rawPrediction").evaluate(d)
        ce = d.agg(cross_entropy(F.col(label_col), F.col("rawPrediction")).alias("ce")).first()["ce"]
    finally:
        d.unpersist()
    return {"accuracy": acc, "f1": f1, "auc": auc, "cross_entropy": ce}


def cross_entropy(label: Column, p_positive: Column) -> Column:
    """Mean ``-ln p(true class)``, probabilities clipped to [1e-15, 1 - 1e-15]."""
    p = F.least(F.greatest(p_positive, F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.avg(-F.log(F.when(label == 1, p).otherwise(1 - p)))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_with(df: DataFrame, make_predict, input_col: str = "review_full_text", batch_size: int = 256) -> DataFrame:
    """Score with a plug-in model (for instance an exported transformer run by an
    inference runtime) through ``predict_batch_udf``: ``make_predict()`` is called once
    per Python worker and returns ``predict(texts: np.ndarray) -> np.ndarray`` of
    positive-class probabilities. Adds ``p_positive``, ``score`` and ``label_code``."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType

    udf = predict_batch_udf(make_predict, return_type=DoubleType(), batch_size=batch_size)
    p = F.col("p_positive")
    return (df.withColumn("p_positive", udf(F.col(input_col)))
              .withColumn("score", F.greatest(p, 1 - p))
              .withColumn("label_code", F.when(p >= 0.5, F.lit(POSITIVE_CODE)).otherwise(F.lit(NEGATIVE_CODE))))


# ---- a fixed-coefficient model ---------------------------------------------------------

# Fixed values of the hashed linear model: a token's coefficient is a number of thousandths in
# [-1000, 1000], taken from the first six hexadecimal digits of its MD5.
HASH_DIGITS, COEFFICIENTS, UNIT = 6, 2001, 1000


def hashed_logit(text: Column | str) -> Column:
    """The sum of a text's token coefficients, in thousandths (an exact integer)."""
    weight = lambda t: F.conv(F.substring(F.md5(t), 1, HASH_DIGITS), 16, 10).cast("long") % COEFFICIENTS - UNIT
    return F.aggregate(F.transform(tokens(text), weight), F.lit(0).cast("long"), lambda a, w: a + w)


def hashed_score(df: DataFrame, input_col: str = "review_full_text") -> DataFrame:
    """Score with the fixed hashed linear model, as expressions: a model that needs no fit, for
    baselines and for checking a scoring path by value. Adds ``p_positive``, ``score``, ``label_code``."""
    p = F.col("p_positive")
    return (df.withColumn("p_positive", 1 / (1 + F.exp(-hashed_logit(input_col) / F.lit(float(UNIT)))))
              .withColumn("score", F.round(F.greatest(p, 1 - p), 6))
              .withColumn("label_code", F.when(p >= 0.5, F.lit(POSITIVE_CODE)).otherwise(F.lit(NEGATIVE_CODE))))


def make_hashed_predict():
    """The same model as a plug-in for ``score_with``: one call a worker, whole batches of texts."""
    import hashlib
    import re

    import numpy as np

    def predict(texts):
        logits = [sum(int(hashlib.md5(t.encode()).hexdigest()[:HASH_DIGITS], 16) % COEFFICIENTS - UNIT
                      for t in re.findall(TOKEN_PATTERN, (x or "").lower())) for x in texts]
        return 1 / (1 + np.exp(-np.array(logits, float) / UNIT))
    return predict
