"""Text scoring as a Spark ML batch job (M1-M3) and the softmax/argmax output contract.

The serving model of the original setup is not available, so a trainable pipeline with the same output
contract is used: RegexTokenizer -> HashingTF -> IDF -> LogisticRegression, trained on the labelled documents
(``labels.quality``) and applied to every document. Output per document: ``label`` ('positive' for class 1,
else 'negative') and ``confidence`` = probability of the chosen class. Whole texts are tokenised (no
truncation). Tokenising, hashing and scoring run in the JVM inside the tasks; training is a distributed
L-BFGS (tree aggregation), so nothing passes through the driver but the model coefficients.
An empty input gives an empty output (deviation: no error for an empty batch).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half

NUM_FEATURES = 1 << 18


def _featurizer() -> list:
    return [RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\W+", toLowercase=True, minTokenLength=1),
            HashingTF(inputCol="tokens", outputCol="tf", numFeatures=NUM_FEATURES)]


def _classifier(max_iter: int = 15, reg: float = 0.01, tol: float = 1e-4) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg, tol=tol,
                              probabilityCol="probability", predictionCol="prediction")


def train(labelled: DataFrame) -> PipelineModel:
    """Fit on (text, quality) rows with a known label.

    The labelled texts are tokenised and hashed once and the (sparse) term vectors persisted for the
    iterative fits (IDF, the feature summary and L-BFGS passes of the classifier); a lost executor only
    recomputes its partitions from the lineage.
    """
    data = labelled.filter(F.col("quality").isNotNull() & F.col("text").isNotNull()) \
        .select("text", F.col("quality").cast("double").alias("label"))
    prep = Pipeline(stages=_featurizer()).fit(data)
    tf = prep.transform(data).select("tf", "label").persist()
    try:
        idf = IDF(inputCol="tf", outputCol="features", minDocFreq=1).fit(tf)
        clf = _classifier().fit(idf.transform(tf))
    finally:
        tf.unpersist()
    return PipelineModel(stages=[*prep.stages, idf, clf])


def held_out(doc_id: str = "doc_id", share: int = 5) -> F.Column:
    """One document in ``share``, by hash, is kept out of training."""
    return F.pmod(F.xxhash64(doc_id), F.lit(share)) == 0


def accuracy(docs: DataFrame) -> DataFrame:
    """One row: number of held-out labelled texts, accuracy and area under the ROC curve on them, after training on
    the other labelled texts."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    known = docs.filter(F.col("quality").isNotNull() & F.col("text").isNotNull())
    model = train(known.filter(~held_out()))
    scored = model.transform(known.filter(held_out()).select("doc_id", "text", F.col("quality").cast("double").alias("label")))
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(scored)
    return scored.agg(F.count(F.lit(1)).alias("n_held_out"),
                      F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                      F.lit(auc).alias("auc"))


def score(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """(doc_id, label, confidence, n_tokens) for every document."""
    scored = model.transform(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")))
    p = vector_to_array(F.col("probability"))
    cls = F.col("prediction").cast("int")
    return scored.select(
        "doc_id",
        F.when(cls == 1, F.lit("positive")).otherwise(F.lit("negative")).alias("label"),
        round_half(F.element_at(p, cls + 1), 6).alias("confidence"),
        F.size("tokens").alias("n_tokens"))


def score_with_model(docs: DataFrame, predict_logits, n_classes: int = 2, max_batch: int = 64) -> DataFrame:
    """M1 with a user-supplied model: ``predict_logits(list[str]) -> list[list[float]]`` is called on batches
    of at most ``max_batch`` texts inside ``mapInPandas`` (Arrow batches, one model load per task if the
    callable loads lazily); softmax, argmax, label and confidence are then column expressions (R6).
    Every document is scored; an empty input gives an empty output."""
    import pandas as pd

    from ..functions.scoring import argmax, softmax

    def batches(frames):
        for pdf in frames:
            for start in range(0, len(pdf), max_batch):
                part = pdf.iloc[start:start + max_batch]
                logits = predict_logits(part["text"].fillna("").tolist()) if len(part) else []
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(),
                                    "logits": [list(map(float, row)) for row in logits]})

    raw = docs.select("doc_id", "text").mapInPandas(batches, "doc_id long, logits array<double>")
    probs = raw.select("doc_id", softmax(F.col("logits")).alias("p"))
    cls = argmax(F.col("p"))
    return probs.select(
        "doc_id",
        F.when(cls == 1, F.lit("positive")).otherwise(F.lit("negative")).alias("label"),
        round_half(F.element_at("p", (cls + 1).cast("int")), 6).alias("confidence"))
