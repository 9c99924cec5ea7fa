"""Text scoring: one row per document (M1), single text (M2), empty batch gives empty output (M3)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pulseward.operators import text
from pulseward.sources import fixtures


def test_scoring_contract(spark):
    docs = fixtures.texts(spark, SF_SMALL)
    model = text.train(docs)
    out = text.score(model, docs)
    n_docs = docs.count()
    assert out.count() == n_docs and out.select("doc_id").distinct().count() == n_docs
    bad = out.filter(~F.col("label").isin("positive", "negative") | (F.col("confidence") < 0.5)
                     | (F.col("confidence") > 1.0)).count()
    assert bad == 0
    one = text.score(model, spark.createDataFrame([(1, "a short discharge note")], "doc_id long, text string"))
    assert one.count() == 1
    empty = text.score(model, spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0


def test_score_with_a_supplied_model_in_batches(spark):
    def predict(texts):          # stand-in model: longer texts lean positive
        return [[0.0, float(len(t) > 10)] for t in texts]

    docs = spark.createDataFrame([(i, "x" * (i * 3)) for i in range(10)], "doc_id long, text string")
    out = {r.doc_id: r for r in text.score_with_model(docs, predict, max_batch=4).collect()}
    assert len(out) == 10
    assert out[0].label == "negative" and out[0].confidence == 0.5          # tie -> class 0
    assert out[9].label == "positive" and round(out[9].confidence, 6) == round(1 / (1 + 2.718281828459045 ** -1), 6)
    assert text.score_with_model(spark.createDataFrame([], "doc_id long, text string"), predict).count() == 0
