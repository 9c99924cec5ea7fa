"""Quality classifier by Bradley-Terry pairwise ranking.

Every text gets measures that only its characters decide (no doc_id, source, language or label). A document's score
is linear in them, and is learnt from preference pairs: a labelled good document is preferred to a labelled bad one
with the logistic loss on the difference of their features (Newton steps, ridge penalty). The pairs are of a bounded,
documented sample: the ``MAX_LABELLED`` labelled rows with the smallest md5 of doc_id; the i-th good document meets
``PAIRS_PER_DOC`` bad ones and the other way round, along the two md5 orders. The sample bounds this fit alone. Scores
become 0..1 by a logistic curve whose value 0.3 is put at the quantile that parts off the share of bad ones among the
scores of all labelled rows that no fold holds out (exact order statistics, selected by counting in rounds).

Defined results: null and empty texts have all measures 0 and get the score these have; without a good and a bad
label all scores are 0.5; labels that are null or not 0/1 are not learnt from; a doc_id with several labels has its
largest; rows without doc_id aren't held out; repeated rows change no weight and count as rows in the quantile; other
columns change nothing. Measures and scores are DataFrame expressions over whole texts, evaluated once per document and
stored; the driver sees the sample and counts of score cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.percentiles import selected_percentiles
from .common import let, non_space, read, stage, words

THRESHOLD = 0.3            # fixed by the contract
FOLDS = 5                  # fixed by the contract
MAX_LABELLED = 20_000
PAIRS_PER_DOC = 8
RIDGE = 1e-2
STEPS = 25
MARGIN = 0.02

FEATURES = ("log_words", "mean_word", "upper", "digit", "symbol", "exclaim", "stop", "comma", "pipe", "distinct",
            "short", "long_word", "lines", "line_dup", "first_word")


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures ``FEATURES`` of its ``text`` (double, never null)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    dense = F.greatest(F.length(non_space(F.col("text"))), F.lit(1))
    ws = F.col("_w")
    n = F.greatest(F.size(ws), F.lit(1))

    def share(characters: str) -> Column:
        return (F.length(t) - F.length(F.translate(t, characters, ""))) / dense

    lines = F.filter(F.split(t, "\n", -1), lambda x: non_space(x) != "")
    letters = F.translate(t, "".join(map(chr, [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)])), "")
    measures = {
        "log_words": F.log1p(F.size(ws)), "mean_word": dense / n, "upper": (F.length(t) - F.length(letters)) / dense,
        "digit": share("0123456789"), "symbol": share("#*$%&<>^~@={}[]"), "exclaim": share("!?"), "stop": share("."),
        "comma": share(","), "pipe": share("|"), "distinct": F.size(F.array_distinct(ws)) / n,
        "short": F.size(F.filter(ws, lambda w: F.length(w) <= 3)) / n,
        "long_word": F.size(F.filter(ws, lambda w: F.length(w) >= 12)) / n,
        "lines": F.size("_l") / n,
        "line_dup": 1 - F.size(F.array_distinct("_l")) / F.greatest(F.size("_l"), F.lit(1)),
        "first_word": let(ws, lambda a: F.size(F.filter(a, lambda w: w == F.get(a, F.lit(0))))) / n,
    }
    return (docs.withColumn("_w", words(F.col("text"))).withColumn("_l", lines)
            .withColumns({f"_f_{k}": v.cast("double") for k, v in measures.items()}).drop("_w", "_l"))


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def _vector(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Scaled measures, their absolute values and squares (each bounded): junk may lie on either side of prose."""
    z = np.clip((x - centre) / scale, -4, 4)
    return np.concatenate([z, np.abs(z), z * z / 4], axis=1)


def fit(features: np.ndarray, label: np.ndarray, pairs_per_doc: int = PAIRS_PER_DOC) -> dict:
    """Weights of the Bradley-Terry model and the scaling."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return {"w": None}
    centre, scale = np.median(features[good], axis=0), features[good].std(axis=0) + 1e-3
    v = _vector(features, centre, scale)
    m = pairs_per_doc * max(len(good), len(bad))
    i = np.arange(m)
    d = v[good[i % len(good)]] - v[bad[(i + i // max(len(good), len(bad)) * 7919) % len(bad)]]
    w = np.zeros(v.shape[1])
    for _ in range(STEPS):   # minimises mean log(1 + exp(-d w)) + ridge |w|^2 / 2
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        g = d.T @ p / m - RIDGE * w
        h = (d * (p * (1 - p))[:, None]).T @ d / m + RIDGE * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return {"w": w, "centre": centre, "scale": scale}


def raw_score(model: dict) -> Column:
    """The linear score from the columns of ``with_measures``."""
    k = len(FEATURES)
    total = F.lit(0.0)
    for j, name in enumerate(FEATURES):
        z = (F.col(f"_f_{name}") - float(model["centre"][j])) / float(model["scale"][j])
        z = F.least(F.greatest(z, F.lit(-4.0)), F.lit(4.0))
        a, b, c = (float(model["w"][j + o * k]) for o in range(3))
        total = total + z * a + F.abs(z) * b + z * z * (c / 4)
    return total


def usable(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the labels that may be learnt from, one row per doc_id."""
    return (labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out())
            .where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")))


def threshold_score(scored: DataFrame, labels: DataFrame) -> float:
    """The raw score that parts off the share of bad rows, over all rows of ``scored`` (doc_id, raw) with a usable
    label: the middle of the scores just below and above that quantile. 0 without such rows."""
    rows = stage(scored.join(usable(labels), "doc_id").select("raw", "quality"), "op4-labelled")
    n, bad = rows.agg(F.count("*"), F.count_if(F.col("quality") == 0)).first()
    if not n:
        return 0.0
    q = bad / n
    ends = selected_percentiles(rows, "raw", {"low": q * (1 - MARGIN), "high": min(1.0, q * (1 + MARGIN))}, digits=12).first()
    return (ends["low"] + ends["high"]) / 2


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict:
    """Fits on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks and no fold holds out."""
    lab = usable(labels).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_labelled)
    lab = stage(lab, "op4-labels")   # at most max_labelled rows
    rows = stage(with_measures(docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")).select(
        "doc_id", "quality", *(f"_f_{f}" for f in FEATURES)), "op4-sample")
    # a doc_id may have several rows: one row per id and label keeps the sample bounded
    got = rows.groupBy("doc_id", "quality").agg(*(F.min(f"_f_{f}").alias(f) for f in FEATURES))
    got = got.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").collect()
    if not got:
        return {"w": None}
    return fit(np.array([[r[f] for f in FEATURES] for r in got]), np.array([r["quality"] for r in got]))


def score(docs: DataFrame, labels: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted."""
    d = docs.select("doc_id", "text")
    if model["w"] is None:
        out = d.select("doc_id", held_out().alias("held_out"), F.lit(0.5).alias("score"))
    else:
        raw = stage(with_measures(d).select("doc_id", raw_score(model).alias("raw")), "op4-raw")
        shift = float(np.log(threshold / (1 - threshold))) - threshold_score(raw, labels)
        out = raw.select("doc_id", held_out().alias("held_out"), (1 / (1 + F.exp(-(F.col("raw") + shift)))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    return score(docs, labels, train(docs, labels))
