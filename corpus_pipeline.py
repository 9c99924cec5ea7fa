"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. quality rules: rejected documents go, boilerplate lines of a host are removed from the others
2. near duplicates by DartMinHash: one document of each class stays
3. suffix-array dedup: bytes covered by repeated strings of ``PASSAGE_BYTES`` are removed, which passages of over 50
   words hold
4. mixing of sources to target weights: documents of small sources are repeated, none is left out
5. SentencePiece encoding and decoding: ids of every text, and the text decoded from them

A stage takes (spark, docs, sf_dir), works on every row that its predecessor kept and, but for the last, returns the
columns of documents (doc_id, text, lang, source, n_chars; n_chars follows the text). Every defined result of the
operators holds here too: null texts and empty tables pass through, rows without doc_id are documents of their own.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseward.llm import op1_quality, op2_pieces, op3_dart, op8_mixing, op9_suffix
from pulseward.llm.common import delete, discard, read, stage, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PASSAGE_BYTES = 200   # 50 words have more in nearly every text
PASSAGE_GRAM = 64
_leftover = threading.local()   # runs of several threads don't meet


def _after_the_last(step):
    """A stage that first deletes the tables which the stage before it stored: as its documents have been written and
    read again, nothing reads those any more. Its own stay, for its result is read after it returns."""
    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in getattr(_leftover, "paths", ()):
            delete(spark, path)
        before = set(stored())
        out = step(spark, docs, sf_dir)
        _leftover.paths = [p for p in stored() if p not in before]
        return out
    return run_stage


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number ``rid``, written once: stages join by it."""
    return stage(docs.select(*COLUMNS).withColumn("rid", F.monotonically_increasing_id()), "pipeline")


def _documents(rows: DataFrame, text) -> DataFrame:
    changed = rows.withColumn("_t", text)
    return changed.select("doc_id", F.col("_t").alias("text"), "lang", "source", F.when(
        F.col("_t").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length("_t").cast("long")).alias("n_chars"))


@_after_the_last
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line counts are over distinct texts: copies of a text are left for the next stage, which keeps one."""
    rows = op1_quality.quality_rules(docs.select(*COLUMNS))
    return _documents(rows.where("kept"), F.col("clean_text"))


@_after_the_last
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _keyed(docs)
    kept = op3_dart.near_duplicates(rows).where("keep").select("rid")
    return rows.join(kept, "rid", "left_semi").select(*COLUMNS)


@_after_the_last
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A removed run may begin or end inside a character; the bytes left of such a character go too."""
    cut = op9_suffix.without_repeats(_keyed(docs), PASSAGE_BYTES, as_text=True,
                                     carry=("doc_id", "lang", "source", "n_chars"), gram=PASSAGE_GRAM)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.when(
        F.size("spans") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


@_after_the_last
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _keyed(docs)
    return rows.join(op8_mixing.mixture(rows).select("rid"), "rid").select(*COLUMNS)


@_after_the_last
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_pieces.encode_documents(docs, op2_pieces.model_path(), "doc_id", "source", decoded=True)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_dedup), ("suffix-array dedup", substring_dedup),
          ("mixing", mixing), ("encoding", encoding)]

#: SQL can't express the hashes of stage 2, the byte spans of stage 3 and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, sf_dir), "pipeline-documents")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
