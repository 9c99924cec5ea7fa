"""Ranked lexical search by Block-Max MaxScore.

1. One pass counts the documents with terms and all terms: with them every document's length figure is known.
2. A second pass cuts the documents into shards of whole texts and writes each shard's inverted index as one row: its
   vocabulary, document frequencies and compressed posting blocks with their largest impacts (``maxscore``).
3. The items are cut into blocks of at most ``BLOCK_BYTES``; for a block the document frequencies of its terms are
   summed over the shards, and with these weights every shard is searched. Lists are parted by their bounds: those
   that can't reach the k-th best score even together are non-essential; candidates come from the others alone and
   are rejected by the block maxima of the non-essential lists before any of their blocks is decompressed.
4. The shards' best documents are merged (each task sends ``k`` at most for an item).

Terms, weights and scores are those of ``impact`` and ``weights``; all of it is 64-bit integer arithmetic but for the
logarithm. Defined results: a null text has no terms; documents without terms never match, and an item without terms
has no rows; rows without doc_id and repeated rows are documents of their own, those without doc_id last among equal
scores; repeated items are items of their own; other columns are ignored; no documents or no items: no rows. Scale: no
text is shuffled; an index row is about as large as its text. A term in very many documents is a list of blocks in
every shard, of which most are skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stage
from .maxscore import Postings, best_documents
from .terms import count_terms, query_blocks, terms_of
from .textnum import slices, text_bytes

K = 10                    # fixed by the contract
SHARD_BYTES = 16 << 20    # text of a shard
BLOCK_BYTES = 4 << 20     # of item terms that are sent to the shards at once

_POSTINGS = [name for name, _ in Postings.FIELDS]
_SHARD = "ids binary, has_id binary, vocabulary binary, ends binary, df binary, " + ", ".join(f"{n} binary" for n in _POSTINGS)


def counts(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all terms) of ``docs`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(0), SHARD_BYTES):
                n = count_terms(*text_bytes(b.column(0).slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["d", "t"])

    r = docs.select("text").mapInArrow(run, "d long, t long").agg(F.sum("d"), F.sum("t")).first()
    return r[0] or 0, r[1] or 0


def build_index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The stored shards of ``docs`` (doc_id: long, text); ``n_docs``, ``n_terms``: see ``counts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1), SHARD_BYTES):
                part = b.slice(lo, hi - lo)
                words, first = terms_of(*text_bytes(part.column(1)))
                n = np.diff(first)
                m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
                coded = words.dictionary_encode()
                docs_ = np.repeat(np.arange(len(n)), n)
                pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(n) + docs_, return_counts=True)
                term, doc = pair // len(n), pair % len(n)
                vocabulary, ends = text_bytes(coded.dictionary)
                df = np.bincount(term, minlength=len(coded.dictionary)).astype(np.int32)
                ids = part.column(0)
                cells = {"ids": ids.fill_null(0).to_numpy().astype(np.int64).tobytes(),
                         "has_id": ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                         "vocabulary": vocabulary.tobytes(), "ends": ends.astype(np.int64).tobytes(), "df": df.tobytes(),
                         **Postings.build(term, doc, tf, len(df), m).dump()}
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells.values()], list(cells))

    return stage(docs.select("doc_id", "text").mapInArrow(run, _SHARD), "op11-shards")


def _vocabulary(row: dict) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(row["ends"]) // 8 - 1, pa.py_buffer(row["ends"]), pa.py_buffer(row["vocabulary"]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def frequencies(index: DataFrame, terms: pa.Array) -> np.ndarray:
    """Number of documents that hold each of some distinct terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            at = pc.index_in(terms, value_set=_vocabulary(row))
            here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            df = np.frombuffer(row["df"], np.int32)[at.fill_null(0).to_numpy()[here]]
            yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(df.astype(np.int64))], ["t", "df"])

    found = index.select("vocabulary", "ends", "df").mapInArrow(run, "t long, df long").groupBy("t").agg(
        F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[found["t"].to_numpy()] = found["df"].to_numpy()
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, item_id, terms, size) of the items (item: long, item_id: long, text): their distinct terms."""
    for b in batches:
        words, first = terms_of(*text_bytes(b.column(2)))
        lists = [words[x:y].unique().to_pylist() for x, y in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(lists, pa.list_(pa.string())),
             pa.array([sum(len(w.encode()) + 4 for w in t) for t in lists], pa.int64())], ["item", "item_id", "terms", "size"])


def search(index: DataFrame, n_docs: int, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame | None:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of every row of ``items`` (item_id: long, text);
    None if there are no items."""
    def over(block: pa.Table) -> DataFrame:
        lists = block["terms"].combine_chunks()
        names, item_ids = block["item"].to_numpy(), block["item_id"].to_pylist()
        flat = lists.flatten().cast(pa.large_string()).dictionary_encode()
        terms, code = flat.dictionary, flat.indices.to_numpy()
        ends = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        weight = weights(frequencies(index, terms), n_docs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                p = Postings.load(row)
                ids, has = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["has_id"], np.uint8)
                order = np.empty(len(ids), np.int64)
                order[np.lexsort((ids, 1 - has))] = np.arange(len(ids))
                at = pc.index_in(terms, value_set=_vocabulary(row)).fill_null(-1).to_numpy()
                out = []
                for i in range(len(names)):
                    c = code[ends[i]:ends[i + 1]]
                    c = c[at[c] >= 0]
                    docs, scores = best_documents(p, at[c], weight[c], k, order)
                    out += [(int(names[i]), item_ids[i], int(ids[d]) if has[d] else None, int(s)) for d, s in zip(docs, scores)]
                col = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in col], ["item", "item_id", "doc_id", "score"])

        return stage(index.select("ids", "has_id", "vocabulary", "ends", *_POSTINGS).mapInArrow(
            run, "item long, item_id long, doc_id long, score long"), "op11-best")

    rows: DataFrame | None = None
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    for block in query_blocks(numbered, _item_terms, "item long, item_id long, terms array<string>, size long",
                              block_bytes, "op11-items"):
        part = over(block)
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return None
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs, n_terms = counts(docs)
    found = search(build_index(docs, n_docs, n_terms), n_docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
g AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(t) AS w FROM d) GROUP BY ALL),
it AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS t FROM benchmark),
iw AS (SELECT item, item_id, unnest(t) AS w FROM it),
wt AS (SELECT w, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS wt
       FROM (SELECT w, count(*) AS df FROM tf WHERE w IN (SELECT w FROM iw) GROUP BY w), g),
m AS (SELECT rid, doc_id, 100 - 90 + (90 * len(t)::BIGINT * n_docs) // n_terms AS m FROM d, g WHERE len(t) > 0),
s AS (SELECT item, item_id, doc_id, rid, sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM iw JOIN wt USING (w) JOIN tf USING (w) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, (row_number() OVER o)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
WINDOW o AS (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) QUALIFY rank <= {K}
"""
