"""Benchmark decontamination by training suffix arrays.

1. The documents are cut into shards of whole texts (a text of more than ``SHARD_WORDS`` words into pieces). A shard's
   words are numbered by the shard's own vocabulary, its suffix array (by words) is built, and the shard is written as
   one row: it doesn't depend on the benchmark, so one index serves any number of test sets.
2. The test items are cut into blocks of at most ``BLOCK_BYTES``; a block is sent to all shards. In every shard every
   suffix of every item is binary-searched: the range of the suffix array is narrowed word by word, which gives its
   longest verbatim match and all places of it, and on the way all places of its first ``WINDOW`` words.
3. A document is affected if a window of an item occurs in it; ``clean_documents`` removes those.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. Items are
searched in segments of ``SEGMENT`` words, which overlap by a window less one word: no window is lost, and a match
is followed up to ``SEGMENT`` words. Pieces of a long text overlap likewise.

Defined results: a null text has no words; rows without doc_id and repeated rows are documents of their own; items are
told apart by item_id (rows with one id are one item; rows without id are one item, listed as an empty string); other
columns are ignored; no documents: no rows; no items: nothing is hit. Scale: no shuffle of texts. An index row is
about as large as its text, and some ``GROUP_BYTES`` of rows are written or read at once, however many a task has; what a
document sends on are its runs of hit words and its items. A window that very many documents share is one range of each
shard's array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, read, stage
from .suffix_array import longest_matches, suffix_array
from .terms import query_blocks, terms_of
from .textnum import slices, text_bytes

WINDOW = 10             # fixed by the contract
SHARD_BYTES = 2 << 20   # text of a shard
SHARD_WORDS = 1 << 20   # words of a shard: longer texts are cut
SEGMENT = 512
BLOCK_BYTES = 4 << 20   # of test items that are sent to the shards at once
GROUP_BYTES = 8 << 20   # of index rows that are written or read at once: a row group

# Parquet looks at the size of a group or page after 100 rows unless told otherwise, and a row is some MB here.
_FILES = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": False}

_SHARD = "rids binary, ids array<string>, begins binary, offsets binary, own binary, words binary, vocabulary binary, ends binary, sa binary"
_HIT = "rid long, id string, n_words long, spans array<struct<f:long,u:long>>, items array<string>, longest long"


def _shards(rids: np.ndarray, ids: list, text: pa.Array) -> Iterator[pa.RecordBatch]:
    """Index rows of some texts. A shard's words are laid one text after another with a zero after each."""
    words, first = terms_of(*text_bytes(text))
    n = np.diff(first)
    long_ = np.flatnonzero(n > SHARD_WORDS)
    cuts = [(np.setdiff1d(np.arange(len(n)), long_), None)]
    cuts += [(np.array([t]), a) for t in long_ for a in range(0, int(n[t]), SHARD_WORDS)]
    for texts, piece in cuts:
        if not len(texts):
            continue
        begin, own = (first[texts], n[texts]) if piece is None else (first[texts] + piece, np.array(
            [min(SHARD_WORDS, int(n[texts[0]]) - piece)]))
        size = own if piece is None else np.minimum(own + SEGMENT - 1, n[texts] - piece)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(size + 1, out=at[1:])
        slot = np.arange(size.sum()) + np.repeat(np.arange(len(texts)), size)
        place = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        whole = len(place) == len(words)
        coded = (words if whole else words.take(pa.array(place))).dictionary_encode()
        seq = np.zeros(at[-1], np.int32)
        seq[slot] = coded.indices.to_numpy() + 1
        sa = suffix_array(seq)
        if piece is not None:
            sa = sa[sa < own[0]]   # the overlap belongs to the next piece
        vocabulary, ends = text_bytes(coded.dictionary)
        offsets = np.zeros(len(texts), np.int64) if piece is None else np.array([piece], np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([x.tobytes()], pa.binary()) for x in (rids[texts],)),
             pa.array([[ids[t] for t in texts]], pa.list_(pa.string())),
             *(pa.array([x.tobytes()], pa.binary()) for x in (
                 at, offsets, own.astype(np.int64), seq, vocabulary, ends.astype(np.int64), sa))],
            ["rids", "ids", "begins", "offsets", "own", "words", "vocabulary", "ends", "sa"])


def build_index(docs: DataFrame) -> DataFrame:
    """The stored shards of ``docs`` (rid: long, id: string, text). ``rid`` tells rows apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(2), SHARD_BYTES):
                p = b.slice(lo, hi - lo)
                yield from _shards(p.column(0).to_numpy(zero_copy_only=False), p.column(1).to_pylist(), p.column(2))

    return stage(docs.select("rid", "id", "text").mapInArrow(run, _SHARD), "op13-shards", _FILES)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, window, text, size): segments of the items (id: string, text), words joined by a space."""
    for b in batches:
        words, first = terms_of(*text_bytes(b.column(1)))
        ids = b.column(0).to_pylist()
        item, window, text = [], [], []
        for i, (a, z) in enumerate(zip(first[:-1], first[1:])):
            for s in range(a, z, SEGMENT - WINDOW + 1):
                if s > a and z - s < WINDOW:
                    break
                item.append(ids[i] or "")
                window.append(min(WINDOW, int(z - s)))
                text.append(" ".join(words[s:min(z, s + SEGMENT)].to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.string()), pa.array(window, pa.int32()), pa.array(text, pa.string()),
             pa.array([len(t.encode()) for t in text], pa.int64())], ["item", "window", "text", "size"])


def _search(row: dict, items: pa.Array, window: np.ndarray, words: pa.Array, begins: np.ndarray,
            all_rows: bool) -> pa.RecordBatch:
    """Hits of one block of segments (``words`` from ``begins`` on) in one shard."""
    def col(name, kind):
        return np.frombuffer(row[name], kind)

    rids, at, offsets, own = (col(c, np.int64) for c in ("rids", "begins", "offsets", "own"))
    seq, sa = col("words", np.int32), col("sa", np.int32)
    ends = col("ends", np.int64)
    vocabulary = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(row["ends"]), pa.py_buffer(row["vocabulary"]))
    code = pc.index_in(words, value_set=vocabulary).fill_null(-2).to_numpy() + 1
    part = np.repeat(np.arange(len(window)), np.diff(begins))
    query = np.zeros(len(words) + len(window), np.int32)
    slot = np.arange(len(words)) + part
    query[slot] = code
    asked = np.zeros(len(query), np.int64)
    asked[slot] = window[part]
    owner = np.zeros(len(query), np.int64)
    owner[slot] = part
    length, lo, hi, wlo, whi = longest_matches(seq, sa, query, asked)

    text_of = np.searchsorted(at, np.arange(at[-1]), "right") - 1 if len(at) > 1 else np.zeros(0, np.int64)
    hit = np.flatnonzero(wlo < whi)
    change = np.zeros(len(seq) + 1, np.int64)
    ranges: dict[tuple[int, int, int], set[int]] = {}
    for j in hit:   # equal windows have one range
        ranges.setdefault((int(wlo[j]), int(whi[j]), int(asked[j])), set()).add(int(owner[j]))
    texts_of_range = {}
    for a, b, w in ranges:
        p = sa[a:b].astype(np.int64)
        change += np.bincount(p, minlength=len(change)) if len(p) > len(change) // 8 else 0
        if len(p) <= len(change) // 8:
            np.add.at(change, p, 1)
        np.add.at(change, p + w, -1)
        texts_of_range[a, b, w] = np.unique(text_of[p])
    longest = np.zeros(len(rids), np.int64)
    for a, b, n in {(int(lo[j]), int(hi[j]), int(length[j])) for j in hit}:
        np.maximum.at(longest, text_of[sa[a:b]], n)
    covered = np.cumsum(change)[:len(seq)] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    f, u = edge[::2], edge[1::2]     # a zero parts texts, so no run crosses them
    run_text = text_of[f]
    per_item: dict[int, list[np.ndarray]] = {}
    for r, owners in ranges.items():
        for s in owners:
            per_item.setdefault(s, []).append(texts_of_range[r])
    pair_text, pair_item = [np.zeros(0, np.int64)], []
    for s, found in per_item.items():
        t = np.unique(np.concatenate(found))
        pair_text.append(t)
        pair_item += [items[s].as_py()] * len(t)
    pair_text = np.concatenate(pair_text)
    by = np.argsort(pair_text, kind="stable")
    keep = np.arange(len(rids)) if all_rows else np.unique(pair_text)
    span = pa.StructArray.from_arrays([pa.array(f - at[run_text] + offsets[run_text]), pa.array(u - at[run_text] + offsets[run_text])],
                                      ["f", "u"])
    spans = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(run_text, np.arange(len(rids))), len(f)), pa.int32()), span)
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(np.searchsorted(pair_text[by], np.arange(len(rids))), len(by)), pa.int32()),
        pa.array(pair_item, pa.string()).take(pa.array(by)))
    ids = pa.array(row["ids"], pa.string())
    n_words = own if all_rows else np.zeros(len(rids), np.int64)
    whole = pa.RecordBatch.from_arrays([pa.array(rids), ids, pa.array(n_words), spans, lists, pa.array(longest)],
                                       ["rid", "id", "n_words", "spans", "items", "longest"])
    return whole.take(pa.array(keep))


def search(index: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of ``index``: rid, id, n_words, spans (runs of hit words: array of (from, until)), items
    (ids of ``items`` (id: string, text) with a window in the document, sorted) and longest, the words of its longest
    verbatim match."""
    def over(block: pa.Table | None, all_rows: bool) -> DataFrame:
        if block is None:
            block = pa.table({"item": pa.array([], pa.string()), "window": pa.array([], pa.int32()),
                              "text": pa.array([], pa.string())})
        texts, names = block["text"].combine_chunks(), block["item"].combine_chunks()
        window = block["window"].to_numpy().astype(np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, begins = terms_of(*text_bytes(texts))
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1).to_pylist()[0]
                    yield _search(row, names, window, words, begins, all_rows)

        return index.mapInArrow(run, _HIT)

    found: list[DataFrame] = []
    for block in query_blocks(items.select("id", "text"), _segments, "item string, window int, text string, size long",
                              block_bytes, "op13-items"):
        found.append(stage(over(block, not found), "op13-hits"))
    if not found:
        found.append(over(None, True))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    per = rows.groupBy("rid").agg(F.max("id").alias("id"), F.sum("n_words").alias("n_words"),
                                  F.flatten(F.collect_list("spans")).alias("spans"),
                                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                  F.max("longest").alias("longest"))
    return per.withColumn("spans", F.array_sort("spans"))


def n_hit(spans) -> F.Column:
    """Number of words in the union of the sorted runs ``spans``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), s["u"] - F.greatest(s["f"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["u"]).alias("end")))["n"]


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, others) in which no window of ``items`` (item_id, text) occurs."""
    rows = keyed(docs, *docs.columns)
    index = build_index(rows.select("rid", F.col("doc_id").cast("string").alias("id"), "text"))
    hit = search(index, _items(items)).where(F.size("items") > 0).select("rid")
    return rows.join(hit, "rid", "left_anti").drop("rid")


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("id"), "text")


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("string").alias("id"), "text")
    found = search(build_index(docs), _items(read(spark, sf_dir, "benchmark")))
    return found.select(F.col("id").cast("long").alias("doc_id"), "n_words", n_hit(F.col("spans")).alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("items") > 0).alias("contaminated"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
it AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS k, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
        FROM it, LATERAL unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS u(i) WHERE len(w) > 0),
pos AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT rid, w, k FROM d, (SELECT DISTINCT k FROM win)), LATERAL unnest(range(1, len(w) - k + 2)) AS u(i)),
hit AS (SELECT DISTINCT rid, k, i, item FROM pos JOIN win USING (k, g)),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM hit, LATERAL unnest(range(0, k)) AS v(j) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
