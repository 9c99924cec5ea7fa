"""Cross-entropy difference: every document is scored under a target and a background word-bigram model.

The target corpus is the documents labelled good, the background corpus is all documents. The models are matched: one
vocabulary (all distinct words of the corpus; words and word pairs are counted exactly, by 64-bit hash), one order, the
same smoothing (pairs backed off to words with ``MU``, words to the uniform distribution with ``DELTA``), and background
counts scaled to the target's number of words. The score is the mean over a text's words of the target's loss less the
background's (nats); the lower, the more like the target. A text is scored by models that leave it out: its own words
and pairs are taken off the counts and the number of words of the background and, if it is in it, of the target. ``word_bits`` and ``pair_bits`` under 64 count hash cells.

Counting: a task takes its texts in batches of about ``BATCH`` words and emits the distinct words and pairs of a batch
with both corpora's counts, cut into blocks of the hash range. A shuffle on the block brings equal keys together, where
they are summed; the totals of a batch's own keys go back to the batch, by a second shuffle that brings its texts,
compressed, as well (the texts are read once more for that), and there the texts are scored. So the tables grow with the corpus, no task holds more than a block of them and a batch, a word or pair in
every text is one key a batch, and the driver gets three sums. There are ``BLOCKS`` blocks, more beyond ``BLOCKS`` times
``BLOCK_CHARS`` characters of text. The texts are written once, so that a retried task sees the same batches.

Defined results: a text without words has n_tokens 0 and null losses and score; without a labelled good document, or
without any word, the target model is uniform; a doc_id with several labels counts as good if one is; rows without
doc_id are background only; repeated rows count each time; other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stage
from .textnum import mix, slices, text_bytes, word_hashes

WORD_BITS = 64
PAIR_BITS = 64
MU = 20.0
DELTA = 0.5
BATCH = 1 << 21
BLOCKS = 1 << 10
BLOCK_CHARS = 1 << 25
WORDS, PAIRS, DOCS = 0, 1, 2   # kinds of rows, in the order in which a batch is read
ROWS = "batch long, kind int, block int, a binary, b binary, c binary"


def token_ids(column: pa.Array, word_bits: int, pair_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, key of each word, key of its pair with the word before it, whether it is a text's first)."""
    h, first = word_hashes(*text_bytes(column))
    n = np.diff(first)
    pair = np.zeros(len(h), np.uint64)
    pair[1:] = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    head = np.zeros(len(h), bool)
    head[first[:-1][n > 0]] = True
    return n, _top(h, word_bits), _top(pair, pair_bits), head


def _top(h: np.ndarray, bits: int) -> np.ndarray:
    return h & np.uint64(((1 << bits) - 1) << (64 - bits))


def pack(a: np.ndarray, level: int = 1) -> bytes:
    """The bytes of ``a``, all first ones, all second ones, ..., compressed, after their number."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(planes, asbytes=True)


def unpack(data: pa.Scalar, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    data = data.as_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    raw = np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(kind).ravel()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["batch", "kind", "block", "a", "b", "c"])


def _cut(batches: Iterator[pa.RecordBatch], tokens) -> Iterator[tuple[int, list[tuple]]]:
    """(number of the batch, [(rows, ``tokens`` of their texts)]) of rows (doc_id, text, good, part); the first of
    ``tokens`` is the number of words of each text. A batch is the same in every call: the rows are those of a stored
    table, and the partition's number is that of its own scan."""
    batch, held, size = None, [], 0
    for b in batches:
        if batch is None and b.num_rows:
            batch = b.column(3)[0].as_py() << 33
        for lo, hi in slices(b.column(1)):
            part = b.slice(lo, hi - lo)
            held.append((part, tokens(part.column(1))))
            size += int(held[-1][1][0].sum())
            if size >= BATCH:
                yield batch, held
                batch, held, size = batch + 1, [], 0
    if held:
        yield batch, held


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "good", F.spark_partition_id().alias("part"))


def text_rows(docs: DataFrame) -> DataFrame:
    """``ROWS`` of kind ``DOCS`` of ``docs`` (doc_id, text, good), one per batch: bytes of the texts (a) and how many
    each has (b); doc_ids, whether they aren't null, and whether they are good (c)."""
    def counted(column: pa.Array) -> tuple[np.ndarray]:
        return (np.diff(word_hashes(*text_bytes(column))[1]),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in _cut(batches, counted):
            raw, sizes, info = [], [], []
            for part, _ in held:
                data, offsets = text_bytes(part.column(1))
                raw.append(data)
                sizes.append(np.diff(offsets))
                ids = part.column(0)
                info.append([x.astype(np.int64) for x in (
                    ids.fill_null(0).to_numpy(), *(x.to_numpy(zero_copy_only=False) for x in (ids.is_valid(), part.column(2))))])
            yield _rows([(batch, DOCS, 0, pack(np.concatenate(raw), 3), pack(np.concatenate(sizes)),
                          pack(np.concatenate([np.concatenate(x) for x in zip(*info)])))])

    return _numbered(docs).mapInArrow(run, ROWS)


def key_blocks(docs: DataFrame, word_bits: int, pair_bits: int, blocks: int, kinds: tuple[int, ...]) -> DataFrame:
    """``ROWS`` of ``docs`` (doc_id, text, good) of kinds ``WORDS``, ``PAIRS``: per batch and block the distinct keys,
    ascending, as differences (a) and their counts in the good texts (b) and in all (c)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in _cut(batches, lambda column: token_ids(column, word_bits, pair_bits)):
            good = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p, _ in held])
            n, word, pair, head = (np.concatenate(c) for c in zip(*(t for _, t in held)))
            held.clear()
            good = np.repeat(good, n)
            yield from cut(batch, WORDS, *np.unique(word, return_inverse=True), good)
            if PAIRS in kinds:
                yield from cut(batch, PAIRS, *np.unique(pair[~head], return_inverse=True), good[~head])

    def cut(batch: int, kind: int, keys: np.ndarray, at: np.ndarray, good: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        n, g = (np.bincount(x, minlength=len(keys)).astype(np.int32) for x in (at, at[good]))
        block = (keys >> np.uint64(64 - (blocks.bit_length() - 1))).astype(np.int64)
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        rows = [(batch, kind, int(block[lo]), pack(np.diff(keys[lo:hi], prepend=np.uint64(0))), pack(g[lo:hi]),
                 pack(n[lo:hi])) for lo, hi in zip(starts, [*starts[1:], len(keys)])]
        for k in range(0, len(rows), 512):
            yield _rows(rows[k:k + 512])

    return _numbered(docs).mapInArrow(run, ROWS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[int], list[int], list[np.ndarray]]]:
    """(kind, block, its batches, their numbers of keys, [index of each key, good counts, all counts of the distinct
    keys]) of sorted rows of ``key_blocks``."""
    def summed(key: tuple[int, int], held: list[tuple]):
        keys = [np.cumsum(unpack(a, np.uint64), dtype=np.uint64) for _, a, _, _ in held]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        good, n = (np.bincount(at, np.concatenate([unpack(r[i], np.int32) for r in held])).astype(np.int64)
                   for i in (2, 3))
        return *key, [r[0] for r in held], [len(k) for k in keys], [at, good, n]

    key, held = None, []
    for b in batches:
        for batch, kind, block, *data in zip(*(c.to_pylist() for c in b.columns[:3]), *b.columns[3:]):
            if (kind, block) != key:
                if held:
                    yield summed(key, held)
                key, held = (kind, block), []
            held.append((batch, *data))
    if held:
        yield summed(key, held)


def totals(words: DataFrame) -> tuple[int, int, int]:
    """(distinct words, words of the good texts, words of all texts), from the word rows of ``key_blocks``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, (_, good, n) in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (len(n), good.sum(), n.sum())],
                                             ["v", "good", "n"])

    one = words.repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(
        run, "v long, good long, n long").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("v", "good", "n")]).first()
    return one[0], one[1], one[2]


def add_up(keys: DataFrame) -> DataFrame:
    """``ROWS`` with the counts of the keys of ``key_blocks`` in the whole corpus, in good texts (a) and in all (b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, block, of, sizes, (at, good, n) in _blocks(batches):
            ends = np.cumsum(sizes)
            for k in range(0, len(of), 512):
                own = [(batch, at[end - size:end]) for batch, size, end in
                       zip(of[k:k + 512], sizes[k:k + 512], ends[k:k + 512])]
                yield _rows([(batch, kind, block, pack(good[x]), pack(n[x]), b"") for batch, x in own])

    return keys.repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(run, ROWS)


def own_counts(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each position how often its ``key`` occurs in its text."""
    _, at, n = np.unique(text.astype(np.int64) << 32 | key, return_inverse=True, return_counts=True)
    return n[at]


def losses(words: np.ndarray, pairs: np.ndarray, head: np.ndarray, scale: np.ndarray, total: np.ndarray,
           vocabulary: int, mu: float, delta: float) -> np.ndarray:
    """Loss of each word, from the counts of it and of its pair with the word before it (which, but at a text's head, is
    the one in the position before); counts and ``total``, the number of all words, are multiplied by ``scale``."""
    p = (words * scale + delta) / (total * scale + delta * vocabulary)
    q = (pairs * scale + mu * p) / (np.concatenate([words[:1], words[:-1]]) * scale + mu)
    return -np.log(np.where(head, p, q))


def score_documents(rows: DataFrame, vocabulary: int, good: int, n: int, word_bits: int = WORD_BITS,
                    pair_bits: int = PAIR_BITS, mu: float = MU, delta: float = DELTA) -> DataFrame:
    """Every text in ``rows`` (of ``add_up`` and ``text_rows``): doc_id, n_tokens, loss_target, loss_background, score."""
    total = (float(good), float(n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {WORDS: [], PAIRS: []}
        for b in batches:
            for kind, *data in zip(b.column(1).to_pylist(), *b.columns[3:]):
                if kind == DOCS:
                    yield score(counts, *data)
                    counts = {WORDS: [], PAIRS: []}
                else:
                    counts[kind].append(tuple(unpack(x, np.int64) for x in data[:2]))

    def score(counts: dict, texts: pa.Scalar, sizes: pa.Scalar, info: pa.Scalar) -> pa.RecordBatch:
        ids, valid, good = unpack(info, np.int64).reshape(3, -1)
        offsets = np.concatenate([[0], np.cumsum(unpack(sizes, np.int64))])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(unpack(texts, np.uint8))])
        n, word, pair, head = token_ids(column, word_bits, pair_bits)
        uw, word = np.unique(word, return_inverse=True)
        up, rank = np.unique(pair[~head], return_inverse=True)
        found = len(uw), len(up)
        if found != tuple(sum(len(c[0]) for c in counts[k]) for k in (WORDS, PAIRS)):
            raise ValueError("the counts are of another batch")
        pair = np.full(len(word), len(up))
        pair[~head] = rank
        del uw, up, rank
        text = np.repeat(np.arange(len(n)), n)
        own = own_counts(text, word), own_counts(text, pair)
        left = total[0] - n * good, total[1] - n
        # background counts are scaled to the target's number of words
        both = (left[0] > 0) & (left[1] > 0)
        scale = np.ones(len(n)), np.where(both, left[0] / np.maximum(left[1], 1), 1.0)
        sums = []
        for m, inside in ((0, good[text]), (1, 1)):
            ofw, ofp = (np.concatenate([*(c[m] for c in counts[k]), [0]]) for k in (WORDS, PAIRS))
            sums.append(np.bincount(text, losses(
                ofw[word] - own[0] * inside, np.where(head, 0, ofp[pair] - own[1] * inside), head, scale[m][text],
                left[m][text], vocabulary, mu, delta), len(n)))
        none = n == 0
        t, g = (s / np.maximum(n, 1) for s in sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=valid == 0), pa.array(n), pa.array(t, mask=none), pa.array(g, mask=none),
             pa.array(t - g, mask=none)], ["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    return rows.repartition("batch").sortWithinPartitions("batch", "kind", "block").mapInArrow(
        run, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")


def cross_entropy_difference(docs: DataFrame, target: DataFrame, word_bits: int = WORD_BITS,
                             pair_bits: int = PAIR_BITS) -> DataFrame:
    """``docs`` (doc_id, text) scored; ``target`` (doc_id) names the documents of the target corpus."""
    ids = stage(target.where("doc_id is not null").select("doc_id").distinct()
                .withColumn("good", F.lit(True)), "op10-target")
    # the list of good documents has no size bound: always a sort-merge join, so that the plan is one at every size
    marked = stage(docs.select(F.col("doc_id").cast("long"), "text").join(ids.hint("merge"), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("good", F.lit(False)).alias("good")), "op10-texts")
    chars = marked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(BLOCKS, 1 << (chars // BLOCK_CHARS).bit_length())
    _free_shuffles(marked)

    def rows(*kinds: int) -> DataFrame:
        return key_blocks(marked, word_bits, pair_bits, blocks, kinds)

    distinct, good, n = totals(rows(WORDS))
    _free_shuffles(marked)
    vocabulary = distinct if word_bits == 64 else 1 << word_bits
    return score_documents(text_rows(marked).unionByName(add_up(rows(WORDS, PAIRS))), vocabulary, good, n, word_bits, pair_bits)


def _free_shuffles(df: DataFrame) -> None:
    """Spark deletes the shuffle files of finished queries when the JVM collects garbage."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return cross_entropy_difference(docs, read(spark, sf_dir, "labels").where("quality = 1"))
