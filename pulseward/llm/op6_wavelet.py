"""Token ids written as wavelet matrices, one per shard, and read back.

Documents are put in ascending doc_id order (rows without doc_id first, equal ids by hash of the text, then by row
number, so that rows of one id are split too) by a range partitioning;
each task encodes its texts, appends the end id and closes a shard once it holds ``shard_tokens`` ids, so a shard is
whole documents. Shards are rows of a Parquet table in the shared folder, so that any store Spark reads can hold them
and a lost task writes its shards again: (part, seq) in document order, the documents' ids, the number of token ids, and
``data``, the wavelet matrix (format in ``wavelet.py``). No lengths are stored: where documents end is found by selecting
the occurrences of the end id in the matrix; ``ends`` (the number of end ids in each document) is only there if a text
holds the end id itself.

Encoding gives exactly the ids of the tokenizers library. Texts are cut, for a few MB at once, where two neighbouring bytes
tell that the library's pattern starts a new piece (letters, digits, other characters, a space before any of them); a
cut that isn't sure isn't made. Each distinct piece goes to the library once and is remembered per Python worker, up to
``MAX_PIECES``: to its BPE model if it is a single piece for sure, else to its whole encoding, as does a text that holds a
special token.

Defined results: null text = empty text (the end id alone); rows without doc_id and repeated rows are documents of
their own; an empty table gives no shards and no rows. Starts are sums over two levels (shards of a part, parts), so
no task sees a row per document of the whole table.
"""

from __future__ import annotations

import json
import os
import re
import string
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stage
from .textnum import slices, text_bytes
from .wavelet import WaveletMatrix

END_ID = 2                 # fixed by the contract
SHARD_TOKENS = 1 << 20
MAX_PIECES = 1_000_000
AT_ONCE = 1 << 22     # bytes of text cut at once


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: Classes of bytes: letters, digits, other ASCII, the apostrophe, the space, other ASCII white space, white space beyond
#: ASCII and controls that not all libraries call white space, other characters.
_L, _N, _P, _Q, _S, _W, _U, _V = range(8)
#: First bytes of the two-byte characters U+00C0 to U+023F and U+0400 to U+047F, letters all but two.
_LETTER_LEADS = [*range(0xC3, 0xC9), 0xD0, 0xD1]
_CLASS = np.full(256, _V, np.uint8)
_CLASS[:128] = _P
for _c, _chars in ((_L, string.ascii_letters), (_N, string.digits), (_Q, "'"), (_S, " "), (_W, "\t\n\v\f\r"),
                   (_U, "\x1c\x1d\x1e\x1f")):
    _CLASS[[ord(x) for x in _chars]] = _c
_CLASS[_LETTER_LEADS] = _L
_LEAD = np.zeros(256, bool)
_LEAD[_LETTER_LEADS] = True
#: Pairs of classes that the library's pattern never has in one piece.
_CUT = np.zeros(64, bool)
for _a, _after in ((_L, (_N, _P, _Q, _S, _W)), (_N, (_L, _P, _Q, _S, _W)), (_P, (_L, _N, _S, _W)), (_Q, (_N, _S, _W)),
                   (_V, (_S, _W))):
    _CUT[[_a * 8 + _b for _b in _after]] = True
#: White space beyond ASCII: first byte -> the two bytes after it, or the one.
_SPACES: dict[int, list[int]] = {}
for _c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))):
    _SPACES.setdefault(_c.encode()[0], []).append(int.from_bytes(_c.encode()[1:], "big"))
#: A single piece of the pattern, told by characters whose class is known.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u023f\u0400-\u047f"
_ONE = re.compile(rf" ?(?:[{_LETTERS}]+|[0-9]+|[!-/:-@\[-`{{-~]+)")


def _byte_chars() -> dict[int, str]:
    """The characters that stand for bytes in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


def piece_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where pieces start that encode alone as they do in place: texts, and cuts that are sure from the bytes around."""
    kind = _CLASS[raw]
    two = np.flatnonzero(_LEAD[raw])
    kind[two + 1] = _L
    sign = two[(raw[two] == 0xC3) & ((raw[two + 1] == 0x97) | (raw[two + 1] == 0xB7))]   # multiplied by, divided by
    kind[sign] = kind[sign + 1] = _V
    for lead, rest in _SPACES.items():
        at = np.flatnonzero(raw == lead)
        size = 2 if lead < 0xE0 else 3
        code = raw[at + 1].astype(np.int64) if size == 2 else raw[at + 1].astype(np.int64) << 8 | raw[at + 2]
        at = at[np.isin(code, rest)]
        for k in range(size):
            kind[at + k] = _U
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = _CUT[kind[:-1] << np.uint8(3) | kind[1:]]
    start = off[:-1]
    cut[start] = True
    # A lone white space is a piece if neither neighbour is white space.
    lone = np.flatnonzero(kind == _W)
    lone = lone[cut[lone]]   # cut before it: after no white space, or at the start of the text
    after = kind[np.minimum(lone + 1, len(raw) - 1)]
    cut[lone[(after != _S) & (after != _W) & (after != _U)] + 1] = True
    cut[len(raw)] = False
    return np.flatnonzero(cut)


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) != (
                "ByteLevel", False, True):
            raise ValueError("pieces are those of a byte-level tokenizer without a normalizer")
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}     # piece -> its ids

    def _library(self, texts: list[str]) -> list[bytes]:
        return [_packed(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]

    def _learn(self, pieces: list[bytes]) -> None:
        texts = [p.decode() for p in pieces]
        match = _ONE.fullmatch
        one = [match(t) is not None for t in texts]
        plain = [t for t, x in zip(texts, one) if x]
        mapped = "\n".join(plain).encode().decode("latin-1").translate(_BYTE_CHARS).split(_BYTE_CHARS[10]) if plain else []
        tokenize = self.model.tokenize
        ids = iter([_packed([k.id for k in tokenize(m)]) for m in mapped])
        rest = iter(self._library([t for t, x in zip(texts, one) if not x]))
        self.known.update((p, next(ids if x else rest)) for p, x in zip(pieces, one))

    def encode_all(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for lo, hi in slices(column, AT_ONCE):
            part = column.slice(lo, hi - lo).fill_null("")
            whole: dict[int, np.ndarray] = {}
            for s in self.special:
                if pc.any(held := pc.match_substring(part, s)).as_py():
                    for k in np.flatnonzero(held.to_numpy(zero_copy_only=False)).tolist():
                        whole[k] = np.frombuffer(self._library([part[k].as_py()])[0], "<u4")
                    part = pc.if_else(held, "", part)
            raw, off = text_bytes(part)
            for k, ids in enumerate(self._pieces(raw, off)):
                yield whole.get(k, ids)

    def _pieces(self, raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        if not len(raw):
            return [np.zeros(0, "<u4")] * (len(off) - 1)
        at = piece_starts(raw, off)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)]).dictionary_encode()
        kind = pieces.indices.to_numpy()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > MAX_PIECES:
            self.known.clear()
        ids = list(map(self.known.get, distinct))
        if None in ids:
            self._learn([p for p, x in zip(distinct, ids) if x is None])
            ids = list(map(self.known.get, distinct))
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        each = n[kind]
        end = np.cumsum(each)
        out = np.frombuffer(b"".join(ids), "<u4")[
            np.repeat((np.cumsum(n) - n)[kind] - (end - each), each) + np.arange(end[-1])]
        bound = np.append(0, end)[np.searchsorted(at, off)]
        return [out[x:y] for x, y in zip(bound[:-1].tolist(), bound[1:].tolist())]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return next(self.encode_all(pa.array([text], pa.string()))).tobytes()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def shards(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(part, seq, doc_ids, ends, n, data) of ``docs`` (doc_id, text)."""
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs_in: list[int | None] = []
        ends: list[int] = []
        held = 0

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([docs_in], pa.list_(pa.int64())),
                 pa.array([ends if max(ends) > 1 else None], pa.list_(pa.int64())), pa.array([matrix.n], pa.int64()),
                 pa.array([matrix.to_bytes()], pa.binary())],
                ["part", "seq", "doc_ids", "ends", "n", "data"])

        for b in batches:
            for doc, one in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                ids += [one, end]
                docs_in.append(doc)
                ends.append(int(np.count_nonzero(one == end_id)) + 1)
                held += len(one) + 1
                if held >= shard_tokens:
                    yield shard()
                    seq += 1
                    ids, docs_in, ends, held = [], [], [], 0
        if ids:
            yield shard()

    order = ["doc_id", "_hash", "_row"]   # the bounds' samples hold no texts
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return ordered.mapInArrow(run, "part long, seq long, doc_ids array<long>, ends array<long>, n long, data binary")


def document_ends(matrix: WaveletMatrix, docs: int, ends: list[int] | None, end_id: int = END_ID) -> np.ndarray:
    """Position after each document of a shard: after its last end id."""
    after = matrix.locate_all(end_id) + 1
    if ends is not None:
        after = after[np.cumsum(ends) - 1]
    if len(after) != docs or after[-1] != matrix.n:
        raise ValueError("the end ids don't fit the documents")
    return after


def read_back(stored: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(part, seq, doc_id, offset, n_tokens, ids_crc32) of every document, decoded from the shards' planes and cut at the
    end ids that they locate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, doc_ids, ends, data in zip(*b.columns):
                matrix = WaveletMatrix.from_bytes(data.as_py())
                end = document_ends(matrix, len(doc_ids), ends.as_py(), end_id)
                n = np.diff(end, prepend=0)
                raw = matrix.decode().astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(end.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(n), pa.int64()), pa.array([seq.as_py()] * len(n), pa.int64()),
                     pa.array(doc_ids.as_py(), pa.int64()), pa.array(end - n), pa.array(n), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])

    return stored.select("part", "seq", "doc_ids", "ends", "data").mapInArrow(
        run, "part long, seq long, doc_id long, offset long, n_tokens long, ids_crc32 long")


def shard_starts(stored: DataFrame) -> DataFrame:
    """(part, seq, base): ids before each shard, summed within parts and then over the parts."""
    size = stored.select("part", "seq", "n")
    parts = size.groupBy("part").agg(F.sum("n").alias("n"))
    base = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = size.select("part", "seq", F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("inside"))
    return stage(own.join(base, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("base")),
                 "op6-starts")


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stage(shards(read(spark, sf_dir, "documents"), tokenizer_path()), "op6-shards")
    return read_back(stored).join(shard_starts(stored), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
