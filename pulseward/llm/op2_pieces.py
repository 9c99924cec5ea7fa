"""SentencePiece encoding and decoding of a merge-type (BPE) model, exact, by backtracking.

A unit of text (a run of ``▁`` with the characters up to the next ``▁``; no piece of such a model spans two units,
which is checked on loading) is encoded without a merge queue over the whole text: an Aho-Corasick automaton finds
the pieces starting at each position, the longest is tried first, a piece is accepted after another if merging the
two pieces' characters anew gives just these two, and a bit field holds positions from which no encoding exists.
The single encoding whose neighbours are all compatible is the one that merging finds. Pieces that share a score
have no order among themselves; a unit that holds one is merged directly. Characters without a piece become bytes.

Everything a task needs is the vocabulary file, whose path is a parameter; tasks share nothing, and a lost one is
run again. Encoded units and pair checks are remembered per Python worker, up to ``MAX_UNITS`` and ``MAX_PAIRS``
entries; beyond that they are computed again.

Defined results: a null or empty text encodes as the end id alone and decodes to an empty text; null ids and
repeated rows are kept as they are; other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

MAX_UNITS = 500_000
MAX_PAIRS = 1_000_000
SPACE_MARK = "▁"


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _bytes_as_marks(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (e.end - e.start), e.end


codecs.register_error("each-byte", _bytes_as_marks)


class PieceModel:
    """Vocabulary, merge order, encoder and decoder of one model file."""

    NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6   # piece types of the file format (fixed values)

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or n.precompiled_charsmap or n.remove_extra_whitespaces:
            raise ValueError("a merge-type model with the identity normalizer is needed")
        self.dummy_prefix = n.add_dummy_prefix
        self.end_id = next(i for i, p in enumerate(m.pieces) if p.piece == "</s>")
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == self.NORMAL}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids):
            raise ValueError("a piece spans two units")
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == self.BYTE}
        self.score = {p: m.pieces[i].score for p, i in self.ids.items()}
        seen: dict[float, int] = {}
        for p, s in self.score.items():
            if len(p) > 1:
                seen[s] = seen.get(s, 0) + 1
        self.tied = {p for p, s in self.score.items() if seen.get(s, 0) > 1}
        self.control = {i for i, p in enumerate(m.pieces) if p.type == self.CONTROL}
        self.surface = [m.trainer_spec.unk_surface.encode() if p.type == self.UNKNOWN else bytes([int(p.piece[3:5], 16)]) if p.type == self.BYTE
                        else p.piece.replace(SPACE_MARK, " ").encode() for p in m.pieces]
        self.decimal = [str(i) for i in range(len(m.pieces))]
        self.pair: dict[tuple[str, str], bool] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.marked = {i for p, i in self.ids.items() if p[0] == SPACE_MARK}
        # pieces of one character always match; a piece that merging its own characters doesn't give never appears
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1 and (p in self.tied or len(self.merge(p)) == 1):
                self.automaton.add_word(p, (len(p), p, p in self.tied))
        self.automaton.make_automaton()

    def merge(self, s: str) -> list[str]:
        """Pieces of ``s`` by merging: always the pair with the best score, the leftmost among equals."""
        sym: list[str] = list(s)
        left, right = list(range(-1, len(s) - 1)), list(range(1, len(s) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i] if i >= 0 else len(sym)
            if i >= 0 and j < len(sym) and (score := self.score.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-score, i, sym[i] + sym[j]))

        for i in range(len(sym) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if not sym[i] or j >= len(sym) or sym[i] + sym[j] != joined:
                continue   # one of the two has been merged meanwhile
            sym[i], sym[j] = joined, ""
            right[i] = right[j]
            if right[j] < len(sym):
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [x for x in sym if x]

    def _compatible(self, a: str, b: str) -> bool:
        if (known := self.pair.get((a, b))) is None:
            if len(self.pair) >= MAX_PAIRS:
                self.pair.clear()
            known = self.pair[a, b] = self.merge(a + b) == [a, b]
        return known

    def split(self, unit: str) -> list[str]:
        """The pieces of one unit, by backtracking."""
        n = len(unit)
        starting: list[list[str]] = [[] for _ in range(n)]
        for end, (size, p, tied) in self.automaton.iter(unit):
            if tied:
                return self.merge(unit)
            starting[end + 1 - size].append(p)   # ends ascend, so the longest comes last
        out: list[str] = []
        tries: list[int] = [len(starting[0])]   # per open position: how many candidates are left; -1: none
        failed, pos, pair = 0, 0, self.pair
        while pos < n:
            at, k = starting[pos], tries[-1]
            while k >= 0:
                p = at[k - 1] if k else unit[pos]
                k -= 1
                if failed >> (pos + len(p)) & 1:
                    continue
                if out and not (pair[out[-1], p] if (out[-1], p) in pair else self._compatible(out[-1], p)):
                    continue
                tries[-1] = k
                out.append(p)
                pos += len(p)
                tries.append(len(starting[pos]) if pos < n else 0)
                break
            else:
                failed |= 1 << pos
                tries.pop()
                pos -= len(out.pop())
        return out

    def _unit_ids(self, unit: str) -> tuple[int, ...]:
        out: list[int] = []
        for p in self.split(unit):
            i = self.ids.get(p)
            if i is None:
                out.extend(self.byte_id[b] for b in p.encode())
            else:
                out.append(i)
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of the text, with the end id."""
        if not text:
            return [self.end_id]
        if len(self.units) > MAX_UNITS:
            self.units.clear()
        if "  " in text or SPACE_MARK in text or text[0] == " " or not self.dummy_prefix:
            marked = (SPACE_MARK if self.dummy_prefix else "") + text.replace(" ", SPACE_MARK)
            units = re.findall(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+", marked)
            found = {u: self._unit_ids(u) for u in set(units)}
            return [*chain.from_iterable(map(found.__getitem__, units)), self.end_id]
        units = text.split(" ")
        known = self.units
        for u in set(units).difference(known):
            known[u] = self._unit_ids(SPACE_MARK + u)
        return [*chain.from_iterable(map(known.__getitem__, units)), self.end_id]

    def decode(self, ids: list[int]) -> str:
        if len(ids) > 0 and ids[-1] == self.end_id:
            ids = ids[:-1]
        if self.control.isdisjoint(ids):
            sections: list = [ids]
        else:   # a control id ends a run of bytes
            sections = [list(g) for c, g in groupby(ids, self.control.__contains__) if not c]
        raw = [b"".join(map(self.surface.__getitem__, x)) for x in sections]
        if self.dummy_prefix and sections and len(sections[0]) and sections[0][0] in self.marked:
            raw[0] = raw[0][1:]
        return "".join([x.decode("utf-8", "each-byte") for x in raw])


_MODELS: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model, loaded once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str, *columns: str, decoded: bool = False) -> DataFrame:
    """``columns`` of every row, ``ids`` (with the end id) and ``n_tokens``. With ``decoded`` also ``decoded``, the text
    that the ids give when they are decoded again."""
    from pyspark.sql import types as T
    kept = docs.select(*columns, "text")
    more = [T.StructField("decoded", T.StringType())] if decoded else []
    schema = T.StructType([*kept.drop("text").schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = [model.encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
                again = [pa.array([model.decode(i) for i in ids], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64()), *again],
                    schema.fieldNames())

    return kept.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, *columns: str) -> DataFrame:
    """``columns`` of every row of ``encoded`` and ``text``, decoded from ``ids`` (null ids: empty text)."""
    from pyspark.sql import types as T
    kept = encoded.select(*columns, "ids")
    schema = T.StructType([*kept.drop("ids").schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for b in batches:
            texts = [model.decode(i or []) for i in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*columns, "text"])

    return kept.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, without moving the ids out of the task."""
    kept = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for b in batches:
            n, a, d = [], [], []
            for t in b.column(1):
                ids = model.encode(t.as_py())
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(model.decimal.__getitem__, ids)).encode()).hexdigest())
                d.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                                              pa.array(d, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return kept.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read(spark, sf_dir, "documents"), model_path())
