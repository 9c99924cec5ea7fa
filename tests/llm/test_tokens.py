"""SentencePiece and wavelet shards against the libraries, exact round trips, edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from .cases import DOCS, docs_of

from pyspark.sql import functions as F

from pulseward.llm import op2_pieces, op6_wavelet
from pulseward.llm.wavelet import WaveletMatrix

ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁a ▁▁", "\n\n", "x" * 3000, " " * 999 + "x", "the " * 500, "漢字😀\u0000é",
       "<s></s><0x0A><unk>", "don't stop, now.\nNew line\n\nand  two   three\t tabs", "<|endoftext|> x<|endoftext|>",
       "a \u00a0 b", "tail \n ", "café, naïve. Straße."]


def noise(n, letters, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=op2_pieces.model_path())


def test_encoding_and_decoding_equal_the_library(library):
    m = op2_pieces.load(op2_pieces.model_path())
    for t in ODD + noise(3000, " ▁ab\n\tThe1…é漢😀 of  ing", 1):
        ids = m.encode(t)
        assert ids == library.encode(t, add_eos=True), repr(t)
        assert m.decode(ids) == library.decode(ids), repr(t)
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(0, 32000), 2, 1]) for _ in range(rng.randint(0, 8))]
        assert m.decode(ids) == library.decode(ids), ids


def test_backtracking_really_backtracks(library):
    """Encodings in which the longest piece at some position isn't the one taken."""
    m = op2_pieces.load(op2_pieces.model_path())
    back = 0
    for t in noise(3000, "abcdeinrst", 3):
        unit = "▁" + t
        got = m.split(unit)
        assert "".join(got) == unit and got == m.merge(unit)
        longest = next((unit[:n] for n in range(len(unit), 0, -1) if unit[:n] in m.ids), unit[:1])
        back += got[0] != longest
    assert back > 50


def test_digest_query_and_operator(spark, tables, library):
    texts = [None, *ODD]
    d = tables(documents=(docs_of(texts) + [(None, "a b", None, None, None), (1, ODD[0], "en", "s", 0)], DOCS))
    rows = op2_pieces.op2_piece_round_trip(spark, d).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is None:
            continue
        ids = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    docs = spark.read.parquet(f"{d}/documents.parquet")
    enc = op2_pieces.encode_documents(docs, op2_pieces.model_path(), "doc_id")
    back = {r.doc_id: r.text for r in op2_pieces.decode_documents(enc, op2_pieces.model_path(), "doc_id").collect()}
    assert back[4] == "a" and back[0] == ""
    assert op2_pieces.round_trip_digests(docs.where("false"), op2_pieces.model_path()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 70_000])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n + top)
    a = rng.integers(0, top, n)
    w = WaveletMatrix.from_bytes(WaveletMatrix.build(a).to_bytes())
    assert (w.decode() == a).all()
    assert all(w.access(int(i)) == a[i] for i in range(0, n, 37))
    for t in [*set(a[:8].tolist()), top + 3]:
        at = np.flatnonzero(a == t)
        assert w.count(t) == len(at) and w.count(t, n // 3, n) == (at >= n // 3).sum()
        assert all(w.locate(t, k) == at[k] for k in range(0, len(at), 1 + len(at) // 6))
        assert w.locate_all(t).tolist() == at.tolist()
        with pytest.raises(IndexError):
            w.locate(t, len(at))


def test_chunk_encoder_equals_the_library():
    e = op6_wavelet.encoder(op6_wavelet.tokenizer_path())
    letters = ["a", "b", " ", " ", "\n", "\t", "'s", "1", "é", "漢", "😀", ".", ",", "!!", "\u00a0", "<|endoftext|>", "\r"]
    for t in ODD + noise(5000, letters, 4):
        got = np.frombuffer(e.encode(t), "<u4").tolist()
        assert got == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_are_cut_only_where_the_library_cuts():
    e = op6_wavelet.PieceEncoder(op6_wavelet.tokenizer_path())
    letters = ["a", "Z", " ", "\n", "\t", "\x1c", "\x85", "\u2003", "\u3000", "'", "'s", "'re", "7", "²", "½", "_", "%", "×", "÷",
               "ß", "ſ", "ж", "\u0482", "\u0301", "\u200b", "“", "漢", "\x00"]
    texts = noise(3000, letters, 5)
    for t, ids in zip(texts, e.encode_all(pa.array(texts))):
        assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_word_is_encoded_once_whatever_follows_it():
    e = op6_wavelet.PieceEncoder(op6_wavelet.tokenizer_path())
    words, marks = [f"{a}é{b}" for a in "abcd" for b in "wxyz"], ["", ".", ",", "%%%", "***", "!?", "12"]
    text = "".join(f" {w}{m}" for w in words for m in marks)
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(e.known) <= len(words) + len(marks) + 1


@pytest.mark.parametrize("shard", [1, 50, 1 << 20])
def test_shards_round_trip_in_order(spark, tables, monkeypatch, shard):
    texts = [None, *ODD, *noise(60, "ab cd\né", 5)]
    rows = docs_of(texts)
    random.Random(6).shuffle(rows)
    d = tables(documents=(rows, DOCS))
    monkeypatch.setattr(op6_wavelet.shards, "__defaults__", (op6_wavelet.END_ID, shard))
    tok = op6_wavelet.encoder(op6_wavelet.tokenizer_path()).tokenizer
    start = 0
    for r in sorted(op6_wavelet.op6_wavelet_shards(spark, d).collect()):
        ids = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("shard", [1, 20, 1 << 20])
def test_documents_end_where_the_matrix_locates_the_end_id(spark, tables, monkeypatch, shard):
    """Also where a text holds the end id itself, and where rows of one doc_id are split among tasks."""
    monkeypatch.setattr(op6_wavelet.shards, "__defaults__", (op6_wavelet.END_ID, shard))
    tok = op6_wavelet.encoder(op6_wavelet.tokenizer_path()).tokenizer
    end = tok.id_to_token(op6_wavelet.END_ID)
    texts = ["plain", end, f"a {end}{end} b", "", None, f"{end} end"]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)] + [(9, f"copy {i % 3}", "", "", 0) for i in range(300)]
    d = tables(documents=(rows, DOCS))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = op6_wavelet.stage(op6_wavelet.shards(spark.read.parquet(f"{d}/documents.parquet"), op6_wavelet.tokenizer_path()), "t")
        hot = stored.where(F.array_contains("doc_ids", 9)).select("part").distinct().count()
        out = sorted(op6_wavelet.op6_wavelet_shards(spark, d).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert hot > 1 and len(out) == len(rows)
    assert [r.doc_id for r in out] == sorted(r[0] for r in rows)
    start = 0
    for r in out:
        assert r.start == start
        start += r.n_tokens
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert [(r.n_tokens, r.ids_crc32) for r in out[:len(texts)]] == [
        (len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in ids]
    assert any(i.count(2) > 1 for i in ids)


def test_shards_of_repeated_and_missing_ids_and_of_nothing(spark, tables):
    d = tables(documents=([(None, "x", None, None, None), (3, "b", "", "", 1), (3, "a", "", "", 1), (1, None, "", "", 0)], DOCS))
    out = sorted((r.start, r.doc_id, r.n_tokens) for r in op6_wavelet.op6_wavelet_shards(spark, d).collect())
    assert out == [(0, None, 2), (2, 1, 1), (3, 3, 2), (5, 3, 2)]
    empty = spark.read.parquet(f"{d}/documents.parquet").where("false")
    assert op6_wavelet.shards(empty, op6_wavelet.tokenizer_path()).count() == 0
