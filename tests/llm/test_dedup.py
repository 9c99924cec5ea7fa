"""Near duplicates and suffix-array dedup against brute force; planted cases; edge cases."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from .cases import DOCS, docs_of

from pulseward.llm import op3_dart, op9_suffix, textnum
from pulseward.llm.common import keyed
from pulseward.llm.components import components
from pulseward.llm.deep_shallow import deep_shallow


def test_word_hashes_in_pieces(monkeypatch):
    monkeypatch.setattr(textnum, "PIECE", 64)
    textnum._tables.cache_clear()
    rng = random.Random(0)
    try:
        for _ in range(300):
            texts = [rng.choice([None, "", "x" * rng.randint(50, 300), " " * 70,
                                 "".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 30)))]) for _ in range(6)]
            h, first = textnum.word_hashes(*textnum.text_bytes(pa.array(texts, pa.string())))
            words = [(t or "").translate(str.maketrans("\n\t", "  ")).split(" ") for t in texts]
            words = [[w for w in ws if w] for ws in words]
            assert list(np.diff(first)) == [len(w) for w in words]
            known = {}
            assert all(known.setdefault(w, x) == x for w, x in zip([w for ws in words for w in ws], h))
            assert len(set(known.values())) == len(known)
    finally:
        textnum._tables.cache_clear()


def test_signatures_agree_like_the_similarity():
    rng = np.random.default_rng(0)
    e = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    wa = rng.uniform(0.1, 9, 300)
    wb = wa * rng.uniform(0.3, 1.5, 300)
    sig = op3_dart.dart_signatures(np.concatenate([e, e]), np.array([0, 300, 600]), np.concatenate([wa, wb]), 4000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.03
    sig = op3_dart.dart_signatures(np.concatenate([e[:200], e[40:240]]), np.array([0, 200, 400]), None, 4000)
    assert abs((sig[0] == sig[1]).mean() - 160 / 240) < 0.03
    one = op3_dart.dart_signatures(e[:1], np.array([0, 0, 1]), None, 50)
    assert (one[0] == 0).all() and (one[1] != 0).all()


def classes(texts):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                r, s = root(a), root(b)
                parent[max(r, s)] = min(r, s)
    return [root(i) for i in range(len(texts))]


def near_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    texts = []
    for _ in range(150):    # many texts on either side of the threshold
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80))) for _ in range(40)]
    return texts + texts[150:160] + ["a b", "a b", "a c", None, "", " \n", None, "word " * 20_000, "word " * 20_001]


@pytest.mark.parametrize("block", [512, 20])
def test_near_duplicate_classes(spark, monkeypatch, block):
    monkeypatch.setattr(op3_dart, "BLOCK", block)
    texts = near_texts()
    alone = " ".join(f"only{i}" for i in range(40))
    more = [(None, texts[0], "", "", 0), (0, texts[0], "", "", 0), (None, alone, "", "", 0), (None, alone + " x", "", "", 0)]
    docs = spark.createDataFrame([(*r, 1) for r in docs_of(texts) + more], DOCS + ", class_id int")   # a clashing name
    out = op3_dart.near_duplicates(keyed(docs, "doc_id", "text")).collect()
    assert len(out) == len(texts) + 4
    got = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    assert [got[i] for i in range(len(texts))] == classes(texts)
    kept = [r.class_id for r in out if r.keep and r.class_id is not None]
    assert sorted(kept) == sorted(set(classes(texts)))   # one row of each class, whether it has a doc_id or not
    assert [r.keep for r in out if r.class_id is None].count(True) == 1 and sum(r.class_id is None for r in out) == 2


def test_no_documents(spark):
    none = keyed(spark.createDataFrame([], DOCS), "doc_id", "text")
    assert op3_dart.near_duplicates(none).count() == 0
    assert op9_suffix.without_repeats(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 400)]
    got = {r.a: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        r, s = root(a), root(b)
        parent[max(r, s)] = min(r, s)
    assert got == {x: root(x) for e in links if e[0] != e[1] for x in e}


def test_deep_shallow_order():
    rng = random.Random(0)
    for _ in range(400):
        base = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60)))
        strings = [base[:rng.randint(0, len(base))] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 50)))
                   for _ in range(rng.randint(1, 60))]
        order, lcp = deep_shallow(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        assert all(lcp[k] == len(os.path.commonprefix([strings[order[k - 1]], strings[order[k]]]))
                   for k in range(1, len(order)))


def brute(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - width + 1):
            seen[b[i:i + width]] = seen.get(b[i:i + width], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def spans_texts():
    rng = random.Random(5)

    def some(n):
        return "".join(rng.choice("abcdeé ") for _ in range(n))

    passages = [some(600) for _ in range(5)]
    texts = []
    for _ in range(70):
        parts = [some(rng.randint(0, 500)) for _ in range(3)] + rng.choices(passages, k=rng.randint(0, 2))
        if rng.random() < 0.2:
            parts.append("ab " * rng.randint(10, 400))
        if rng.random() < 0.3:
            p = list(rng.choice(passages))
            p[rng.randint(0, 599)] = "Z"
            parts.append("".join(p))
        rng.shuffle(parts)
        texts.append("".join(parts))
    return texts + [None, "", "x" * 399, "y" * 401, "z" * 400, some(30_000)] + texts[:3]


@pytest.mark.parametrize("max_group,chunk,width,gram", [(4000, 1 << 18, 400, 256), (2, 1 << 18, 400, 256), (4000, 700, 400, 256),
                                                        (4000, 1 << 18, 200, 64), (2, 1 << 18, 200, 64), (3, 700, 37, 8)])
def test_repeated_bytes_against_brute_force(spark, tables, monkeypatch, max_group, chunk, width, gram):
    monkeypatch.setattr(op9_suffix, "CHUNK", chunk)     # read by the driver only; workers keep the default
    texts = spans_texts()
    d = tables(documents=([(*r, b"x") for r in docs_of(texts)], DOCS + ", spans binary"))   # a clashing name
    monkeypatch.setattr(op9_suffix.without_repeats, "__defaults__", (width, max_group, False, (), gram))
    out = {r.doc_id: r for r in op9_suffix.op9_suffix_dedup(spark, d).collect()}
    assert [(out[i].n_bytes, out[i].n_removed, out[i].n_spans, out[i].kept_sha256) for i in range(len(texts))] == \
        brute(texts, width)
    for i in range(len(texts)):
        if not out[i].n_removed:
            assert out[i].kept_text == (texts[i] or "")


def test_passages_shorter_than_the_width_are_told(spark, tables):
    """Words of five bytes: passages of 51 of them are shorter than 400 bytes, which alone are removed."""
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    passage, long = words(51), words(120)
    texts = [f"{words(30)} {passage} {words(20)}", f"{words(5)} {passage}", words(90), words(90), None, "",
             f"{words(9)} {long} {words(3)}", f"{passage} {words(2)} {long}"]
    d = tables(documents=(docs_of(texts), DOCS))
    out = {r.doc_id: r for r in op9_suffix.op9_suffix_dedup(spark, d).collect()}
    assert [(out[i].n_bytes, out[i].n_removed, out[i].n_spans, out[i].kept_sha256) for i in range(len(texts))] == \
        brute(texts, 400)
    assert [(out[i].n_bytes, out[i].n_passage_bytes, out[i].n_passages) for i in range(len(texts))] == \
        [x[:3] for x in brute(texts, op9_suffix.PASSAGE_BYTES)]
    assert [out[i].has_passages for i in range(len(texts))] == [True, True, False, False, False, False, True, True]
    assert [out[i].n_removed > 0 for i in range(len(texts))] == [False] * 6 + [True, True]


def test_anchor_chunks_do_not_change_windows(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 3000))) for _ in range(5)]
    raw, off = textnum.text_bytes(pa.array(texts))

    def covered():
        out = set()
        for t, lo, n, _, _, _, times in op9_suffix.anchors_of(raw, off, 400):
            for a, b, c, d in zip(t, lo, n, times):
                out |= {(int(a), int(b) + k) for k in range(int(c) * int(d))}
        return out

    want = {(t, i) for t, x in enumerate(texts) for i in range(len(x) - 399)}
    assert covered() == want
    monkeypatch.setattr(op9_suffix, "CHUNK", 300)
    assert covered() == want


def test_text_results_drop_cut_characters(spark):
    p = "é" * 300
    texts = ["a" + p + "tail", "ê"[:1] + p + "tail2", None]
    docs = keyed(spark.createDataFrame(docs_of(texts), DOCS), "doc_id", "text")
    out = {r.doc_id: r for r in op9_suffix.without_repeats(docs, as_text=True, carry=("doc_id",)).collect()}
    assert out[2].kept is None and not out[2].spans
    assert out[0].kept.startswith("a") and "�" not in out[0].kept + out[1].kept
