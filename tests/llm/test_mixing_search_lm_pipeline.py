"""Mixing, the prefix forest, LM scoring and the pipeline: brute force, edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from .cases import DOCS, SMALL, docs_of

from pulseward.llm import op7_forest, op8_mixing, op10_lm
from pulseward.llm.textnum import mix


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame(rows, DOCS).withColumn("rid", F.monotonically_increasing_id())
    return op8_mixing.mixture(docs, **kw).collect()


def corpus():
    rows = []
    for s, n in (("a", 60), ("b", 12), (None, 5)):
        rows += [(len(rows) + i, " ".join(["w"] * (3 + i % 7)), "en", s, 0) for i in range(n)]
    return rows + [(900, None, "en", "a", 0), (901, "", "en", "empty", 0), (None, "x y", "en", "b", 0), (0, "w w w", "en", "a", 0)]


def test_mixture_repeats_within_the_limit_and_leaves_nothing_out(spark):
    rows = corpus()
    out = mixed(spark, rows, max_repeats=2.0, block_docs=4)
    used = Counter(r.rid for r in out)
    assert len(used) == len(rows) and max(used.values()) <= 3
    tokens = defaultdict(int)
    for r in rows:
        tokens[r[3]] += len((r[1] or "").split())
    per = defaultdict(int)
    text = {r.rid: r for r in spark.createDataFrame(rows, DOCS).withColumn("rid", F.monotonically_increasing_id()).collect()}
    for r in out:
        per[r.source] += len((text[r.rid].text or "").split())
    assert per["a"] == tokens["a"] and per["empty"] == 0
    assert 1.6 * tokens[None] <= per[None] <= 2 * tokens[None]
    assert all(0 <= r.mix_key <= 1 for r in out)
    again = {(r.rid, r.epoch, r.block, r.mix_key) for r in mixed(spark, rows, max_repeats=2.0, block_docs=4)}
    assert again == {(r.rid, r.epoch, r.block, r.mix_key) for r in out}


def test_one_block_hash_for_most_rows_is_dealt_by_row(spark):
    """Rows without doc_id, or with one repeated, hash to one block: its parts are bounded, nothing is lost or moved on."""
    rows = [(None, "w w", "en", "a", 0)] * 300 + [(7, "w", "en", "a", 0)] * 200 + [(i, "w w w", "en", "a", 0) for i in range(100, 140)]
    rows += [(1, "x " * 3000, "en", "b", 0), (None, None, "en", "b", 0)]
    out = mixed(spark, rows, max_repeats=2.0, block_docs=8)
    assert Counter(r.source for r in out if r.epoch == 0) == {"a": 540, "b": 2}
    tokens = 300 * 2 + 200 + 40 * 3
    words = {r.rid: len(r.text.split()) if r.text else 0 for r in spark.createDataFrame(rows, DOCS).withColumn(
        "rid", F.monotonically_increasing_id()).collect()}
    goal, at = {}, 0
    for source in "ab":
        whole = sum(n for rid, n in words.items() if rid in {r.rid for r in out if r.source == source})
        ordered = sorted((r for r in out if r.source == source), key=lambda r: (r.mix_key, words[r.rid] > 0))
        at = 0
        for r in ordered:      # a document starts where the one before it ended
            goal.setdefault(source, at / r.mix_key if r.mix_key else None)
            if r.mix_key:
                goal[source] = goal[source] or at / r.mix_key
                assert r.mix_key * goal[source] == pytest.approx(at)
            at += words[r.rid]
        assert whole == (tokens if source == "a" else 3000)
    blocks = [[r.block for r in sorted(out, key=lambda r: r.mix_key) if r.source == "a" and r.epoch == e] for e in (0, 1)]
    assert all(b == sorted(b) for b in blocks)


def test_budget_and_entropy(spark):
    rows = corpus()
    out = mixed(spark, rows, max_repeats=None, entropy=0.3, budget=120.0)
    total = sum(len((r[1] or "").split()) for r in rows if False)
    assert total == 0 and out
    docs = spark.createDataFrame(rows, DOCS)
    t = {}
    for r in rows:
        t[r[3]] = t.get(r[3], 0) + len((r[1] or "").split())
    src = docs.sparkSession.createDataFrame([(str(k), v, 1) for k, v in t.items()], "skey string, tokens long, docs long")
    k, most = op8_mixing.find_exponent(src, None, 0.3, 120.0)

    def entropy(a):
        w = np.array([v ** a for v in t.values() if v])
        w /= w.sum()
        return -(w * np.log(w)).sum()

    assert most == max(t.values())
    assert entropy(k / 1e6) <= 0.3 + 1e-9 or k == 1_000_000
    assert k == 1_000_000 or entropy((k - 1) / 1e6) > 0.3
    words = {i: len((r[1] or "").split()) for i, r in enumerate(rows)}
    assert sum(len((r.source or "")) >= 0 for r in out) == len(out) and sum(words.values()) > 120
    assert mixed(spark, []) == []


def test_forest_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(3000, 32)).astype(np.float32)
    v[1000:1500] = v[1000] + rng.normal(size=(500, 32)) * 0.05     # a hot group
    v[2000:2010] = v[2000]                                          # ties
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)]
    rows += [(5000, None), (5050, [0.0] * 32), (5100, [float("nan")] * 32), (5150, [None] * 32), (5200, []),
             (5250, [1.0, 2.0]), (None, rows[0][1]), (50, rows[50][1]), (5300, [float("inf")] * 32)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    out = op7_forest.nearest(df, F.col("vec_id") % 50 == 0, block=1000, chunk=16).collect()
    x = v.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    want, got = set(), {}
    for r in out:
        got[r.query_id, r["rank"]] = (r.vec_id, r.score)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id] / norm[r.query_id] / norm[r.vec_id]), abs=1e-12)
    for q in range(0, 3000, 50):
        s = x @ x[q] / norm / norm[q]
        s[q] = -9
        s = np.round(s, 12)
        for i in np.lexsort((np.arange(3000), -s))[:5]:
            want.add((q, i))
        assert [(q, k) in got for k in range(1, 6)] == [True] * 5 and (q, 6) not in got
    assert len({(q, a) for (q, _), (a, _) in got.items()} & want) >= 0.95 * len(want)
    assert [got[2000, k][0] for k in range(1, 6)] == [2001, 2002, 2003, 2004, 2005]
    assert {q for q, _ in got} == set(range(0, 3000, 50))


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (100, [0.5, 0.0])], "vec_id long, embedding array<double>")
    out = {(r.query_id, r["rank"]): r.vec_id for r in op7_forest.nearest(df, F.col("vec_id") % 50 == 0).collect()}
    assert out == {(0, 1): 100, (0, 2): 1, (100, 1): 0, (100, 2): 1}
    assert op7_forest.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def brute_lm(docs, good, word_bits, pair_bits):
    import pyarrow as pa
    from pulseward.llm.textnum import text_bytes, word_hashes

    def hashes(t):
        return word_hashes(*text_bytes(pa.array([t], pa.string())))[0].tolist()

    mask = (1 << 64) - 1
    seqs = {d: hashes(t) for d, t in docs}
    word = lambda h: h >> (64 - word_bits)
    pair = lambda a, b: int(mix(np.array([(a * 0x9E3779B97F4A7C15 + b) & mask], np.uint64))[0]) >> (64 - pair_bits)
    c1, c2 = [Counter(), Counter()], [Counter(), Counter()]
    for d, s in seqs.items():
        for m in ([0, 1] if d in good else [1]):
            c1[m].update(map(word, s))
            c2[m].update(pair(a, b) for a, b in zip(s, s[1:]))
    out = {}
    for d, s in seqs.items():
        one, two = Counter(map(word, s)), Counter(pair(a, b) for a, b in zip(s, s[1:]))
        holds = [d in good, True]   # the models leave the text out
        n = [sum(c.values()) - len(s) * h for c, h in zip(c1, holds)]
        scale = [1.0, n[0] / n[1] if n[0] and n[1] else 1.0]
        loss = []
        for m in (0, 1):
            total = 0.0
            w = {k: c1[m][k] - holds[m] * one[k] for k in one}
            for i, h in enumerate(s):
                p = (w[word(h)] * scale[m] + op10_lm.DELTA) / (n[m] * scale[m] + op10_lm.DELTA * (1 << word_bits))
                if i:
                    k = pair(s[i - 1], h)
                    p = ((c2[m][k] - holds[m] * two[k]) * scale[m] + op10_lm.MU * p) / (w[word(s[i - 1])] * scale[m] + op10_lm.MU)
                total -= math.log(p)
            loss.append(total / len(s) if s else None)
        out[d] = (len(s), *loss)
    return out


@pytest.mark.parametrize("good", [set(range(0, 40, 3)), set()])
def test_cross_entropy_difference(spark, good):
    rng = random.Random(0)
    texts = [" ".join(rng.choice("the of and cat dog runs far away".split()) for _ in range(rng.randint(1, 50))) for _ in range(40)]
    texts += [None, "", " \n ", "one", "é" * 5000]
    docs = spark.createDataFrame(docs_of(texts), DOCS)
    target = spark.createDataFrame([(g, "x") for g in [*good, None]] or [], "doc_id long, text string").where("doc_id is not null")
    out = {r.doc_id: r for r in op10_lm.cross_entropy_difference(docs.select("doc_id", "text"), target, 10, 12).collect()}
    want = brute_lm(list(enumerate(texts)), good, 10, 12)
    for d, (n, t, b) in want.items():
        assert out[d].n_tokens == n
        if n:
            assert out[d].loss_target == pytest.approx(t, rel=1e-9) and out[d].score == pytest.approx(t - b, abs=1e-9)
        else:
            assert out[d].score is None
    assert op10_lm.cross_entropy_difference(docs.select("doc_id", "text").where("false"), target, 10, 12).count() == 0


def test_cross_entropy_counts_words_and_pairs_exactly(spark, monkeypatch):
    monkeypatch.setattr(op10_lm, "BATCH", 20_000)   # several batches a task
    rng = np.random.default_rng(5)
    seqs = [["hot", "pair", *map(str, rng.integers(0, 60_000, 700))] for _ in range(400)]
    docs = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(seqs)] + [(None, "no id")], "doc_id long, text string")
    good = set(range(0, 400, 4))
    target = spark.createDataFrame([(g,) for g in good], "doc_id long")
    out = {r.doc_id: r for r in op10_lm.cross_entropy_difference(docs, target).collect()}
    assert len(out) == 401 and out[None].n_tokens == 2
    c1, c2 = [Counter(), Counter()], [Counter(), Counter()]
    for d, s in [*enumerate(seqs), (None, ["no", "id"])]:
        for m in ([0, 1] if d in good else [1]):
            c1[m].update(s)
            c2[m].update(zip(s, s[1:]))
    assert len(c2[1]) > 270_000   # 2^22 cells would hold thousands of colliding pairs
    for d in range(0, 400, 7):
        one, two = Counter(seqs[d]), Counter(zip(seqs[d], seqs[d][1:]))
        n = [sum(c.values()) - len(seqs[d]) * h for c, h in zip(c1, (d in good, True))]
        for m, got in ((0, out[d].loss_target), (1, out[d].loss_background)):
            k, loss, h = (1.0, n[0] / n[1])[m], 0.0, m or d in good
            for a, b in zip([None, *seqs[d]], seqs[d]):
                p = ((c1[m][b] - h * one[b]) * k + op10_lm.DELTA) / (n[m] * k + op10_lm.DELTA * len(c1[1]))
                if a is not None:
                    p = ((c2[m][a, b] - h * two[a, b]) * k + op10_lm.MU * p) / ((c1[m][a] - h * one[a]) * k + op10_lm.MU)
                loss -= math.log(p)
            assert got == pytest.approx(loss / len(seqs[d]), rel=1e-9)


def test_pipeline_keeps_clean_documents_and_takes_effect(spark, tables):
    import corpus_pipeline as cp
    rng = random.Random(4)

    def prose(n=80):
        return " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 9))) for _ in range(n))

    passage = prose(51)
    clean = [prose() for _ in range(30)]
    near = clean[0].split()
    near[5] = "changed"
    texts = clean + [" ".join(near), clean[1], "spam " * 50, "short", None, "", prose(60) + passage + prose(60), prose(70) + passage]
    d = tables(documents=(docs_of(texts) + [(None, prose(), None, None, None)], DOCS))
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumn("rid", F.lit("clash"))
    sizes = []
    for name, step in cp.STAGES:
        docs = step(spark, docs, d)
        docs.write.parquet(f"{d}/{name.replace(' ', '')}.parquet")
        docs = spark.read.parquet(f"{d}/{name.replace(' ', '')}.parquet")
        sizes.append(docs.count())
        if name != cp.STAGES[-1][0]:
            assert docs.columns == list(cp.COLUMNS)
        if name == "suffix-array dedup":
            left = {r.doc_id: r for r in docs.collect()}
            assert all(left[i].text == texts[i] for i in range(2, 30))
            assert passage not in left[36].text and passage not in left[37].text and len(left[36].text) == left[36].n_chars
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(range(2, 30)) <= ids and len({0, 30} & ids) == 1 and len({1, 31} & ids) == 1
    assert not {32, 33, 34, 35} & ids and None in ids
    assert all(r.decoded == " ".join(texts[r.doc_id].split()) for r in docs.collect() if r.doc_id in range(2, 30))
    assert cp.run(spark, d).count() == sizes[-1]
    empty = spark.read.parquet(f"{d}/documents.parquet").where("false")
    for _, step in cp.STAGES:
        assert step(spark, empty, d).count() == 0


def test_pipeline_keeps_one_of_a_third_of_copies_and_still_removes_boilerplate(spark, tables):
    import corpus_pipeline as cp
    rng = random.Random(7)

    def prose(n=60):
        return " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 9))) for _ in range(n))

    copied, banner = "\n".join(prose(12) for _ in range(5)), "accept all cookies"
    rows = docs_of([copied] * 70 + [prose() for _ in range(70)] + [f"{banner}\n{prose()}" for _ in range(70)])
    d = tables(documents=(rows, DOCS))
    first = cp.quality_rules(spark, spark.read.parquet(f"{d}/documents.parquet"), d)
    first.write.parquet(f"{d}/first.parquet")
    first = spark.read.parquet(f"{d}/first.parquet")
    texts = [r.text for r in first.collect()]
    assert len(texts) == 210 and texts.count(copied) == 70
    assert not any(banner in t for t in texts)
    left = [r.text for r in cp.near_dedup(spark, first, d).collect()]
    assert left.count(copied) == 1 and len(left) == 141


def test_every_query_is_registered():
    import __spark_entry__ as entry
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{i}" for i in range(1, 14)} <= names and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert re.match("/", SMALL)
