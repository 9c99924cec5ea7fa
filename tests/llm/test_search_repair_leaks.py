"""Ranked search, conversation repair and benchmark decontamination: against their SQL, against brute force, edge cases."""

import hashlib
import heapq
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from .cases import DOCS, SMALL, docs_of

from pulseward.llm import op11_ranked_search, op12_conversations, op13_decontaminate, queries
from pulseward.llm.maxscore import Postings, best_documents, impact
from pulseward.llm.suffix_array import longest_matches, suffix_array
from pulseward.llm.survivors import Survivors

ITEMS = "item_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def against_sql(spark, name, folder):
    got = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet" + ("'" if folder == SMALL else "/*.parquet'"))
    want = con.sql(queries.ORACLE[name]).to_arrow_table()
    assert sorted(got.columns) == sorted(want.column_names)
    rows = [tuple(r[c] for c in sorted(r)) for r in got.toArrow().to_pylist()]
    return sorted(map(repr, rows)), sorted(repr(tuple(r[c] for c in sorted(r))) for r in want.to_pylist())


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_decontaminate"])
def test_queries_match_their_sql(spark, name):
    got, want = against_sql(spark, name, SMALL)
    assert got == want and len(got) >= 200


# --- ranked search

def random_index(rng, n_docs, n_terms):
    m = rng.integers(10, 400, n_docs)
    tf = rng.integers(0, 400, (n_terms, n_docs)) * (rng.random((n_terms, n_docs)) < rng.random((n_terms, 1)) ** 3)
    term, doc = np.nonzero(tf)
    return tf, m, Postings.load(Postings.build(term, doc, tf[term, doc], n_terms, m).dump())


def test_max_score_against_full_scores():
    rng = np.random.default_rng(5)
    read = total = 0
    for n_docs in (1, 63, 700, 9000):
        tf, m, p = random_index(rng, n_docs, 30)
        order = rng.permutation(n_docs)
        for _ in range(12):
            terms = rng.permutation(30)[:rng.integers(1, 20)]
            weight = rng.integers(0, 9000, len(terms)) // rng.integers(1, 900, len(terms))
            every = sum((w * np.where(tf[t] > 0, impact(tf[t], m), 0) for t, w in zip(terms, weight)), np.zeros(n_docs, np.int64))
            want = sorted((-s, order[d], d) for d, s in enumerate(every) if s > 0)[:10]
            p.read = 0
            docs, scores = best_documents(p, terms, weight, 10, order)
            assert [(-s, order[d], d) for d, s in zip(docs, scores)] == want
            if n_docs == 9000:
                read, total = read + p.read, total + int((p.start[terms + 1] - p.start[terms]).sum())
    assert read < 0.8 * total   # whole blocks are never decompressed


def test_postings_of_wide_gaps_and_counts():
    doc, tf = np.array([0, 300, 70_000, 140_000, 5]), np.array([1, 70_000, 2, 300, 1])
    p = Postings.build(np.array([0, 0, 0, 0, 2]), doc, tf, 3, np.full(140_001, 20))
    assert list(p.start) == [0, 1, 1, 2]
    got, q, of = p.decode(np.array([0, 1]))
    assert list(got) == list(doc) and list(of) == [0, 0, 0, 0, 1]
    assert list(q) == list(impact(tf, np.full(5, 20)))


@pytest.mark.parametrize("shard,block", [(16 << 20, 4 << 20), (40, 30)])
def test_ranked_search_edge_cases(spark, tables, monkeypatch, shard, block):
    """Nulls, empty and long texts, ties, repeated rows and items, no matter how shards and blocks are cut."""
    monkeypatch.setattr(op11_ranked_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(op11_ranked_search.search, "__defaults__", (10, block))
    texts = [None, "", "...", "Alpha beta", "alpha BETA", "alpha é漢 x1", "beta beta " * 3000, *["alpha beta"] * 30, "gamma"]
    docs = [(*r, "x") for r in docs_of(texts)] + [(None, "alpha gamma", None, None, None, "y"), (3, "Alpha beta", "en", "s", 1, "z")]
    items = [(1, "ALPHA, alpha!"), (2, None), (3, "zzz"), (4, "beta 漢 É é漢 gamma"), (1, "ALPHA, alpha!"), (None, "gamma")]
    d = tables(documents=(docs, DOCS + ", item_id string"), benchmark=([(*r, 7) for r in items], ITEMS + ", doc_id long"))
    got, want = against_sql(spark, "op11_ranked_search", d)
    assert got == want and len(got) == 10 + 10 + 10 + 2


def test_ranked_search_of_nothing(spark, tables):
    d = tables(documents=([], DOCS), benchmark=([(1, "a")], ITEMS))
    assert op11_ranked_search.op11_ranked_search(spark, d).count() == 0


def test_ranked_search_without_items(spark, tables):
    d = tables(documents=(docs_of(["a b"]), DOCS), benchmark=([], ITEMS))
    assert op11_ranked_search.op11_ranked_search(spark, d).count() == 0


# --- benchmark decontamination

def parts(rng, n, size, letters):
    out = []
    for _ in range(n):
        out += [*rng.integers(1, letters + 1, rng.integers(0, size)), 0]
    return np.array(out, np.int32)


def test_suffix_array_and_matches_against_brute_force():
    rng = np.random.default_rng(7)
    for letters in (1, 2, 5):
        for _ in range(15):
            seq, query = parts(rng, 5, 30, letters), parts(rng, 4, 25, letters)
            query[rng.random(len(query)) < 0.05] = -1
            query[-1] = 0

            def tail(a, i):
                return tuple(a[i:i + np.flatnonzero(a[i:] <= 0)[0]])
            sa = suffix_array(seq)
            tails = [tail(seq, i) for i in sa]
            assert tails == sorted(tails) and sorted(sa) == list(np.flatnonzero(seq))
            asked = np.full(len(query), 3)
            length, lo, hi, wlo, whi = longest_matches(seq, sa, query, asked)
            for i in np.flatnonzero(query > 0):
                t = tail(query, i)
                n = max((k for k in range(len(t) + 1) if any(x[:k] == t[:k] for x in tails)), default=0)
                assert length[i] == n
                if n:
                    assert sorted(sa[lo[i]:hi[i]]) == sorted(p for p, x in zip(sa, tails) if x[:n] == t[:n])
                want = sorted(p for p, x in zip(sa, tails) if len(t) >= 3 and x[:3] == t[:3])
                assert sorted(sa[wlo[i]:whi[i]]) == want


@pytest.mark.parametrize("small", [False, True])
def test_decontamination_against_sql_and_brute_force(spark, tables, monkeypatch, small):
    if small:   # cut long texts and items into pieces, and both tables into many
        monkeypatch.setattr(op13_decontaminate, "SHARD_BYTES", 60)
        monkeypatch.setattr(op13_decontaminate, "SHARD_WORDS", 16)
        monkeypatch.setattr(op13_decontaminate, "SEGMENT", 12)
        monkeypatch.setattr(op13_decontaminate.search, "__defaults__", (90,))
    rng = random.Random(3)
    item = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(n)) for n in (35, 9, 12, 10, 200)]
    w = item[0].split()
    texts = [None, "", " .,", item[0], item[0].upper() + "!", "x " + "-".join(w[3:13]) + " y", " ".join(w[3:12]),
             item[1] + " " + item[1], item[1][:-1], " ".join(w[:10] + w[2:12]), "q " * 300 + item[4] + " q" * 300,
             item[4][:400], "é漢 é漢", *[item[2]] * 40, " ".join(w[20:]) + " " + item[3]]
    docs = docs_of(texts) + [(None, item[2], None, None, None), (3, item[0], "en", "s", 1)]
    items = [(i, t) for i, t in enumerate(item)] + [(9, None), (10, ""), (11, "É漢"), (12, "é漢"), (2, item[3]), (0, item[0]),
                                                     (None, item[3]), (13, " ".join(w[5:20]))]
    d = tables(documents=([(*r, 5) for r in docs], DOCS + ", item_id long"), benchmark=([(*r, 5) for r in items], ITEMS + ", doc_id long"))
    got, want = against_sql(spark, "op13_decontaminate", d)
    assert got == want
    # the same by hand
    rows = {}
    for i, (_, t, *_) in enumerate(docs):
        x, hit, names = words(t), set(), set()
        for name, text in items:
            y = words(text)
            k = min(10, len(y))
            grams = {tuple(y[j:j + k]) for j in range(len(y) - k + 1)} if y else set()
            for j in range(len(x) - k + 1):
                if tuple(x[j:j + k]) in grams:
                    hit |= set(range(j, j + k))
                    names.add("" if name is None else str(name))
        rows[i] = (len(x), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    found = op13_decontaminate.op13_decontaminate(spark, d).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == sorted(rows.values())
    read = spark.read.parquet
    clean = op13_decontaminate.clean_documents(read(f"{d}/documents.parquet"), read(f"{d}/benchmark.parquet"))
    assert clean.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "item_id"]
    assert clean.count() == sum(not r[-1] for r in rows.values())


def test_longest_match_and_places(spark):
    item = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(0, "0", " ".join(["x", *item[5:31], "y"])), (1, "1", " ".join(item[:9]))], "rid long, id string, text string")
    items = spark.createDataFrame([("a", " ".join(item))], "id string, text string")
    rows = {r.id: r for r in op13_decontaminate.search(op13_decontaminate.build_index(docs), items).collect()}
    assert rows["0"].longest == 26 and [(s.f, s.u) for s in rows["0"].spans] == [(1, 27)] and rows["0"]["items"] == ["a"]
    assert rows["1"].longest == 0 and not rows["1"].spans and rows["1"].n_words == 9


def test_index_rows_are_stored_in_small_row_groups(spark):
    rng = np.random.default_rng(9)
    rows = [(i, str(i), " ".join(map(str, rng.integers(0, 50_000, 150_000)))) for i in range(18)]
    index = op13_decontaminate.build_index(spark.createDataFrame(rows, "rid long, id string, text string").coalesce(1))
    assert index.count() >= 9
    most = op13_decontaminate.GROUP_BYTES
    for f in Path(index._stored_at.removeprefix("file:")).glob("*.parquet"):
        meta = pq.read_metadata(f)
        for g in map(meta.row_group, range(meta.num_row_groups)):
            assert g.num_rows == 1 or g.total_byte_size * (g.num_rows - 1) / g.num_rows <= most   # the last row may go over
    items = spark.createDataFrame([(r[1], " ".join(r[2].split()[1000 + r[0]:1012 + r[0]])) for r in rows], "id string, text string")
    found = op13_decontaminate.search(index, items).collect()
    assert [(r.id, r.n_words, [tuple(s) for s in r.spans], r["items"], r.longest) for r in sorted(found, key=lambda r: r.rid)] == [
        (i, 150_000, [(1000 + k, 1012 + k)], [i], 12) for k, i, _ in rows]


def test_decontamination_of_nothing(spark, tables):
    d = tables(documents=([], DOCS), benchmark=([(1, "a")], ITEMS))
    assert op13_decontaminate.op13_decontaminate(spark, d).count() == 0


def test_decontamination_without_items(spark, tables):
    d = tables(documents=(docs_of(["a b", None]), DOCS), benchmark=([], ITEMS))
    rows = op13_decontaminate.op13_decontaminate(spark, d).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows) == [(0, 2, 0, False), (1, 0, 0, False)]


# --- conversation repair

def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        out.append("B" if not solid else "D" if (role, text) in seen else "T" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, edits, repaired rows) by listing all edits in order of their cost."""
    fault = faults(rows)
    heap, best = [(0, "", 0, ())], None
    while heap:
        cost, done, i, out = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        roles = "".join(r[0][:1] or "?" for r in out)
        if not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles) and (best is None or done < best[1]):
            best = (cost, done, out)
        if done[-2:] != "II":
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 3, done + "I", i, out + ((role, ""),)))
        if i < len(rows):
            role, text = rows[i]
            more = 3 if fault[i] == "T" else 0
            heapq.heappush(heap, (cost + 4, done + "D", i + 1, out))
            if fault[i] not in ("B", "D"):
                heapq.heappush(heap, (cost + more, done + "K", i + 1, out + ((role, text),)))
                for to in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, done + "R", i + 1, out + ((to, text),)))
    return best


class Rows(list):
    def add(self, role, text):
        self.append((role, text))

    def copy(self):
        return Rows(self)


def solve(rows):
    done = []
    s = Survivors(done.extend, Rows())
    for (role, text), f in zip(rows, faults(rows)):
        s.row(role, text, f in ("B", "D"), f == "T")
    cost, out = s.end()
    return cost, "".join(done), tuple(out)


def some_rows(rng, n):
    return [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]),
             rng.choice([" ", "a.", "b", f"{rng.random()}.", f"{rng.random()}?", f"{rng.random()}"])) for _ in range(n)]


def test_survivors_against_all_edits():
    rng = random.Random(11)
    for n in (0, 1, 2, 3, 4, 5):
        for _ in range(60):
            rows = some_rows(rng, n)
            assert solve(rows) == cheapest(rows), rows


def test_survivors_hold_only_what_is_unresolved():
    """Also where nothing is decided before the end: a run of user rows ends with an inserted row or doesn't."""
    rng = random.Random(12)
    for rows, all_handed_out in ((some_rows(rng, 5000), True), ([("user", f"{i}.") for i in range(3000)], False),
                                 ([(("user", "assistant")[i % 2], f"{i}") for i in range(3000)], True),
                                 ([("system", f"{i}.") for i in range(3000)], None), ([("user", " ")] * 3000, False)):
        done = []
        s = Survivors(done.extend, op12_conversations.Nothing())
        most = 0
        for (role, text), f in zip(rows, faults(rows)):
            s.row(role, text, f in ("B", "D"), f == "T")
            most = max(most, s.nodes())
        assert most < 16   # the tree stays small; it holds letters only
        if all_handed_out:
            assert len(done) > 0.9 * len(rows)
        s.end()
        assert sum(x != "I" for x in done) == len(rows)


def repaired_by_hand(given):
    """The contract, row by row: {conv_id: result}."""
    out = {}
    for conv in {r[0] for r in given}:
        rows = []
        for c, turn, role, text in (r for r in given if r[0] == conv):
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if f == 0:
                continue
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            rows += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        pairs = [r[1:] for r in rows]
        f = faults(pairs)
        turns = [t for t, *_ in rows if t is not None]
        cost, audit, fixed = cheapest(pairs)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("B"), f.count("D"), f.count("T"),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def test_repair_query_against_brute_force(spark, tables):
    rng = random.Random(13)
    given = [(c, t, *r) for c in [*range(60), None] for t, r in enumerate(some_rows(rng, rng.randint(1, 5)))]
    given += [(100, None, "user", "x."), (100, None, "assistant", None), (101, 5, None, "q"), (101, 2, "", "q."),
              (102, 3, "user", "long. " * 20_000), (102, 4, "assistant", "y" * 100_000), (102, 4, "assistant", "y" * 100_000),
              (103, 1, "user", "same."), (103, 1, "user", "same."), (103, 1, "user", "same."), (104, 2**40, "system", "")]
    given += [(c, t, "user", "z.") for c, t in [(200, t) for t in range(2000)] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    want = repaired_by_hand(given)
    d = tables(conversations=([(*r, "x") for r in given], TURNS + ", dropped string"))
    rows = op12_conversations.op12_conversation_repair(spark, d).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert want[200][-2:] == ("", hashlib.sha256(b"").hexdigest()) and not any(want[200][:6])


def test_edits_and_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (2, 0, "system", "x.")], TURNS)
    assert [solve([("user", "a."), ("user", "b."), ("assistant", "c.")])[i] for i in (0, 1)] == [3, "KIKK"]
    given = rows.withColumn("dropped", F.lit(False))
    found = sorted(map(tuple, op12_conversations.edits(given).collect()))
    assert found == [(1, 0, "K", "user", "a."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "b."),
                     (1, 3, "K", "assistant", "c."), (2, 0, "D", None, None)]
    assert sorted(map(tuple, op12_conversations.repaired(rows).collect())) == [
        (1, 0, "user", "a."), (1, 1, "assistant", ""), (1, 2, "user", "b."), (1, 3, "assistant", "c.")]


def test_no_conversations(spark, tables):
    assert op12_conversations.op12_conversation_repair(spark, tables(conversations=([], TURNS))).count() == 0
