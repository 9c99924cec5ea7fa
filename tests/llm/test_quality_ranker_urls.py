"""Quality rules, the pairwise ranker and the URL filter: SQL, brute force, edge cases, planted cases."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from .cases import DOCS, SMALL, docs_of

from pulseward.llm import op1_quality, op4_ranker, op5_cascade


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_url_cascade", "op8_temperature_mix"])
def test_queries_match_their_sql(spark, name, monkeypatch):
    from pulseward.llm.queries import ORACLE, QUERIES
    from pulseward.plans import oracle
    from pulseward.plans.compare import compare, duckdb_connection
    monkeypatch.setitem(oracle.ORACLE, name, ORACLE[name])
    ok, said = compare(spark, duckdb_connection(SMALL), name, SMALL, spark_df=QUERIES[name](spark, SMALL))
    assert ok, said


def repeats(words, n=5):
    seen = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    hit = set()
    for i in range(len(words) - n + 1):
        if seen[tuple(words[i:i + n])] > 1:
            hit |= set(range(i, i + n))
    return len(hit)


def test_repeated_windows_against_brute_force(spark):
    rng = np.random.default_rng(0)
    lists = [[str(x) for x in rng.integers(0, 3, rng.integers(0, 40))] for _ in range(60)] + [[], ["a"] * 5, ["a"] * 6]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "i long, w array<string>")
    got = {r.i: r.n for r in df.select("i", op1_quality.repeat_words(F.col("w")).alias("n")).collect()}
    assert [got[i] for i in range(len(lists))] == [repeats(w) for w in lists]


def test_boilerplate_lines_go_and_depleted_documents_are_rejected(spark, tables):
    shared = "subscribe to our  Newsletter now"
    own = [f"{shared}\n" + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(60)]
    depleted = ["Subscribe to our newsletter NOW\n\na b c d e f g"]
    plain = [" ".join(f"p{i}q{j}" for j in range(12)) for i in range(20)]
    edge = [None, "", " \t\n", "short text", "é漢" * 5000]
    texts = own + depleted + plain + edge + plain[:1]
    rows = [(*r[:3], None if i % 2 else "s", r[4]) for i, r in enumerate(docs_of(texts))]
    rows.append((None, plain[1], None, None, None))
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit(-1)).withColumn("bad", F.lit("x"))
    out = op1_quality.quality_rules(docs.select("doc_id", "text", "source"), min_docs=20).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept and shared not in by[i].clean_text and by[i].n_left == 30 for i in range(60))
    assert not by[60].kept and by[60].n_left == 7 and not by[60].base_failed
    assert all(by[i].kept and by[i].clean_text == texts[i] for i in range(61, 81))
    assert all(by[i].base_failed and not by[i].kept for i in range(81, 86))
    assert by[81].n_words == 0 and by[81].clean_text is None
    # a filter on the result stays a linear plan
    assert op1_quality.quality_rules(docs.select("doc_id", "text", "source"), min_docs=20).where("kept").count() == \
        sum(r.kept for r in out)
    assert op1_quality.quality_rules(docs.where("false").select("doc_id", "text", "source")).count() == 0


def test_copies_are_one_document_and_lines_go_at_every_size(spark, tables):
    """A third of a host is one clean text: it stays. Its banner goes from small and large hosts alike."""
    clean = "\n".join(" ".join(f"c{i}d{j}" for j in range(8)) for i in range(4))
    for n in (10, 300):
        own = ["accept all cookies\n" + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(n)]
        rows = docs_of([clean] * n + own + [" ".join(f"p{i}q{j}" for j in range(12)) for i in range(n)])
        out = {r.doc_id: r for r in op1_quality.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
        assert all(out[i].kept and out[i].clean_text == clean for i in range(n))
        assert all(out[i].kept and out[i].n_left == 30 for i in range(n, 2 * n))
        assert all(out[i].kept for i in range(2 * n, 3 * n))
    # below the share, but in many documents
    rows = docs_of([f"a banner\n{'w ' * 20}{i}" for i in range(30)] + [f"{'v ' * 20}{i}" for i in range(400)])
    docs = spark.createDataFrame(rows, DOCS)
    assert op1_quality.frequent_lines(docs).count() == 0
    assert op1_quality.frequent_lines(docs, many=30).count() == 1


def test_lines_go_from_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    changed = op1_quality.with_line_frequency(docs).where("not (clean_text <=> text)").count()
    assert changed > 50


def test_ranker_learns_from_pairs_and_handles_edge_cases(spark):
    rng = np.random.default_rng(1)

    def prose():
        return " ".join("".join(rng.choice(list("aeinrst"), rng.integers(2, 9))) for _ in range(60)) + "."

    texts = [prose() if i % 4 else rng.choice(["BUY NOW!! " * 20, "x### y*** " * 20, "same " * 60]) for i in range(400)]
    texts += [None, "", "word " * 30_000]
    docs = spark.createDataFrame(docs_of(texts), DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)] + [(0, None, 0), (None, 1, 0), (5, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in op4_ranker.score(docs, labels, op4_ranker.train(docs, labels)).collect()}
    assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out.values())
    held = [i for i in range(400) if out[i].held_out]
    assert 40 < len(held) < 140
    assert np.mean([out[i].predicted == int(i % 4 > 0) for i in held]) > 0.97
    assert out[400].score == out[401].score
    none = op4_ranker.score(docs, labels.where("false"), op4_ranker.train(docs, labels.where("false"))).collect()
    assert {r.score for r in none} == {0.5}
    assert op4_ranker.score(docs.where("false"), labels, op4_ranker.train(docs, labels)).count() == 0


def test_pairwise_fit_orders_by_preference():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 15))
    y = (x[:, 3] > -1).astype(int)
    m = op4_ranker.fit(x, y)
    s = op4_ranker._vector(x, m["centre"], m["scale"]) @ m["w"]
    good, bad = s[y == 1], s[y == 0]
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_cascade_is_exact_over_its_universe():
    rng = np.random.default_rng(3)
    for n, share in ((0, 0), (1, 1), (500, 0.02), (500, 0.5), (20_000, 0.01), (300, 1.0), (300, 0.0)):
        h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        listed = rng.random(n) < share
        levels = op5_cascade.parse_cascade(op5_cascade.build_cascade(h1, h2, listed))
        assert (op5_cascade.in_cascade(levels, h1, h2) == listed).all()


URLS = ["http://a.com/x", "https://www.example.com/en/1", "https://example.com/en/", "http://m.example.com/en/2?q#f",
        "http://x.net/es/1", "http://NET/fr/9", "http://notnet/fr/9", "http://x.net/de/", "http://spam-farm.example.org/a",
        "http://b.org", "http://com", "http://com?x=/", None, "", "no scheme", "ftp://h#frag/en/", "a://b://c.com/p",
        "http://www.example.com.evil.org/en/"]


@pytest.mark.parametrize("small_broadcast", [False, True])
def test_urls(spark, tables, monkeypatch, small_broadcast):
    import duckdb
    d = tables(pages=([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], None), (None, None, None)],
                      "page_id long, url string, html string"))
    if small_broadcast:
        monkeypatch.setattr(op5_cascade.judge, "__defaults__", (5, 0))
    got = Counter(tuple(r) for r in op5_cascade.op5_url_cascade(spark, d).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet/*.parquet'")
    assert got == Counter(con.sql(op5_cascade.ORACLE).fetchall())
    by = {r[0]: r for r in got}
    assert by[1][3:] == ("www.example.com/en/", "allow") and by[3][3:] == ("example.com/en/", "block")
    assert by[8][3:] == (None, "block") and by[15][1:3] == ("h", "")


def test_no_pages(spark, tables):
    d = tables(pages=([], "page_id long, url string, html string"))
    assert op5_cascade.op5_url_cascade(spark, d).count() == 0


def test_pairwise_scores_and_threshold_equal_numpy(spark):
    """The columns restate the numpy model; the threshold is the quantile over all labelled rows, not the sample."""
    import numpy as np
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = op4_ranker.train(docs, labels, max_labelled=40)
    rows = op4_ranker.with_measures(docs).join(op4_ranker.usable(labels), "doc_id", "left").collect()
    x = np.array([[r[f"_f_{f}"] for f in op4_ranker.FEATURES] for r in rows])
    raw = op4_ranker._vector(x, model["centre"], model["scale"]) @ model["w"]
    lab = np.array([-1 if r.quality is None else r.quality for r in rows])
    assert (lab >= 0).sum() > 40
    q = (lab == 0).sum() / (lab >= 0).sum()
    m = op4_ranker.MARGIN
    cut = np.quantile(raw[lab >= 0], [q * (1 - m), min(1.0, q * (1 + m))]).mean()
    want = 1 / (1 + np.exp(-(raw - cut + np.log(0.3 / 0.7))))
    got = {r.doc_id: r.score for r in op4_ranker.score(docs, labels, model).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], want, atol=1e-9)


def test_pairwise_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, "fine words here, and more. " * 3 if i % 2 else "!!! ### $$$", 1.0, 2)
                                  for i in range(40)], "doc_id long, text string, raw double, quality int")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)], "doc_id long, quality int, text string")
    out = {r.doc_id: r for r in op4_ranker.score(docs, labels, op4_ranker.train(docs, labels)).collect()}
    assert all(r.predicted == i % 2 for i, r in out.items())
