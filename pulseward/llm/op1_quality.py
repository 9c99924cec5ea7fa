"""Quality rules: per-document base rules and cross-document line frequency (DataFrame functions only).

A line is normalised (outer and repeated white space removed, lower case) and hashed. Per host (``source``) the
distinct texts that hold the line are counted: copies of one text are one document, so they don't make their own
lines boilerplate. A line is boilerplate of a host, and removed there, if at least ``min_docs`` of the host's distinct
texts and more than ``max_share`` of them hold it, or ``many`` of them whatever the share. So a small host needs a few
documents that agree, and in a host of any size a line in ``many`` documents goes. A document is depleted, and
rejected, if what is left has under ``min_words`` words or under ``min_left`` of its words.

Scale: a text's lines are made distinct inside its row, and copies are combined before the shuffle, so the counts are
two ``groupBy`` with map-side combination. The table of boilerplate lines is written; a host has at most (mean lines
per document) / max_share + (all its lines) / many of them. It is joined as one array per host: a broadcast while its
files are under the session's threshold, a sort-merge join beyond it (AQE splits a hot host).

Defined results: a null or empty text has no words and fails the base rules; a null host is a host of its own; a
null ``doc_id`` stays; repeated rows are rows of their own in the result; other columns are ignored. Empty table: no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, non_space, read, stage, words

SYMBOLS = "#*$%&|<>"      # fixed by the contract
MIN_WORDS = 10            # fixed by the contract
MAX_REPEAT_PCT = 20       # fixed by the contract
WINDOW = 5                # words in a repeated window; fixed by the contract
MAX_SHARE = 0.1
MIN_DOCS = 5
MANY = 10_000
MIN_LEFT = 0.5


def repeat_words(words_: Column, n: int = WINDOW) -> Column:
    """Number of words in ``n``-word windows found twice or more in the array ``words_``."""
    def hashes(ws: Column) -> Column:
        last = F.size(ws) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(n)]))

    def positions(s: Column) -> Column:
        again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                         | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n))).cast("long"))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        # most texts repeat no window: the distinct count decides that without sorting pairs
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(let(pairs, positions), covered))

    return let(let(words_, hashes), count)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _normal(line: Column) -> Column:
    return F.lower(F.array_join(words(line), " "))


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs`` (with a ``text`` column) and the base measures of the contract."""
    full = F.filter(_lines(F.col("text")), lambda x: non_space(x) != "")
    text = F.coalesce(F.col("text"), F.lit(""))
    out = (docs.withColumn("_w", words(F.col("text"))).withColumn("_l", full)
           .withColumn("n_words", F.size("_w").cast("long"))
           .withColumn("word_chars", F.length(non_space(F.col("text"))).cast("long"))
           .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
           .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
           .withColumn("n_repeat_words", repeat_words(F.col("_w"))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_w", "_l")


def _hashed_lines(text: Column) -> Column:
    return F.transform(_lines(text), lambda x: F.struct(x.alias("line"), F.xxhash64(_normal(x)).alias("h")))


def frequent_lines(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, many: int = MANY) -> DataFrame:
    """(host, bad): per host the array of hashes of its boilerplate lines."""
    text = F.coalesce("text", F.lit(""))
    hashes = F.array_distinct(F.transform(_lines(text), lambda x: F.xxhash64(_normal(x))))
    d = docs.select(F.col("source").alias("host"), F.xxhash64(text).alias("t"), F.length(text).alias("size"), hashes.alias("hashes"))
    # combined before the shuffle: a group of copies sends one row a task
    d = stage(d.groupBy("host", "t", "size").agg(F.first("hashes").alias("hashes")).select("host", "hashes"), "op1-texts")
    blank = F.xxhash64(F.lit(""))
    lines = d.select("host", F.explode("hashes").alias("h")).where(F.col("h") != blank)
    counts = lines.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    hosts = stage(d.groupBy("host").agg(F.count("*").alias("docs")), "op1-hosts")
    bad = (counts.join(hosts, counts["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
           .where((F.col("n") > max_share * F.col("docs")) | (F.col("n") >= many)))
    return stage(bad.groupBy("host").agg(F.collect_list("h").alias("bad")), "op1-lines")


def with_line_frequency(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
                        many: int = MANY) -> DataFrame:
    """``docs`` with ``clean_text`` (boilerplate lines removed)."""
    bad = frequent_lines(docs, max_share, min_docs, many)
    j = docs.join(bad, docs["source"].eqNullSafe(bad["host"]), "left").drop("host")

    def without(lines: Column) -> Column:
        kept = F.filter(lines, lambda x: ~F.array_contains(F.col("bad"), x["h"]))
        return let(kept, lambda k: F.when(F.size(k) == F.size(lines), F.col("text")).otherwise(
            F.array_join(F.transform(k, lambda x: x["line"]), "\n")))

    clean = F.when(F.col("bad").isNotNull() & F.col("text").isNotNull(), let(_hashed_lines(F.col("text")), without)).otherwise(
        F.col("text"))
    return j.withColumn("clean_text", clean).drop("bad")


def quality_rules(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, many: int = MANY,
                  min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): the base measures, ``n_left``, ``clean_text``, ``kept``."""
    d = with_line_frequency(docs, max_share, min_docs, many)
    left = F.when(F.col("clean_text").eqNullSafe(F.col("text")), F.col("n_words")).otherwise(
        F.size(words(F.col("clean_text"))).cast("long"))
    out = base_columns(d).withColumn("n_left", left)
    depleted = (F.col("n_left") < MIN_WORDS) | (F.col("n_left") < min_left * F.col("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", "n_left")


_W = "list_filter(string_split_regex(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, source FROM documents),
ws AS (SELECT rid, doc_id, source, coalesce(text, '') AS t, {_W.format('text')} AS w FROM d),
wp AS (SELECT rid, len(w) AS n, i, w[i:i+{WINDOW - 1}] AS g FROM ws, LATERAL unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)),
rep AS (SELECT rid, i FROM wp QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, sum(least({WINDOW}, coalesce(nx - i, {WINDOW}))) AS c
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM rep) GROUP BY rid),
ln AS (SELECT rid, source, t, p, l, lower(array_to_string({_W.format('l')}, ' ')) AS norm, len({_W.format('l')}) AS lw
       FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS l,
                    unnest(range(1, len(string_split(t, chr(10))) + 1)) AS p FROM ws)),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS nd FROM ln WHERE norm <> '' GROUP BY rid),
fr AS (SELECT source, norm, count(DISTINCT t) AS n FROM ln WHERE norm <> '' GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM ws GROUP BY ALL),
bad AS (SELECT fr.source, norm FROM fr JOIN hosts ON fr.source IS NOT DISTINCT FROM hosts.source
        WHERE n >= {MIN_DOCS} AND (n > {MAX_SHARE}::DOUBLE * docs OR n >= {MANY})),
lost AS (SELECT rid, sum(lw) AS lost FROM ln JOIN bad ON ln.source IS NOT DISTINCT FROM bad.source
         AND ln.norm = bad.norm GROUP BY rid),
m AS (SELECT ws.rid, doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
             coalesce(nd, 0)::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words,
             (len(w) - coalesce(lost, 0))::BIGINT AS n_left
      FROM ws LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_left >= {MIN_WORDS} AND n_left >= {MIN_LEFT}::DOUBLE * n_words AS kept, n_left FROM f
"""
