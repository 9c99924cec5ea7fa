"""Temperature mixing of sources (DataFrame functions only).

A source with the share p of all tokens (words) gets the weight p^a / sum p^a. The exponent a, a multiple of 1e-6 in
[0, 1], is found by cutting its interval (32 parts at a time, each round one aggregation over the table of sources):
the smallest a whose weights repeat no source more than ``max_repeats`` times and whose entropy is no more than
``entropy`` (nats), where given; a = 1, the shares themselves, always repeats nothing. The budget is a number of
tokens; by default the least at which no source has to leave anything out, so that mixing only repeats.

Weights are realised as budgeted block permutations. A source's documents are dealt by hash to blocks of about
``block_docs``, anew in every epoch; an epoch runs through its blocks, and through a block in hash order. The hash is of
the doc_id, so rows without one, or with one repeated, meet in a block; a block of over ``OVERFULL`` times ``block_docs``
rows is dealt again to parts by row number, and they follow one another. A source
gets as many whole epochs as its budget holds, and of the next one the leading documents whose tokens fit in the rest.
``mix_key``, the share of its source's budget that precedes a document, orders the whole mixture: any leading part of
it holds the sources in their weights.

Running sums go over the parts of blocks and within a part, so no task sees a whole source or doc_id; the table of sources is joined as a
broadcast while its files are under the session's threshold, else by sort-merge (a hot source is then split by AQE).
Defined results: a null source is a source of its own; texts without words have 0 tokens and are in every whole
epoch; a source without tokens gets weight 0 and one epoch; rows without doc_id and repeated rows are documents of
their own; other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, read, stage, words

MAX_REPEATS = 2.0
BLOCK_DOCS = 4096
OVERFULL = 2
UNIT = 1_000_000       # exponents are multiples of 1 / UNIT
PARTS = 32


def _source_key(source: Column) -> Column:
    return F.concat(F.when(source.isNull(), "-").otherwise("+"), F.coalesce(source, F.lit("")))


def source_tokens(rows: DataFrame) -> DataFrame:
    """(skey, tokens, docs) of ``rows`` (skey, n)."""
    return stage(rows.groupBy("skey").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")), "op8-sources")


def _relative(tokens: Column, most: float, exponent: Column) -> Column:
    """Tokens that the weights ask for, in multiples of a source's own, but for a common factor."""
    return F.pow(tokens / F.lit(most), exponent - 1)


def find_exponent(sources: DataFrame, max_repeats: float | None, entropy: float | None,
                  budget: float | None) -> tuple[int, float]:
    """(exponent * UNIT, tokens of the largest source)."""
    live = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    most = live.agg(F.max("t")).first()[0]
    if most is None:
        return UNIT, 1.0
    low, high = -1, UNIT     # low is too small (or no exponent), high is good
    while high - low > 1:
        tried = sorted({low + (high - low) * i // PARTS for i in range(1, PARTS)} - {low, high})
        a = F.explode(F.array(*[F.lit(k) for k in tried])).alias("k")
        each = live.select("t", a).withColumn("r", _relative(F.col("t"), most, F.col("k") / UNIT))
        all_ = each.groupBy("k").agg(F.sum(F.col("t") * F.col("r")).alias("z"), F.max("r").alias("most"),
                                     F.sum(F.col("t") * F.col("r") * F.log(F.col("t") * F.col("r"))).alias("zl"))
        repeats = F.col("most") * (F.lit(float(budget)) / F.col("z") if budget is not None else F.lit(1.0))
        good = F.lit(True)
        if max_repeats is not None:
            good = good & (repeats <= max_repeats)
        if entropy is not None:
            good = good & (F.log("z") - F.col("zl") / F.col("z") <= entropy)
        fits = [r["k"] for r in all_.select("k", good.alias("good")).where("good").collect()]   # under PARTS rows
        high = min([high, *fits])
        low = max([low, *(k for k in tried if k < high)])
    return high, most


def mixture(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
            budget: float | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(rid, doc_id, source, epoch, block, mix_key), a row for every time that a row of ``docs`` (rid, doc_id,
    source, text) is used."""
    rows = stage(docs.select("rid", "doc_id", "source", _source_key(F.col("source")).alias("skey"),
                             F.size(words(F.col("text"))).cast("long").alias("n")), "op8-rows")
    sources = source_tokens(rows)
    exponent, most = find_exponent(sources, max_repeats, entropy, budget)
    want = F.col("tokens") * _relative(F.col("tokens").cast("double"), most, F.lit(exponent / UNIT))
    plan = sources.withColumn("want", F.when(F.col("tokens") > 0, want).otherwise(0.0))
    if budget is not None:
        total = plan.agg(F.sum("want")).first()[0] or 1.0
        plan = plan.withColumn("want", F.col("want") * F.lit(float(budget) / total))
    plan = plan.withColumn("goal", F.floor(F.col("want") + 1e-6).cast("long"))
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("goal") / F.greatest("tokens", F.lit(1)))).otherwise(1)
    plan = stage(plan.withColumn("epochs", whole.cast("int")).select(
        "skey", "tokens", "goal", "epochs", (F.col("goal") - F.col("epochs") * F.col("tokens")).alias("rest"),
        F.ceil(F.col("docs") / block_docs).cast("int").alias("blocks")), "op8-plan")
    used = rows.join(plan, "skey").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    used = used.where((F.col("epoch") < F.col("epochs")) | (F.col("rest") > 0))
    used = used.withColumn("h", F.md5(F.concat_ws("|", F.col("epoch"), F.col("skey"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("-"))))).withColumn(
        "block", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("blocks") / F.lit(1 << 32)).cast("int"))
    used = stage(used.select("rid", "doc_id", "source", "skey", "n", "tokens", "goal", "epochs", "rest", "epoch",
                             "block", "h"), "op8-used")
    discard(rows, plan, sources)
    full = stage(used.groupBy("skey", "epoch", "block").agg(F.ceil(F.count("*") / (OVERFULL * block_docs)).alias("parts"))
                 .where("parts > 1"), "op8-overfull")
    dealt = used.join(full, ["skey", "epoch", "block"], "left").withColumn(
        "part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("rid"), F.col("parts"))).otherwise(0))
    # one column names a part, so that rows aren't left dealt by block alone
    dealt = dealt.withColumn("cell", F.concat_ws("|", "epoch", "block", "part", "skey"))
    sums = dealt.groupBy("cell").agg(F.first("skey").alias("skey"), F.first("epoch").alias("epoch"), F.first("block").alias("block"),
                                     F.first("part").alias("part"), F.sum("n").alias("inside"))
    over = Window.partitionBy("skey", "epoch").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select("cell", F.coalesce(F.sum("inside").over(over), F.lit(0)).alias("base")), "op8-blocks")
    within = Window.partitionBy("cell").orderBy("h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(sums, "cell").withColumn(
        "before", F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    fits = (F.col("epoch") < F.col("epochs")) | (F.col("before") + F.col("n") <= F.col("rest"))
    at = (F.col("epoch") * F.col("tokens") + F.col("before")) / F.greatest("goal", F.lit(1))
    return placed.where(fits).select("rid", "doc_id", "source", "epoch", "block", at.cast("double").alias("mix_key"))


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text").withColumn(
        "rid", F.monotonically_increasing_id())   # mixture() writes it before it uses it
    return mixture(docs).drop("rid")


ORACLE = f"""
WITH r AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS skey,
                  len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n
           FROM documents),
s AS (SELECT skey, sum(n)::BIGINT AS tokens, count(*) AS docs FROM r GROUP BY 1),
x AS (SELECT max(tokens)::DOUBLE AS most, min(tokens)::DOUBLE AS least FROM s WHERE tokens > 0),
e AS (SELECT most, CASE WHEN most <= least * {MAX_REPEATS} THEN 0.0
                   ELSE ceil({UNIT} * (1 - ln({MAX_REPEATS}::DOUBLE) / ln(most / least))) / {UNIT} END AS a FROM x),
g AS (SELECT skey, tokens, docs, CASE WHEN tokens > 0
             THEN floor(tokens * pow(tokens / most, a - 1) + 1e-6)::BIGINT ELSE 0 END AS goal FROM s, e),
p AS (SELECT *, CASE WHEN tokens > 0 THEN goal // tokens ELSE 1 END AS epochs, ceil(docs / {BLOCK_DOCS}.0)::INT AS blocks FROM g),
u AS (SELECT r.*, tokens, goal, epochs, goal - epochs * tokens AS rest, blocks,
             unnest(range(0, epochs + 1)) AS epoch FROM r JOIN p USING (skey)),
h AS (SELECT *, md5(concat_ws('|', epoch::VARCHAR, skey, coalesce(doc_id::VARCHAR, '-'))) AS h FROM u
      WHERE epoch < epochs OR rest > 0),
b AS (SELECT *, floor(('0x' || substr(h, 1, 8))::BIGINT * blocks / 4294967296.0)::INT AS block FROM h),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY skey, epoch ORDER BY block, h, doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM b)
SELECT doc_id, source, epoch::INT AS epoch, block,
       (epoch * tokens + before)::DOUBLE / greatest(goal, 1)::DOUBLE AS mix_key
FROM c WHERE epoch < epochs OR before + n <= rest
"""
