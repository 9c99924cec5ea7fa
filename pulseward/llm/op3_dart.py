"""Near duplicates by DartMinHash signatures.

The elements of a text are its shingles of five words, with weights (one each unless given: the similarity is then
the Jaccard similarity of the shingle sets). Darts fall on (element, weight, rank) space as a Poisson process whose
every dart follows from hashes of the element, its weight strip ([0,1), [1,2), [2,4), ...) and the dart's number:
ranks are sums of exponential gaps at the strip's width. A text gets the darts under its weights and under a rank
limit that yields about ``k (ln k + 2)`` of them, keeps the earliest per coordinate, and doubles the limit while a
coordinate is empty. Two texts agree in a coordinate with the probability of their weighted Jaccard similarity.

Equal texts are first reduced to one. Signatures are cut into bands; texts that share a band are compared, exactly,
on their shingle sets. No list of all pairs is made: first each bucket's members are compared with one centre, and the
verified links are joined into components; then the buckets that still hold several components are finished in blocks
of members, whose pairs of different components are told apart by their signatures inside a task and never become
rows. A pair is only left out if both texts are in one class already, or if their signatures say that they are well
below the threshold, so no cap is needed.

Result: one row per row of the input: ``class_id``, the smallest doc_id of the class (null if it has none), and
``keep``, true for one row of each class. Defined results: texts without words (null, empty, white space) are in no
class (class_id = doc_id, keep = true). Fewer than five words: one shingle of them all. Repeated rows are one class, and
rows without doc_id are in the class of their text.
Scale: texts are shuffled by row number, buckets by band; hot buckets are joins that AQE splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, keyed, read, stage
from .components import components
from .textnum import mix, shingles, slices, text_bytes, unit, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5     # a pair of similarity 0.8 shares a band with probability 1 - 7e-6
DOUBLINGS = 60
BLOCK = 512             # members
AGREE = 5 / 6           # of the threshold: a pair of similarity 0.8 agrees that much but for 2 in 100,000
MASK = (1 << 64) - 1


def _throw(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, limit: np.ndarray, k: int,
           best: np.ndarray, dart: np.ndarray) -> None:
    """Darts of rank up to ``limit[owner]``; ``best`` and ``dart`` (owner x coordinate) take the earliest."""
    top = int(np.ceil(np.log2(weight.max()))) if len(weight) and weight.max() > 1 else 0
    for strip in range(top + 1):
        low, width = (0.0, 1.0) if strip == 0 else (2.0 ** (strip - 1), 2.0 ** (strip - 1))
        live = np.flatnonzero(weight > low)
        e = mix(element[live] + np.uint64((strip + 1) * 0xD1342543DE82EF95 & MASK))
        o, w, rank = owner[live], weight[live], np.zeros(len(live))
        most = limit[o]
        number = 0
        while len(e):
            number += 1
            h = mix(e + np.uint64(number * 0x9E3779B97F4A7C15 & MASK))
            rank = rank - np.log(unit(h)) / width
            near = np.flatnonzero(rank <= most)
            e, o, w, rank, most, h = e[near], o[near], w[near], rank[near], most[near], h[near]
            h2 = mix(h ^ np.uint64(0xA0761D6478BD642F))
            cell = o * k + (mix(h2) % np.uint64(k)).astype(np.int64)
            hit = slice(None) if width == 1.0 and w.min(initial=1.0) >= low + width else low + unit(h2) * width < w
            c, r, d = cell[hit], rank[hit], h[hit]
            np.minimum.at(best, c, r)
            won = best[c] == r
            dart[c[won]] = d[won]


def dart_signatures(element: np.ndarray, begin: np.ndarray, weight: np.ndarray | None, k: int) -> np.ndarray:
    """(sets x k) unsigned 64-bit signatures; set i has elements ``begin[i]:begin[i+1]``; none: zeros. An element
    that is repeated within a set must have one weight and counts once."""
    n = np.diff(begin)
    weight = np.ones(len(element)) if weight is None else weight.astype(np.float64)
    total = np.add.reduceat(np.append(weight, 0.0), begin[:-1]) if len(n) else np.zeros(0)
    dart, best = np.zeros(len(n) * k, np.uint64), np.full(len(n) * k, np.inf)
    rows = np.flatnonzero((n > 0) & (total > 0))
    limit = np.zeros(len(n))
    limit[rows] = k * (math.log(k) + 2) / total[rows]
    owner = np.repeat(np.arange(len(n)), n)
    for _ in range(DOUBLINGS):
        if not len(rows):
            break
        chosen = np.zeros(len(n), bool)
        chosen[rows] = True
        at = np.flatnonzero(chosen[owner])
        _throw(element[at], owner[at], weight[at], limit, k, best, dart)
        rows = rows[np.isinf(best.reshape(-1, k)[rows]).any(axis=1)]
        limit[rows] *= 2
    return dart.reshape(-1, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), 1))
    for r in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands])
    return out.view(np.int64)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(rid, doc_id, th, bands) of ``docs`` (rid, doc_id, text); bands is null for a text without words."""
    d = docs.select("rid", "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("th"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(3)):
                part = b.slice(lo, hi - lo)
                element, begin = shingles(*word_hashes(*text_bytes(part.column(3))), size)
                keys = band_keys(dart_signatures(element, begin, None, bands * rows), bands, rows)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel(), pa.int64()), bands)
                lists = lists.cast(pa.list_(pa.int64()))
                empty = pa.array(np.diff(begin) == 0)
                lists = pc.if_else(empty, pa.scalar(None, lists.type), lists)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], lists], ["rid", "doc_id", "th", "bands"])

    return d.mapInArrow(run, "rid long, doc_id long, th string, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``threshold`` or more."""
    j = (pairs.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("ta")), "a")
         .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def sets(column: pa.Array) -> list[np.ndarray]:
        element, begin = shingles(*word_hashes(*text_bytes(column)), size)
        return [np.unique(element[begin[i]:begin[i + 1]]) for i in range(len(begin) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(2)):
                part = b.slice(lo, hi - lo)
                ok = []
                for x, y in zip(sets(part.column(2)), sets(part.column(3))):
                    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                        ok.append(False)
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(both >= threshold * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return j.mapInArrow(run, "a long, b long")


def _joined(links: DataFrame, label: DataFrame) -> DataFrame:
    """Labels (rid, label) after the links (a, b) as well."""
    if links.limit(1).count() == 0:
        return label
    known = label.select(F.col("rid").alias("a"), F.col("label").alias("b"))
    out = stage(components(links.unionByName(known)).select(F.col("a").alias("rid"), "label"), "dart-labels")
    discard(label)
    return out


def _open(members: DataFrame, label: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one label, with the bucket's number of members ``m``."""
    labelled = stage(members.join(label, "rid", "left").withColumn("label", F.coalesce("label", "rid")), "dart-labelled")
    mixed = stage(labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m"))
                  .where("x <> y").select("bucket", "m"), "dart-mixed")
    out = stage(labelled.join(mixed, "bucket"), "dart-open")
    discard(labelled, mixed)
    return out


def _in_blocks(opened: DataFrame, texts: DataFrame, bands: int, rows: int, size: int, threshold: float) -> DataFrame:
    """Links (a, b) between members of a bucket that have different labels, without a row per pair.

    A bucket's members are dealt to blocks of about ``BLOCK``; a task gets two blocks with signatures and shingle
    sets. A pair is looked at in the first band that it shares, so once in all; the pairs whose signatures agree in
    ``AGREE`` of the threshold or more are compared exactly, unless links found in this task join them already.
    """
    k = bands * rows
    wanted = opened.select("rid").distinct()

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(1)):
                part = b.slice(lo, hi - lo)
                element, begin = shingles(*word_hashes(*text_bytes(part.column(1))), size)
                sig = dart_signatures(element, begin, None, k).astype("<u4")
                sets = [np.unique(element[begin[i]:begin[i + 1]]).tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sig], pa.binary()),
                                                  pa.array(sets, pa.binary())], ["rid", "sig", "elements"])

    facts = stage(texts.select("rid", "text").join(wanted, "rid", "left_semi").mapInArrow(
        described, "rid long, sig binary, elements binary"), "dart-facts")
    dealt = (opened.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("rid", F.lit(7)), F.col("blocks")).cast("int")))
    cells = dealt.select("bucket", "band", "rid", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("bucket", "band", "rid", "label", "own", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j")).join(facts, "rid")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, band = (int(pdf[c].iloc[0]) for c in ("i", "j", "band"))
        rid, label, own = (pdf[c].to_numpy() for c in ("rid", "label", "own"))
        sig = np.frombuffer(b"".join(pdf["sig"]), "<u4").reshape(-1, k)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["elements"]]
        length = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        out = []
        for x in left:
            y = right[right > x] if i == j else right
            y = y[(label[y] != label[x]) & (np.minimum(length[y], length[x]) >= threshold * np.maximum(length[y], length[x]))]
            equal = sig[y] == sig[x]
            shared = equal.reshape(len(y), bands, rows).all(axis=2)
            y = y[(shared.argmax(axis=1) == band) & shared.any(axis=1) & (equal.sum(axis=1) >= AGREE * threshold * k)]
            for z in y:
                a, b = root(int(label[x])), root(int(label[z]))
                if a == b:
                    continue
                both = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                if both >= threshold * (length[x] + length[z] - both):
                    parent[max(a, b)] = min(a, b)
                    out.append((rid[x], rid[z]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    links = stage(cells.groupBy("bucket", "i", "j").applyInPandas(solve, "a long, b long"), "dart-links")
    discard(facts)
    return links


def _classes(members: DataFrame, texts: DataFrame, bands: int, rows: int, size: int, threshold: float) -> DataFrame:
    """(rid, label) of the members (bucket, band, rid) that are linked to others."""
    label = members.sparkSession.createDataFrame([], "rid long, label long")
    # one centre per bucket, by hash, so that the buckets of a group have the same few centres
    centre = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("rid").alias("h"), "rid")).alias("c"))
    pairs = (members.join(centre.select("bucket", F.col("c.rid").alias("c")), "bucket").where("rid <> c")
             .select(F.least("rid", "c").alias("a"), F.greatest("rid", "c").alias("b")).distinct())
    links = stage(_verified(pairs, texts, size, threshold), "dart-links")
    label = _joined(links, label)
    opened = _open(members, label)
    more = _in_blocks(opened, texts, bands, rows, size, threshold)
    label = _joined(more, label)
    discard(links, opened, more)
    return label


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE,
                    threshold: float = SIMILARITY) -> DataFrame:
    """(rid, doc_id, class_id, keep) for every row of ``docs`` (rid, doc_id, text)."""
    sig = stage(signatures(docs, bands, rows, size), "dart-signatures")
    real = sig.where("bands is not null")
    one = stage(real.groupBy("th").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least_doc")), "dart-texts")
    bucket = (real.join(one.select("rid"), "rid", "left_semi")
              .select("rid", F.posexplode("bands").alias("band", "bucket")))
    shared = bucket.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = stage(bucket.join(shared, "bucket"), "dart-members")
    wanted = members.select("rid").distinct()
    texts = stage(docs.select("rid", "text").join(wanted, "rid", "left_semi"), "dart-candidates")
    label = _classes(members, texts, bands, rows, size, threshold)
    of_text = stage(one.join(label, "rid", "left").select("th", F.coalesce("label", "rid").alias("label"),
                                                          F.col("rid").alias("first_rid"), "least_doc"), "dart-classes")
    discard(one, label, members, texts)
    of_class = of_text.groupBy("label").agg(F.min("least_doc").alias("class_id"), F.min("first_rid").alias("kept_rid"))
    named = of_text.select("th", "label").join(of_class, "label").select("th", "class_id", "kept_rid")
    rows_ = sig.select("rid", "doc_id", F.when(F.col("bands").isNotNull(), F.col("th")).alias("th"))
    return rows_.join(named, "th", "left").select(
        "rid", "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("rid") == F.col("kept_rid"), F.lit(True)).alias("keep"))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "keep")
