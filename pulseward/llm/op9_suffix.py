"""Suffix-array dedup: remove every byte covered by a ``width``-byte string that starts anywhere else too.

Sorting every suffix of a corpus would move ``width`` bytes per byte. Instead each window of ``width`` bytes names
an anchor: the position, among its first ``width - gram + 1``, whose ``gram`` bytes have the smallest hash (the leftmost
of equals). Equal windows name equal anchors at equal distances, so only windows of anchors with the same bytes can
be equal. Runs of windows with one anchor form a context of up to ``2 * width - gram`` bytes. ``gram`` is a power of two.

1. One pass writes an anchor row per context (hashes, place, number of windows); anchors that occur once are dropped
   and equal contexts are counted, both with map-side combination.
2. Of the distinct contexts of an anchor the bytes are fetched. Their suffixes from the anchor on, and their reversed
   prefixes, are put in order by deep-shallow sorting; a window is repeated if another context (or a second
   occurrence of its own) agrees with it on both sides of the anchor, which common prefix lengths tell for each
   distance. An anchor with over ``max_group`` distinct contexts (the edge of a passage that very many texts share)
   isn't sorted by one task: each of its windows is counted by its own hash (two of 64 bits).
3. The repeated runs are joined back by context, gathered per text and cut out.

Passages of over 50 words are often shorter than the 400 bytes of the query (51 words start at some 200), so the query also
tells, in columns of its own, which bytes strings of ``PASSAGE_BYTES`` repeat. Those are found first: a longer string that
starts elsewhere too lies inside a run of them, so ``width`` is then judged on the runs alone, with the same result.

Hashes: anchors and contexts count as equal when 64-bit hashes of the anchor and of the whole context agree.
Defined results: null text = empty text; rows without doc_id and repeated rows are texts of their own; other columns
are ignored; an empty table gives no rows. Scale: rows per anchor, not per byte, are shuffled (about one per half of
``width - gram``, 73 bytes in the query); the text itself is shuffled by row number twice. Gathered lists are bounded by one text's length.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, keyed, read, stage
from .deep_shallow import deep_shallow
from .textnum import mix, text_bytes

WIDTH = 400
GRAM = 256            # bytes of an anchor
PASSAGE_BYTES = 200   # 51 words have more in nearly every text
PASSAGE_GRAM = 64
CHUNK = 1 << 18       # window starts handled at once
MAX_GROUP = 4000
SORT_AT_ONCE = 20_000

_SPANS = "array<struct<f:long,u:long>>"
_ROW = ("ah long, ch long, rid long, lo long, n int, p int, times int")


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on, by doubling."""
    h = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[raw]
    size = 1
    while size < gram:
        a, b = h[:-size], h[size:]
        h = a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        size *= 2
    return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(31))


def _chained(h: np.ndarray, at: np.ndarray, size: np.ndarray, gram: int, most: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` bytes (``gram`` to ``most``) from each position ``at`` on, from the hashes ``h`` of the grams
    that cover them."""
    out = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    for k in range(0, most, gram):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[at + np.minimum(k, size - gram)])
    return out


def _first_least(h: np.ndarray, span: int) -> np.ndarray:
    """Position of the leftmost smallest value of ``h[i:i + span]`` for each i that has so many."""
    v, at, size = h, np.arange(len(h), dtype=np.int32), 1
    while size < span:
        step = min(size, span - size)
        left = v[:-step] <= v[step:]
        at = np.where(left, at[:-step], at[step:])
        v = np.where(left, v[:-step], v[step:])
        size += step
    return at


def anchors_of(raw: np.ndarray, off: np.ndarray, width: int, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start in the text, windows, distance to the anchor, anchor hash, context hash, repetitions) of every
    context, in parts. Equal contexts that follow each other directly come once, with their number."""
    span = width - gram + 1
    for s in range(0, max(0, len(raw) - width + 1), CHUNK):
        part = raw[s:s + CHUNK + width + span]
        if len(part) < width:
            break
        h = _gram_hashes(part, gram)
        at = _first_least(h, span)[:CHUNK]
        at = at[:len(part) - width + 1]
        i = np.arange(len(at))
        text = np.searchsorted(off, i + s, "right") - 1
        ok = i + s + width <= off[text + 1]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        edge = np.flatnonzero(fresh | np.append(True, ok[1:] != ok[:-1]))
        n = np.diff(np.append(edge, len(at)))
        edge, n = edge[ok[edge]], n[ok[edge]]
        if not len(edge):
            continue
        size = n + width - 1
        ah = h[at[edge]]
        p = at[edge] - edge
        ch = mix(_chained(h, edge, size, gram, 2 * width - gram, 1) + p.astype(np.uint64))
        t = text[edge]
        again = np.zeros(len(edge), bool)
        again[1:] = (ch[1:] == ch[:-1]) & (ah[1:] == ah[:-1]) & (t[1:] == t[:-1]) & (edge[1:] == edge[:-1] + n[:-1])
        head = np.flatnonzero(~again)
        times = np.diff(np.append(head, len(edge)))
        yield (t[head], edge[head] + s - off[t[head]], n[head], p[head], ah[head].view(np.int64),
               ch[head].view(np.int64), times)


def anchors(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = b.column(0).to_numpy(zero_copy_only=False)
            for t, lo, n, p, ah, ch, times in anchors_of(*text_bytes(b.column(1)), width, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ah), pa.array(ch), pa.array(rid[t]), pa.array(lo.astype(np.int64)),
                     pa.array(n.astype(np.int32)), pa.array(p.astype(np.int32)), pa.array(times.astype(np.int32))],
                    ["ah", "ch", "rid", "lo", "n", "p", "times"])

    return docs.select("rid", "text").mapInArrow(run, _ROW)


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [{"f": int(a), "u": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def repeated_windows(group: np.ndarray, n: np.ndarray, p: np.ndarray, count: np.ndarray, context: list[bytes],
                     width: int, gram: int = GRAM) -> list[np.ndarray]:
    """For each context the mask of its windows that occur elsewhere too. ``group`` (ascending): the anchor."""
    m = len(context)
    sides = []
    for reverse in (False, True):
        place, cut = np.zeros(m, np.int64), np.zeros(m, np.int64)
        bound = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for a, b in zip(bound, np.append(bound[1:], m)):
            strings = [c[:q][::-1] if reverse else c[q:] for c, q in zip(context[a:b], p[a:b])]
            order, lcp = deep_shallow(strings, 0 if reverse else gram)
            place[a + np.array(order)] = np.arange(a, b)
            cut[a:b] = [-1, *lcp[1:]]
        sides.append((place, cut))
    masks = [np.zeros(x, bool) for x in n]
    (right, right_cut), (left, left_cut) = sides
    for q in range(int(p.max(initial=-1)) + 1):   # q: distance from the window's start to the anchor
        here = np.flatnonzero((p - n < q) & (q <= p))
        if not len(here):
            continue
        r, c = np.cumsum(right_cut < width - q)[right[here]], np.cumsum(left_cut < q)[left[here]]
        _, kind = np.unique(r * (m + 1) + c, return_inverse=True)
        twice = np.bincount(kind, count[here])[kind] > 1
        for x in here[twice]:
            masks[x][p[x] - q] = True
    return masks


def _sorted_groups(contexts: DataFrame, width: int, gram: int) -> DataFrame:
    """(ah, ch, spans) of the contexts (ah, ch, n, p, cnt, context), an anchor's contexts in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table) -> pa.RecordBatch:
            col = {c: t.column(c).to_numpy() for c in ("ah", "ch", "n", "p", "cnt")}
            masks = repeated_windows(col["ah"], col["n"], col["p"], col["cnt"], t.column("context").to_pylist(), width, gram)
            spans = [_runs(x) for x in masks]
            return pa.RecordBatch.from_arrays(
                [pa.array(col["ah"]), pa.array(col["ch"]),
                 pa.array(spans, pa.list_(pa.struct([("f", pa.int32()), ("u", pa.int32())])))], ["ah", "ch", "spans"])

        held: list[pa.Table] = []
        rows = 0
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            rows += b.num_rows
            if rows < SORT_AT_ONCE:
                continue
            t = pa.concat_tables(held)
            ah = t.column("ah").to_numpy()
            cut = int(np.searchsorted(ah == ah[-1], True))   # the last anchor may go on in the next batch
            if cut:
                yield solve(t.slice(0, cut))
            held, rows = [t.slice(cut)], len(t) - cut
        if rows:
            yield solve(pa.concat_tables(held))

    return contexts.repartition("ah").sortWithinPartitions("ah", "ch").mapInArrow(
        run, "ah long, ch long, spans array<struct<f:int,u:int>>")


def _window_counts(contexts: DataFrame, width: int, gram: int) -> DataFrame:
    """The same for anchors with very many contexts: each window is counted by its own hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                raw, off = text_bytes(part.column(5))
                n = part.column(2).to_numpy()
                h = _gram_hashes(raw, gram)
                row = np.repeat(np.arange(len(n)), n)
                o = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at = off[:-1][row] + o
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     pa.array(o.astype(np.int32)),
                     *(pa.array(_chained(h, at, np.full(len(at), width), gram, width, seed).view(np.int64)) for seed in (1, 2)),
                     part.column(4).take(pa.array(row))],
                    ["ah", "ch", "o", "f1", "f2", "cnt"])

    w = stage(contexts.select("ah", "ch", "n", "p", "cnt", "context").mapInArrow(
        run, "ah long, ch long, o int, f1 long, f2 long, cnt long"), "op9-windows")
    twice = w.groupBy("f1", "f2").agg(F.sum("cnt").alias("s")).where("s > 1").select("f1", "f2")
    one = F.struct(F.col("o").alias("f"), (F.col("o") + 1).alias("u"))
    return w.join(twice, ["f1", "f2"], "left_semi").groupBy("ah", "ch").agg(F.collect_list(one).alias("spans"))


def _fetch(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted`` (ah, ch, n, p, cnt, hot, rid, lo) with the bytes of each context."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("ah", "ch", "n", "p", "cnt", "hot", "lo")).alias("w"))
    j = docs.select("rid", "text").join(lists, "rid").select("text", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                w = part.column(1)
                each = w.flatten()
                col = {f.name: each.field(i) for i, f in enumerate(each.type)}
                raw, off = text_bytes(part.column(0))
                lengths = np.diff(w.offsets.to_numpy())
                begin = np.repeat(off[:-1], lengths) + col["lo"].to_numpy()
                end = begin + col["n"].to_numpy() + width - 1
                data = raw.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(col[c] for c in ("ah", "ch", "n", "p", "cnt", "hot")),
                     pa.array([data[x:y] for x, y in zip(begin, end)], pa.binary())],
                    ["ah", "ch", "n", "p", "cnt", "hot", "context"])

    return j.mapInArrow(run, "ah long, ch long, n int, p int, cnt long, hot boolean, context binary")


def _repeated_contexts(docs: DataFrame, width: int, max_group: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Stored: the contexts of anchors that occur twice or more, and the repeated windows of each (ah, ch, spans)."""
    every = stage(anchors(docs, width, gram), "op9-anchors")
    common = every.groupBy("ah").agg(F.sum("times").alias("s")).where("s > 1").select("ah")
    shared = stage(every.join(common, "ah", "left_semi"), "op9-shared")
    discard(every)
    kinds = stage(shared.groupBy("ah", "ch").agg(
        F.sum("times").alias("cnt"), F.min(F.struct("rid", "lo")).alias("at"), F.first("n").alias("n"),
        F.first("p").alias("p")), "op9-contexts")
    per = stage(kinds.groupBy("ah").agg(F.count("*").alias("kinds")), "op9-kinds")
    stored_kinds, kinds = kinds, kinds.join(per, "ah")
    whole = kinds.where("kinds = 1 and cnt > 1").select(
        "ah", "ch", F.array(F.struct(F.lit(0).alias("f"), F.col("n").alias("u"))).alias("spans"))
    wanted = kinds.where("kinds > 1").select("ah", "ch", "n", "p", "cnt", (F.col("kinds") > max_group).alias("hot"),
                                             "at.rid", "at.lo")
    fetched = stage(_fetch(docs, wanted, width), "op9-fetched")
    found = stage(whole.unionByName(_sorted_groups(fetched.where("not hot").drop("hot"), width, gram))
                  .unionByName(_window_counts(fetched.where("hot"), width, gram)).where(F.size("spans") > 0), "op9-found")
    discard(stored_kinds, per, fetched)
    return shared, found


def _placed(shared: DataFrame, found: DataFrame, width: int) -> DataFrame:
    placed = shared.join(found, ["ah", "ch"]).select("rid", F.when(
        F.col("times") > 1, F.array(F.struct(F.col("lo").alias("f"), (F.col("lo") + F.col("n") * F.col("times") + width - 1).alias("u")))
    ).otherwise(F.transform("spans", lambda s: F.struct((F.col("lo") + s["f"]).alias("f"),
                                                        (F.col("lo") + s["u"] + width - 1).alias("u")))).alias("spans"))
    return placed.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeated_spans(docs: DataFrame, width: int = WIDTH, max_group: int = MAX_GROUP, gram: int = GRAM) -> DataFrame:
    """(rid, spans) of the texts (rid, text) that hold repeated bytes; spans: array of (from, until) in bytes."""
    return _placed(*_repeated_contexts(docs, width, max_group, gram), width)


def _runs_of(docs: DataFrame, width: int, max_group: int, gram: int) -> DataFrame:
    """``repeated_spans`` as maximal runs, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = [[{"f": f, "u": u} for f, u in merged(s)] for s in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(runs, pa.list_(pa.struct([("f", pa.int64()), ("u", pa.int64())])))], ["rid", "spans"])

    behind = _repeated_contexts(docs, width, max_group, gram)
    out = stage(_placed(*behind, width).mapInArrow(run, f"rid long, spans {_SPANS}"), "op9-runs")
    discard(*behind)
    gc.collect()
    docs.sparkSession._jvm.System.gc()   # Spark deletes the shuffle files of finished queries when the JVM collects garbage
    return out


def _inside(docs: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """(rid, of, base, text): the bytes of each run of ``width`` or more, as a text of its own; ``of``, ``base``: whose it
    is and where it starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                raw, off = text_bytes(part.column(1))
                w = part.column(2)
                f, u = (w.flatten().field(k).to_numpy() for k in (0, 1))
                lengths = np.diff(w.offsets.to_numpy())
                at = np.repeat(off[:-1], lengths)
                data = raw.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(), lengths)), pa.array(f),
                     pa.array([data[x:y] for x, y in zip(at + f, at + u)], pa.binary())], ["of", "base", "text"])

    long = runs.select("rid", F.filter("spans", lambda s: s["u"] - s["f"] >= width).alias("spans")).where(F.size("spans") > 0)
    cut = docs.select("rid", "text").join(long, "rid").select("rid", "text", "spans").mapInArrow(
        run, "of long, base long, text binary")
    return stage(cut.withColumn("rid", F.monotonically_increasing_id()), "op9-inside")


def spans_and_passages(docs: DataFrame, width: int, max_group: int, gram: int, passage: int, passage_gram: int) -> DataFrame:
    """(rid, spans, passages): the runs that repeated strings of ``width`` and of ``passage`` bytes cover."""
    passages = _runs_of(docs, passage, max_group, passage_gram)
    if width < passage:
        spans = _runs_of(docs, width, max_group, gram)
    else:
        inside = _inside(docs, passages, width)
        own = _runs_of(inside, width, max_group, gram)
        moved = F.transform("spans", lambda s: F.struct((F.col("base") + s["f"]).alias("f"), (F.col("base") + s["u"]).alias("u")))
        spans = stage(own.join(inside.select("rid", "of", "base"), "rid").groupBy(F.col("of").alias("rid")).agg(
            F.flatten(F.collect_list(moved)).alias("spans")), "op9-spans")
        discard(inside, own)
    return passages.withColumnRenamed("spans", "passages").join(spans, "rid", "full")


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for f, u in sorted((s["f"], s["u"]) for s in spans or ()):
        if out and f <= out[-1][1]:
            out[-1][1] = max(out[-1][1], u)
        else:
            out.append([f, u])
    return [(f, u) for f, u in out]


def without_repeats(docs: DataFrame, width: int = WIDTH, max_group: int = MAX_GROUP, as_text: bool = False,
                    carry: tuple[str, ...] = (), gram: int = GRAM, *, passage: tuple[int, int] | None = None) -> DataFrame:
    """Every row of ``docs`` (rid, text): rid, the ``carry`` columns, n_bytes, spans (maximal removed runs) and kept,
    the remaining bytes. With ``as_text`` kept is a string: a character that a run cuts is dropped whole, and a text
    without runs, null too, is as it was. With ``passage`` (bytes, and those of its anchors) the column passages, after
    the carried ones: the runs that repeated strings of so many bytes cover, which are not removed."""
    columns = ["rid", *carry]
    if passage is None:
        j = docs.select(*columns, "text").join(repeated_spans(docs, width, max_group, gram), "rid", "left")
    else:
        j = docs.select(*columns, "text").join(spans_and_passages(docs, width, max_group, gram, *passage), "rid", "left")
        j = j.withColumn("passages", F.coalesce("passages", F.array().cast(_SPANS)))
        columns.append("passages")
    j = j.select(*columns, "text", "spans")
    schema = T.StructType([*j.select(*columns).schema.fields, T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("f", T.LongType()),
                                                                            T.StructField("u", T.LongType())]))),
                           T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                raw, off = text_bytes(part.column(k))
                data = raw.tobytes()
                runs = [merged(s) for s in part.column(k + 1).to_pylist()]
                kept = []
                for i, r in enumerate(runs):
                    edges = [0, *(x for fu in r for x in fu), int(off[i + 1] - off[i])]
                    pieces = [data[off[i] + x:off[i] + y] for x, y in zip(edges[::2], edges[1::2])]
                    if not as_text:
                        kept.append(b"".join(pieces))
                    elif r:
                        kept.append("".join(x.decode("utf-8", "ignore") for x in pieces))
                    else:
                        kept.append(part.column(k)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], pa.array(np.diff(off)),
                     pa.array([[{"f": f, "u": u} for f, u in r] for r in runs],
                              pa.list_(pa.struct([("f", pa.int64()), ("u", pa.int64())]))),
                     pa.array(kept, pa.string() if as_text else pa.binary())], [*columns, "n_bytes", "spans", "kept"])

    return j.mapInArrow(run, schema)


def _length(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["u"] - s["f"])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kept_text``: the remaining bytes as text; U+FFFD stands for what is left of a character that a run cuts.
    ``has_passages``, ``n_passages``, ``n_passage_bytes``: whether, in how many maximal runs and on how many bytes the
    text repeats strings of ``PASSAGE_BYTES``, which passages of over 50 words hold; only longer ones are removed."""
    docs = keyed(read(spark, sf_dir, "documents"), "doc_id", "text")
    cut = without_repeats(docs, carry=("doc_id",), passage=(PASSAGE_BYTES, PASSAGE_GRAM))
    return cut.select(
        "doc_id", "n_bytes", _length("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
        (F.size("passages") > 0).alias("has_passages"), F.size("passages").cast("long").alias("n_passages"),
        _length("passages").alias("n_passage_bytes"))
