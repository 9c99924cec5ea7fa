"""Ordered running computations without a single-task window.

A running aggregate "over all earlier rows of a key" is usually written as a window partitioned by the key.
When one key holds a large share of the rows (a hot patient, or no key at all for a global watermark) that
window runs on one task. ``chunked_running`` computes the same values in two levels:

1. rows are split into ordered chunks (``chunk`` must be monotone in ``order``, e.g. the hour of the arrival
   time); a window partitioned by (keys, chunk) gives the running value inside each chunk;
2. one summary row per (keys, chunk) -- pre-aggregated, so only this small table is re-shuffled -- gives the
   value of all earlier chunks through a window over chunks, and is joined back on (keys, chunk).

The large side is shuffled once, on (keys, chunk); the join back reuses that partitioning. The summary has at
most one row per non-empty (key, chunk) and is never broadcast by hint: AQE may still turn the join into a
broadcast after it has measured the summary.

``with_ranges`` gives chunks of about equal row counts. Chunks may also be fine-grained; the summary is then large as
well and its prefix is computed two-level again (``summary_chunk``).

Supported kinds, each with ``inclusive`` (frame ends at the current row) or exclusive (ends one row before):
  ``sum``  running sum;   ``max``  running maximum (nulls ignored);
  ``prev`` the value of the previous row in order (``lag``), ignoring ``inclusive``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Running:
    name: str
    kind: str          # 'sum' | 'max' | 'prev'
    expr: Column
    inclusive: bool = True


def chunked_running(df: DataFrame, keys: list[str], chunk: Column | None, order: list[str],
                    specs: list[Running], chunk_name: str = "_chunk",
                    summary_chunk: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add one column per ``Running`` spec; see module docstring. ``order`` must be unique within a key.

    Without ``chunk`` the chunks are an existing column ``chunk_name`` (see ``with_ranges``), which is kept: a second
    scan over the same ranges then needs no further shuffle of the rows. ``chunk`` may be a struct (compared field by field). With ``summary_chunk`` the prefix over the per-chunk
    summary is itself computed two-level, chunked by ``summary_chunk(chunk)`` (monotone in the chunk); use it
    when chunks are fine-grained, so that the summary table is large.
    """
    part = [*keys, chunk_name]
    base = df if chunk is None else df.withColumn(chunk_name, chunk)
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    local_cols = []
    for s in specs:
        if s.kind == "sum":
            local_cols.append(F.sum(s.expr).over(upto if s.inclusive else before).alias(f"_l_{s.name}"))
        elif s.kind == "max":
            local_cols.append(F.max(s.expr).over(upto if s.inclusive else before).alias(f"_l_{s.name}"))
        elif s.kind == "prev":
            local_cols.append(F.lag(s.expr).over(w).alias(f"_l_{s.name}"))
        else:
            raise ValueError(f"unknown running kind {s.kind!r}")
        # summary inputs are carried as columns so the summary is computed from the same shuffled rows
        local_cols.append(s.expr.alias(f"_x_{s.name}"))
    if any(s.kind == "prev" for s in specs):
        local_cols.append((F.row_number().over(w) == 1).alias("_first_in_chunk"))
    local = base.select("*", *local_cols)

    order_struct = F.struct(*[F.col(c) for c in order])
    summary_aggs = []
    for s in specs:
        x = F.col(f"_x_{s.name}")
        if s.kind == "sum":
            summary_aggs.append(F.sum(x).alias(f"_c_{s.name}"))
        elif s.kind == "max":
            summary_aggs.append(F.max(x).alias(f"_c_{s.name}"))
        else:
            summary_aggs.append(F.max_by(x, order_struct).alias(f"_c_{s.name}"))
    summary = local.groupBy(*part).agg(*summary_aggs)

    if summary_chunk is None:
        wc = Window.partitionBy(*keys).orderBy(chunk_name) if keys else Window.orderBy(chunk_name)
        earlier = wc.rowsBetween(Window.unboundedPreceding, -1)
        prefix_cols = []
        for s in specs:
            c = F.col(f"_c_{s.name}")
            if s.kind == "sum":
                prefix_cols.append(F.sum(c).over(earlier).alias(f"_p_{s.name}"))
            elif s.kind == "max":
                prefix_cols.append(F.max(c).over(earlier).alias(f"_p_{s.name}"))
            else:
                prefix_cols.append(F.lag(c).over(wc).alias(f"_p_{s.name}"))
        prefix = summary.select(*part, *prefix_cols)
    else:
        inner = [Running(f"_p_{s.name}", s.kind, F.col(f"_c_{s.name}"), inclusive=False) for s in specs]
        prefix = chunked_running(summary, keys, summary_chunk(F.col(chunk_name)), [chunk_name], inner,
                                 chunk_name=f"{chunk_name}_s").select(*part, *[f"_p_{s.name}" for s in specs])

    joined = local.join(prefix, on=part, how="inner")
    out_cols = []
    for s in specs:
        l, p = F.col(f"_l_{s.name}"), F.col(f"_p_{s.name}")
        if s.kind == "sum":
            out_cols.append((F.coalesce(p, F.lit(0)) + F.coalesce(l, F.lit(0))).alias(s.name))
        elif s.kind == "max":
            out_cols.append(F.greatest(p, l).alias(s.name))
        else:
            out_cols.append(F.when(F.col("_first_in_chunk"), p).otherwise(l).alias(s.name))
    drop = [c for c in joined.columns if c.startswith(("_l_", "_p_", "_x_")) or c == "_first_in_chunk"
            or (c == chunk_name and chunk is not None)]
    return joined.select("*", *out_cols).drop(*drop)


SEQ_BLOCK = 1 << 20            # inside one timestamp that fills ranges of its own, a chunk is this many sequence numbers
ROWS_PER_RANGE = 1 << 20
MAX_RANGES = 4096
SPANS_PER_RANGE = 20           # a range with copies of the rows of the span before it is this many spans long at least


def with_ranges(df: DataFrame, ts: str, seq: str | None, name: str = "_range", rows: int | None = None) -> DataFrame:
    """``df`` with ``name``, a chunk that is monotone in the order (ts, seq): ranges of ``ts`` between fixed cut
    points, about ``rows`` rows each (at most ``MAX_RANGES``). A timestamp that fills a range is a range of its own,
    cut into blocks of sequence numbers, so a burst splits by row count too; without ``seq`` (``ts`` unique per key)
    it isn't, and ``ts`` may be any number.

    The cut points are approximate quantiles (one pass over one column; the driver gets the cut points alone). A key
    has at most one summary row per range, so summaries are smaller than the rows by the rows per key and range.
    """
    rows = rows or ROWS_PER_RANGE
    n = df.count()
    k = min(MAX_RANGES, -(-n // rows))
    cuts = df.approxQuantile(ts, [i / k for i in range(1, k)], 1 / (4 * k)) if k > 1 else []
    heavy = sorted({c for c in cuts if cuts.count(c) > 1}) if seq else []
    # one cut point at least: a constant range would be folded, and the join on it would become a cartesian product
    splits = sorted({*cuts, *(c + 1 for c in heavy)}) or [0.0]
    df = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="_ts", outputCol="_bucket",
                    handleInvalid="keep").transform(df.withColumn("_ts", F.col(ts).cast("double"))).drop("_ts")
    block = (F.when(F.col(ts).isin([int(c) for c in heavy]), F.floor(F.col(seq) / F.lit(SEQ_BLOCK)))
             .otherwise(F.lit(0)) if heavy else F.lit(0)).cast("long")
    return df.withColumn(name, F.struct(F.col("_bucket").cast("int").alias("a"), block.alias("b"))).drop("_bucket")


def with_overlap(df: DataFrame, ts: str, span: int, name: str = "_range", rows: int | None = None) -> DataFrame:
    """``df`` in ranges ``name`` (int) of the integer time ``ts``, every range with copies of the rows of the ``span``
    before it: a frame ``RANGE BETWEEN span - 1 PRECEDING AND CURRENT ROW`` of a range's own rows (``_own``) lies
    inside the range. Ranges hold about ``rows`` rows and are ``SPANS_PER_RANGE`` spans long or longer, so of rows
    spread evenly one in ``SPANS_PER_RANGE`` is copied at most. ``ts`` should be unique per key (aggregate first):
    a range of one key is then at most as many rows as its time has units, or ``rows``."""
    rows = rows or ROWS_PER_RANGE
    n = df.count()
    k = min(MAX_RANGES, -(-n // rows))
    splits: list[float] = []
    for c in sorted(set(df.approxQuantile(ts, [i / k for i in range(1, k)], 1 / (4 * k)))) if k > 1 else []:
        if not splits or c - splits[-1] >= SPANS_PER_RANGE * span:
            splits.append(c)
    df = df.withColumns({"_at": F.col(ts).cast("double"), "_until": (F.col(ts) + (span - 1)).cast("double")})
    for col, out in (("_at", "_first"), ("_until", "_last")):
        df = Bucketizer(splits=[float("-inf"), *(splits or [0.0]), float("inf")], inputCol=col, outputCol=out).transform(df)
    first = F.col("_first").cast("int")
    return (df.withColumn(name, F.explode(F.sequence(first, F.col("_last").cast("int"))))
            .withColumn("_own", F.col(name) == first).drop("_at", "_until", "_first", "_last"))
