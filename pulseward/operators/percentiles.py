"""Exact percentiles without gathering a group's values in one place, in two ways.

``selected_percentiles`` (one row for all rows, or for a few groups that the caller names) selects order statistics by
histogram refinement. Every value has an order-preserving 64-bit code (``with_ordered_code``). A round counts the rows per
cell, the leading ``BITS`` bits of the code, map-side combined; the driver gets these counts, at most 2^BITS for each
cell kept before, keeps the cell that each wanted rank falls into, and the next round counts inside the kept cells by
the next bits. All groups and quantiles share a round, so a round is one scan of one column and moves no rows. Rounds
end when a kept cell holds ``SMALL`` rows or fewer, or is a single value (after ceil(64 / BITS) rounds at the latest);
the last pass counts the values in the kept cells and picks the ranks. No sort, sketch or spread of the values matters.

``exact_percentiles`` serves any number of groups, as tables keyed by time have them.
``percentile`` in Spark keeps every distinct value of a group in one aggregation buffer. Here the values are
first counted per (keys, value) -- a partial aggregation, so a hot group is combined map-side -- and the counts are
stored. Ranks come from the two-level running sum of ``operators.scan`` over ranges of the values of about equal row
counts (``with_ranges``), however the values are spread, and the two neighbouring order statistics are picked:

    pos = (n - 1) * q,  p = v[floor(pos)] + (v[ceil(pos)] - v[floor(pos)]) * (pos - floor(pos))

(the "linear" rule of numpy and DuckDB ``quantile_cont``). Results are rounded to ``digits``; the two engines
agree only to about 1e-14 on interpolated values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half
from ..staging import stage
from .scan import Running, chunked_running, with_ranges

BITS = 13            # of the code per round: 8,192 cells
SMALL = 1 << 16      # rows of a cell that needs no further round
CODE_BITS = 64


def with_ordered_code(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with ``name``, a long that orders like the double ``value``: equal for equal values (0.0 and -0.0 as
    well), larger for larger ones, NaN last. It is the number of doubles between zero and the value, made of exponent
    and mantissa by exact arithmetic (divisions by powers of two); ``log2`` may be one off beside a power of two."""
    two = lambda e: F.pow(F.lit(2.0), e)
    a = F.abs(F.col(value))
    guess = F.greatest(F.floor(F.log2(F.when((a > 0) & (a < float("inf")), a).otherwise(1.0))).cast("int"), F.lit(-1022))
    df = df.withColumn("_e", guess)
    e = F.col("_e") + (a >= two(F.col("_e") + 1)).cast("int") - ((a < two(F.col("_e"))) & (F.col("_e") > -1022)).cast("int")
    df = df.withColumn("_e", e)
    size = (F.col("_e") + 1022).cast("long") * (1 << 52) + (a / two(F.col("_e")) * F.lit(2.0 ** 52)).cast("long")
    code = (F.when(F.isnan(value), F.lit((2047 << 52) + 1)).when(a == float("inf"), F.lit(2047 << 52) * F.signum(value).cast("long"))
            .when(a == 0, F.lit(0)).otherwise(size * F.signum(value).cast("long")))
    return df.withColumn(name, code.cast("long")).drop("_e")


def _cell_of(kept: list[tuple[str, int]], shift: int) -> Column:
    """The number in ``kept`` (group, leading bits of the code) of a row's cell; null if it is in none."""
    at = F.shiftright(F.col("_code"), shift) if shift < CODE_BITS else F.lit(0)
    out = F.lit(None).cast("int")
    for i, (group, prefix) in enumerate(kept):
        out = F.when((F.col("_group") == group) & (at == prefix), F.lit(i)).otherwise(out)
    return out


def selected_percentiles(df: DataFrame, value: str, qs: dict[str, float], groups: Column | None = None,
                         names: tuple[str, ...] = ("",), digits: int = 6) -> DataFrame:
    """One row with a column ``<group><name>`` for every group of ``names`` and entry of ``qs`` (name -> quantile).

    ``groups`` gives a row's group; rows of groups that aren't named, and null values, take no part. A group without
    values has nulls. The rule between two order statistics is that of ``exact_percentiles``.
    """
    group = F.lit(names[0]) if groups is None else groups
    rows = df.select(group.alias("_group"), F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & F.col("_group").isin(*names))
    rows = with_ordered_code(rows, "_v", "_code")
    kept = [(g, 0) for g in names]                       # cells of the round
    ranks: dict[tuple[str, int], list] = {}              # (group, rank) -> [number of its cell, rank inside]
    total: dict[str, int] = {}
    shift = CODE_BITS
    while True:
        step = max(0, shift - BITS)
        counts = (rows.select(_cell_of(kept, shift).alias("i"), F.shiftright(F.col("_code"), step).alias("cell"))
                  .filter("i is not null").groupBy("i", "cell").agg(F.count(F.lit(1)).alias("c")).collect())
        if shift == CODE_BITS:
            for r in counts:
                total[names[r.i]] = total.get(names[r.i], 0) + r.c
            for g, n in total.items():
                for q in qs.values():
                    for k in (math.floor((n - 1) * q), math.ceil((n - 1) * q)):
                        ranks[g, k] = [names.index(g), k]
        cells: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r.i, r.cell)):
            cells.setdefault(r.i, []).append((r.cell, r.c))
        chosen, largest = {}, 0
        for (g, k), at in ranks.items():
            inside = at[1]
            for cell, c in cells[at[0]]:
                if inside < c:
                    break
                inside -= c
            largest = max(largest, c)
            at[:] = [chosen.setdefault((g, cell), len(chosen)), inside]
        kept, shift = list(chosen), step
        if shift == 0 or largest <= SMALL:
            break
    # few rows: a kept cell has SMALL rows at most, or one value
    counted = (rows.select(_cell_of(kept, shift).alias("i"), "_v").filter("i is not null")
               .groupBy("i", "_v").agg(F.count(F.lit(1)).alias("_c")))
    ranked = counted.withColumn("_hi", F.sum("_c").over(
        Window.partitionBy("i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def at_rank(g: str, k: int) -> Column:
        i, inside = ranks[g, k]
        return F.max(F.when((F.col("i") == i) & (F.col("_hi") > inside) & (F.col("_hi") - F.col("_c") <= inside), F.col("_v")))

    picks, out = [], []
    for g in names:
        for name, q in qs.items():
            if g not in total:
                out.append(F.lit(None).cast("double").alias(f"{g}{name}"))
                continue
            pos = (total[g] - 1) * q
            lo, hi = f"_{g}{name}_lo", f"_{g}{name}_hi"
            picks += [at_rank(g, math.floor(pos)).alias(lo), at_rank(g, math.ceil(pos)).alias(hi)]
            out.append(round_half(F.col(lo) + (F.col(hi) - F.col(lo)) * F.lit(pos - math.floor(pos)), digits)
                       .alias(f"{g}{name}"))
    return ranked.agg(F.count(F.lit(1)).alias("_n"), *picks).select(*out)


def exact_percentiles(df: DataFrame, value: str, qs: dict[str, float], keys: list[str] | None = None,
                      digits: int = 6) -> DataFrame:
    """One row per key combination with one column per entry of ``qs`` (name -> quantile in [0, 1])."""
    if not keys:
        return selected_percentiles(df, value, qs, digits=digits)
    v = F.col(value).cast("double")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counts = stage(counts, "percentile_counts")
    ranked = chunked_running(with_ranges(counts, "_v", None), keys, None, ["_v"], [Running("_hi", "sum", F.col("_c"))],
                             chunk_name="_range")
    ranked = ranked.join(counts.groupBy(*keys).agg(F.sum("_c").alias("_n")), keys)
    picks = []
    for name, q in qs.items():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        hit = lambda k: (F.col("_hi") - F.col("_c") <= k) & (k < F.col("_hi"))
        picks += [F.max(F.when(hit(lo), F.col("_v"))).alias(f"_{name}_lo"),
                  F.max(F.when(hit(hi), F.col("_v"))).alias(f"_{name}_hi"),
                  F.max(pos - lo).alias(f"_{name}_f")]
    agg = ranked.groupBy(*keys).agg(*picks)
    out = [round_half(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f"), digits).alias(n)
           for n in qs]
    return agg.select(*keys, *out)
