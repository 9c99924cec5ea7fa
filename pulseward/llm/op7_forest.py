"""Approximate nearest neighbours by a hash-prefix forest.

Index vectors are dealt to blocks. A block holds one sorted array of hash strings (``BITS`` signs of random
projections) per tree. A query descends in every tree to its longest matching prefix, and then ascends in all trees at
once, one bit at a time: the vectors that share the shorter prefix are a range of each array. All candidates met are
compared exactly, in double precision. The ascent ends at length x once a vector as near as the query's k-th best so
far would have been missed by all ``TREES`` trees with probability ``MISS`` at most, (1 - p^x)^TREES with
p = 1 - angle / pi. There is no cap: at length 0 the whole block has been compared, so a query that stays uncertain
(vectors without structure) costs as much as brute force, and near neighbours end the ascent early.

The query set meets the blocks in chunks: a join on (chunk, block), a row each. Each pair yields k rows per query;
the best k of all blocks are kept. Block and chunk sizes are fixed, so a task's memory is too; blocks do not depend on
the values, so no cluster of equal vectors makes a hot one.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part; rows without
vec_id neither; rows that repeat a vec_id count once (the smallest vector); vectors of other dimensions are never
compared; fewer than k candidates give fewer rows; ties go to the smaller vec_id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stage

K = 5                # fixed by the contract
EVERY = 50           # fixed by the contract
TREES = 64
BITS = 24
MISS = 0.05
BLOCK = 1 << 14      # vectors
CHUNK = 1 << 11      # queries
SEED = 20_240


def planes(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((trees * bits, dim))


def hash_strings(unit: np.ndarray, normal: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(trees x vectors) hash strings as unsigned numbers, the first bit highest."""
    sign = (unit @ normal.T > 0).reshape(len(unit), -1, bits)
    weight = (1 << np.arange(bits - 1, -1, -1)).astype(np.int64)
    return (sign @ weight).T


def measured(vectors: np.ndarray) -> np.ndarray:
    """Norms. Vectors are first scaled by a power of two, which is exact, so that squares stay finite."""
    return np.sqrt((vectors * vectors).sum(axis=1))


def scaled(vectors: np.ndarray) -> np.ndarray:
    _, e = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -e[:, None])


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K,
           trees: int = TREES, bits: int = BITS, miss: float = MISS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's ``k`` nearest found in one block."""
    v, q = scaled(vectors), scaled(queries)
    nv, nq = measured(v), measured(q)
    normal = planes(v.shape[1], trees, bits)
    code, mine = hash_strings(v / nv[:, None], normal, bits), hash_strings(q / nq[:, None], normal, bits)
    order = np.argsort(code, axis=1, kind="stable")
    tree = np.take_along_axis(code, order, axis=1)
    seen = np.zeros((len(q), len(v)), bool)
    seen[query_ids[:, None] == ids] = True     # a query's own row is no candidate
    best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(len(q))]
    live = np.arange(len(q))
    for length in range(bits, -1, -1):
        if not len(live):
            break
        step = 1 << (bits - length)
        prefix = mine[:, live] & ~(step - 1)
        lo = np.stack([np.searchsorted(t, p, "left") for t, p in zip(tree, prefix)])
        hi = np.stack([np.searchsorted(t, p + step, "left") for t, p in zip(tree, prefix)])
        still = []
        for j, i in enumerate(live):
            met = np.zeros(len(v), bool)
            for t in np.flatnonzero(hi[:, j] > lo[:, j]) if length else [0]:
                met[order[t, lo[t, j]:hi[t, j]]] = True
            new = np.flatnonzero(met & ~seen[i])
            if len(new):
                seen[i, new] = True
                s = (v[new] * q[i]).sum(axis=1) / (nv[new] * nq[i])
                a, b = np.concatenate([best[i][0], ids[new]]), np.concatenate([best[i][1], s])
                top = np.lexsort((a, -b))[:k]
                best[i] = a[top], b[top]
            if len(best[i][1]) >= k:
                p = 1 - np.arccos(np.clip(best[i][1][k - 1], -1, 1)) / np.pi
                if (1 - p ** length) ** trees <= miss:
                    continue
            still.append(i)
        live = np.array(still, np.int64)
    return best


def _dealt(rows: DataFrame, name: str, size: int) -> DataFrame:
    """(dim, name, ids, data): the vectors of ``rows`` (vec_id, v, dim) in blocks of about ``size``."""
    count = stage(rows.groupBy("dim").agg(F.count("*").alias("n")).select(
        "dim", F.ceil(F.col("n") / size).cast("int").alias("blocks")), "op7-sizes")
    cell = rows.join(count, "dim").withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    return stage(cell.groupBy("dim", name).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")), f"op7-{name}")


def nearest(vectors: DataFrame, is_query, k: int = K, block: int = BLOCK, chunk: int = CHUNK, trees: int = TREES,
            bits: int = BITS, miss: float = MISS) -> DataFrame:
    """query_id, rank, vec_id, score of ``vectors`` (vec_id, embedding) for the rows that ``is_query`` holds for."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    rows = stage(rows, "op7-rows")
    index = _dealt(rows, "block", block)
    query = _dealt(rows.where(is_query), "chunk", chunk)
    left = index.join(query.select("dim", "chunk"), "dim").withColumnRenamed("rows", "index")
    right = query.join(index.select("dim", "block"), "dim").withColumnRenamed("rows", "queries")
    pairs = left.join(right, ["dim", "block", "chunk"]).select("dim", "index", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(column: pa.Array, i: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
            each = column.slice(i, 1).flatten()
            return (each.field(0).to_numpy(zero_copy_only=False),
                    each.field(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))

        for b in batches:
            for i, dim in enumerate(b.column(0).to_pylist()):
                ids, v = arrays(b.column(1), i, dim)
                qids, q = arrays(b.column(2), i, dim)
                found = search(ids, v, qids, q, k, trees, bits, miss)
                sizes = [len(a) for a, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qids, sizes)), pa.array(np.concatenate([a for a, _ in found])),
                     pa.array(np.concatenate([s for _, s in found]))], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op7_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
