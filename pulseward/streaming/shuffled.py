"""Shuffled replay as a stream (S9): without replacement within an epoch, without ranking rows.

Record i of the replay is in epoch ``i div n`` and takes row ``permutation(i mod n)`` of that epoch's keyed bijection of
the n rows. The bijection is a Feistel network over pairs (left, right) with ``left < a`` and ``right < b``, where
``a * b`` is just above n; a value beyond n goes through it again until it is below (cycle walking), which keeps it
a bijection. So any record's row is known from i alone: the stream restarts at any offset, and no row is ranked.
The offsets and the rate are those of Spark's ``rate-micro-batch`` source.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

ROUNDS = 6


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permutation(i: np.ndarray, n: int, epoch: np.ndarray, seed: int) -> np.ndarray:
    """Row of each position ``i`` (0 to n - 1) of its epoch."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = -(-n // a)
    key = _scramble(epoch.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 64)))

    def once(x: np.ndarray, k: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for r in range(ROUNDS):
            k = _scramble(k + np.uint64(0xD6E8FEB86659FD93))
            if r % 2 == 0:
                left = (left + (_scramble(k ^ right.astype(np.uint64)) % np.uint64(a)).astype(np.int64)) % a
            else:
                right = (right + (_scramble(k ^ left.astype(np.uint64)) % np.uint64(b)).astype(np.int64)) % b
        return left * b + right

    with np.errstate(over="ignore"):
        out = once(i.astype(np.int64), key)
        beyond = np.flatnonzero(out >= n)
        while len(beyond):
            out[beyond] = once(out[beyond], key[beyond])
            beyond = beyond[out[beyond] >= n]
    return out


def row_of(n: int, seed: int):
    """Column function (i) -> row index of record i."""
    @pandas_udf("long")
    def row(i: pd.Series) -> pd.Series:
        x = i.to_numpy()
        return pd.Series(permutation(x % n, n, x // n, seed))
    return row


def shuffled_replay_source(spark: SparkSession, records: DataFrame, n_rows: int, rows_per_batch: int, t0_ms: int,
                           rps: int = 50, seed: int = 42) -> DataFrame:
    """(seq, arrival_ms, value) of ``records`` (row_index from 0 to ``n_rows`` - 1, value), replayed epoch by epoch in
    shuffled order at ``rps`` records a second of replay time."""
    if n_rows < 1:
        raise ValueError("nothing to replay")
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", str(rows_per_batch)).load()
             .select(F.col("value").alias("seq")))
    picked = ticks.withColumn("row_index", row_of(n_rows, seed)("seq"))
    at = F.lit(t0_ms) + (F.col("seq") * F.lit(1000) / F.lit(rps)).cast("long")
    return picked.join(records.select("row_index", "value"), "row_index").select("seq", at.alias("arrival_ms"), "value")
