"""Writing intermediate DataFrames to the cluster's checkpoint folder and reading them back.

A DataFrame consumed by two branches of one plan (rows and their per-chunk summary, say) is otherwise
recomputed per branch, and each nested two-level step doubles the upstream work. Writing it once as parquet
under ``spark.checkpoint.dir`` -- a shared, reliable folder, written by retry-safe tasks, so a lost executor
only re-runs its own tasks -- cuts the lineage. ``stage`` writes a fresh table on every call; ``shared``
writes once per (application, source folder, name) and reuses it within the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir

_SHARED: dict[tuple[str, str, str], str] = {}


def _path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = _path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shared(spark: SparkSession, df: DataFrame, name: str, source: str) -> DataFrame:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # no SparkContext on this client
        app = spark.conf.get("spark.app.id", "session")
    key = (app, source, name)
    path = _SHARED.get(key)
    if path is None:
        path = _path(spark, name)
        df.write.mode("overwrite").parquet(path)
        _SHARED[key] = path
    return spark.read.parquet(path)
