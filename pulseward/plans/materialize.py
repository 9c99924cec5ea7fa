"""Shared intermediate tables of the catalogue (see ``pulseward.staging``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..staging import shared


def materialize(spark: SparkSession, df: DataFrame, name: str, source: str) -> DataFrame:
    """Write ``df`` once per session and source folder; later calls read the stored table."""
    return shared(spark, df, name, source)
