"""Epoch-millisecond helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970-01-01 (truncating microseconds) of a TIMESTAMP or TIMESTAMP_NTZ column.

    A wall-clock (NTZ) value is read as UTC, independent of ``spark.sql.session.timeZone``.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    else:
        micros = F.unix_micros(F.col(name))
    return F.floor(micros / F.lit(1000)).cast("long")
