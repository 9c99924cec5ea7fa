"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging

__all__ = ["stage", "discard", "stored", "read", "words", "non_space", "keyed", "let", "SPACE"]

#: Characters that separate words: space and U+0009..U+000D.
SPACE = " \t\n\x0b\x0c\r"


_STORED: list[str] = []


def stage(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df``, written to a table of its own in the shared folder (``options``: of the writer) and read back."""
    spark = df.sparkSession
    path = staging._path(spark, name)
    df.write.options(**options or {}).parquet(path)
    _STORED.append(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the tables of ``stage`` results that nothing reads any more: whatever was made from them is written."""
    for f in frames:
        delete(f.sparkSession, f.__dict__.get("_stored_at"))


def delete(spark: SparkSession, path: str | None) -> None:
    if path:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _STORED:
            _STORED.remove(path)


def stored() -> list[str]:
    """Paths of the tables that ``stage`` has written in this process and nobody has deleted."""
    return list(_STORED)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; a null text has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACE, " " * len(SPACE))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once. A filter that the optimizer pushes below a projection takes the
    projection's expressions with it; bound like this, an array isn't built anew in every step of a lambda over it."""
    return F.transform(F.array(value), use)[0]


def non_space(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns plus ``rid``, a row number of its own for every row (also of repeated rows and rows
    without an id), written once so that a retried task or a second scan sees the same numbers."""
    return stage(docs.select(*columns).withColumn("rid", F.monotonically_increasing_id()), "keyed")
