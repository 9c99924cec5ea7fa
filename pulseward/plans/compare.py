"""Local correctness check: run a catalogue query in Spark and its oracle SQL in DuckDB, compare results.

Comparison: same column names (sorted) and types, same row count, and the same multiset of rows after
normalising (floats rounded to 9 significant digits, NaN/None unified; PULSEWARD_STRICT_COMPARE=1 compares
floats exactly). Used by tests and ``python -m pulseward.plans.compare``.
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

from ..tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                  "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint", "DATE": "date"}


STRICT = os.environ.get("PULSEWARD_STRICT_COMPARE", "0") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, con, name: str, sf_dir: str, spark_df=None) -> tuple[bool, str]:
    from .catalog import QUERIES
    from .oracle import ORACLE
    sdf = spark_df if spark_df is not None else QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    o_cols = rel.columns
    o_rows = rel.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    o_types = dict(zip(o_cols, [str(t) for t in rel.types]))
    bad_types = [(c, t, o_types[c]) for c, t in sdf.dtypes if _DUCK_TO_SPARK.get(o_types[c], o_types[c]) != t]
    if bad_types:
        return False, f"column types differ (name, spark, duckdb): {bad_types}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_index = {c: i for i, c in enumerate(o_cols)}
    s_set = Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    o_set = Counter(tuple(_norm(r[o_index[s_cols[i]]]) for i in order) for r in o_rows)
    if s_set != o_set:
        only_s = list((s_set - o_set).elements())[:3]
        only_o = list((o_set - s_set).elements())[:3]
        cols = [s_cols[i] for i in order]
        return False, f"values differ ({cols}); spark-only={only_s} oracle-only={only_o}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    from ..session import get_spark
    from .oracle import ORACLE
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(ORACLE)
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
