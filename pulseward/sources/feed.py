"""The record feed derived from the supplied ``events`` table.

The feed plays the role of the broker topic: ``seq`` is the offset, ``arrival_ms`` the broker timestamp and
``value`` the JSON text of one wire record. Dirt and delay come from integer arithmetic on ``event_id`` only,
so the same definitions can be written in DuckDB SQL for the oracle (see ``plans.oracle``):

  malformed         event_id % 101 = 7 (JSON text cut short)
  missing key       no cholesterol at event_id % 107 = 3 (takes its default)
  explicit null     bmi at event_id % 109 = 5
  wrong type        age as text at event_id % 113 = 9
  age               -1 / 151 at event_id % 97 = 5 / 11, else 18 + (event_id*37 + user_id*11) % 73
  bmi               5.0 / 60.5 at event_id % 89 = 3 / 7, else (180 + event_id*53 % 221) / 10
  timestamp         0 at event_id % 103 = 1 (exercises the fall-back to arrival time), else epoch ms of ts
  arrival_ms        epoch ms of ts, plus 6 h when event_id % 23 = 0 (those rows arrive late)

Epoch milliseconds truncate the microseconds of ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import epoch_ms
from ..tables import read_table

SIX_HOURS_MS = 21_600_000

# Fixed values of the derived feed.
GENDERS = ["Male", "Female", "Other"]
DESTINATIONS = ["Home", "Nursing_Facility", "Rehab"]


def _pick(values: list[str], index: Column) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def feed_fields(events: DataFrame) -> DataFrame:
    """Typed record fields per event (before JSON encoding), plus ``seq``, ``ts_ms``, ``arrival_ms``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    ts_ms = epoch_ms(events, "ts")
    return events.select(
        eid.alias("seq"),
        uid.alias("patient_id"),
        (eid % 101 == 7).alias("malformed"),
        F.when(eid % 97 == 5, F.lit(-1)).when(eid % 97 == 11, F.lit(151))
         .otherwise(18 + (eid * 37 + uid * 11) % 73).cast("int").alias("age"),
        _pick(GENDERS, eid % 3).alias("gender"),
        (100 + eid % 81).cast("int").alias("systolic_bp"),
        (60 + eid % 61).cast("int").alias("diastolic_bp"),
        (150 + (eid * 29) % 151).cast("int").alias("cholesterol"),
        F.when(eid % 89 == 3, F.lit(5.0)).when(eid % 89 == 7, F.lit(60.5))
         .otherwise((180 + (eid * 53) % 221).cast("double") / 10).alias("bmi"),
        ((uid * 3 + eid) % 5 < 2).cast("int").alias("diabetes"),
        ((uid + eid * 3) % 7 < 4).cast("int").alias("hypertension"),
        ((eid * 7) % 11).cast("int").alias("medication_count"),
        (1 + (eid * 13) % 21).cast("int").alias("length_of_stay"),
        _pick(DESTINATIONS, uid % 3).alias("discharge_destination"),
        F.when(F.col("event_type") == "purchase", F.lit(1.0)).otherwise(F.lit(0.0)).alias("readmission_risk_raw"),
        F.when(eid % 103 == 1, F.lit(0).cast("long")).otherwise(ts_ms).alias("timestamp"),
        ts_ms.alias("ts_ms"),
        (ts_ms + F.when(eid % 23 == 0, F.lit(SIX_HOURS_MS)).otherwise(F.lit(0))).alias("arrival_ms"),
    )


def record_json(fields: DataFrame) -> Column:
    """JSON text of the wire record: keys left out, nulls, texts for numbers, and malformed rows cut short."""
    doc = F.to_json(F.struct(
        F.concat(F.lit("patient_"), F.col("patient_id").cast("string"), F.lit("_"),
                 F.col("ts_ms").cast("string")).alias("id"),
        "patient_id", "age", "gender", "systolic_bp", "diastolic_bp", "cholesterol", "bmi", "diabetes",
        "hypertension", "medication_count", "length_of_stay", "discharge_destination",
        "readmission_risk_raw", "timestamp"))
    seq = F.col("seq")
    doc = F.when(seq % 107 == 3, F.regexp_replace(doc, '"cholesterol":[0-9]+,', "")).otherwise(doc)
    doc = F.when(seq % 109 == 5, F.regexp_replace(doc, '"bmi":[0-9.]+', '"bmi":null')).otherwise(doc)
    doc = F.when(seq % 113 == 9, F.regexp_replace(doc, '"age":(-?[0-9]+)', '"age":"$1"')).otherwise(doc)
    return F.when(F.col("malformed"), F.substring(doc, 1, 40)).otherwise(doc)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, arrival_ms, value): the broker feed derived from ``events``."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    fields = feed_fields(events)
    return fields.select("seq", "arrival_ms", record_json(fields).alias("value"))
