"""Explicit schemas (never inferred) for the raw rows, the wire record and the streaming state."""

from pyspark.sql import types as T

# Raw discharge row as read from CSV.
RAW_CSV_SCHEMA = T.StructType([
    T.StructField("patient_id", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("blood_pressure", T.StringType()),
    T.StructField("cholesterol", T.IntegerType()),
    T.StructField("bmi", T.DoubleType()),
    T.StructField("diabetes", T.StringType()),
    T.StructField("hypertension", T.StringType()),
    T.StructField("medication_count", T.IntegerType()),
    T.StructField("length_of_stay", T.IntegerType()),
    T.StructField("discharge_destination", T.StringType()),
    T.StructField("readmitted_30_days", T.StringType()),
])
RAW_COLUMNS = [f.name for f in RAW_CSV_SCHEMA.fields]

# Wire record keys, their Spark types and the default used when a key is missing
# (an explicit JSON null stays null).
WIRE_FIELDS = [
    ("id", T.StringType(), ""),
    ("patient_id", T.LongType(), 0),
    ("age", T.IntegerType(), 0),
    ("gender", T.StringType(), "Unknown"),
    ("systolic_bp", T.IntegerType(), 120),
    ("diastolic_bp", T.IntegerType(), 80),
    ("cholesterol", T.IntegerType(), 200),
    ("bmi", T.DoubleType(), 25.0),
    ("diabetes", T.IntegerType(), 0),
    ("hypertension", T.IntegerType(), 0),
    ("medication_count", T.IntegerType(), 0),
    ("length_of_stay", T.IntegerType(), 0),
    ("discharge_destination", T.StringType(), "Home"),
    ("readmission_risk_raw", T.DoubleType(), 0.5),
    ("timestamp", T.LongType(), 0),
]
WIRE_SCHEMA = T.StructType([T.StructField(n, t) for n, t, _ in WIRE_FIELDS])
CORRUPT_COLUMN = "_corrupt_record"
WIRE_PARSE_SCHEMA = T.StructType(WIRE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])

# Record columns after parsing: ``readmission_risk_raw`` is carried as ``readmission_risk``.
RECORD_COLUMNS = [("readmission_risk" if n == "readmission_risk_raw" else n) for n, _, _ in WIRE_FIELDS]

# Incoming stream row: broker offset, broker timestamp (arrival), raw value.
FEED_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("arrival_ms", T.LongType()),
    T.StructField("value", T.StringType()),
])

# Per-patient state kept by the streaming processor.
STATE_SCHEMA = T.StructType([
    T.StructField("total_records", T.LongType()),
    T.StructField("high_risk_count", T.LongType()),
    T.StructField("medium_risk_count", T.LongType()),
    T.StructField("low_risk_count", T.LongType()),
    T.StructField("last_activity", T.LongType()),
    T.StructField("created_ms", T.LongType()),
])

PATIENT_STATS_SCHEMA = T.StructType([
    T.StructField("total_records", T.LongType()),
    T.StructField("high_risk_count", T.LongType()),
    T.StructField("medium_risk_count", T.LongType()),
    T.StructField("low_risk_count", T.LongType()),
    T.StructField("high_risk_ratio", T.DoubleType()),
    T.StructField("last_activity", T.LongType()),
    T.StructField("state_age_seconds", T.DoubleType()),
])

FEATURES_SCHEMA = T.StructType([
    T.StructField("age", T.IntegerType()),
    T.StructField("bmi", T.DoubleType()),
    T.StructField("medication_count", T.IntegerType()),
    T.StructField("length_of_stay", T.IntegerType()),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("patient_id", T.LongType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("patient_stats", PATIENT_STATS_SCHEMA),
    T.StructField("processing_timestamp", T.LongType()),
    T.StructField("processing_latency_ms", T.DoubleType()),
    T.StructField("watermark", T.LongType()),
    T.StructField("features", FEATURES_SCHEMA),
])
