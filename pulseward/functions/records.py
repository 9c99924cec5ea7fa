"""Wire-record parsing, validation, event time, serialisation and raw-row reshaping (column expressions).

Parsing rules (deliberately explicit):
  * the text must be a JSON object; anything else (array, scalar, ``null``, broken, empty, single quotes)
    is ``parsed = false``;
  * a missing key takes its default, an explicit ``null`` stays null;
  * a value of the wrong JSON type (``"age": "70"``, ``70.5`` for an int, ``true``) sets ``type_mismatch``.
The object test and key presence come from a ``map<string,string>`` parse; typed values from a struct parse
with a corrupt-record column. Catalyst prunes the struct parse to the fields a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COLUMN, WIRE_FIELDS, WIRE_PARSE_SCHEMA

JSON_OPTIONS = {"allowSingleQuotes": "false"}
LATE_DELAY_MS = 5_000          # bounded out-of-orderness of the live path
MIN_AGE, MAX_AGE = 0, 150      # inclusive limits
MIN_BMI, MAX_BMI = 10.0, 60.0  # inclusive limits

# Error codes written to the dead-letter table.
ERR_MALFORMED = "malformed_json"
ERR_TYPE = "type_mismatch"
ERR_NULL = "null_field"
ERR_AGE = "invalid_age"
ERR_BMI = "invalid_bmi"
ERR_CELL = "invalid_cell"
ERR_PRESSURE = "invalid_blood_pressure"


def parse_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``parsed``, ``type_mismatch`` and the typed record columns to ``df``."""
    m = F.from_json(F.col(value), "map<string,string>", JSON_OPTIONS)
    s = F.from_json(F.col(value), WIRE_PARSE_SCHEMA,
                    {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    staged = df.withColumn("_m", m).withColumn("_s", s)
    parsed = F.col("_m").isNotNull()
    cols = [parsed.alias("parsed"),
            (parsed & F.col(f"_s.{CORRUPT_COLUMN}").isNotNull()).alias("type_mismatch")]
    for name, dtype, default in WIRE_FIELDS:
        out = "readmission_risk" if name == "readmission_risk_raw" else name
        cols.append(
            F.when(~parsed, F.lit(None).cast(dtype))
             .when(F.map_contains_key(F.col("_m"), name), F.col(f"_s.{name}"))
             .otherwise(F.lit(default).cast(dtype)).alias(out))
    return staged.select("*", *cols).drop("_m", "_s")


def event_time_ms(arrival_ms: str = "arrival_ms") -> Column:
    """Event time: the record timestamp, falling back to arrival time when missing, 0 or unparsed."""
    ts = F.col("timestamp")
    return F.when(F.col("parsed") & ts.isNotNull() & (ts != 0), ts).otherwise(F.col(arrival_ms))


def error_code() -> Column:
    """First failing check in the order the live path applies them; null for a valid record.

    Nulls in fields that are later compared (age, bmi, cholesterol, medication_count, length_of_stay) are
    reported here too, as ``null_field``: a deliberate deviation that routes them to the dead-letter table.
    """
    age, bmi = F.col("age"), F.col("bmi")
    return (F.when(~F.col("parsed"), F.lit(ERR_MALFORMED))
             .when(F.col("type_mismatch"), F.lit(ERR_TYPE))
             .when(age.isNull(), F.lit(ERR_NULL))
             .when((age < MIN_AGE) | (age > MAX_AGE), F.lit(ERR_AGE))
             .when(bmi.isNull(), F.lit(ERR_NULL))
             .when((bmi < MIN_BMI) | (bmi > MAX_BMI), F.lit(ERR_BMI))
             .when(F.col("cholesterol").isNull() | F.col("medication_count").isNull()
                   | F.col("length_of_stay").isNull(), F.lit(ERR_NULL)))


def with_checks(parsed: DataFrame) -> DataFrame:
    """Add ``event_time_ms`` and ``error`` to a parsed feed."""
    return parsed.withColumn("event_time_ms", event_time_ms()).withColumn("error", error_code())


def serialise() -> Column:
    """The validated record as JSON; ``readmission_risk_raw`` goes out as ``readmission_risk``."""
    return F.to_json(F.struct(
        F.col("id"), "patient_id", "age", "gender", "systolic_bp", "diastolic_bp", "cholesterol", "bmi",
        "diabetes", "hypertension", "medication_count", "length_of_stay", "discharge_destination",
        "readmission_risk", "timestamp"))


def yes_no_flag(col: Column) -> Column:
    """Exactly 'Yes' -> 1, everything else (including null) -> 0."""
    return F.coalesce((col == F.lit("Yes")).cast("int"), F.lit(0))


def blood_pressure(text: Column) -> tuple[Column, Column]:
    """Systolic and diastolic value of 'sys/dia'; null where a part is missing or no whole number."""
    parts = F.split(text, "/")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def raw_error_code() -> Column:
    """Error of a raw row, null if it can be reshaped: a cell that doesn't fit its column (``corrupt`` holds the
    line), or a blood pressure that isn't two whole numbers."""
    systolic, diastolic = blood_pressure(F.col("blood_pressure"))
    return (F.when(F.col("corrupt").isNotNull(), F.lit(ERR_CELL))
             .when(F.col("blood_pressure").isNotNull() & (systolic.isNull() | diastolic.isNull()),
                   F.lit(ERR_PRESSURE)))


def raw_to_wire(raw: DataFrame, timestamp: Column, id_prefix: str = "patient_",
                with_ms_in_id: bool = True) -> DataFrame:
    """Reshape raw CSV rows into wire-record columns (blood pressure split, Yes/No flags, record ids)."""
    systolic, diastolic = blood_pressure(F.col("blood_pressure"))
    pid = F.col("patient_id").cast("long")
    rid = (F.concat(F.lit(id_prefix), pid.cast("string"), F.lit("_"), timestamp.cast("string"))
           if with_ms_in_id else F.concat(F.lit(id_prefix), pid.cast("string")))
    return raw.select(
        "*",
        rid.alias("id"),
        systolic.alias("systolic_bp"),
        diastolic.alias("diastolic_bp"),
        yes_no_flag(F.col("diabetes")).alias("diabetes_flag"),
        yes_no_flag(F.col("hypertension")).alias("hypertension_flag"),
        yes_no_flag(F.col("readmitted_30_days")).cast("double").alias("readmission_risk_raw"),
        timestamp.cast("long").alias("timestamp"),
    )
