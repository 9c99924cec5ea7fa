"""Loading the raw discharge file and replaying it.

  cleanse          whole-row de-duplication keeping the first copy in file order, then rows with any null
                   dropped. The first copy is ``min(seq)`` per distinct row: one aggregation, combined map-side.
  to_records       raw row -> wire record columns (blood pressure split, Yes/No -> 1/0, record ids).
  replay_cyclic    the file in order, wrapping at the end; record i has event time t0 + 100 ms * (i + 1).
  replay_shuffled  epochs of sampling without replacement: epoch = i div N, order inside an epoch by
                   xxhash64(seed, epoch, seq); record i has event time t0 + i * 1000 / rps ms.
  stratified       the first n/2 rows labelled 'Yes' followed by the first n/2 labelled 'No', flagged as tests.

Row numbers (0..N-1 in file order, needed to wrap the replay) come from the running count in
``operators.scan`` chunked by blocks of ``seq`` (and the block summaries again by blocks of blocks); ranks
inside a shuffled epoch likewise, over ranges of the hash.
Replays are generated with ``spark.range`` and an equi-join on the row number, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import raw_error_code, raw_to_wire
from ..operators.scan import Running, chunked_running
from ..schemas import RAW_COLUMNS, RAW_CSV_SCHEMA

T0_MS = 1704067200000          # 2024-01-01 00:00:00 UTC, start of every replay clock
CYCLIC_STEP_MS = 100
SEQ_CHUNK = 4096

# The two rows used when the discharge file is missing.
DEMO_ROWS = [
    (1, 65, "Male", "130/80", 200, 25.5, "Yes", "No", 3, 5, "Home", "No"),
    (2, 72, "Female", "140/90", 240, 28.1, "No", "Yes", 5, 7, "Nursing_Facility", "Yes"),
]


def read_raw_csv(spark: SparkSession, path: str | None, demo: bool = False) -> DataFrame:
    """Header CSV with the explicit raw schema, ``seq`` (position in file order) and ``corrupt``, the line of
    a row with a cell that doesn't fit its column. ``demo``: the two demo rows instead of a file; a path that doesn't
    exist is an error.

    Common missing-value spellings are read as null so that ``cleanse`` drops them.
    """
    if demo:
        rows = spark.createDataFrame(DEMO_ROWS, RAW_CSV_SCHEMA).withColumn("corrupt", F.lit(None).cast("string"))
        return rows.withColumn("seq", F.monotonically_increasing_id())
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField("corrupt", T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "corrupt").csv(path))
    missing = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None"]
    for c, t in zip(RAW_COLUMNS, RAW_CSV_SCHEMA.fields):
        if t.dataType.simpleString() == "string":
            df = df.withColumn(c, F.when(F.trim(F.col(c)).isin(missing), None).otherwise(F.col(c)))
    # position in file order: ids increase with the partition and the row inside it
    return df.withColumn("seq", F.monotonically_increasing_id())


def good_rows(raw: DataFrame) -> DataFrame:
    """The raw rows that can be reshaped; the others are ``operators.dlq.raw_dead_letters``."""
    return raw.filter(raw_error_code().isNull()).drop("corrupt")


def cleanse(raw: DataFrame) -> DataFrame:
    """Drop duplicate rows (first copy kept) and rows with any null."""
    firsts = raw.groupBy(*RAW_COLUMNS).agg(F.min("seq").alias("seq"))
    return firsts.na.drop("any").select("seq", *RAW_COLUMNS)


def to_records(rows: DataFrame, timestamp: F.Column) -> DataFrame:
    """Wire-record columns; ``timestamp`` gives the event ms used in the record id."""
    w = raw_to_wire(rows, timestamp)
    return w.select(
        "seq", "id", F.col("patient_id").cast("long").alias("patient_id"), "age", "gender", "systolic_bp",
        "diastolic_bp", "cholesterol", "bmi", F.col("diabetes_flag").alias("diabetes"),
        F.col("hypertension_flag").alias("hypertension"), "medication_count", "length_of_stay",
        "discharge_destination", "readmission_risk_raw", "timestamp")


def with_row_index(rows: DataFrame, chunk: int = SEQ_CHUNK) -> DataFrame:
    """Add ``row_index`` = 0-based position by ``seq`` without a single-task window."""
    out = chunked_running(rows, [], F.floor(F.col("seq") / F.lit(chunk)), ["seq"],
                          [Running("_pos", "sum", F.lit(1).cast("long"))],
                          summary_chunk=lambda c: F.floor(c / F.lit(chunk)))
    return out.withColumn("row_index", F.col("_pos") - 1).drop("_pos")


def replay_cyclic(spark: SparkSession, rows: DataFrame, total: int, n_rows: int) -> DataFrame:
    """``total`` records replaying ``rows`` (``n_rows`` of them) in file order, wrapping at the end."""
    indexed = with_row_index(rows)
    positions = spark.range(total if n_rows else 0).select(
        F.col("id").alias("i"), (F.col("id") % F.lit(max(n_rows, 1))).alias("row_index"))
    ts = F.lit(T0_MS) + F.lit(CYCLIC_STEP_MS) * (F.col("i") + 1)
    joined = positions.join(indexed, "row_index", "inner").withColumn("_ts", ts)
    rec = raw_to_wire(joined, F.col("_ts"))
    return rec.select("i", "seq", F.col("patient_id").cast("long").alias("patient_id"), "id", "timestamp")


def replay_shuffled(rows: DataFrame, total: int, n_rows: int, rps: int, seed: int) -> DataFrame:
    """(i, epoch, seq, patient_id, timestamp, id) for ``total`` records sampled epoch by epoch without
    replacement; the order inside an epoch is a hash permutation, so the result is deterministic. Record ids
    are ``medical_record_{patient}_{ms}`` with the replay clock's ms."""
    epochs = -(-total // max(n_rows, 1))
    if epochs <= 0:
        rows, epochs = rows.limit(0), 1
    per_epoch = rows.select("seq", "patient_id", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    h = F.xxhash64(F.lit(seed), F.col("epoch"), F.col("seq"))
    hashed = per_epoch.withColumn("_h", h)
    # ranges of the hash, about 2^16 rows each, so that the summary is far smaller than the rows
    bits = max(0, n_rows.bit_length() - 16)
    chunk = F.shiftright(F.col("_h"), 64 - bits) if bits else F.lit(0).cast("long")
    ranked = chunked_running(hashed, ["epoch"], chunk, ["_h", "seq"], [Running("_rank", "sum", F.lit(1).cast("long"))])
    i = F.col("epoch").cast("long") * F.lit(n_rows) + F.col("_rank") - 1
    out = ranked.select(i.alias("i"), "epoch", "seq", "patient_id").filter(F.col("i") < F.lit(total))
    out = out.withColumn("timestamp", F.lit(T0_MS) + (F.col("i") * F.lit(1000) / F.lit(rps)).cast("long"))
    rid = F.concat(F.lit("medical_record_"), F.col("patient_id").cast("string"), F.lit("_"),
                   F.col("timestamp").cast("string"))
    return out.withColumn("id", rid)


def stratified(rows: DataFrame, n: int) -> DataFrame:
    """First n//2 'Yes' rows then first n//2 'No' rows (file order), as test records."""
    half = n // 2
    label = F.col("readmitted_30_days")
    yes = rows.filter(label == "Yes").orderBy("seq").limit(half).withColumn("_part", F.lit(0))
    no = rows.filter(label == "No").orderBy("seq").limit(half).withColumn("_part", F.lit(1))
    both = yes.unionByName(no)
    # at most n rows here (two limits), so one ordered window is bounded
    pos = (F.row_number().over(Window.orderBy("_part", "seq")) - 1).cast("long")
    rec = raw_to_wire(both.withColumn("position", pos), F.lit(None).cast("long"), id_prefix="test_medical_",
                      with_ms_in_id=False)
    return rec.select("position", "seq", "id", F.col("patient_id").cast("long").alias("patient_id"), "age", "bmi",
                      "readmission_risk_raw", F.lit(True).alias("is_test"))
