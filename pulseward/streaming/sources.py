"""Stream sources producing the feed schema ``(seq, arrival_ms, value)``.

The source is chosen by configuration -- ``kafka``, ``files`` or ``rate`` -- never by probing a broker.
The Kafka connector jar must be on the classpath for ``kafka``; it is not needed by the other two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_SCHEMA
from .shuffled import shuffled_replay_source

# Topics and consumer group.
RECORDS_TOPIC = "medical-records"
RESULTS_TOPIC = "medical-risk-results"
CONSUMER_GROUP = "readmission-analysis"


def kafka_source(spark: SparkSession, bootstrap: str, topic: str = RECORDS_TOPIC, group: str = CONSUMER_GROUP,
                 max_offsets_per_trigger: int = 100_000) -> DataFrame:
    """Records topic from the earliest offset; value as text, broker time as arrival.

    The consumer-group name becomes ``groupIdPrefix``: Spark then gives every query its own group id (the
    risk and dead-letter queries read the same topic; sharing one ``kafka.group.id`` would make them split
    the partitions between them). ``failOnDataLoss`` stays on, so lost offsets stop the query instead of
    being skipped silently. Offsets live in the query checkpoint, not in the consumer group.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest")
              .option("groupIdPrefix", group))
    raw = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).load()
    # offsets are per partition; (partition, offset) packed into one ordered sequence number
    seq = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return raw.select(seq.alias("seq"), F.unix_millis(F.col("timestamp")).alias("arrival_ms"),
                      F.col("value").cast("string").alias("value"))


def file_source(spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int = 1) -> DataFrame:
    """Feed rows from files (JSON lines or parquet with the feed schema), a bounded number per micro-batch."""
    return (spark.readStream.schema(FEED_SCHEMA).format(fmt)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path))


def rate_replay_source(spark: SparkSession, records: DataFrame, n_rows: int, rows_per_batch: int,
                       t0_ms: int, step_ms: int = 100) -> DataFrame:
    """Cyclic replay of ``records`` (with ``row_index`` and ``value``) driven by ``rate-micro-batch``;
    record i is row i mod N with arrival t0 + step * (i + 1). A stream-static equi-join, no driver loop."""
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", str(rows_per_batch)).load()
             .select(F.col("value").alias("seq"), (F.col("value") % F.lit(n_rows)).alias("row_index")))
    joined = ticks.join(records.select("row_index", "value"), "row_index")
    return joined.select("seq", (F.lit(t0_ms) + F.lit(step_ms) * (F.col("seq") + 1)).alias("arrival_ms"), "value")


def pick_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """The stream source named by configuration: 'kafka' (bootstrap, topic, group, max_offsets_per_trigger),
    'files' (path, fmt, max_files_per_trigger), 'rate' (records, n_rows, rows_per_batch, t0_ms) or 'shuffled' (the same,
    rps, seed).
    There is no broker probing: an unavailable broker is a configuration error, not a silent switch."""
    if kind == "kafka":
        return kafka_source(spark, **options)
    if kind == "files":
        return file_source(spark, **options)
    if kind == "rate":
        return rate_replay_source(spark, **options)
    if kind == "shuffled":
        return shuffled_replay_source(spark, **options)
    raise ValueError(f"unknown source kind {kind!r}")
