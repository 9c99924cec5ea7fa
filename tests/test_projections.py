"""Serialisation (P4), nested result rows (P9) and the Kafka sink frame."""

import json

from pulseward.functions.records import parse_records, serialise, with_checks
from pulseward.operators.running import as_result_rows
from pulseward.streaming import sinks, sources


def test_serialise_renames_risk_key(spark):
    df = spark.createDataFrame([(1, 10, '{"id": "a", "patient_id": 7, "readmission_risk_raw": 1.0}')],
                               "seq long, arrival_ms long, value string")
    out = with_checks(parse_records(df))
    doc = json.loads(out.select(serialise().alias("j")).first().j)
    assert doc["readmission_risk"] == 1.0 and "readmission_risk_raw" not in doc
    assert list(doc)[:3] == ["id", "patient_id", "age"] and len(doc) == 15


def test_result_rows_are_nested(spark):
    row = spark.createDataFrame(
        [("r1", 7, "high", 2, 1, 1, 0, 0.5, 100, 3.0, 100, 50, 70, 32.0, 6, 8)],
        "id string, patient_id long, risk_level string, total_records long, high_risk_count long, "
        "medium_risk_count long, low_risk_count long, high_risk_ratio double, last_activity long, "
        "state_age_seconds double, event_time_ms long, watermark_ms long, age int, bmi double, "
        "medication_count int, length_of_stay int")
    r = as_result_rows(row).first()
    assert r.record_id == "r1" and r.patient_stats.total_records == 2 and r.features.bmi == 32.0
    assert r.processing_timestamp == 100 and r.watermark == 50


def test_kafka_sink_frame(spark):
    res = spark.createDataFrame(
        [("result", 1, "r1", 7, "low", 1, 0, 0, 1, 0.0, 5, 0.0, 5, 0.01, 0, 5, 30, 20.0, 1, 1)],
        sinks_schema())
    kv = sinks.kafka_sink_frame(res).first()
    assert kv.key == "7"
    doc = json.loads(kv.value)
    assert doc["patient_stats"]["total_records"] == 1 and doc["features"]["age"] == 30


def sinks_schema():
    from pulseward.streaming.processor import OUTPUT_SCHEMA
    return OUTPUT_SCHEMA


def test_pick_source_rejects_unknown_kind(spark):
    import pytest
    with pytest.raises(ValueError):
        sources.pick_source(spark, "socket")
