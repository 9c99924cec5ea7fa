"""The feed figures published with the fixture description, reproduced by the Spark queries."""

import pytest
from pyspark.sql import functions as F

from pulseward.plans.catalog import QUERIES

# Fixed values: (rows, malformed, wrong type, null, bad age, bad bmi, valid, late, accepted, TTL resets, high, medium, low)
FIGURES = {
    "/root/testdata/sf0.001": (1_000, 10, 9, 9, 21, 22, 929, 40, 889, 106, 158, 487, 244),
    "/root/testdata/sf0.01": (10_000, 99, 88, 89, 202, 215, 9_307, 401, 8_906, 1_203, 1_509, 4_966, 2_431),
}


@pytest.mark.parametrize("sf_dir", sorted(FIGURES))
def test_feed_figures(spark, sf_dir):
    rows, malformed, wrong_type, null, bad_age, bad_bmi, valid, late, accepted, resets, high, medium, low = FIGURES[sf_dir]
    parsed = QUERIES["parse_records"](spark, sf_dir)
    assert parsed.count() == rows
    errors = {r.error: r["count"] for r in QUERIES["dlq_rows"](spark, sf_dir).groupBy("error").count().collect()}
    assert errors == {"malformed_json": malformed, "type_mismatch": wrong_type, "null_field": null,
                      "invalid_age": bad_age, "invalid_bmi": bad_bmi}
    assert QUERIES["validate_records"](spark, sf_dir).count() == valid
    assert QUERIES["late_records"](spark, sf_dir).count() == late
    seg = QUERIES["ttl_segments"](spark, sf_dir)
    assert seg.count() == accepted and seg.filter(F.col("ttl_reset")).count() == resets
    levels = {r.risk_level: r["count"] for r in
              QUERIES["patient_risk_running"](spark, sf_dir).groupBy("risk_level").count().collect()}
    assert levels == {"high": high, "medium": medium, "low": low}
