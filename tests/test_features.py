"""Feature upsert / merge / lookup semantics."""

from pulseward.operators.features import lookup_features, merge_features, upsert_features


def test_upsert_merge_and_lookup(spark):
    writes = spark.createDataFrame([(1, 10, 1, 100), (1, 20, 2, 50), (2, 15, 3, 70)],
                                   "patient_id long, arrival_ms long, seq long, timestamp long")
    first = upsert_features(writes)
    got = {r.patient_id: (r.record_count, r.last_activity) for r in first.collect()}
    assert got == {1: (2, 50), 2: (1, 70)}          # last write wins, not the maximum
    later = upsert_features(spark.createDataFrame([(2, 30, 4, 90), (3, 31, 5, 10)],
                                                  "patient_id long, arrival_ms long, seq long, timestamp long"))
    merged = {r.patient_id: (r.record_count, r.last_activity) for r in merge_features(first, later).collect()}
    assert merged == {1: (2, 50), 2: (2, 90), 3: (1, 10)}
    req = spark.createDataFrame([(7, 2), (8, 9)], "seq long, patient_id long")
    out = {r.seq: r for r in lookup_features(req, merge_features(first, later)).collect()}
    assert (out[7].record_count, out[7].last_activity, out[7].known_patient) == (2, 90, True)
    assert (out[8].record_count, out[8].avg_risk_score, out[8].last_activity, out[8].risk_trend,
            out[8].known_patient) == (0, 0.5, 0, 0.0, False)
