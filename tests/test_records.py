"""JSON parse edge cases (missing vs null, wrong types, non-objects) and validation limits."""

from pulseward.functions.records import parse_records, with_checks


def _parse(spark, texts):
    df = spark.createDataFrame([(i, 1000 + i, t) for i, t in enumerate(texts)], "seq long, arrival_ms long, value string")
    return {r.seq: r for r in with_checks(parse_records(df)).collect()}


def test_non_objects_are_not_parsed(spark):
    bad = ['[1]', '"x"', '5', 'null', '{bad', '', "{'age': 1}"]
    out = _parse(spark, bad)
    for i in range(len(bad)):
        assert out[i].parsed is False
        assert out[i].error == "malformed_json"
        assert out[i].event_time_ms == 1000 + i  # falls back to arrival


def test_missing_keys_take_defaults_and_empty_object_is_valid(spark):
    r = _parse(spark, ['{}'])[0]
    assert r.parsed and not r.type_mismatch and r.error is None
    assert (r.id, r.patient_id, r.age, r.gender, r.systolic_bp, r.diastolic_bp, r.cholesterol, r.bmi) == \
        ("", 0, 0, "Unknown", 120, 80, 200, 25.0)
    assert (r.diabetes, r.hypertension, r.medication_count, r.length_of_stay, r.discharge_destination,
            r.readmission_risk, r.timestamp) == (0, 0, 0, 0, "Home", 0.5, 0)
    assert r.event_time_ms == 1000  # timestamp 0 -> arrival


def test_explicit_null_is_kept(spark):
    out = _parse(spark, ['{"age": null}', '{"bmi": null}', '{"diabetes": null}', '{"cholesterol": null}'])
    assert out[0].age is None and out[0].error == "null_field"
    assert out[1].bmi is None and out[1].error == "null_field"
    assert out[2].diabetes is None and out[2].error is None  # compared with ==, null is just "no"
    assert out[3].error == "null_field"


def test_wrong_types_are_type_mismatch(spark):
    out = _parse(spark, ['{"age": "70"}', '{"age": 70.5}', '{"age": true}', '{"diabetes": true}', '{"age": NaN}'])
    for i in range(5):
        assert out[i].parsed and out[i].type_mismatch and out[i].error == "type_mismatch"


def test_int_accepted_for_double_and_duplicate_key_last_wins(spark):
    out = _parse(spark, ['{"bmi": 32}', '{"age": 1, "age": 2}'])
    assert out[0].bmi == 32.0 and out[0].error is None
    assert out[1].age == 2


def test_timestamp_used_when_present(spark):
    out = _parse(spark, ['{"timestamp": 5}', '{"timestamp": 0}'])
    assert out[0].event_time_ms == 5
    assert out[1].event_time_ms == 1001


def test_validation_limits_are_inclusive(spark):
    cases = {0: ('{"age": 0}', None), 1: ('{"age": 150}', None), 2: ('{"age": 151}', "invalid_age"),
             3: ('{"age": -1}', "invalid_age"), 4: ('{"bmi": 10}', None), 5: ('{"bmi": 60}', None),
             6: ('{"bmi": 9.99}', "invalid_bmi"), 7: ('{"bmi": 60.01}', "invalid_bmi"),
             8: ('{"age": 151, "bmi": 5}', "invalid_age")}
    out = _parse(spark, [cases[i][0] for i in range(len(cases))])
    for i, (_, err) in cases.items():
        assert out[i].error == err, cases[i]
