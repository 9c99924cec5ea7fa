"""CSV scan with the explicit schema, demo fallback, cleansing and reshaping."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulseward.operators.dlq import raw_dead_letters

from pulseward.sources import loading


def test_demo_rows_only_on_request(spark):
    assert loading.read_raw_csv(spark, None, demo=True).count() == 2
    with pytest.raises(AnalysisException):
        loading.read_raw_csv(spark, "/nonexistent/hospital.csv")


def test_bad_cells_and_blood_pressures_are_dead_letters(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pulseward-csv-", dir="/tmp"), "rows.csv")
    with open(path, "w") as f:
        f.write("patient_id,age,gender,blood_pressure,cholesterol,bmi,diabetes,hypertension,medication_count,"
                "length_of_stay,discharge_destination,readmitted_30_days\n")
        f.write("1,65.0,Male,130/80,200,25.5,Yes,No,3,5,Home,No\n")      # 65.0 in a whole-number column
        f.write("2,72,Female,n/a,240,28.1,No,Yes,5,7,Home,Yes\n")
        f.write("3,80,Female,130,250,31.0,No,Yes,6,9,Rehab,Yes\n")
        f.write("4,81,Female,131/79,250,31.0,No,Yes,6,9,Rehab,Yes\n")
    raw = loading.read_raw_csv(spark, path).cache()
    assert [r.patient_id for r in loading.good_rows(raw).collect()] == [4]
    bad = {r.error: [] for r in raw_dead_letters(raw).collect()}
    for r in raw_dead_letters(raw).collect():
        bad[r.error].append(r)
    assert [r.original_data for r in bad["invalid_cell"]] == ["1,65.0,Male,130/80,200,25.5,Yes,No,3,5,Home,No"]
    assert sorted(r.key for r in bad["invalid_blood_pressure"]) == [2, 3]
    # reshaping itself never fails on such a cell
    rec = {r.patient_id: r for r in loading.to_records(raw.filter("patient_id > 1"), F.lit(1).cast("long")).collect()}
    assert (rec[2].systolic_bp, rec[3].systolic_bp, rec[3].diastolic_bp, rec[4].diastolic_bp) == (None, 130, None, 79)


def test_csv_scan_cleanse_and_records(spark):
    d = tempfile.mkdtemp(prefix="pulseward-csv-", dir="/tmp")
    path = os.path.join(d, "rows.csv")
    with open(path, "w") as f:
        f.write("patient_id,age,gender,blood_pressure,cholesterol,bmi,diabetes,hypertension,medication_count,"
                "length_of_stay,discharge_destination,readmitted_30_days\n")
        f.write("1,65,Male,130/80,200,25.5,Yes,No,3,5,Home,No\n")
        f.write("1,65,Male,130/80,200,25.5,Yes,No,3,5,Home,No\n")        # duplicate
        f.write("2,72,NA,140/90,240,28.1,No,Yes,5,7,Nursing_Facility,Yes\n")  # missing gender
        f.write("3,80,Female,150/95,250,31.0,No,Yes,6,9,Rehab,Yes\n")
    raw = loading.read_raw_csv(spark, path)
    clean = loading.cleanse(raw)
    assert sorted(r.patient_id for r in clean.collect()) == [1, 3]
    rec = {r.patient_id: r for r in loading.to_records(clean, F.lit(1000).cast("long")).collect()}
    assert (rec[1].systolic_bp, rec[1].diastolic_bp, rec[1].diabetes, rec[1].hypertension) == (130, 80, 1, 0)
    assert rec[3].readmission_risk_raw == 1.0 and rec[3].id == "patient_3_1000"


def test_batch_command_line_lists_and_runs():
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "pulseward", "list"], cwd=repo, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0 and "patient_risk_running" in out.stdout
    target = tempfile.mkdtemp(prefix="pulseward-clirun-", dir="/tmp") + "/late_ratio"
    run = subprocess.run([sys.executable, "-m", "pulseward", "run", "late_ratio", "/root/testdata/sf0.001", "--out",
                          target, "--master", "local[2]"], cwd=repo, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert os.path.isdir(target)


def _raw(spark, labels):
    rows = [(i, 100 + i, 60, "Male", "120/80", 200, 25.0, "No", "No", 1, 2, "Home", lab) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, "seq long, patient_id int, age int, gender string, blood_pressure string, "
                                       "cholesterol int, bmi double, diabetes string, hypertension string, "
                                       "medication_count int, length_of_stay int, discharge_destination string, "
                                       "readmitted_30_days string")


def test_stratified_takes_first_yes_then_first_no(spark):
    out = loading.stratified(_raw(spark, ["No", "Yes", "No", "Yes", "Yes", "No"]), 4).orderBy("position").collect()
    assert [(r.position, r.seq) for r in out] == [(0, 1), (1, 3), (2, 0), (3, 2)]
    assert out[0].id == "test_medical_101" and out[0].readmission_risk_raw == 1.0 and out[0].is_test


def test_cyclic_replay_wraps_in_file_order(spark):
    rows = _raw(spark, ["No", "Yes", "No"]).filter("seq != 1")          # gaps in seq are fine
    out = loading.replay_cyclic(spark, rows, total=5, n_rows=2).orderBy("i").collect()
    assert [r.seq for r in out] == [0, 2, 0, 2, 0]
    assert [r.timestamp for r in out] == [loading.T0_MS + 100 * (i + 1) for i in range(5)]
    assert out[1].id == f"patient_102_{loading.T0_MS + 200}"
