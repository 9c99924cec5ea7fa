"""DuckDB oracle SQL for every catalogue query that SQL can express.

The SQL restates each definition directly (integer arithmetic on ``events``, plain windows over the whole
table) and shares nothing with the Spark code path except the definitions themselves. Epoch milliseconds
truncate: ``epoch_us(ts) // 1000`` (DuckDB's ``epoch_ms`` rounds).
"""

from __future__ import annotations

FEED = """
feed AS (
  SELECT event_id AS seq, user_id AS src_patient, event_type,
    (event_id % 101 = 7) AS malformed,
    CAST(CASE WHEN event_id % 97 = 5 THEN -1 WHEN event_id % 97 = 11 THEN 151
              ELSE 18 + (event_id * 37 + user_id * 11) % 73 END AS INTEGER) AS src_age,
    CASE event_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS src_gender,
    CAST(100 + event_id % 81 AS INTEGER) AS src_systolic,
    CAST(60 + event_id % 61 AS INTEGER) AS src_diastolic,
    CAST(150 + (event_id * 29) % 151 AS INTEGER) AS src_cholesterol,
    CASE WHEN event_id % 89 = 3 THEN CAST(5.0 AS DOUBLE) WHEN event_id % 89 = 7 THEN CAST(60.5 AS DOUBLE)
         ELSE CAST(180 + (event_id * 53) % 221 AS DOUBLE) / 10 END AS src_bmi,
    CAST((user_id * 3 + event_id) % 5 < 2 AS INTEGER) AS src_diabetes,
    CAST((user_id + event_id * 3) % 7 < 4 AS INTEGER) AS src_hypertension,
    CAST((event_id * 7) % 11 AS INTEGER) AS src_medication,
    CAST(1 + (event_id * 13) % 21 AS INTEGER) AS src_stay,
    CASE user_id % 3 WHEN 0 THEN 'Home' WHEN 1 THEN 'Nursing_Facility' ELSE 'Rehab' END AS src_destination,
    CASE WHEN event_type = 'purchase' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS src_risk,
    epoch_us(ts) // 1000 AS ts_ms,
    CASE WHEN event_id % 103 = 1 THEN CAST(0 AS BIGINT) ELSE epoch_us(ts) // 1000 END AS src_timestamp,
    epoch_us(ts) // 1000 + CASE WHEN event_id % 23 = 0 THEN 21600000 ELSE 0 END AS arrival_ms
  FROM events
),
parsed AS (
  SELECT seq, arrival_ms, ts_ms, event_type, NOT malformed AS parsed, NOT malformed AND seq % 113 = 9 AS type_mismatch,
    IF(malformed, NULL, 'patient_' || CAST(src_patient AS VARCHAR) || '_' || CAST(ts_ms AS VARCHAR)) AS id,
    IF(malformed, NULL, src_patient) AS patient_id,
    IF(malformed OR seq % 113 = 9, NULL, src_age) AS age,
    IF(malformed, NULL, src_gender) AS gender,
    IF(malformed, NULL, src_systolic) AS systolic_bp,
    IF(malformed, NULL, src_diastolic) AS diastolic_bp,
    IF(malformed, NULL, IF(seq % 107 = 3, 200, src_cholesterol)) AS cholesterol,
    IF(malformed OR seq % 109 = 5, NULL, src_bmi) AS bmi,
    IF(malformed, NULL, src_diabetes) AS diabetes,
    IF(malformed, NULL, src_hypertension) AS hypertension,
    IF(malformed, NULL, src_medication) AS medication_count,
    IF(malformed, NULL, src_stay) AS length_of_stay,
    IF(malformed, NULL, src_destination) AS discharge_destination,
    IF(malformed, NULL, src_risk) AS readmission_risk,
    IF(malformed, NULL, src_timestamp) AS "timestamp"
  FROM feed
),
checked AS (
  SELECT *,
    CASE WHEN parsed AND "timestamp" IS NOT NULL AND "timestamp" <> 0 THEN "timestamp" ELSE arrival_ms END
      AS event_time_ms,
    CASE WHEN NOT parsed THEN 'malformed_json'
         WHEN type_mismatch THEN 'type_mismatch'
         WHEN age < 0 OR age > 150 THEN 'invalid_age'
         WHEN bmi IS NULL THEN 'null_field'
         WHEN bmi < 10 OR bmi > 60 THEN 'invalid_bmi' END AS error
  FROM parsed
),
wm AS (
  SELECT *, max(event_time_ms) OVER (ORDER BY arrival_ms, seq
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5001 AS watermark_ms
  FROM checked
),
flagged AS (
  SELECT *, (error IS NULL AND coalesce(event_time_ms < watermark_ms, false)) AS late FROM wm
),
accepted AS (SELECT * FROM flagged WHERE error IS NULL AND NOT late),
scored AS (
  SELECT *,
    CAST(age > 65 AS INTEGER) + CAST(bmi > 30 AS INTEGER) + CAST(medication_count > 5 AS INTEGER)
    + CAST(length_of_stay > 7 AS INTEGER) + CAST(diabetes = 1 AS INTEGER) + CAST(hypertension = 1 AS INTEGER)
    + CAST(cholesterol > 240 AS INTEGER) AS hits
  FROM accepted
),
leveled AS (
  SELECT *, CASE WHEN CAST(hits AS DOUBLE) / 7 > CAST(0.7 AS DOUBLE) THEN 'high'
                 WHEN CAST(hits AS DOUBLE) / 7 > CAST(0.4 AS DOUBLE) THEN 'medium' ELSE 'low' END AS risk_level
  FROM scored
),
gaps AS (
  SELECT *, lag(arrival_ms) OVER (PARTITION BY patient_id ORDER BY arrival_ms, seq) AS prev_arrival_ms
  FROM leveled
),
segs AS (
  SELECT *, arrival_ms - prev_arrival_ms AS gap_ms,
    coalesce(arrival_ms - prev_arrival_ms >= 86400000, false) AS ttl_reset,
    CAST(sum(CAST(prev_arrival_ms IS NULL OR arrival_ms - prev_arrival_ms >= 86400000 AS INTEGER))
         OVER (PARTITION BY patient_id ORDER BY arrival_ms, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
  FROM gaps
),
running AS (
  SELECT *,
    count(*) OVER w AS total_records,
    CAST(sum(CAST(risk_level = 'high' AS INTEGER)) OVER w AS BIGINT) AS high_risk_count,
    CAST(sum(CAST(risk_level = 'medium' AS INTEGER)) OVER w AS BIGINT) AS medium_risk_count,
    CAST(sum(CAST(risk_level = 'low' AS INTEGER)) OVER w AS BIGINT) AS low_risk_count,
    min(arrival_ms) OVER w AS seg_start_ms
  FROM segs
  WINDOW w AS (PARTITION BY patient_id, segment ORDER BY arrival_ms, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def with_ctes(body: str, *extra: str) -> str:
    ctes = FEED + "".join("," + e for e in extra)
    return f"WITH {ctes}\n{body}"


RECORD_COLS = ("id, patient_id, age, gender, systolic_bp, diastolic_bp, cholesterol, bmi, diabetes, hypertension, "
               "medication_count, length_of_stay, discharge_destination, readmission_risk, \"timestamp\"")

ORACLE: dict[str, str] = {}

ORACLE["parse_records"] = with_ctes(
    f"SELECT seq, arrival_ms, parsed, type_mismatch, {RECORD_COLS} FROM checked")

ORACLE["event_time"] = with_ctes("SELECT seq, arrival_ms, event_time_ms FROM checked")

ORACLE["validate_records"] = with_ctes(
    f"SELECT seq, {RECORD_COLS}, event_time_ms FROM checked WHERE error IS NULL")

ORACLE["dlq_rows"] = with_ctes(
    "SELECT seq, original_data, error, event_time_ms AS \"timestamp\", patient_id AS \"key\", 'dlq-medical' AS topic "
    "FROM checked JOIN wire USING (seq) WHERE error IS NOT NULL", """
wire AS (SELECT seq, CASE WHEN malformed THEN substr(doc, 1, 40) ELSE doc END AS original_data FROM (
  SELECT seq, malformed, '{"id":"patient_' || src_patient || '_' || ts_ms || '","patient_id":' || src_patient
    || ',"age":' || IF(seq % 113 = 9, '"' || src_age || '"', src_age::VARCHAR) || ',"gender":"' || src_gender || '","systolic_bp":' || src_systolic
    || ',"diastolic_bp":' || src_diastolic || IF(seq % 107 = 3, '', ',"cholesterol":' || src_cholesterol)
    || ',"bmi":' || IF(seq % 109 = 5, 'null', src_bmi::VARCHAR)
    || ',"diabetes":' || src_diabetes || ',"hypertension":' || src_hypertension || ',"medication_count":'
    || src_medication || ',"length_of_stay":' || src_stay || ',"discharge_destination":"' || src_destination
    || '","readmission_risk_raw":' || src_risk || ',"timestamp":' || src_timestamp || '}' AS doc FROM feed))""")

ORACLE["late_records"] = with_ctes(
    "SELECT seq, patient_id, arrival_ms, event_time_ms, watermark_ms FROM flagged WHERE late")

ORACLE["late_ratio"] = with_ctes("""
SELECT count(*) AS valid_records, count(*) FILTER (WHERE late) AS late_records,
  round(CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE late)) / count(*) ELSE 0.0 END, 9) AS late_ratio,
  CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE late)) / count(*) ELSE 0.0 END > CAST(0.05 AS DOUBLE)
    AS late_alarm
FROM flagged WHERE error IS NULL""")

ORACLE["ttl_segments"] = with_ctes(
    "SELECT seq, patient_id, arrival_ms, prev_arrival_ms, gap_ms, ttl_reset, segment FROM segs")

ORACLE["patient_risk_running"] = with_ctes("""
SELECT seq, id AS record_id, patient_id, risk_level, segment, total_records, high_risk_count,
  medium_risk_count, low_risk_count, high_risk_count / total_records AS high_risk_ratio,
  "timestamp" AS last_activity, (arrival_ms - seg_start_ms) / 1000.0 AS state_age_seconds, arrival_ms,
  event_time_ms AS processing_timestamp, watermark_ms AS watermark, age, bmi, medication_count, length_of_stay
FROM running""")

# ---------------------------------------------------------------- step 2: scoring
HITS = ("CAST(age > 65 AS INTEGER) + CAST(bmi > 30 AS INTEGER) + CAST(medication_count > 5 AS INTEGER) "
        "+ CAST(length_of_stay > 7 AS INTEGER) + CAST(diabetes = 1 AS INTEGER) + CAST(hypertension = 1 AS INTEGER) "
        "+ CAST(cholesterol > 240 AS INTEGER)")


def level_sql(x: str) -> str:
    return (f"CASE WHEN {x} > CAST(0.7 AS DOUBLE) THEN 'high' WHEN {x} > CAST(0.4 AS DOUBLE) THEN 'medium' "
            f"ELSE 'low' END")


ORACLE["risk_score"] = with_ctes(f"""
SELECT seq, hits, CAST(hits AS DOUBLE) / 7 AS risk_score, {level_sql('CAST(hits AS DOUBLE) / 7')} AS risk_level
FROM (SELECT seq, {HITS} AS hits FROM checked WHERE error IS NULL)""")

_W = [("age > 65", "0.2"), ("bmi > 30", "0.15"), ("medication_count > 5", "0.15"), ("length_of_stay > 7", "0.2"),
      ("diabetes = 1", "0.15"), ("hypertension = 1", "0.15")]
_WSUM = "CAST(0.0 AS DOUBLE)" + "".join(
    f" + CASE WHEN coalesce({c}, false) THEN CAST({w} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END" for c, w in _W)
_WN = "0" + "".join(f" + CAST(coalesce({c}, false) AS INTEGER)" for c, _ in _W)
ORACLE["weighted_risk"] = with_ctes(f"""
SELECT seq, round(ws, 9) AS weighted_score,
  CASE WHEN ws IS NULL THEN 'medium' ELSE {level_sql('ws')} END AS weighted_level
FROM (SELECT seq, CASE WHEN fired > 0 THEN total / fired ELSE CAST(0.5 AS DOUBLE) END AS ws
      FROM (SELECT seq, {_WSUM} AS total, {_WN} AS fired FROM checked WHERE error IS NULL))""")

ORACLE["linear_risk"] = with_ctes("""
SELECT seq, round((age / CAST(100 AS DOUBLE) + bmi / CAST(40 AS DOUBLE) + medication_count / CAST(10 AS DOUBLE))
                  / CAST(3 AS DOUBLE), 9) AS linear_score
FROM checked WHERE error IS NULL""")

ORACLE["softmax_label"] = """
WITH lg AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
e AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS e FROM lg),
p AS (SELECT vec_id, list_position(v, list_max(v)) - 1 AS cls, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e)
SELECT vec_id, CASE cls WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'class_' || cls END AS label,
  round(p[cls + 1], 9) AS confidence, round(p[1], 9) AS p_negative, round(p[2], 9) AS p_positive FROM p"""

# ---------------------------------------------------------------- step 4: features
FEATS = """
fw AS (SELECT * FROM accepted),
fcount AS (SELECT patient_id, count(*) AS record_count FROM fw GROUP BY patient_id),
flast AS (SELECT patient_id, "timestamp" AS last_activity FROM (
  SELECT patient_id, "timestamp", row_number() OVER (PARTITION BY patient_id ORDER BY arrival_ms DESC, seq DESC) AS rn
  FROM fw) WHERE rn = 1),
feats AS (SELECT patient_id, record_count, last_activity FROM fcount JOIN flast USING (patient_id))"""

ORACLE["patient_features_update"] = with_ctes("SELECT patient_id, record_count, last_activity FROM feats", FEATS)

ORACLE["patient_features_lookup"] = with_ctes("""
SELECT a.seq, a.patient_id, coalesce(f.record_count, 0) AS record_count, CAST(0.5 AS DOUBLE) AS avg_risk_score,
  coalesce(f.last_activity, 0) AS last_activity, CAST(0.0 AS DOUBLE) AS risk_trend,
  f.patient_id IS NOT NULL AS known_patient
FROM (SELECT seq, patient_id FROM accepted UNION ALL
      SELECT seq + 1000000000000, patient_id + 1000000000 FROM accepted WHERE seq % 3 = 0) a LEFT JOIN feats f ON a.patient_id = f.patient_id""", FEATS)

# ---------------------------------------------------------------- step 5: quality
SPLIT_MS = 1705363200000
ORACLE["risk_distribution"] = with_ctes(f"""
SELECT period, count(*) AS n,
  count(*) FILTER (WHERE risk_level = 'high') / count(*) AS high_share,
  count(*) FILTER (WHERE risk_level = 'medium') / count(*) AS medium_share,
  count(*) FILTER (WHERE risk_level = 'low') / count(*) AS low_share
FROM (SELECT *, CASE WHEN event_time_ms < {SPLIT_MS} THEN 'reference' ELSE 'current' END AS period FROM leveled)
GROUP BY period""")


def psi_sql(e: list[str], a: list[str]) -> str:
    terms = "".join(f" + CASE WHEN {x} > 0 AND {y} > 0 THEN ({y} - {x}) * ln({y} / {x}) ELSE CAST(0.0 AS DOUBLE) END"
                    for x, y in zip(e, a))
    return f"abs(CAST(0.0 AS DOUBLE){terms})"


_LV = ("high", "medium", "low")
ORACLE["psi_drift"] = with_ctes(f"""
SELECT reference_records, current_records, round(psi, 9) AS psi, coalesce(psi > CAST(0.2 AS DOUBLE), false) AS drift
FROM (SELECT *, CASE WHEN reference_records > 0 AND current_records > 0 THEN
        {psi_sql([f'r_{l} / reference_records' for l in _LV], [f'c_{l} / current_records' for l in _LV])} END AS psi
      FROM (SELECT count(*) FILTER (WHERE ref) AS reference_records, count(*) FILTER (WHERE NOT ref) AS current_records,
              {', '.join(f"count(*) FILTER (WHERE ref AND risk_level = '{l}') AS r_{l}" for l in _LV)},
              {', '.join(f"count(*) FILTER (WHERE NOT ref AND risk_level = '{l}') AS c_{l}" for l in _LV)}
            FROM (SELECT *, event_time_ms < {SPLIT_MS} AS ref FROM leveled)))""")

SAMPLES = """
smp AS (SELECT event_id AS seq, event_type AS stage, epoch_us(ts) // 1000 AS ts_ms, value AS latency_ms,
               event_type <> 'error' AS ok, 1 + event_id % 120 AS batch_size FROM events),
last1000 AS (SELECT * FROM smp ORDER BY seq DESC LIMIT 1000),
last1000_ok AS (SELECT * FROM smp WHERE ok ORDER BY seq DESC LIMIT 1000),
last1000_batch AS (SELECT * FROM smp WHERE batch_size > 1 ORDER BY seq DESC LIMIT 1000)"""

ORACLE["quality_flags"] = with_ctes(f"""
SELECT hour_ms, valid_records, late_records,
  round(CASE WHEN valid_records > 0 THEN late_records / valid_records END, 9) AS late_ratio,
  coalesce(CASE WHEN valid_records > 0 THEN late_records / valid_records END > CAST(0.05 AS DOUBLE), false) AS late_flag,
  psi_prev_hour, coalesce(psi_prev_hour > CAST(0.2 AS DOUBLE), false) AS drift_flag,
  live_states, round(growth, 9) AS state_growth, coalesce(growth > CAST(0.1 AS DOUBLE), false) AS growth_flag,
  checkpoint_ms, coalesce(checkpoint_ms > 30000, false) AS checkpoint_flag,
  lag_records, lag_records > 1000 AS lag_flag, p99_ms, coalesce(p99_ms > CAST(30 AS DOUBLE), false) AS p99_flag
FROM (
  SELECT l.*, CASE WHEN prev_live > 0 THEN live_states / prev_live - 1 END AS growth, ps.psi_prev_hour
  FROM liv2 l LEFT JOIN ps USING (hour_ms)
  WHERE has_input)""", SAMPLES, f"""
rows_h AS (SELECT (arrival_ms // 3600000) * 3600000 AS hour_ms,
  count(*) FILTER (WHERE error IS NULL) AS valid_records, count(*) FILTER (WHERE late) AS late_records,
  count(*) FILTER (WHERE arrival_ms - event_time_ms > 5000) AS lag_records FROM flagged GROUP BY 1),
lv_h AS (SELECT (arrival_ms // 3600000) * 3600000 AS hour_ms, count(*) AS n_acc,
  {', '.join(f"count(*) FILTER (WHERE risk_level = '{l}') AS n_{l}" for l in _LV)} FROM leveled GROUP BY 1),
seg_se AS (SELECT patient_id, segment, min(arrival_ms) AS s, max(arrival_ms) AS e FROM segs GROUP BY 1, 2),
deltas AS (SELECT hour_ms, sum(d) AS live_delta FROM (
  SELECT (s // 3600000) * 3600000 AS hour_ms, 1 AS d FROM seg_se
  UNION ALL SELECT ((e + 86400000) // 3600000) * 3600000 AS hour_ms, -1 AS d FROM seg_se) GROUP BY 1),
smp_h AS (SELECT (ts_ms // 3600000) * 3600000 AS hour_ms, max(latency_ms) AS checkpoint_ms,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms FROM smp GROUP BY 1),
hours AS (SELECT hour_ms FROM rows_h UNION SELECT hour_ms FROM lv_h UNION SELECT hour_ms FROM deltas
          UNION SELECT hour_ms FROM smp_h),
comb AS (SELECT h.hour_ms, r.hour_ms IS NOT NULL OR s.hour_ms IS NOT NULL AS has_input,
  coalesce(r.valid_records, 0) AS valid_records, coalesce(r.late_records, 0) AS late_records,
  coalesce(r.lag_records, 0) AS lag_records, v.n_acc, s.checkpoint_ms, s.p99_ms,
  coalesce(d.live_delta, 0) AS live_delta
  FROM hours h LEFT JOIN rows_h r USING (hour_ms) LEFT JOIN lv_h v USING (hour_ms)
  LEFT JOIN deltas d USING (hour_ms) LEFT JOIN smp_h s USING (hour_ms)),
liv AS (SELECT *, CAST(sum(live_delta) OVER (ORDER BY hour_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS live_states
        FROM comb),
liv2 AS (SELECT *, lag(live_states) OVER (ORDER BY hour_ms) AS prev_live FROM liv),
ps0 AS (SELECT hour_ms, {', '.join(f'n_{l} / n_acc AS sh_{l}' for l in _LV)},
  {', '.join(f'lag(n_{l} / n_acc) OVER (ORDER BY hour_ms) AS pv_{l}' for l in _LV)} FROM lv_h),
ps AS (SELECT hour_ms, round(CASE WHEN pv_high IS NOT NULL THEN
  {psi_sql([f'pv_{l}' for l in _LV], [f'sh_{l}' for l in _LV])} END, 9) AS psi_prev_hour FROM ps0)""")

# ---------------------------------------------------------------- step 6: metrics


def pcts(col: str, src: str = "") -> str:
    return ", ".join(f"round(quantile_cont({col}, {q}), 6) AS {n}" for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))


ORACLE["latency_summary"] = with_ctes(f"""
SELECT {pcts('latency_ms')}, count(*) AS sample_count, max(latency_ms) AS "max", min(latency_ms) AS "min",
  round(avg(latency_ms), 6) AS mean, round(stddev_pop(latency_ms), 6) AS std,
  round(quantile_cont(latency_ms, 0.99), 6) < CAST(30 AS DOUBLE) AS sla_ok
FROM smp""", SAMPLES)

ORACLE["latency_last_1000"] = with_ctes(f"""
SELECT r.p50, r.p95, r.p99, t.total_requests, t.errors,
  round(t.total_requests / t.duration_s, 6) AS throughput_rps, round(t.errors / t.total_requests, 9) AS error_rate
FROM (SELECT {pcts('latency_ms')} FROM last1000) r,
     (SELECT count(*) AS total_requests, count(*) FILTER (WHERE NOT ok) AS errors,
             (max(ts_ms) - min(ts_ms)) / CAST(1000 AS DOUBLE) AS duration_s FROM smp) t""", SAMPLES)

ORACLE["client_metrics"] = with_ctes(f"""
SELECT count(*) AS total_requests, count(*) FILTER (WHERE NOT ok) AS failed_requests,
  round((count(*) - count(*) FILTER (WHERE NOT ok)) / count(*), 9) AS success_rate, {pcts('CASE WHEN ok THEN latency_ms END')},
  count(*) FILTER (WHERE batch_size = 1) AS single_requests, count(*) FILTER (WHERE batch_size > 1) AS batch_requests,
  count(*) FILTER (WHERE batch_size > 1 AND NOT ok) AS batch_errors,
  round(count(*) / ((max(ts_ms) - min(ts_ms)) / CAST(1000 AS DOUBLE)), 6) AS throughput_rps
FROM smp""", SAMPLES)

ORACLE["penalised_metrics"] = with_ctes(f"""
SELECT {pcts('lat')}, count(*) AS sample_count, round(count(*) / (sum(lat) / CAST(1000 AS DOUBLE)), 6) AS throughput_rps,
  round(count(*) FILTER (WHERE NOT ok) / count(*), 9) AS error_rate
FROM (SELECT CASE WHEN ok THEN latency_ms ELSE CAST(1000 AS DOUBLE) END AS lat, ok FROM smp)""", SAMPLES)

ORACLE["stage_metrics"] = with_ctes("""
SELECT stage, (ts_ms // 3600000) * 3600000 AS window_start_ms, round(avg(latency_ms), 6) AS avg_ms,
  count(*) AS "count", round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms
FROM smp GROUP BY 1, 2""", SAMPLES)

ORACLE["latency_index_pct"] = with_ctes("""
SELECT n AS sample_count,
  v[CAST(floor(CAST(n AS DOUBLE) * CAST(0.5 AS DOUBLE)) AS BIGINT) + 1] AS p50_seconds,
  v[CAST(floor(CAST(n AS DOUBLE) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1] AS p95_seconds,
  v[CAST(floor(CAST(n AS DOUBLE) * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1] AS p99_seconds
FROM (SELECT list_sort(list(latency_ms / CAST(1000 AS DOUBLE))) AS v, count(*) AS n FROM last1000_ok)""", SAMPLES)

_LB = ["0.001", "0.005", "0.01", "0.05", "0.1", "0.5", "1.0", "2.0", "5.0"]
ORACLE["latency_histogram"] = with_ctes(
    " UNION ALL ".join(f"SELECT '{b}' AS le, b{i} AS cumulative_count, total_count, total_sum FROM agg"
                       for i, b in enumerate(_LB))
    + " UNION ALL SELECT '+Inf' AS le, total_count AS cumulative_count, total_count, total_sum FROM agg",
    SAMPLES, "s AS (SELECT latency_ms / CAST(1000 AS DOUBLE) AS s FROM last1000_ok)",
    "agg AS (SELECT " + ", ".join(f"count(*) FILTER (WHERE s <= CAST({b} AS DOUBLE)) AS b{i}" for i, b in enumerate(_LB))
    + ", count(*) AS total_count, round(sum(s), 6) AS total_sum FROM s)")

_BB = [1, 5, 10, 20, 50, 100]
ORACLE["batch_size_histogram"] = with_ctes(
    " UNION ALL ".join(f"SELECT '{b}' AS le, b{i} AS cumulative_count, total_count, total_sum FROM agg"
                       for i, b in enumerate(_BB))
    + " UNION ALL SELECT '+Inf' AS le, total_count AS cumulative_count, total_count, total_sum FROM agg",
    SAMPLES,
    "agg AS (SELECT " + ", ".join(f"count(*) FILTER (WHERE batch_size <= {b}) AS b{i}" for i, b in enumerate(_BB))
    + ", count(*) AS total_count, CAST(sum(batch_size) AS BIGINT) AS total_sum FROM last1000_batch)")

ORACLE["compare_runs"] = with_ctes("""
SELECT b.metric, b.value AS "before", a.value AS "after",
  round(CASE WHEN b.value <> 0 THEN (b.value - a.value) / b.value * 100 END, 6) AS improvement_pct
FROM t b JOIN t a ON b.metric = a.metric AND b.run = 'before' AND a.run = 'after'""", SAMPLES, """
r AS (SELECT CASE WHEN seq % 2 = 0 THEN 'before' ELSE 'after' END AS run, latency_ms FROM smp),
m AS (SELECT run, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.95), 6) AS p95,
        round(quantile_cont(latency_ms, 0.99), 6) AS p99, round(avg(latency_ms), 6) AS mean FROM r GROUP BY run),
t AS (SELECT run, 'p50' AS metric, p50 AS value FROM m UNION ALL SELECT run, 'p95', p95 FROM m
      UNION ALL SELECT run, 'p99', p99 FROM m UNION ALL SELECT run, 'mean', mean FROM m)""")

# ---------------------------------------------------------------- step 7: loading and replay
RAW_COLS = ("patient_id, age, gender, blood_pressure, cholesterol, bmi, diabetes, hypertension, medication_count, "
            "length_of_stay, discharge_destination, readmitted_30_days")
RAW = f"""
rawbase AS (
  SELECT seq, CAST(src_patient AS INTEGER) AS patient_id, src_age AS age,
    CASE WHEN seq % 59 = 0 THEN NULL ELSE src_gender END AS gender,
    CAST(src_systolic AS VARCHAR) || '/' || CAST(src_diastolic AS VARCHAR) AS blood_pressure,
    src_cholesterol AS cholesterol, src_bmi AS bmi,
    CASE WHEN src_diabetes = 1 THEN 'Yes' ELSE 'No' END AS diabetes,
    CASE WHEN src_hypertension = 1 THEN 'Yes' ELSE 'No' END AS hypertension,
    src_medication AS medication_count, src_stay AS length_of_stay, src_destination AS discharge_destination,
    CASE WHEN src_risk = CAST(1.0 AS DOUBLE) THEN 'Yes' ELSE 'No' END AS readmitted_30_days
  FROM feed),
raw AS (SELECT * FROM rawbase UNION ALL
        SELECT seq + 1000000000000 AS seq, {RAW_COLS} FROM rawbase WHERE seq % 71 = 0),
cleansed AS (
  SELECT * FROM (SELECT min(seq) AS seq, {RAW_COLS} FROM raw GROUP BY {RAW_COLS})
  WHERE {' AND '.join(c.strip() + ' IS NOT NULL' for c in RAW_COLS.split(','))}),
nn AS (SELECT count(*) AS n FROM cleansed)"""

ORACLE["cleanse_rows"] = with_ctes(f"SELECT seq, {RAW_COLS} FROM cleansed", RAW)


def yn(c: str) -> str:
    return f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END"


ORACLE["raw_to_record"] = with_ctes(f"""
SELECT seq, 'patient_' || CAST(patient_id AS VARCHAR) || '_' || CAST(ts AS VARCHAR) AS id,
  CAST(patient_id AS BIGINT) AS patient_id, age, gender,
  CAST(split_part(blood_pressure, '/', 1) AS INTEGER) AS systolic_bp,
  CAST(split_part(blood_pressure, '/', 2) AS INTEGER) AS diastolic_bp, cholesterol, bmi,
  {yn('diabetes')} AS diabetes, {yn('hypertension')} AS hypertension, medication_count, length_of_stay,
  discharge_destination, CAST({yn('readmitted_30_days')} AS DOUBLE) AS readmission_risk_raw, ts AS "timestamp"
FROM (SELECT *, 1704067200000 + 100 * (seq + 1) AS ts FROM cleansed)""", RAW)

ORACLE["replay_cyclic"] = with_ctes("""
SELECT p.i, x.seq, CAST(x.patient_id AS BIGINT) AS patient_id,
  'patient_' || CAST(x.patient_id AS VARCHAR) || '_' || CAST(1704067200000 + 100 * (p.i + 1) AS VARCHAR) AS id,
  1704067200000 + 100 * (p.i + 1) AS "timestamp"
FROM pos p JOIN idx x ON p.row_index = x.row_index""", RAW, """
idx AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS row_index FROM cleansed),
pos AS (SELECT i, i % n AS row_index FROM (SELECT unnest(range(2 * n + n // 2)) AS i, n FROM nn))""")

ORACLE["replay_shuffled"] = with_ctes("""
SELECT epoch, cnt AS n_records, cnt AS n_distinct_rows, epoch * n AS first_i, epoch * n + cnt - 1 AS last_i,
  1704067200000 + epoch * n * 20 AS first_ts_ms, 1704067200000 + (epoch * n + cnt - 1) * 20 AS last_ts_ms
FROM (SELECT epoch, n, least(n, 30000 - epoch * n) AS cnt
      FROM (SELECT unnest(range(CAST(ceil(30000 / n) AS BIGINT))) AS epoch, n FROM nn))""", RAW)

ORACLE["stratified_sample"] = with_ctes("""
SELECT row_number() OVER (ORDER BY part, seq) - 1 AS position, seq,
  'test_medical_' || CAST(patient_id AS VARCHAR) AS id, CAST(patient_id AS BIGINT) AS patient_id, age, bmi,
  CAST(CASE WHEN readmitted_30_days = 'Yes' THEN 1 ELSE 0 END AS DOUBLE) AS readmission_risk_raw, true AS is_test
FROM (SELECT *, 0 AS part FROM (SELECT * FROM cleansed WHERE readmitted_30_days = 'Yes' ORDER BY seq LIMIT 500)
      UNION ALL
      SELECT *, 1 AS part FROM (SELECT * FROM cleansed WHERE readmitted_30_days = 'No' ORDER BY seq LIMIT 500))""",
    RAW)

# ---------------------------------------------------------------- step 8: alerts
SERIES = """
ser AS (
  SELECT CASE event_type WHEN 'view' THEN 'latency_p99_ms' WHEN 'click' THEN 'backpressured'
                         WHEN 'purchase' THEN 'kafka_lag' WHEN 'error' THEN 'failed_checkpoints' END AS series,
    event_id AS seq, epoch_us(ts) // 1000 AS ts_ms,
    CASE event_type WHEN 'view' THEN value
      WHEN 'click' THEN CASE WHEN value > 250 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
      WHEN 'purchase' THEN value * 4
      WHEN 'error' THEN CAST(((event_id % 500 + 1) // 5) * 10
                             + ((event_id % 500 + 1) % 5) * ((event_id % 500 + 1) % 5 - 1) // 2 AS DOUBLE) END AS value
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'error'))"""

ORACLE["threshold_alerts"] = """
WITH """ + SERIES.strip() + """,
rules AS (SELECT * FROM (VALUES
  ('HighMedicalProcessingLatency', 'latency_p99_ms', CAST(30 AS DOUBLE), CAST(60000 AS BIGINT), 'critical'),
  ('HighMedicalBackpressure', 'backpressured', CAST(0 AS DOUBLE), CAST(60000 AS BIGINT), 'warning'),
  ('HighKafkaLagMedical', 'kafka_lag', CAST(1000 AS DOUBLE), CAST(180000 AS BIGINT), 'warning'))
  r(alert, series, threshold, for_ms, severity)),
pts AS (SELECT r.alert, r.severity, r.for_ms, s.series, s.seq, s.ts_ms, s.value, s.value > r.threshold AS hold
        FROM ser s JOIN rules r ON s.series = r.series),
isl AS (SELECT *, sum(CASE WHEN hold THEN 0 ELSE 1 END) OVER (PARTITION BY alert ORDER BY ts_ms, seq
                                                             ROWS UNBOUNDED PRECEDING) AS grp FROM pts),
g AS (SELECT alert, series, severity, for_ms, grp, min(ts_ms) AS island_start_ms, max(ts_ms) AS island_end_ms,
             count(*) AS n_points, max(value) AS max_value
      FROM isl WHERE hold GROUP BY alert, series, severity, for_ms, grp),
f AS (SELECT i.alert, i.grp, min(i.ts_ms) AS firing_since_ms FROM isl i JOIN g ON i.alert = g.alert AND i.grp = g.grp
      WHERE i.hold AND i.ts_ms >= g.island_start_ms + g.for_ms GROUP BY i.alert, i.grp)
SELECT g.alert, g.series, g.severity, g.island_start_ms, f.firing_since_ms, g.island_end_ms, g.n_points, g.max_value
FROM g JOIN f ON g.alert = f.alert AND g.grp = f.grp"""

ORACLE["counter_rate"] = """
WITH """ + SERIES.strip() + """,
c AS (SELECT seq, ts_ms, value FROM ser WHERE series = 'failed_checkpoints'),
c2 AS (SELECT *, lag(value) OVER (ORDER BY ts_ms, seq) AS prev FROM c),
c3 AS (SELECT *, CASE WHEN prev IS NULL THEN CAST(0.0 AS DOUBLE) WHEN value >= prev THEN value - prev
                      ELSE value END AS increase FROM c2),
c4 AS (SELECT *, sum(increase) OVER (ORDER BY ts_ms RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW)
                 / CAST(300 AS DOUBLE) AS rate FROM c3),
c5 AS (SELECT *, rate > 0 AS hold, sum(CASE WHEN rate > 0 THEN 0 ELSE 1 END)
                 OVER (ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) AS grp FROM c4),
c6 AS (SELECT *, min(ts_ms) OVER (PARTITION BY grp, hold) AS island_start FROM c5)
SELECT seq, ts_ms, value AS counter, increase, round(rate, 9) AS rate_5m, rate > 0 AS above,
  coalesce(hold AND ts_ms >= island_start + 60000, false) AS firing
FROM c6"""


# ---------------------------------------------------------------- engine-independent rounding and means
# The Spark side rounds with ``functions.numeric``: floor(x * 10^d + 0.5) / 10^d, and exact means from a
# DECIMAL(38,0) sum of values scaled by 10^10. The SQL above writes ``round(x, d)`` and
# ``round(avg(col), d)`` for readability; both are rewritten here into the identical formulas.


def exact_mean_sql(col: str, digits: int) -> str:
    d = 10 ** (10 - digits)
    return (f"CASE WHEN count({col}) > 0 THEN CAST((2 * CAST(sum(CAST({col} * 1e10 AS DECIMAL(38,0))) AS HUGEINT)"
            f" + count({col}) * {d}) // (2 * count({col}) * {d}) AS DOUBLE) / 1e{digits} END")


def _rewrite_round(sql: str) -> str:
    out = sql
    while True:
        i = next((k for k in range(len(out)) if out.startswith("round(", k)
                  and (k == 0 or not (out[k - 1].isalnum() or out[k - 1] == "_"))), -1)
        if i < 0:
            return out
        depth, comma, j = 0, -1, i + len("round(")
        while True:
            ch = out[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = j
            j += 1
        expr, digits = out[i + len("round("):comma].strip(), int(out[comma + 1:j].strip())
        out = f"{out[:i]}floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}{out[j + 1:]}"


ORACLE = {name: _rewrite_round(sql.replace("round(avg(latency_ms), 6)", exact_mean_sql("latency_ms", 6)))
          for name, sql in ORACLE.items()}
