"""pulseward: patient-risk stream analytics expressed as Spark DataFrame jobs.

Sub-packages:
  sources    -- derived record feed, raw CSV rows, replays, samples, Kafka/file stream options
  functions  -- column expressions (JSON parse, validation, risk scoring, softmax)
  operators  -- DataFrame operators (lateness, running state, features, quality, metrics, alerts, text)
  plans      -- the query catalogue used by ``__spark_entry__`` and its DuckDB oracle SQL
  streaming  -- Structured Streaming job (transformWithStateInPandas processor, idempotent sinks)
"""

__version__ = "0.1.0"
