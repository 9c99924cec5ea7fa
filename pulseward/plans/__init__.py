"""Query catalogue (Spark) and the matching DuckDB oracle SQL."""
