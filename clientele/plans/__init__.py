"""Query registry, DuckDB oracle SQL and the end-to-end pipeline."""
