"""Named query plans, stage tables and the DuckDB oracle SQL."""
