"""Column-level functions (Spark Columns only)."""
