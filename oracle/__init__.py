"""DuckDB statements that recompute every registered query from the same parquet tables."""
