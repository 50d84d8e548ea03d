"""Independent DuckDB statements that say what each query must return."""
