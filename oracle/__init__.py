"""DuckDB oracle SQL for every registered query (the independent side of the correctness check)."""
