"""Independent checks: DuckDB oracle SQL and a Spark-vs-DuckDB comparer."""
