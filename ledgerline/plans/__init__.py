"""Plans: the registered queries (catalog), their DuckDB oracle, end-to-end jobs."""
