"""Registered queries (Spark) and their DuckDB oracles; end-to-end jobs."""
