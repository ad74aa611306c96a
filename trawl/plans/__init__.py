"""Registered queries (catalog), their stand-in inputs, and the DuckDB oracle SQL."""
