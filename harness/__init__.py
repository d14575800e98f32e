"""Test and benchmark inputs derived from the given tables, and DuckDB oracles."""
