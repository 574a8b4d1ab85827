"""Comparison SQL for DuckDB, written against the given tables only."""
