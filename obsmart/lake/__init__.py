"""Versioned publishing of tables as Parquet folders."""
