"""Partitioned Parquet writes and keyed merges."""
