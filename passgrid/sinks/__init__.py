"""Sinks: sharded Parquet tables, and rows into a database."""
