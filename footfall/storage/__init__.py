"""Parquet tables: partitioned writes and crash-safe replacement."""
