"""Readers: Parquet tables, text layouts and the custom binary layouts."""
