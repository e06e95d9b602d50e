"""Readers and writers: CSV with declared schema, Parquet, baseline profiles,
JSON records, fitted pipelines."""
