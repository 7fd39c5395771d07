"""Readers: canonical views over Parquet and sectioned report text."""
