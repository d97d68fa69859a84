"""Readers: archives, delimited files, Parquet tables and stage reports."""
