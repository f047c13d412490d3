"""Readers and writers: raw CSV text in, Parquet tables out."""
